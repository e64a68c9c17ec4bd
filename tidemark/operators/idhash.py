"""Mapping table from (document id, child id) to a hashed id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.operators.merge import merge


def hashed(value: Column) -> Column:
    """SHA-256 in hex; NULL stays NULL."""
    return F.when(value.isNotNull(), F.sha2(value, 256))


def pair_text(first: Column, second: Column) -> Column:
    """One text for a pair, a different one for each pair: each part comes after its length, NULL is a mark.

    NULL where the first part is: a document without an id has no hash.
    """
    parts = [F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in (first.cast("string"), second.cast("string"))]
    return F.when(first.isNotNull(), F.concat(*parts))


def id_hash_mapping(
    rows: DataFrame, id_column: str = "_id", child_column: str = "patient__id", lookup: DataFrame | None = None
) -> DataFrame:
    """(id, patient_id, ehr_id_hash) of a curated table.

    The hashed text is made of the two ids, or comes from `lookup` (id, patient_id, value):
    a joined table takes the place of a call per row. A pair that the lookup has more than once raises.
    """
    ids = rows.select(col(id_column).alias("id"), col(child_column).alias("patient_id"))
    if lookup is None:
        return ids.withColumn("ehr_id_hash", hashed(pair_text(F.col("id"), F.col("patient_id"))))
    text = F.when(F.count("*") > 1, F.raise_error(F.lit("a pair of ids comes more than once in the lookup")).cast("string"))
    found = lookup.groupBy("id", "patient_id").agg(text.otherwise(F.first(F.col("value").cast("string"))).alias("__text"))
    # pairs with a NULL match nothing: they stay out of the join, where they would meet in one task
    whole = F.col("id").isNotNull() & F.col("patient_id").isNotNull()
    joined = ids.where(whole).join(found, ["id", "patient_id"], "left")
    hashes = joined.select("id", "patient_id", hashed(F.col("__text")).alias("ehr_id_hash"))
    return hashes.union(ids.where(~whole).withColumn("ehr_id_hash", F.lit(None).cast("string")))


def hash_mapping_merge(
    mapping: DataFrame,
    changed: DataFrame,
    id_column: str = "_id",
    child_column: str = "patient__id",
    rehash: bool = False,
    **options,
) -> DataFrame:
    """Merge changed rows into the mapping; keys are named differently on the two sides.

    `rehash` hashes the hash once more, for mappings whose changes were stored that way.
    """
    value = hashed(pair_text(col(id_column), col(child_column)))
    if rehash:
        value = hashed(value)
    return merge(
        mapping,
        changed,
        keys=[("id", id_column), ("patient_id", child_column)],
        mapping={"id": col(id_column), "patient_id": col(child_column), "ehr_id_hash": value},
        **options,
    )
