"""What raw documents hold against what is declared of them. Each document is parsed once, as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, names
from tidemark.functions.docs import DOC, KEY
from tidemark.session import remove, scratch_dir, stage


def _kind(value: Column) -> Column:
    """`object`, `array`, or the type of a single value, in lower case."""
    found = F.schema_of_variant(value)
    short = F.when(found.startswith("OBJECT"), "object").when(found.startswith("ARRAY"), "array")
    return short.otherwise(F.lower(F.regexp_extract(found, r"^[A-Z_]+", 0)))


def field_paths(envelopes: DataFrame, doc: str = DOC) -> DataFrame:
    """`path`, `type`, `n`: every path in the documents with the types it comes with and how often.

    Names are joined by dots, and `[]` stands for the elements of an array: `audit[].date.$date`. A value that is null in
    the text has the type `void`. Text that is no JSON adds nothing, and neither does a document that is a single value.
    The texts are read and parsed once; each further level of nesting goes over what the one before it has left.
    """
    spark = envelopes.sparkSession
    opened = envelopes.select(F.lit("").alias("path"), F.try_parse_json(col(doc)).alias("value")).where(F.col("value").isNotNull())
    opened = opened.where(_kind(F.col("value")).isin("object", "array"))
    counts, folders = [], []
    while True:
        path = scratch_dir(spark, "paths")
        # objects give their fields by name, arrays their elements
        members = opened.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("pos", "key", "member"))
        name = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("key"))
        below = members.select(name.otherwise(F.concat("path", F.lit("."), "key")).alias("path"), F.col("member").alias("value"))
        level = stage(below.withColumn("type", _kind(F.col("value"))), path=path)
        folders.append(path)
        counts.append(level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n")))
        opened = level.where("type IN ('object', 'array')").select("path", "value")
        if opened.isEmpty():
            break
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.union(more)
    found = stage(whole.groupBy("path", "type").agg(F.sum("n").alias("n")), "paths")
    for path in folders:
        remove(spark, path)
    return found


def declared_paths(dtype: T.DataType, path: str = "") -> set[str]:
    """The paths of a declared schema, written as `field_paths` does; the inside of maps is not declared."""
    if isinstance(dtype, T.ArrayType):
        return {f"{path}[]"} | declared_paths(dtype.elementType, f"{path}[]")
    if isinstance(dtype, T.StructType):
        own = [(f"{path}.{f.name}" if path else f.name, f.dataType) for f in dtype]
        return {p for p, _ in own}.union(*[declared_paths(t, p) for p, t in own])
    return set()


def undeclared_fields(envelopes: DataFrame, schema: T.StructType, doc: str = DOC) -> DataFrame:
    """`path`, `type`, `n` of what the documents hold and the schema does not list."""
    declared = sorted(declared_paths(schema))
    return field_paths(envelopes, doc).where(~F.col("path").isin(declared))


#: JSON types that a declared type takes from a document, as `parse_docs` does; text takes all.
_TAKES = {
    T.BooleanType: ("BOOLEAN",),
    T.LongType: ("BIGINT",),
    T.IntegerType: ("BIGINT",),
    T.DoubleType: ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"),
}


def _step(value: Column, name: str, dtype: str = "variant") -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", dtype)


def _rejects(value: Column, dtype: T.DataType, path: str) -> Column:
    """Fields below `value` that are there, and not null, but do not become a value of their declared type."""
    none = F.array().cast("array<struct<field: string, found: string, text: string>>")
    found = F.schema_of_variant(value)
    there = value.isNotNull() & (found != "VOID")
    this = F.array(F.struct(F.lit(path).alias("field"), _kind(value).alias("found"), F.to_json(value).alias("text")))
    if isinstance(dtype, T.StructType):
        inner = [_rejects(_step(value, f.name), f.dataType, f"{path}.{f.name}" if path else f.name) for f in dtype]
        return F.when(~there, none).when(found.startswith("OBJECT"), F.concat(*inner)).otherwise(this)
    if isinstance(dtype, T.ArrayType):
        inner = F.flatten(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: _rejects(x, dtype.elementType, f"{path}[]")))
        return F.when(~there, none).when(found.startswith("ARRAY"), inner).otherwise(this)
    takes = _TAKES.get(type(dtype))
    if takes is None:
        return none
    fits = F.regexp_extract(found, r"^[A-Z]+", 0).isin(*takes)
    if isinstance(dtype, T.IntegerType):
        fits = fits & F.try_variant_get(value, "$", "int").isNotNull()
    return F.when(~there | fits, none).otherwise(this)


def field_rejects(envelopes: DataFrame, schema: T.StructType, keep: Sequence[str] = (KEY,), doc: str = DOC) -> DataFrame:
    """`keep` columns, `field`, `found`, `text`: each field of a document that is NULL after the parse though the text has
    a value for it, with the type and text of that value.

    Arrays are looked at element by element (`audit[].date`). A document that is no object is one reject without a field; one
    that is no JSON has neither type nor text. Missing documents and nulls in them are no rejects.
    """
    parsed = envelopes.select(*names(keep), col(doc).isNotNull().alias("__there"), F.try_parse_json(col(doc)).alias("__value"))
    unread = F.array(F.struct(F.lit("").alias("field"), F.lit(None).cast("string").alias("found"), F.lit(None).cast("string").alias("text")))
    wrong = F.when(F.col("__there") & F.col("__value").isNull(), unread).otherwise(_rejects(F.col("__value"), schema, ""))
    return parsed.select(*names(keep), F.explode(wrong).alias("__r")).select(*names(keep), "__r.field", "__r.found", "__r.text")
