"""JSON documents to columns, with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, names
from tidemark.functions.docs import CHANGED_AT, DATE_FIELD, DOC, ENVELOPE_KEY, KEY, OP, SEQ, is_wrapped_date


def prune_schema(schema: T.StructType, fields: Sequence[str]) -> T.StructType:
    """The part of a document schema that is used; fields left out are never parsed."""
    wanted = set(fields)
    return T.StructType([f for f in schema if f.name in wanted])


def parse_docs(envelopes: DataFrame, schema: T.StructType, fields: Sequence[str] | None = None) -> DataFrame:
    """Envelope columns (the key renamed, so it cannot clash with the document's own) and
    one column per document field. A field of the wrong type is NULL; text that is no
    JSON object gives a row of NULLs.
    """
    wanted = prune_schema(schema, fields) if fields is not None else schema
    lead = [OP] if OP in envelopes.columns else []
    return (
        envelopes.withColumn("doc", F.from_json(col(DOC), wanted))
        .withColumnRenamed(KEY, ENVELOPE_KEY)
        .select(*names([*lead, ENVELOPE_KEY, SEQ, CHANGED_AT]), "doc.*")
    )


def unwrap_dates(df: DataFrame, fields: Sequence[str] | None = None, to_timestamp: bool = False) -> DataFrame:
    """`{"$date": n}` to bare `n`, or to a timestamp. Without `fields`, every wrapped date."""
    dates = [f.name for f in df.schema if is_wrapped_date(f.dataType)] if fields is None else list(fields)

    def bare(name: str):
        value = col(name).getField(DATE_FIELD)
        return F.timestamp_millis(value) if to_timestamp else value

    return df.withColumns({name: bare(name) for name in dates}) if dates else df


def quarantine(parsed: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows with a document key, rows without): the second are NULL, malformed or keyless."""
    return parsed.where(col(key).isNotNull()), parsed.where(col(key).isNull())


def unreadable(schema: T.StructType, key: str = KEY) -> Column:
    """Whether an envelope has a document, but none that can be read: malformed, or without a key.

    A change without any document (a bare delete) is not one of them.
    """
    found = F.from_json(col(DOC), prune_schema(schema, [key])).getField(key)
    return col(DOC).isNotNull() & found.isNull()
