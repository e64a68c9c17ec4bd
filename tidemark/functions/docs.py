"""The JSON shapes of the change feed: wrapped dates, wrapped ids, envelopes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wrapper field names of the feed's extended JSON, its
# envelope columns and its operation code for a delete.
DATE_FIELD = "$date"
OID_FIELD = "$oid"
KEY, SEQ, CHANGED_AT, DOC, OP = "_id", "transact_seq", "transact_change_timestamp", "_doc", "Op"
ENVELOPE_KEY = "_orig_id"
DELETE = "D"



def record(**fields: T.DataType) -> T.StructType:
    """A document schema, fields in the order given."""
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def list_of(**fields: T.DataType) -> T.ArrayType:
    """An array of records."""
    return T.ArrayType(record(**fields))


TEXT, LONG, FLAG, REAL = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()
DATE = record(**{DATE_FIELD: LONG})
OID = record(**{OID_FIELD: TEXT})


def is_wrapped_date(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and dtype.fieldNames() == [DATE_FIELD]


def wrap_date(millis: Column) -> Column:
    return F.struct(millis.cast("long").alias(DATE_FIELD))


def wrap_oid(text: Column) -> Column:
    return F.struct(text.cast("string").alias(OID_FIELD))


def to_doc(fields: Mapping[str, Column]) -> Column:
    """JSON text of one document; NULL fields are left out, as the feed does."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def ntz_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without zone, whatever the session's zone is."""
    elapsed = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.call_function("div", elapsed, F.expr("INTERVAL '0.001' SECOND"))
