"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote(name: str) -> str:
    """Back-tick a column name, so that dots and `$` in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The top-level column of exactly this name."""
    return F.col(quote(name))


def names(columns: Sequence[str]) -> list[str]:
    """Quoted names, for `select`: far cheaper to send to the JVM than a Column each."""
    return [quote(c) for c in columns]


def type_sql(dtype: T.DataType) -> str:
    """A type as SQL reads it, with the names of nested fields quoted (`simpleString` leaves them bare)."""
    if isinstance(dtype, T.StructType):
        return f"struct<{', '.join(f'{quote(f.name)}: {type_sql(f.dataType)}' for f in dtype)}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{type_sql(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{type_sql(dtype.keyType)}, {type_sql(dtype.valueType)}>"
    return dtype.simpleString()


def columns_sql(fields: Sequence[T.StructField]) -> str:
    """Column definitions for CREATE TABLE and ADD COLUMNS."""
    return ", ".join(f"{quote(f.name)} {type_sql(f.dataType)}" for f in fields)


def any_null(columns: Sequence[str]) -> Column:
    return F.expr(any_null_sql(columns))


def any_null_sql(columns: Sequence[str]) -> str:
    return "(" + (" OR ".join(f"{quote(c)} IS NULL" for c in columns) or "false") + ")"


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype)
    return True


def row_hash_sql(schema: T.StructType) -> str:
    """64-bit hash of the whole row (maps cannot be hashed and are left out)."""
    hashable = [quote(f.name) for f in schema if orderable(f.dataType)]
    return f"xxhash64({', '.join(hashable)})" if hashable else "0L"


def zero_sql(columns: Sequence[str]) -> str:
    """Zero, but computed from the columns, so that the optimizer cannot fold it away.

    As one more join key on both sides it makes Spark shuffle a side that is grouped by the
    other keys already, instead of reusing that grouping; the adaptive skew join splits
    only sides that come straight out of a shuffle.
    """
    return f"pmod(xxhash64({', '.join(names(columns))}), 1L)"


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """Bucket number of a key: the one that Spark's own bucketed tables give it, on every cluster and in every run."""
    return F.pmod(F.hash(*names(columns)), F.lit(buckets)).cast("int")
