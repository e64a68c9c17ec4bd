"""Schema drift between the feed and the curated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, type_sql


#: Types that hold every value of a type; parquet files of the narrower one are read as the wider one.
_WIDER = {
    T.NullType: (T.DataType,),
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def merge_types(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """A type that takes the values of both. Structs have the fields of `old` in their order, then what `new` adds,
    at every depth, also in arrays and maps; single values take the wider type. A TypeError names the path where
    neither type holds the values of the other."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        ours, theirs = {f.name: f.dataType for f in old}, {f.name: f.dataType for f in new}
        both = [(n, merge_types(t, theirs[n], f"{path}.{n}" if path else n) if n in theirs else t) for n, t in ours.items()]
        return T.StructType([T.StructField(n, t) for n, t in [*both, *((n, t) for n, t in theirs.items() if n not in ours)]])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merge_types(old.elementType, new.elementType, f"{path}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key = merge_types(old.keyType, new.keyType, f"{path}.key")
        return T.MapType(key, merge_types(old.valueType, new.valueType, f"{path}.value"))
    if old == new:
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if isinstance(new, _WIDER.get(type(old), ())):
        return new
    if isinstance(old, _WIDER.get(type(new), ())):
        return old
    raise TypeError(f"{path or 'the value'}: {old.simpleString()} and {new.simpleString()} have no common type")


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """`value` as the type `want`: fields of structs go by their names at every depth, missing ones are NULL, others
    are left out. (A cast goes by their places, and fails where their number differs.)"""
    if type_sql(have) == type_sql(want):
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name: f.dataType for f in have}
        fields = [
            (conform(value.getField(f.name), there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: conform(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: conform(v, have.valueType, want.valueType))
    return value.cast(want)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, and inside structs, arrays and maps exactly its fields: missing ones as typed
    NULLs, others cast or dropped."""
    have = {f.name: f.dataType for f in df.schema}

    def aligned(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return conform(col(field.name), have[field.name], field.dataType).alias(field.name)

    return df.select(*[aligned(f) for f in schema])


def dropped_fields(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Drift report: each column the table does not take, with its number of filled rows.

    One pass, one aggregation row; the report has one row per column.
    """
    extra = [c for c in df.columns if c not in set(kept)]
    if not extra:
        return df.sparkSession.createDataFrame([], "field string, filled bigint")
    counts = df.agg(*[F.count(col(c)).alias(c) for c in extra])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), col(c).alias("filled")) for c in extra])
    return counts.select(F.explode(pairs).alias("p")).select("p.field", "p.filled")
