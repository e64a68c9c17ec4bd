"""The newest change of every key.

Three forms, equal where the sequence is unique within a key:

* `join`   - aggregate the newest sequence per key, combined before the shuffle and of those
             columns alone; then semi-join the rows with it on key *and* sequence. Whole rows are
             shuffled once. Neither versions nor ties of a key meet in one task: versions are
             shuffled by their sequence, and the adaptive skew join splits a group of ties.
* `window` - rank within the key. One scan and one shuffle; Spark drops the rows that
             cannot win before the shuffle, so many versions of a key cost little. All
             ties of one key meet in one task.
* `max_by` - one row per key by aggregation, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import any_null, col, names, orderable
from tidemark.functions.docs import KEY, SEQ


def max_seq_per_key(df: DataFrame, keys: Sequence[str] = (KEY,), seq: str = SEQ) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.max(col(seq)).alias("max_seq"))


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = (KEY,),
    seq: str = SEQ,
    ties: str = "keep",
    method: str | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Rows at the newest sequence of their key; rows without key or sequence drop out.

    `ties="keep"` returns every row at the newest sequence, `ties="one"` exactly one,
    decided by `tie_breakers` (descending; default: all other columns in their order, so
    the choice does not depend on the row order). The default method is `join` for
    "keep" and `window` for "one": neither gathers a hot key in one task.
    """
    method = method or ("join" if ties == "keep" else "window")
    if ties not in ("keep", "one"):
        raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
    rows = df.where(~any_null([*keys, seq]))
    if method == "join":
        if ties == "one":
            raise ValueError("the join form keeps ties; use 'window' or 'max_by' for one row per key")
        return _by_join(rows, keys, seq)
    if method == "window":
        return _by_window(rows, keys, seq, ties, tie_breakers)
    if method == "max_by":
        if ties == "keep":
            raise ValueError("the max_by form gives one row per key; use 'join' or 'window' to keep ties")
        return _by_aggregate(rows, keys, seq, tie_breakers)
    raise ValueError(f"unknown method {method!r}")


def _breakers(df: DataFrame, keys: Sequence[str], seq: str, tie_breakers: Sequence[str] | None) -> list[Column]:
    if tie_breakers is None:
        tie_breakers = [f.name for f in df.schema if f.name not in (*keys, seq) and orderable(f.dataType)]
    return [col(c) for c in tie_breakers]


def _by_join(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    winners = max_seq_per_key(rows, keys, seq).withColumnRenamed("max_seq", seq)
    return rows.join(winners, [*keys, seq], "left_semi").select(*names(rows.columns))


def _by_window(rows, keys, seq, ties, tie_breakers) -> DataFrame:
    order = [col(seq).desc()]
    if ties == "one":
        order += [c.desc() for c in _breakers(rows, keys, seq, tie_breakers)]
    place = F.row_number() if ties == "one" else F.rank()
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return rows.withColumn("__place", place.over(window)).where("__place = 1").drop("__place")


def _by_aggregate(rows, keys, seq, tie_breakers) -> DataFrame:
    others = [c for c in rows.columns if c not in keys]
    order = F.struct(col(seq), *_breakers(rows, keys, seq, tie_breakers))
    newest = F.max_by(F.struct(*[col(c) for c in others]), order).alias("__newest")
    found = rows.groupBy(*[col(k) for k in keys]).agg(newest)
    return found.select(
        *[col(c) if c in keys else F.col("__newest").getField(c).alias(c) for c in rows.columns]
    )
