"""Minimax contiguous partition of ordered atomic groups into shards.

Groups of rows that must stay together are ordered by the hash of what they share. The smallest capacity for
which a greedy walk needs no more than the given shards is found by binary search, and the cuts follow it.

The groups stay on the executors. The search looks at their sizes summed over ranges of the hash, and asks for
finer sums only of ranges in which a cut may fall: every capacity still possible puts its i-th cut between two
known places. Ranges of one group are exact, so the search ends with the exact smallest capacity, having seen a
bounded number of sums whatever the number of groups. One group of any size is one range.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, names
from tidemark.session import stage

#: The first sums are over 2**16 ranges; a finer step cuts at most this many ranges by 2**10.
FIRST_BITS, STEP_BITS, RANGES = 16, 10, 256
#: Blocks of each shard in which slots are counted.
BLOCKS = 1024


class Sums:
    """Sizes of consecutive ranges of the hash: first value, shift of the range, size, number of groups."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.rows = sorted(rows)
        self.size = np.array([r[2] for r in self.rows], dtype=np.int64)
        self.upto = np.concatenate([[0], np.cumsum(self.size)])
        self.total = int(self.upto[-1])

    def greedy(self, capacity: int, shards: int, start: int = 0) -> list[int]:
        """Ends (in ranges) of the shards that a greedy walk fills; stuck at a range over the capacity."""
        ends, at = [], start
        for _ in range(shards):
            at = max(at, int(np.searchsorted(self.upto, self.upto[at] + capacity, "right")) - 1)
            ends.append(at)
        return ends

    def fits(self, capacity: int, shards: int, start: int = 0) -> bool:
        return start == len(self.rows) or shards > 0 and self.greedy(capacity, shards, start)[-1] == len(self.rows)

    def smallest(self, shards: int, low: int) -> int:
        """Binary search for the smallest capacity that fits, from `low` on."""
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle, shards) else (middle + 1, high)
        return low

    def open_ranges(self, shards: int) -> tuple[list[int], int]:
        """Ranges of several groups in which a cut of some still possible capacity may fall; the capacity found."""
        low = max(-(-self.total // shards), max((r[2] for r in self.rows if r[3] == 1), default=0))
        high = self.smallest(shards, low)
        found: set[int] = set()
        for i, end in enumerate(self.greedy(low, shards)[:-1], 1):
            last = int(np.searchsorted(self.upto, min(self.total, i * high), "right"))
            found.update(k for k in range(end, min(last, len(self.rows))) if self.rows[k][3] > 1)
        return sorted(found, key=lambda k: -self.rows[k][2]), high

    def cuts(self, shards: int, capacity: int) -> list[int]:
        """First hash of each shard after the first: as even as the capacity allows.

        A shard ends as soon as it has its share of what is left, if the rest still fits; else it is filled.
        """
        bounds, at = [], 0
        for left in range(shards, 1, -1):
            full = self.greedy(capacity, 1, at)[0]
            share = self.upto[at] + -(-(self.total - int(self.upto[at])) // left)
            even = min(full, int(np.searchsorted(self.upto, share, "left")))
            even = next((e for e in (even - 1, even) if e > at and abs(self.upto[e] - share) <= abs(self.upto[even] - share) and self.fits(capacity, left - 1, e)), full)
            at = even
            bounds.append(self.rows[at][0] if at < len(self.rows) else None)
        return bounds


def _summed(groups: DataFrame, shift: int) -> DataFrame:
    prefix = F.shiftright("h", shift)
    return groups.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))


def _first_of(prefix: int, shift: int) -> int:
    return prefix << shift


def cut_points(groups: DataFrame, shards: int) -> list[int | None]:
    """`groups`: one row for each atomic group, `h` (its place) and `size`. First `h` of shards 1, 2, ..."""
    shift = 64 - FIRST_BITS
    rows = [(_first_of(r.prefix, shift), shift, r["size"], r.n) for r in _summed(groups, shift).collect()]
    while True:
        sums = Sums(rows)
        if not sums.rows:
            return [None] * (shards - 1)
        wanted, capacity = sums.open_ranges(shards)
        if not wanted:
            return sums.cuts(shards, capacity)
        finer = {sums.rows[k][:2] for k in wanted[:RANGES]}
        rows = [r for r in sums.rows if r[:2] not in finer]
        for shift in {s for _, s in finer}:
            below = max(0, shift - STEP_BITS)
            prefixes = [first >> shift for first, s in finer if s == shift]
            found = _summed(groups.where(F.shiftright("h", shift).isin(prefixes)), below).collect()
            rows += [(_first_of(r.prefix, below), below, r["size"], r.n) for r in found]


def _shard(bounds: list[int | None]) -> Column:
    return sum((F.when(F.col("h") >= b, 1).otherwise(0) for b in bounds if b is not None), F.lit(0)).cast("int")


def shard_by_bytes(docs: DataFrame, shards: int = 8, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `size` (UTF-8 bytes of the text plus 1), `text_crc32`, `shard`, `slot` (0, 1, ... in a shard).

    Rows of equal text are one atomic group and share a shard; so do texts of equal 64-bit hash. The largest
    shard is as small as any contiguous cut of the groups, ordered by hash, allows. Null texts are one group of
    size 1 a row and crc 0, empty texts another. Repeated rows keep their number, each with a slot of its own.
    Shards may stay empty where there are fewer groups. Columns that are not kept play no part. Texts are read
    once; what is shuffled is sums by group, and the numbers of a row (no text).
    """
    kept = [f"k{i}" for i in range(len(keep))]
    raw = F.coalesce(col(text).cast("binary"), F.lit(b""))
    slim = docs.select(
        *[col(c).alias(k) for c, k in zip(keep, kept)],
        (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        # the hash of Spark passes over nulls: give them a place of their own
        F.when(col(text).isNull(), F.xxhash64(F.lit(-1))).otherwise(F.xxhash64(col(text))).alias("h"),
    )
    # the block spreads rows of one group, or of one key, evenly
    slim = stage(slim.withColumn("block", F.pmod(F.xxhash64(*kept, F.spark_partition_id()), F.lit(BLOCKS)).cast("int")), "shard-rows")
    groups = stage(slim.groupBy("h").agg(F.sum("size").alias("size")), "shard-groups")
    placed = slim.withColumn("shard", _shard(cut_points(groups, shards)))

    filled = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))  # at most shards x BLOCKS rows
    first = filled.selectExpr("shard", "block", "sum(n) OVER (PARTITION BY shard ORDER BY block) - n AS first")
    numbered = placed.selectExpr("*", f"row_number() OVER (PARTITION BY shard, block ORDER BY {', '.join(names(kept))}, h) - 1 AS within")
    out = numbered.join(first, ["shard", "block"])
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], "size", "text_crc32", "shard", (F.col("first") + F.col("within")).alias("slot")
    )
