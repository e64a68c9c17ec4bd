"""Running totals over sorted rows, spread over all tasks: no group and no order is gathered in one."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import map_rows
from tidemark.session import stage

PART = "__part"


def sort_out(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows in one order over all partitions; equal keys lie in one partition."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Sequence[str] = (), xors: Sequence[str] = ()
) -> DataFrame:
    """Adds `<value>_upto` for each of `sums` and `xors` (long): its total within the group as far as the row, itself included.

    The rows are sorted by range, a hot group over several partitions. Each partition adds up its own; what earlier ones
    hold of its first group is added from a table of one row a partition, which is all that reaches the driver.
    Group columns are long and without null.
    """
    before, places = df.columns, [df.columns.index(g) for g in group]
    values = [(before.index(v), np.add) for v in sums] + [(before.index(v), np.bitwise_xor) for v in xors]
    ends = [f"{v}_upto" for v in (*sums, *xors)]

    def totals(batches):
        part, seq = TaskContext.get().partitionId(), 0
        last, carried, head = None, np.zeros(len(values), np.int64), True
        for columns in batches:
            n = len(columns[0])
            keys = np.array([columns[i] for i in places], np.int64).reshape(len(places), n)
            starts = np.zeros(n, bool)
            starts[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            starts[0] = last is not None and bool((keys[:, 0] != last).any())
            start = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            out = []
            for j, (i, add) in enumerate(values):
                upto = add.accumulate(np.array(columns[i], np.int64))
                earlier = np.concatenate([[0], upto])[np.maximum(start, 0)]
                own = upto - earlier if add is np.add else upto ^ earlier
                out.append(np.where(start >= 0, own, add(upto, carried[j])))
            heads = head & (start < 0)
            head, last, carried = bool(heads[-1]), keys[:, -1].copy(), np.array([o[-1] for o in out], np.int64)
            yield [*columns, *(pa.array(o) for o in out), [part] * n, list(range(seq, seq + n)), heads.tolist()]
            seq += n

    ddl = ", ".join([*[f"{e} long" for e in ends], f"{PART} int", "__seq long", "__head boolean"])
    local = stage(map_rows(sort_out(df, [*group, *order]), len(before), ddl, totals), "running")

    key = F.struct(*group, F.lit(0))
    final = F.max_by(F.struct(key.alias("key"), F.array(*ends).alias("totals"), "__head"), "__seq")
    carried, known, add = [0] * len(ends), None, [(lambda a, b: a + b)] * len(sums) + [(lambda a, b: a ^ b)] * len(xors)
    rows = []
    for r in local.groupBy(PART).agg(F.min(key).alias("first"), final.alias("last")).orderBy(PART).collect():
        carried = carried if r["first"] == known else [0] * len(ends)
        rows.append((r[PART], *carried))
        mine = r["last"]["totals"]
        carried = [f(a, b) for f, a, b in zip(add, mine, carried)] if r["last"]["__head"] else mine
        known = r["last"]["key"]
    offsets = df.sparkSession.createDataFrame(rows, ", ".join([f"{PART} int", *[f"__o{j} long" for j in range(len(ends))]]))
    both = local.join(F.broadcast(offsets), PART)
    whole = [
        F.when(F.col("__head"), F.col(e) + F.col(f"__o{j}") if j < len(sums) else F.col(e).bitwiseXOR(F.col(f"__o{j}"))).otherwise(F.col(e)).alias(e)
        for j, e in enumerate(ends)
    ]
    return both.select(*before, *whole)
