"""Headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Feeds are landed as parquet envelopes before the clock starts. Each query runs once to
warm up and then `BENCH_RUNS` times (median); the result is computed whole and thrown away.
`python bench.py --plain` times the plain forms of the same steps for comparison: the
newest change by self-join, every step computed twice because of a preview, and a merge
as a full outer join that rewrites the whole table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from showcase import feeds  # noqa: E402
from tidemark import apply_changes, keep_latest, merge, parse_docs, replace_children, snapshot_to_rows, tune  # noqa: E402
from tidemark.operators.merge import no_repeats  # noqa: E402
from tidemark.plans.collections import REPORTS  # noqa: E402
from tidemark.plans.loads import changes_to_rows, is_small, merge_into, table_for  # noqa: E402
from tidemark.session import scratch_dir, stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# The newest orders, by share: the days before the last order date.
SHARES = {"1pct": 24, "10pct": 240, "50pct": 1200}


# The merge target is made so many times larger than the feed, by rows of other keys.
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]


def enlarged(df: DataFrame) -> DataFrame:
    if COPIES == 1:
        return df
    copy = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    key = F.expr("CASE WHEN copy = 1 THEN _id ELSE concat(_id, '-', copy) END")
    return df.withColumn("copy", copy).withColumn("_id", key).drop("copy")


def run_through(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def newest(changes: DataFrame, days: int) -> DataFrame:
    last = changes.agg(F.max("transact_change_timestamp")).first()[0]
    return changes.where(F.col("transact_change_timestamp") > F.lit(last) - F.expr(f"INTERVAL {days} DAYS"))


def whole(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    return parts[0].unionByName(parts[1])


def queries(spark: SparkSession) -> dict:
    events = feeds.event_feed(spark, SF_DIR)
    snapshot = feeds.report_snapshot(spark, SF_DIR)
    changes = feeds.report_changes(spark, SF_DIR)
    before = stage(snapshot_to_rows(REPORTS, snapshot), "bench-before")
    target = stage(enlarged(snapshot_to_rows(REPORTS, changes.drop("Op"))), "bench-target")
    out = {
        "keep_latest_join": lambda: run_through(keep_latest(events, method="join")),
        "keep_latest_window": lambda: run_through(keep_latest(events, method="window")),
        "keep_latest_max_by": lambda: run_through(keep_latest(events, ties="one", method="max_by")),
        "parse_docs": lambda: run_through(parse_docs(changes, REPORTS.doc_schema)),
        "flatten": lambda: run_through(snapshot_to_rows(REPORTS, snapshot)),
        "incremental_c1": lambda: run_through(apply_changes(REPORTS, before, changes)),
    }
    for share, days in SHARES.items():
        batch = stage(changes_to_rows(REPORTS, newest(changes, days)), f"bench-{share}")
        out[f"merge_{share}"] = lambda batch=batch: run_through(
            merge(target, batch, REPORTS.keys, small_source=is_small(batch), unique=no_repeats(batch, REPORTS.keys))
        )
        if share != "10pct":
            out[f"merge_{share}_shuffled"] = lambda batch=batch: run_through(
                merge(target, batch, REPORTS.keys, unique=no_repeats(batch, REPORTS.keys))
            )
            out[f"replace_children_{share}"] = lambda batch=batch: run_through(whole(replace_children(target, batch, ["_id"])))

    spec = REPORTS.with_(buckets=16)
    table = table_for(spark, spec, scratch_dir(spark, "bench-table"))
    table.create(target)
    few = stage(newest(changes, 24), "bench-few")
    number = iter(range(10**6))
    out["commit_1pct"] = lambda: merge_into(spec, table, few, f"bench-{next(number)}")
    on_read = spec.with_(on_read=True)
    waiting = table_for(spark, on_read, scratch_dir(spark, "bench-on-read"))
    waiting.create(target)
    out["append_1pct"] = lambda: merge_into(on_read, waiting, few, f"bench-{next(number)}")
    out["read_appended"] = lambda: run_through(waiting.read())
    out["read_table"] = lambda: run_through(table.read())
    return out


def plain(spark: SparkSession) -> dict:
    events = feeds.event_feed(spark, SF_DIR)
    snapshot = feeds.report_snapshot(spark, SF_DIR)
    changes = feeds.report_changes(spark, SF_DIR)
    before = stage(snapshot_to_rows(REPORTS, snapshot), "bench-before")
    target = stage(enlarged(snapshot_to_rows(REPORTS, changes.drop("Op"))), "bench-target")

    def rows(df):
        # a snapshot has one version of each document; changes are reduced by aggregate and join
        newest = keep_latest(df, method="join") if "Op" in df.columns else df
        return snapshot_to_rows(REPORTS, newest)

    def outer(t, s):
        keys = list(REPORTS.keys)
        s = s.select(*[F.col(c).alias(f"s_{c}") for c in s.columns], F.lit(True).alias("s_hit"))
        t = t.withColumn("t_hit", F.lit(True))
        both = t.join(s, [t[k] == s[f"s_{k}"] for k in keys], "full")
        both = both.where("NOT (coalesce(s_hit AND t_hit, false) AND coalesce(s_Op = 'D', false))")
        return both.select(*[F.when(F.col("s_hit"), F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in REPORTS.table_schema().names])

    def twice(df):
        df.count()
        run_through(df)

    out = {
        "keep_latest": lambda: run_through(keep_latest(events, method="join")),
        "flatten": lambda: twice(rows(snapshot)),
        "incremental_c1": lambda: run_through(outer(before, rows(changes))),
    }
    for share, days in SHARES.items():
        batch = stage(rows(newest(changes, days)), f"bench-{share}")
        out[f"merge_{share}"] = lambda batch=batch: run_through(outer(target, batch))
    few = stage(newest(changes, 24), "bench-few")
    out["commit_1pct"] = lambda: outer(target, rows(few)).write.parquet(scratch_dir(spark, "bench-full"))
    return out


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    make = plain if "--plain" in sys.argv else queries
    times = {}
    for name, once in make(spark).items():
        if ONLY and name not in ONLY:
            continue
        once()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            once()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "plain forms, total" if make is plain else "change feed operators, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
