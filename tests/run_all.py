"""All queries at one scale, with times: python tests/run_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.compare import check, connect  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                n = check(run(spark, sf_dir), con, oracle[name])
            else:
                n = run(spark, sf_dir).count()
            print(f"ok   {name:32s} {n:8d} rows {time.time() - start:6.2f}s", flush=True)
        except Exception as e:
            bad += 1
            print(f"FAIL {name:32s} {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
