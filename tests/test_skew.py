"""A third of all rows in one group: the shuffled joins split it, and lose nothing."""

import pytest
from pyspark.sql import functions as F

from tidemark import keep_latest, merge, replace_children

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def skewed(plan):
    return "skew=true" in plan


def rows(spark, n=60000):
    """Every third row has the key `hot`; text that does not compress gives the rows size."""
    return spark.range(0, n, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END id", "'1' kid", "5L + id % 3 transact_seq", "sha2(string(id), 512) v"
    )


def test_ties_of_a_hot_key_are_split(shuffled):
    got, plan = final_plan(keep_latest(rows(shuffled), ["id"], "transact_seq"))
    assert len(got) == 60000 and skewed(plan)


def test_copies_in_the_target_are_split(shuffled):
    source = shuffled.createDataFrame([("U", "hot", "1", 6, "new")], "Op string, id string, kid string, transact_seq long, v string")
    got, plan = final_plan(merge(rows(shuffled), source, ["id", "kid"]))
    assert len(got) == 60000 and skewed(plan)
    assert sum(r["v"] == "new" for r in got) == 20000


def test_a_parent_with_very_many_children_is_split(shuffled):
    source = shuffled.createDataFrame([("U", "hot", "1", 6, "new")], "Op string, id string, kid string, transact_seq long, v string")
    kept, added = replace_children(rows(shuffled), source, ["id"])
    got, plan = final_plan(kept)
    assert len(got) == 40000 and skewed(plan) and added.count() == 1


def test_rows_without_a_key_are_spread(shuffled):
    target = rows(shuffled).withColumn("id", F.expr("nullif(id, 'hot')"))
    source = shuffled.createDataFrame([("U", "k1", "1", 6, "new")], "Op string, id string, kid string, transact_seq long, v string")
    merged = merge(target, source, ["id", "kid"])
    got, plan = final_plan(merged)
    assert len(got) == 60000 and sum(r["v"] == "new" for r in got) == 1
    # Spread by a hash of the row, so no partition is skewed to begin with.
    assert not skewed(plan)
