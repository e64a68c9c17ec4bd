import random

import pytest

from tidemark import keep_latest

SCHEMA = "k string, seq long, v string"


def run(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r) for r in keep_latest(df, ["k"], "seq", **options).collect())


ROWS = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 9, "m"), ("c", None, "n"), ("c", 3, "q")]


@pytest.mark.parametrize("method", ["join", "window"])
def test_ties_stay_and_nulls_go(spark, method):
    assert run(spark, ROWS, method=method) == [("a", 2, "y"), ("a", 2, "z"), ("c", 3, "q")]


@pytest.mark.parametrize("method", ["window", "max_by"])
def test_one_row(spark, method):
    assert run(spark, ROWS, ties="one", method=method) == [("a", 2, "z"), ("c", 3, "q")]
    by_other = [("a", 2, "y", 9), ("a", 2, "z", 1)]
    got = run(spark, by_other, SCHEMA + ", t int", ties="one", method=method, tie_breakers=["t"])
    assert got == [("a", 2, "y", 9)]


def test_text_sequence_compares_as_text(spark):
    assert run(spark, [("a", "9", "x"), ("a", "10", "y")], "k string, seq string, v string") == [("a", "9", "x")]


def test_forms_agree_when_the_sequence_is_unique(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(40)}", i, str(rng.random())) for i in range(2000)]
    rng.shuffle(rows)
    want = {}
    for k, s, v in rows:
        want[k] = max(want.get(k, (-1, "")), (s, v))
    expected = sorted((k, s, v) for k, (s, v) in want.items())
    for options in ({"method": "join"}, {"method": "window"}, {"ties": "one"}, {"ties": "one", "method": "max_by"}):
        assert run(spark, rows, **options) == expected


def test_hot_key_and_hot_ties(spark):
    """A third of all rows one key, a third ties of another: all ties come back."""
    rows = [("hot", i, "v") for i in range(3000)] + [("tied", 7, str(i)) for i in range(3000)]
    rows += [(f"k{i}", i, "v") for i in range(3000)]
    got = run(spark, rows)
    assert len(got) == 1 + 3000 + 3000 and ("hot", 2999, "v") in got


def test_wrong_combinations(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for options in ({"ties": "one", "method": "join"}, {"method": "max_by"}, {"ties": "some"}, {"method": "x"}):
        with pytest.raises(ValueError):
            keep_latest(df, ["k"], "seq", **options)


def test_window_form_prunes_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 k", "id seq")
    plan = keep_latest(df, ["k"], "seq", method="window")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_join_form_shuffles_whole_rows_once(spark):
    """Not ranked in a shuffle of its own first: the newest sequences are found from the key and sequence alone."""
    df = spark.range(1000).selectExpr("id % 3 k", "id seq", "sha2(string(id), 512) v")
    plan = keep_latest(df, ["k"], "seq")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("sha2") == 1
