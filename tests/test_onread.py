"""Tables whose batches wait beside them: the same as if each had been merged."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_tables import SPEC, contents, doc, envelopes, land, snapshot
from tidemark import initial_load
from tidemark.plans.loads import merge_into, table_for
from tidemark.session import files_under
from tidemark.sources.onread import OnReadTable
from tidemark.sources.tables import drop_table

ON_READ = SPEC.with_(on_read=True)


@pytest.fixture
def place(tmp_path):
    return {k: str(tmp_path / k) for k in ("landing", "tables", "checkpoints")}


def batches(seed, n):
    """Random upserts and deletes; some documents have no children, so their key has a NULL in it."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rows = {}
        for key in rng.sample("abcdefgh", 4):
            kids = rng.sample(["x", "y"], rng.randrange(3))
            rows[key] = (rng.choice("UUD"), key, i + 2, None, doc(key, i + 2, *kids))
        out.append(list(rows.values()))
    return out


@pytest.mark.parametrize("insert_deletes", [True, False])
def test_same_as_merging_each_batch(spark, place, insert_deletes):
    options = {} if insert_deletes else {"insert_deletes": False}
    snapshot(spark, place)
    merged = initial_load(spark, SPEC.with_(options=options), place["landing"], place["tables"] + "/merged")
    waiting = initial_load(spark, ON_READ.with_(options=options), place["landing"], place["tables"] + "/waiting")
    assert isinstance(waiting, OnReadTable)
    files = len([f for f, _ in files_under(spark, waiting.path) if f.endswith(".parquet")])
    for i, rows in enumerate(batches(3, 5)):
        merge_into(SPEC.with_(options=options), merged, envelopes(spark, rows), f"b{i}")
        assert merge_into(ON_READ.with_(options=options), waiting, envelopes(spark, rows), f"b{i}")
        assert not merge_into(ON_READ.with_(options=options), waiting, envelopes(spark, rows), f"b{i}"), "once"
        assert contents(waiting.read()) == contents(merged.read()), i
        if i == 2:
            assert len([f for f, _ in files_under(spark, waiting.path) if f.endswith(".parquet")]) == files, "no row is rewritten"
            waiting.compact({0, 1})
            assert contents(waiting.read()) == contents(merged.read())
    assert contents(waiting.read({2, 3})) == contents(merged.read({2, 3}))
    assert waiting.compact() and not waiting.compact()
    assert contents(waiting.read()) == contents(merged.read()) and waiting.has_batch("b4")
    merge_into(ON_READ.with_(options=options), waiting, envelopes(spark, []), "empty")
    assert contents(waiting.read()) == contents(merged.read())
    assert not waiting._stored_changes(), "what was folded in is removed by the commit after"


def test_neither_side_is_shuffled(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, ON_READ, place["landing"], place["tables"])
    merge_into(ON_READ, table, envelopes(spark, [("U", "b", 2, None, doc("b", 2, "x"))]), "1")
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan, plan


def test_a_job_that_dies_and_a_lost_catalog(spark, place, monkeypatch):
    snapshot(spark, place)
    table = initial_load(spark, ON_READ, place["landing"], place["tables"])
    before = contents(table.read())
    monkeypatch.setattr(OnReadTable, "_show", lambda self, note: None)
    merge_into(ON_READ, table, envelopes(spark, [("D", "b", 2, None, doc("b", 2, "x"))]), "half")
    assert contents(table.read()) == before, "written, but not shown"
    monkeypatch.undo()
    for name in (table.name, table.rows_name, table.changes_name):
        drop_table(spark, name)
    again = table_for(spark, ON_READ, place["tables"])
    assert again.exists() and again.has_batch("half")
    assert contents(again.read()) == [r for r in before if r[0] != "b"]


def test_what_cannot_wait_is_merged(spark, place):
    """Keys that come twice in a batch are refused as ever; a table with appended changes can be merged into."""
    snapshot(spark, place)
    table = initial_load(spark, ON_READ, place["landing"], place["tables"])
    merge_into(ON_READ, table, envelopes(spark, [("U", "a", 2, None, doc("a", 2, "x")), ("U", "n", 2, None, doc("n", 2, "x"))]), "1")
    twice = [("U", "a", 3, None, doc("a", 3, "x")), ("U", "a", 3, None, doc("a", 4, "x"))]
    with pytest.raises(Exception, match="several source rows"):
        merge_into(ON_READ, table, envelopes(spark, twice), "2")
    guarded = ON_READ.with_(options={"seq_guard": "transact_seq"})
    older = [("U", "n", 1, None, doc("n", 1, "x")), ("U", "a", 5, None, doc("a", 5, "x"))]
    merge_into(guarded, table_for(spark, guarded, place["tables"]), envelopes(spark, older), "3")
    assert {r for r in contents(table.read()) if r[1] == "x"} == {("a", "x", 5, 5), ("b", "x", 1, 1), ("n", "x", 2, 2)}
    assert table.read().where(F.col("n") > 4).count() == 1
