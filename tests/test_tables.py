"""Landing folders, stored tables, the run and the stream."""

import json
import os
import time
from threading import Barrier

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showcase.feeds import landed, write_landing
from tidemark import (
    BucketTable,
    CollectionSpec,
    RunError,
    align_to_schema,
    drop_database,
    drop_table,
    dropped_fields,
    initial_load,
    read_changes,
    read_full_load,
    read_unprocessed,
    record_files,
    register_parquet,
    run,
    save_table,
    stream_changes,
    table_exists,
    unprocessed_files,
)
from tidemark.functions.docs import DATE, LONG, TEXT, list_of, record
from tidemark.operators.merge import merge_colocated
from tidemark.plans.collections import ACCESS, COLLECTIONS, ERRORS, REPORTS, UPLOADS
from tidemark.plans.loads import BROADCAST_BYTES, is_small, merge_into, table_for
from tidemark.session import files_under, staged_bytes
from tidemark.sources.envelope import envelope_schema
from tidemark.sources.ledger import create_ledger

SPEC = CollectionSpec(
    name="things",
    doc_schema=record(_id=TEXT, n=LONG, kids=list_of(k=TEXT)),
    keys=("_id", "kid_k"),
    array="kids",
    child_fields=("k",),
    child_prefix="kid_",
    buckets=4,
)


def doc(key, n, *kids):
    inner = ",".join('{"k":"%s"}' % k for k in kids)
    return '{"_id":"%s","n":%d,"kids":[%s]}' % (key, n, inner)


def envelopes(spark, rows, with_op=True):
    return spark.createDataFrame(rows, envelope_schema(with_op))


def land(spark, folder, rows, basename, with_op=True):
    write_landing(envelopes(spark, rows, with_op).coalesce(1), folder, basename)


def contents(df):
    return sorted((r["_id"] or "", r["kid_k"] or "", r["n"], r["transact_seq"]) for r in df.collect())


@pytest.fixture
def place(tmp_path):
    return {k: str(tmp_path / k) for k in ("landing", "tables", "checkpoints")}


def snapshot(spark, place):
    rows = [("a", 1, None, doc("a", 1, "x", "y")), ("b", 1, None, doc("b", 1, "x")), ("c", 1, None, doc("c", 1))]
    land(spark, f"{place['landing']}/things", rows, "LOAD", with_op=False)


def test_scans_tell_files_by_name(spark, place):
    folder = f"{place['landing']}/things"
    snapshot(spark, place)
    land(spark, folder, [("d", 1, None, doc("d", 1))], "LOAD-second", with_op=False)
    land(spark, folder, [("U", "a", 2, None, doc("a", 2, "x"))], "load-lower")
    land(spark, folder, [("U", "b", 2, None, doc("b", 2, "x"))], "20240101")
    assert read_full_load(spark, folder).count() == 4
    assert sorted(r["_id"] for r in read_changes(spark, folder).collect()) == ["a", "b"]


@pytest.mark.parametrize("folder_name", ["things", "some things %20"])
def test_ledger(spark, place, tmp_path, folder_name):
    folder, ledger = f"{place['landing']}/{folder_name}", str(tmp_path / "ledger")
    create_ledger(spark, ledger)
    create_ledger(spark, ledger)
    land(spark, folder, [("U", "a", 2, None, doc("a", 2, "x"))], "one")
    land(spark, folder, [("s", 1, None, doc("s", 1))], "LOAD", with_op=False)
    record_files(unprocessed_files(spark, folder, ledger), ledger)
    assert unprocessed_files(spark, folder, ledger).count() == 0
    land(spark, folder, [("U", "b", 2, None, doc("b", 2, "x"))], "two")
    assert [r["_id"] for r in read_unprocessed(spark, folder, ledger).collect()] == ["b"]


def test_load_then_run_twice(spark, place):
    folder = f"{place['landing']}/things"
    snapshot(spark, place)
    changes = [("U", "a", 3, None, doc("a", 3, "x", "z")), ("U", "a", 2, None, doc("a", 2, "q")), ("D", "b", 2, None, doc("b", 2, "x"))]
    land(spark, folder, changes, "c1")
    table = run(spark, [SPEC], place["landing"], place["tables"], place["checkpoints"])["things"]
    expected = [("a", "x", 3, 3), ("a", "y", 1, 1), ("a", "z", 3, 3), ("c", "", 1, 1)]
    assert contents(table.read()) == expected
    before = table.properties()["tidemark.batch"]
    run(spark, [SPEC], place["landing"], place["tables"], place["checkpoints"])
    assert table.properties()["tidemark.batch"] == before, "nothing new, no batch"
    land(spark, folder, [("D", "a", 4, None, doc("a", 4, "y"))], "c2")
    run(spark, [SPEC], place["landing"], place["tables"], place["checkpoints"])
    assert contents(table.read()) == [r for r in expected if r[1] != "y"]


def test_replacing_children_through_the_stored_table(spark, place):
    spec = SPEC.with_(parents=("_orig_id",))
    snapshot(spark, place)
    table = initial_load(spark, spec, place["landing"], place["tables"])
    merge_into(spec, table, envelopes(spark, [("U", "a", 3, None, doc("a", 3, "z")), ("D", "b", 2, None, None)]), "1")
    assert contents(table.read()) == [("a", "z", 3, 3), ("c", "", 1, 1)]


def test_changes_without_full_load(spark, place):
    land(spark, f"{place['landing']}/things", [("U", "a", 2, None, doc("a", 2, "x"))], "c1")
    assert initial_load(spark, SPEC, place["landing"], f"{place['tables']}/things") is None
    with pytest.raises(Exception, match="full load never came"):
        run(spark, [SPEC], place["landing"], place["tables"], place["checkpoints"])


def test_missing_landing_folder_is_no_work(spark, place):
    os.makedirs(place["landing"])
    done = run(spark, [SPEC], place["landing"], place["tables"], place["checkpoints"])
    assert not done["things"].exists()


def test_a_batch_is_committed_once_and_only_in_its_buckets(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    change = envelopes(spark, [("U", "b", 2, None, doc("b", 2, "x"))])
    paths = lambda: {r[0] for r in table.read().select(F.input_file_name()).distinct().collect()}
    old = paths()
    assert merge_into(SPEC, table, change, "batch-1")
    assert not merge_into(SPEC, table, change, "batch-1")
    changed = {p.split("in_bucket=")[1].split("/")[0] for p in old ^ paths()}
    assert len(changed) == 1


def test_interrupted_batch_is_finished_by_the_next(spark, place, monkeypatch):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    before = contents(table.read())
    broken = table.read().withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken, {0, 1, 2, 3}, "bad")
    assert contents(table.read()) == before and not table.has_batch("bad")
    # the rows are written and noted, then the job dies: readers see nothing of it
    change = envelopes(spark, [("D", "b", 2, None, doc("b", 2, "x")), ("D", "none", 2, None, doc("none", 2, "x"))])
    reader = table.read()
    monkeypatch.setattr(BucketTable, "_show", lambda self, note: None)
    merge_into(SPEC, table, change, "half")
    assert contents(table.read()) == before
    monkeypatch.undo()
    forgotten = {r[0] for r in reader.select(F.input_file_name()).collect()}
    assert not merge_into(SPEC, table, change, "half"), "what was staged is written, and the batch is not merged again"
    assert contents(table.read()) == [("a", "x", 1, 1), ("a", "y", 1, 1), ("c", "", 1, 1), ("none", "x", 2, 2)]
    assert contents(reader) == before, "a reader that began before goes on reading what it saw"
    merge_into(SPEC, table, envelopes(spark, [("D", "b", 3, None, doc("b", 3, "x")), ("D", "none", 3, None, doc("none", 3, "x"))]), "later")
    there = {f for f, _ in files_under(spark, table.path)}
    assert not any(f in there for f in forgotten if "in_commit=1/in_bucket=1" in f), "files of two commits ago are removed"


def test_each_row_is_written_once(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    before = {f: n for f, n in files_under(spark, table.path) if f.endswith(".parquet")}
    merge_into(SPEC, table, envelopes(spark, [("U", "b", 2, None, doc("b", 2, "x"))]), "1")
    new = [f for f, _ in files_under(spark, table.path) if f.endswith(".parquet") and f not in before]
    assert len(new) == 1, "one file, for the one bucket"
    assert sum(r["files"] for r in table.files().collect()) == len(before)


def test_a_large_batch_is_merged_where_the_target_lies(spark, place):
    """Neither exchange nor sort of the target: it is stored in buckets of the key, and sorted."""
    rows = spark.range(40000).selectExpr("string(id) AS _id", "id AS n", "concat('k', id % 3) AS kid_k", "'o' AS _orig_id", "1L AS transact_seq", "current_timestamp() AS transact_change_timestamp")
    table = table_for(spark, SPEC, place["tables"] + "/many")
    table.create(rows)
    batch = rows.where("n % 2 = 0").selectExpr("* EXCEPT (transact_seq)", "2L AS transact_seq", "'U' AS Op")
    merged = merge_colocated(table.read(range(4)), batch, SPEC.keys, table.buckets)
    assert merged.count() == 40000 and merged.where("transact_seq = 2").count() == 20000
    plan = merged._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    scan = plan.index("Scan parquet", join)
    assert "Exchange" not in plan[join:scan], "the target stays where it lies"
    assert "Sort [" not in plan[join:scan], "the target comes sorted"


@pytest.mark.parametrize("spec", [REPORTS, ACCESS], ids=["dates", "dotted"])
def test_wrapped_dates_and_dotted_keys_in_a_stored_table(spark, place, spec):
    """Types with a `$` in them and keys with a dot: loaded, emptied bucket by bucket, found again, merged, widened."""
    spec = spec.with_(buckets=4, options={"insert_deletes": False})
    folder = f"{place['landing']}/{spec.name}"
    shape = {
        "reports": '{"_id":"%s","fromDate":{"$date":5},"patients":[{"_id":"p"}]}',
        "access": '{"_id":{"$oid":"%s"},"audit":[{"reportId":"r","date":{"$date":5}}]}',
    }[spec.name]
    text = lambda key: shape % key
    land(spark, folder, [(k, 1, None, text(k)) for k in "abcdefgh"], "LOAD", with_op=False)
    table = initial_load(spark, spec, place["landing"], f"{place['tables']}/{spec.name}")
    keys = lambda: sorted(r["_orig_id"] for r in table.read().collect())
    assert keys() == list("abcdefgh")
    gone = sorted(r["_orig_id"] for r in table.read([next(iter(table.buckets_of(table.read())))]).collect())
    merge_into(spec, table, envelopes(spark, [("D", k, 2, None, text(k)) for k in gone]), "empty a bucket")
    left = [k for k in "abcdefgh" if k not in gone]
    assert keys() == left
    drop_table(spark, table.name)
    drop_table(spark, table.rows_name)
    assert table.exists() and keys() == left and table.has_batch("empty a bucket")
    merge_into(spec, table, envelopes(spark, [("U", "z", 3, None, text("z"))]), "after")
    assert keys() == [*left, "z"]
    wider = spec.with_(doc_schema=T.StructType([*spec.doc_schema.fields, T.StructField("laterDate", DATE)]))
    grown = table_for(spark, wider, table.path)
    merge_into(wider, grown, envelopes(spark, [("U", "y", 4, None, text("y")[:-1] + ',"laterDate":{"$date":7}}')]), "wider")
    assert {r["_orig_id"]: r["laterDate"] for r in grown.read().where("laterDate IS NOT NULL").collect()} == {"y": (7,)}


def test_rows_outside_the_touched_buckets_are_refused(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    before = contents(table.read())
    with pytest.raises(ValueError, match="does not touch"):
        table.replace(table.read(), set(), "stray")
    assert contents(table.read()) == before


def test_files_do_not_pile_up(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    there = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    for i in range(2, 7):
        merge_into(SPEC, table, envelopes(spark, [("U", "b", i, None, doc("b", i, "x"))]), f"b{i}")
    assert max(r["files"] for r in table.files().collect()) == 1
    left = {d for d in os.listdir(spark.conf.get("spark.checkpoint.dir")) if d.startswith(("things-batch", "commit-"))}
    assert left <= there, "staged batches are removed"


def test_a_table_is_found_again_by_its_files(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    before = contents(table.read())
    drop_table(spark, table.name)
    assert table.exists() and contents(table.read()) == before


def test_emptied_table(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    nothing = table.read().limit(0)
    table.replace(nothing, {0, 1, 2, 3}, "clear")
    assert table.exists() and table.read().count() == 0 and table.read().columns == table.schema.names
    assert not BucketTable(spark, "tide_none.none", place["tables"] + "/none", table.schema, ["_id"], 4).exists()


def test_large_batches_take_the_shuffled_way(spark, place, monkeypatch):
    monkeypatch.setattr("tidemark.plans.loads.BROADCAST_BYTES", 0)
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    merge_into(SPEC, table, envelopes(spark, [("D", "b", 2, None, doc("b", 2, "x")), ("U", "n", 2, None, doc("n", 2, "x"))]), "1")
    assert contents(table.read()) == [("a", "x", 1, 1), ("a", "y", 1, 1), ("c", "", 1, 1), ("n", "x", 2, 2)]


def test_stream_in_small_batches_with_archive(spark, place, tmp_path):
    spec = SPEC.with_(options={"seq_guard": "transact_seq"})
    folder = f"{place['landing']}/things"
    snapshot(spark, place)
    table = initial_load(spark, spec, place["landing"], place["tables"])
    for i in (2, 3, 4):
        land(spark, folder, [("U", "a", i, None, doc("a", i, "x"))], f"c{i}")
    stream_changes(spark, spec, folder, table, place["checkpoints"], files_per_batch=1, archive=str(tmp_path / "archive"), timeout=120)
    assert ("a", "x", 4, 4) in contents(table.read())
    assert table.properties()["tidemark.batch"] >= "things-2", "a batch for each file"


def test_a_stream_out_of_time_raises(spark, place, monkeypatch):
    folder = f"{place['landing']}/things"
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    land(spark, folder, [("U", "a", 2, None, doc("a", 2, "x"))], "c")
    monkeypatch.setattr("tidemark.plans.loads.merge_into", lambda *a: time.sleep(30))
    with pytest.raises(TimeoutError):
        stream_changes(spark, SPEC, folder, table, place["checkpoints"], timeout=1)
    assert not spark.streams.active


def test_a_small_file_of_much_text_is_not_broadcast(spark, tmp_path):
    """Parents repeated over their children: 50 KB of file, 300 MB of text."""
    wide = spark.range(6000).selectExpr("id % 4 AS parent", "id AS child", "repeat(string(id % 4), 50000) AS text")
    wide.coalesce(1).write.parquet(str(tmp_path / "wide"))
    staged = spark.read.parquet(str(tmp_path / "wide"))
    assert staged_bytes(staged) < BROADCAST_BYTES and not is_small(staged)
    assert is_small(staged.select("parent", "child"))


def test_catalog(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"], name="tide_test.Things")
    assert table_exists(spark, "tide_test.things")
    merge_into(SPEC, table, envelopes(spark, [("D", "b", 2, None, doc("b", 2, "x"))]), "1")
    assert contents(spark.table("tide_test.things")) == [("a", "x", 1, 1), ("a", "y", 1, 1), ("c", "", 1, 1)]
    path = place["tables"] + "-flat"
    table.read().write.parquet(path)
    register_parquet(spark, "tide_test.flat", path)
    register_parquet(spark, "tide_test.flat", path)
    assert spark.table("tide_test.flat").count() == table.read().count()
    assert not table_exists(spark, "tide_test.nothing")
    drop_database(spark, "tide_test", cascade=True)
    assert not spark.catalog.databaseExists("tide_test")


def test_table_schemas(spark):
    sizes = {s.name: len(s.table_schema()) for s in COLLECTIONS}
    assert sizes == {"reports": 28, "uploads": 19, "access": 15, "errors": 8}
    assert REPORTS.table_schema()["completedTime"].dataType == LONG
    assert REPORTS.table_schema().names[-3:] == ["patient__id", "patient_numOfRetries", "patient_status"]
    assert ACCESS.table_schema().names[-1] == "audit.user"
    assert set(UPLOADS.change_fields()) == set(UPLOADS.table_schema().names[3:])
    assert ERRORS.table_schema().names[0] == "_orig_id"


def test_align_and_drift(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "a int, extra string, none string")
    aligned = align_to_schema(df, record(a=LONG, later=TEXT))
    assert aligned.schema.simpleString() == "struct<a:bigint,later:string>"
    assert sorted(tuple(r) for r in dropped_fields(df, ["a"]).collect()) == [("extra", 1), ("none", 0)]
    assert dropped_fields(df, df.columns).count() == 0


def test_empty_change_batch(spark, place):
    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], place["tables"])
    before = contents(table.read())
    merge_into(SPEC, table, envelopes(spark, []), "empty")
    assert contents(table.read()) == before
    assert table_for(spark, SPEC, place["tables"]).has_batch("empty")


def test_managed_table(spark, place):
    name = "tide_managed.things"
    drop_table(spark, name)
    save_table(spark.range(3), name)
    assert spark.table(name).count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        save_table(spark.range(3), name)
    drop_table(spark, name)
    assert not table_exists(spark, name)


def test_table_with_a_column_added_later(spark, place):
    snapshot(spark, place)
    initial_load(spark, SPEC, place["landing"], place["tables"])
    wider = SPEC.with_(doc_schema=record(_id=TEXT, n=LONG, kids=list_of(k=TEXT), later=TEXT))
    table = table_for(spark, wider, place["tables"])
    change = '{"_id":"b","n":2,"later":"new","kids":[{"k":"x"}]}'
    merge_into(wider, table, envelopes(spark, [("U", "b", 2, None, change)]), "1")
    assert {(r["_id"], r["later"]) for r in table.read().collect()} == {("a", None), ("b", "new"), ("c", None)}


def test_a_text_sequence(spark, place):
    spec = SPEC.with_(seq_type=TEXT, options={"seq_guard": "transact_seq"})
    schema = envelope_schema(True, TEXT)
    rows = [("U", "a", "0009", None, doc("a", 9, "x")), ("U", "a", "0010", None, doc("a", 10, "x"))]
    write_landing(spark.createDataFrame(rows[:1], schema).drop("Op"), f"{place['landing']}/things", "LOAD")
    write_landing(spark.createDataFrame(rows, schema), f"{place['landing']}/things", "c")
    table = run(spark, [spec], place["landing"], place["tables"], place["checkpoints"])["things"]
    assert contents(table.read()) == [("a", "x", 10, "0010")]


def test_deletes_are_remembered_in_any_order(spark, place):
    spec = SPEC.with_(options={"seq_guard": "transact_seq", "insert_deletes": False})
    snapshot(spark, place)
    batches = [
        [("U", "a", 7, None, doc("a", 7, "x"))],
        [("D", "a", 9, None, doc("a", 9, "x"))],
        [("U", "a", 11, None, doc("a", 11, "x")), ("D", "b", 5, None, doc("b", 5, "x"))],
        [("U", "b", 4, None, doc("b", 4, "x"))],
    ]
    results = []
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 3, 2)):
        path = f"{place['tables']}-{''.join(map(str, order))}"
        table = initial_load(spark, spec, place["landing"], path)
        for i in order:
            merge_into(spec, table, envelopes(spark, batches[i]), f"b{i}")
        results.append(contents(table.read()))
    assert results[0] == results[1] == results[2] == [("a", "x", 11, 11), ("a", "y", 1, 1), ("c", "", 1, 1)]


def test_only_new_files_are_opened(spark, place, tmp_path):
    folder, ledger = f"{place['landing']}/things", str(tmp_path / "ledger")
    create_ledger(spark, ledger)
    for i in range(4):
        land(spark, folder, [("U", f"k{i}", 2, None, doc(f"k{i}", 2, "x"))], f"old{i}")
    record_files(unprocessed_files(spark, folder, ledger), ledger)
    assert read_unprocessed(spark, folder, ledger).count() == 0
    land(spark, folder, [("U", "new", 2, None, doc("new", 2, "x"))], "new")
    found = read_unprocessed(spark, folder, ledger)
    assert len(found.inputFiles()) == 1 and found.first()["_id"] == "new"


def test_commit_counts(spark, place):
    spec = SPEC.with_(options={"seq_guard": "transact_seq"})
    snapshot(spark, place)
    table = initial_load(spark, spec, place["landing"], place["tables"])
    rows = [("U", "a", 2, None, doc("a", 2, "x", "new")), ("D", "b", 2, None, doc("b", 2, "x")), ("U", "c", 2, None, doc("c", 2))]
    merge_into(spec, table, envelopes(spark, rows), "1")
    assert table.counts() == {"inserted": 2, "updated": 1, "deleted": 1, "ignored": 0}, "c has a NULL key: its change is a row of its own"
    merge_into(spec, table, envelopes(spark, [("U", "a", 1, None, doc("a", 1, "x"))]), "older")
    assert table.counts() == {"inserted": 0, "updated": 0, "deleted": 0, "ignored": 1}
    merge_into(spec, table, envelopes(spark, []), "empty")
    assert ("a", "x", 2, 2) in contents(table.read())


@pytest.mark.parametrize("options", [{}, {"insert_deletes": False}, {"seq_guard": "transact_seq", "insert_deletes": False}])
def test_a_merge_of_outgrown_buckets_is_spread_over_more_tasks(spark, place, monkeypatch, options):
    """No task holds a bucket that is too large for one, or a batch's share of it; rows and counts are the same."""
    import tidemark.plans.loads as loads

    spec = SPEC.with_(buckets=1, options=options)
    folder = f"{place['landing']}/{spec.name}"
    land(spark, folder, [(k, 1, None, doc(k, i, "a", "b")) for i, k in enumerate("abcdef")], "LOAD", with_op=False)
    batch = [("U", "a", 2, None, doc("a", 20, "a", "z")), ("D", "b", 2, None, doc("b", 0, "a")), ("D", "y", 2, None, doc("y", 0, "a")), ("I", "n", 2, None, doc("n", 7)), ("U", "c", 0, None, doc("c", 9, "a"))]
    seen = {}
    real = loads.merge_colocated
    monkeypatch.setattr(loads, "merge_colocated", lambda t, s, k, partitions, **o: taken.append(partitions) or real(t, s, k, partitions, **o))
    for most in (loads.TASK_BYTES, 0):
        monkeypatch.setattr(loads, "TASK_BYTES", most)
        taken = []
        table = initial_load(spark, spec, place["landing"], f"{place['tables']}/{most}")
        assert merge_into(spec, table, envelopes(spark, batch), "one")
        rows = sorted((str(r["_id"]), str(r["kid_k"]), r["transact_seq"], r["n"]) for r in table.read().collect())
        seen[most] = rows, table.counts(), {r.in_bucket for r in table.files().collect()}
        assert taken == [None if most == 0 else 1]
    first, second = seen.values()
    assert first == second and first[1]["inserted"] and first[1]["updated"]


def test_a_failing_collection_does_not_hold_up_the_others(spark, place):
    snapshot(spark, place)
    land(spark, f"{place['landing']}/orphans", [("U", "a", 2, None, doc("a", 2, "x"))], "c")
    land(spark, f"{place['landing']}/things", [("U", "a", 2, None, doc("a", 2, "x"))], "c")
    with pytest.raises(RunError, match="orphans.*full load never came") as e:
        run(spark, [SPEC.with_(name="orphans"), SPEC], place["landing"], place["tables"], place["checkpoints"])
    assert list(e.value.failures) == ["orphans"] and ("a", "x", 2, 2) in contents(e.value.tables["things"].read())


def test_collections_run_at_once(spark, place, monkeypatch):
    """All threads are in their load at the same time, with pools of their own; a failing one is told by name."""
    from tidemark.plans import loads

    names, pools, meet = ["things", "others", "more"], {}, Barrier(3)
    for name in names:
        land(spark, f"{place['landing']}/{name}", [("U", "a", 2, None, doc("a", 2, "x"))], "c")
        if name != "more":
            land(spark, f"{place['landing']}/{name}", [("a", 1, None, doc("a", 1, "x"))], "LOAD", with_op=False)

    def together(spark, spec, *args, **kwargs):
        meet.wait(60)
        pools[spec.name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return initial_load(spark, spec, *args, **kwargs)

    monkeypatch.setattr(loads, "initial_load", together)
    with pytest.raises(RunError, match="more.*full load never came") as e:
        run(spark, [SPEC.with_(name=n) for n in names], place["landing"], place["tables"], place["checkpoints"], at_once=3)
    assert pools == {n: n for n in names} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert {n: contents(t.read()) for n, t in e.value.tables.items()} == {n: [("a", "x", 2, 2)] for n in names[:2]}
    with pytest.raises(ValueError, match="more than once"):
        run(spark, [SPEC, SPEC], place["landing"], place["tables"], place["checkpoints"])


@pytest.mark.parametrize("on_read", [False, True])
def test_a_large_snapshot_gets_more_buckets(spark, place, monkeypatch, on_read):
    """The tasks of a merge hold a bucket each, so a bucket may not grow with the table; the number stays with the table."""
    spec = SPEC.with_(on_read=on_read)
    folder = f"{place['landing']}/{spec.name}"
    land(spark, folder, [(f"k{i}", 1, None, doc(f"k{i}", i, "a", "b")) for i in range(200)], "LOAD", with_op=False)
    monkeypatch.setattr("tidemark.plans.loads.LANDED_BYTES", 100)
    table = initial_load(spark, spec, place["landing"], f"{place['tables']}/many")
    made = table.buckets
    assert made > 4 and max(r[0] for r in spark.table(table.name).select("in_bucket").distinct().collect()) > 3
    monkeypatch.undo()
    again = table_for(spark, spec, table.path, table.name)  # asks for 4
    batch = [(op, f"k{i}", 2, None, doc(f"k{i}", -i, "a")) for i, op in ((3, "U"), (5, "D"), (777, "I"))]
    assert merge_into(spec, again, envelopes(spark, batch), "one") and again.buckets == made
    got = {(r["_id"], r["kid_k"]): r["n"] for r in again.read().collect()}
    assert len(got) == 400 and got["k3", "a"] == -3 and got["k777", "a"] == -777 and ("k5", "a") not in got
    drop_table(spark, table.name)  # a catalog that has lost the view, and then the rows too
    assert again.exists() and again.read().count() == 400
    reloaded = initial_load(spark, spec, place["landing"], table.path, reload=True)
    assert reloaded.buckets == made and reloaded.read().count() == 400


def test_a_feed_that_comes_out_of_a_join_is_not_dealt_again(spark):
    build = lambda spark, sf_dir: spark.range(60).selectExpr("string(id) _id", "id transact_seq", "now() transact_change_timestamp", "'{}' _doc").repartition(3)
    for dealt, files in ((True, 3), (False, spark.sparkContext.defaultParallelism)):
        feed = landed(f"probe-{dealt}", dealt)(build)(spark, "nowhere")
        assert feed.count() == 60 and len(feed.inputFiles()) == files


def test_a_merge_of_reports_parses_its_table_once(spark):
    """The check for repeated keys and the join read what is staged, not the documents again."""
    from showcase import merges

    for query in (merges.merge_delete, merges.merge_insert_deletes_off):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "full" in plan.lower() and "from_json" not in plan


def test_feeds_of_orders_share_their_grouped_lines(spark, monkeypatch):
    from showcase import feeds

    built = []
    real = feeds.order_lines
    monkeypatch.setattr(feeds, "order_lines", lambda *a: built.append(a) or real(*a))
    monkeypatch.setattr(feeds, "_LANDED", {})
    sizes = [f(spark, "/root/testdata/sf0.001").count() for f in (feeds.report_snapshot, feeds.report_changes, feeds.upload_snapshot)]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    before = orders.where(feeds.ORDERS_BEFORE).count()
    assert sizes == [before, orders.count(), before] and len(built) == 1


def test_feeds_are_built_of_one_list_of_lines(spark, tmp_path):
    """Uploads of the kept lines of an order, whether it comes twice, has lines without a number, or none that stay."""
    from showcase import feeds

    folder = str(tmp_path)
    orders = [(1, 7, "O", "1996-01-02", "1-URGENT"), (2, 7, "F", "1997-05-01", None), (4, None, "O", "1995-02-02", "2-HIGH"), (None, 9, "O", "1995-02-03", None)]
    orders += 2 * [(3, 8, "P", "1998-03-04", "5-LOW")]
    lines = [(1, 1, "N"), (1, 1, "R"), (1, 2, "R"), (2, 1, "A"), (2, None, "N"), (3, 3, None), (3, 4, "N"), (3, 4, "N"), (None, 1, "N"), (9, 1, "N")]
    orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, d string, o_orderpriority string")
    orders.selectExpr("* except (d)", "d::timestamp_ntz AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    ups = [json.loads(r["_doc"]) for r in feeds.upload_changes(spark, folder).collect()]
    got = sorted((d["_id"], str(d.get("fileName")), d["inputType"], d.get("uploadStatus")) for d in ups)
    # by order and number: 1-1 keeps one line of two, 2 keeps both, and 3-4 (two lines) is there for each of the two equal orders
    assert got == [("1", "line-1", "N", None), ("2", "None", "N", None), ("2", "line-1", "A", None)] + 2 * [("3", "line-4", "N", "repeated")]
    lines = {(r.o_orderkey, tuple(sorted((str(x["_id"]), x["numOfRetries"], x["status"]) for x in r.lines_2 or []))) for r in feeds.orders_with_lines(spark, folder).collect()}
    assert lines == {(1, (("1", 1, "N"),)), (2, (("1", 1, "A"), ("None", 1, "N"))), (3, (("4", 2, "N"),)), (4, ()), (None, ())}


def test_a_feed_that_nobody_wrote_is_landed_without_a_copy(spark, tmp_path):
    from showcase import feeds

    folder = str(tmp_path)
    spark.createDataFrame([(i, f"https://a.org/{i}", "x" * i) for i in range(9)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    fresh = sorted(map(tuple, feeds.error_changes.fresh(spark, folder).collect()))
    assert len(fresh) == 9 and not [k for k in feeds._LANDED if folder in k]
    assert fresh == sorted(map(tuple, feeds.error_changes(spark, folder).collect())) and [k for k in feeds._LANDED if folder in k]
    assert "error_changes-" in feeds.error_changes.fresh(spark, folder).inputFiles()[0]  # now there is one


def test_documents_are_not_shuffled_to_find_the_newest(spark, tmp_path, monkeypatch):
    import tidemark.plans.loads as loads
    from tidemark import keep_latest

    def written(rows, name):
        envelopes(spark, rows).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def exchanged(df):
        df.collect()
        return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line and "_doc" in line]

    once = [("U", f"k{i}", 2, None, f"d{i}") for i in range(50)] + [("U", "tie", 2, None, "a"), ("U", "tie", 2, None, "b"), ("U", None, 3, None, "n"), ("U", "q", None, None, "n")]
    few = once + [("U", "k1", 1, None, "old"), ("D", "k2", 5, None, "new"), ("U", "k2", 5, None, "new too")]
    same = {}
    for name, rows in (("once", once), ("few", few)):
        df = written(rows, name)
        want = sorted(map(str, keep_latest(df).collect()))
        newest = loads.newest_changes(df)
        assert sorted(map(str, newest.collect())) == want and not exchanged(newest)
        same[name] = df, want
    monkeypatch.setattr(loads, "BROADCAST_BYTES", 0)
    df, want = same["few"]
    assert sorted(map(str, loads.newest_changes(df).collect())) == want
    assert len(same["once"][1]) == 52 and len(want) == 53


def test_tables_and_batches_lie_compressed(spark, place):
    import pyarrow.parquet as pq

    snapshot(spark, place)
    table = initial_load(spark, SPEC, place["landing"], f"{place['tables']}/things")
    files = [f.removeprefix("file:") for f, _ in files_under(spark, table.path) if f.endswith(".parquet")]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
