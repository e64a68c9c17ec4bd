"""The merge against a plain Python model, and each rule on its own."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import hash_mapping_merge, id_hash_mapping, merge, replace_children
from tidemark.operators.merge import no_repeats, unrepeated

T = "id string, kid string, transact_seq long, v string"
S = "Op string, " + T


def frames(spark, target, source):
    return spark.createDataFrame(target, T), spark.createDataFrame(source, S)


def out(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, target, source, **options):
    t, s = frames(spark, target, source)
    return out(merge(t, s, ["id", "kid"], **options))


def model(target, source, insert_deletes=True, null_safe=False, seq_guard=False):
    """Source keys that can match are unique."""
    def same(a, b):
        kid = a[1] == b[1] and (null_safe or a[1] is not None)
        return a[0] is not None and a[0] == b[0] and kid

    result = []
    for t in target:
        hit = [s for s in source if same(t, s[1:])]
        acts = bool(hit) and (not seq_guard or hit[0][3] > t[2])
        if not acts:
            result.append(t)
        elif hit[0][0] != "D":
            result.append(tuple(hit[0][1:]))
    for s in source:
        if not any(same(t, s[1:]) for t in target) and (insert_deletes or s[0] != "D"):
            result.append(tuple(s[1:]))
    return sorted(result, key=repr)


def random_case(seed):
    rng = random.Random(seed)
    ids, kids = ["a", "b", "c", "d", None], ["1", "2", None]
    target = [(rng.choice(ids), rng.choice(kids), rng.randrange(9), f"t{i}") for i in range(rng.randrange(12))]
    seen, source = set(), []
    for i in range(rng.randrange(12)):
        key = (rng.choice(ids), rng.choice(kids))
        if key in seen:
            continue
        seen.add(key)
        source.append((rng.choice(["D", "U", "I", None]), *key, rng.randrange(9), f"s{i}"))
    return target, source


@pytest.mark.parametrize(
    "options", [{}, {"insert_deletes": False}, {"null_safe": True}, {"seq_guard": True}, {"small": True}]
)
def test_against_model(spark, options):
    for seed in range(4):
        target, source = random_case(seed)
        o = dict(options)
        small = o.pop("small", False)
        expected = model(target, source, **o)
        if "null_safe" in o:
            o["null_safe"] = ["kid"]
        if "seq_guard" in o:
            o["seq_guard"] = "transact_seq"
        assert run(spark, target, source, small_source=small, **o) == expected, (seed, options)


def test_shuffled_joins_give_the_same(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for seed in (5, 6):
            target, source = random_case(seed)
            assert run(spark, target, source) == model(target, source)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_delete_of_absent_key_is_added_or_ignored(spark):
    source = [("D", "x", "1", 2, "s")]
    assert run(spark, [], source) == [("x", "1", 2, "s")]
    assert run(spark, [], source, insert_deletes=False) == []


def test_null_child_is_added_again_unless_null_safe(spark):
    target, source = [("x", None, 1, "t")], [("U", "x", None, 2, "s")]
    assert len(run(spark, target, source)) == 2
    assert run(spark, target, source, null_safe=["kid"]) == [("x", None, 2, "s")]


def test_target_copies_are_all_updated(spark):
    target = [("x", "1", 1, "t")] * 2
    assert run(spark, target, [("U", "x", "1", 2, "s")]) == [("x", "1", 2, "s")] * 2


def test_several_source_rows_for_one_target_row(spark):
    target = [("x", "1", 1, "t")]
    source = [("U", "x", "1", 2, "old"), ("U", "x", "1", 3, "new")]
    with pytest.raises(Exception, match="several source rows"):
        run(spark, target, source)
    assert run(spark, target, source, on_duplicate="latest") == [("x", "1", 3, "new")]
    # Nothing matched: both come in, or the newest.
    assert len(run(spark, [], source)) == 2
    assert run(spark, [], source, on_duplicate="latest") == [("x", "1", 3, "new")]
    # Rows without a key stand for themselves.
    keyless = [("U", None, "1", 2, "a"), ("U", None, "1", 2, "b")]
    assert len(run(spark, target, keyless, on_duplicate="latest")) == 3


def test_hot_source_key_and_hot_null_keys(spark):
    target = [("x", "1", 1, "t")] * 500 + [(None, None, 1, str(i)) for i in range(500)]
    source = [("U", "x", "1", i, f"s{i}") for i in range(2000)] + [("U", None, None, 5, str(i)) for i in range(2000)]
    got = run(spark, target, source, on_duplicate="latest")
    assert Counter(r[0] for r in got) == {"x": 500, None: 2500}
    assert {r[3] for r in got if r[0] == "x"} == {"s1999"}


def test_struct_keys(spark):
    schema = "_id struct<`$oid`: string>, v string"
    target = spark.createDataFrame([(("a",), "t"), ((None,), "t"), (None, "t")], schema)
    source = spark.createDataFrame([("U", ("a",), "s"), ("U", (None,), "s"), ("U", None, "s")], "Op string, " + schema)
    got = Counter((r[0], r[1]) for r in merge(target, source, ["_id"]).collect())
    oid = Row("$oid")
    assert got == {(oid("a"), "s"): 1, (oid(None), "s"): 1, (None, "t"): 1, (None, "s"): 1}


def test_mapping_and_renamed_keys(spark):
    t = spark.createDataFrame([("x", "1", 1, "t")], T)
    s = spark.createDataFrame([("U", "x", "1", 2, "s"), ("U", "y", "1", 2, "s")], "Op string, i string, k string, transact_seq int, w string")
    got = merge(t, s, [("id", "i"), ("kid", "k")], mapping={"id": "i", "transact_seq": "transact_seq", "v": F.upper("w")})
    assert out(got) == [("x", "1", 2, "S"), ("y", None, 2, "S")]
    assert got.schema["transact_seq"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        merge(t, s, ["id"], mapping={"nope": "w"})


def test_merging_twice_changes_nothing(spark):
    target, source = random_case(11)
    options = dict(null_safe=["kid"], insert_deletes=False)
    source = [s for s in source if s[1] is not None]
    once = run(spark, target, source, **options)
    assert run(spark, once, source, **options) == once


def test_batches_in_any_order_with_guard(spark):
    batches = [[("U", "a", "1", s, f"v{s}"), ("U", f"k{s}", "1", s, "v")] for s in (3, 1, 2)]
    results = []
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        state = []
        for i in order:
            state = run(spark, state, batches[i], seq_guard="transact_seq")
        results.append(state)
    assert results[0] == results[1] == results[2] and ("a", "1", 3, "v3") in results[0]


def test_replace_children(spark):
    target = [("a", "1", 1, "t"), ("a", "2", 1, "t"), ("b", "1", 1, "t"), ("c", "1", 5, "t"), (None, "1", 1, "t")]
    source = [("U", "a", "1", 2, "s"), ("D", "b", None, 2, None), ("U", "c", "9", 4, "s"), ("U", "n", "1", 4, "s")]
    t, s = frames(spark, target, source)
    kept, added = replace_children(t, s, ["id"])
    expected = [("a", "1", 2, "s"), ("c", "9", 4, "s"), ("n", "1", 4, "s"), (None, "1", 1, "t")]
    assert out(kept.unionByName(added)) == sorted(expected, key=repr)
    kept, added = replace_children(t, s, ["id"], seq_guard="transact_seq")
    expected = [("a", "1", 2, "s"), ("c", "1", 5, "t"), ("n", "1", 4, "s"), (None, "1", 1, "t")]
    assert out(kept.unionByName(added)) == sorted(expected, key=repr)


def test_empty_sides(spark):
    assert run(spark, [("a", "1", 1, "t")], []) == [("a", "1", 1, "t")]
    assert run(spark, [], []) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_source_never_shuffles_the_target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(1000).selectExpr("string(id) id", "'1' kid", "id transact_seq", "'t' v", "id extra").write.parquet(path)
    t = spark.read.parquet(path)
    s = spark.createDataFrame([("U", "5", "1", 2, "s")], S)
    plan = plan_of(merge(t, s, ["id", "kid"], small_source=True))
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    keys_only = [line for line in scans if "ReadSchema: struct<id:string,kid:string>" in line]
    assert len(scans) - len(keys_only) == 1, "whole rows are read once"
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "__s" in line or "__t" in line, "only keys and source rows are shuffled"


def test_hash_mapping(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", None)], "_id string, patient__id string")
    mapping = id_hash_mapping(rows)
    want = {c: hashlib.sha256(text.encode()).hexdigest() for c, text in (("1", "1:a1:1"), (None, "1:a-"))}
    assert {r["patient_id"]: r["ehr_id_hash"] for r in mapping.collect()} == want
    others = spark.createDataFrame([(None, "a"), ("1:a", "1"), ("a1", None)], "_id string, patient__id string")
    hashes = {r["ehr_id_hash"] for r in id_hash_mapping(others).collect()}
    assert None in hashes and len(hashes) == 3 and not hashes & set(want.values())
    changed = spark.createDataFrame([("D", "a", "1"), ("U", "b", "1")], "Op string, _id string, patient__id string")
    merged = hash_mapping_merge(mapping, changed)
    assert sorted((r["id"], r["patient_id"] or "") for r in merged.collect()) == [("a", ""), ("b", "1")]
    once = {r["id"]: r["ehr_id_hash"] for r in hash_mapping_merge(mapping.limit(0), changed).collect()}
    twice = {r["id"]: r["ehr_id_hash"] for r in hash_mapping_merge(mapping.limit(0), changed, rehash=True).collect()}
    assert hashlib.sha256(once["b"].encode()).hexdigest() == twice["b"]
    lookup = spark.createDataFrame([("a", "1", "secret")], "id string, patient_id string, value string")
    found = {r["patient_id"]: r["ehr_id_hash"] for r in id_hash_mapping(rows, lookup=lookup).collect()}
    assert found[None] is None and len(found["1"]) == 64
    with pytest.raises(Exception, match="more than once"):
        id_hash_mapping(rows, lookup=lookup.union(lookup)).collect()


def test_a_source_without_repeats_reads_the_target_twice(spark, tmp_path):
    """In the shuffled form: whole rows and keys, and no third scan for the check."""
    rows = "id long, v string, Op string, transact_seq long"
    spark.createDataFrame([(i, "old", "I", 1) for i in range(50)], rows).drop("Op").write.parquet(str(tmp_path / "target"))
    spark.createDataFrame([(i, "new", "U", 2) for i in range(40, 60)] + [(None, "new", "U", 2)], rows).write.parquet(str(tmp_path / "source"))
    target, source = spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "source"))
    assert no_repeats(source, ["id"]) and not no_repeats(source.union(source), ["id"])
    known, checked = merge(target, source, ["id"], unique=True), merge(target, source, ["id"])
    assert sorted(map(tuple, known.collect()), key=repr) == sorted(map(tuple, checked.collect()), key=repr)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = merge(target, source, ["id"], unique=True)._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sum("FileScan" in line and "/target" in line for line in plan.splitlines()) == 2


@pytest.mark.parametrize("options", [{}, {"insert_deletes": False}, {"null_safe": ["kid"]}, {"seq_guard": "transact_seq"}, {"mapping": {"id": "id", "kid": "kid", "v": "v"}}])
def test_sides_without_repeats_are_joined_once(spark, options):
    """One full outer join, each side's rows shuffled once, and the rows of the two-part merge."""
    kid = "nullif(string(id % 3), '0') kid"
    target = spark.range(0, 90, 1, 4).selectExpr("CASE WHEN id % 10 < 9 THEN string(id) END id", kid, "3L transact_seq", "'old' v", "id n")
    some = "CASE WHEN id % 5 = 0 THEN 'D' WHEN id % 5 = 1 THEN 'I' ELSE 'U' END Op"
    source = spark.range(60, 150, 1, 4).selectExpr(some, "CASE WHEN id % 10 < 9 THEN string(id) END id", kid, "2L + id % 3 transact_seq", "'new' v", "-id n")
    checked = unrepeated(target, source, ["id", "kid"], options.get("null_safe", ()))
    assert checked == {"unique": True, "unique_target": True}
    once = merge(target, source, ["id", "kid"], **checked, **options)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "FullOuter" in plan
    in_parts = merge(target, source, ["id", "kid"], **options)
    assert once.columns == in_parts.columns
    assert sorted(map(repr, once.collect())) == sorted(map(repr, in_parts.collect()))


def test_repeats_are_found_on_either_side(spark):
    one = spark.createDataFrame([("a", None), ("b", None)], "id string, kid string")
    two = spark.createDataFrame([("a", None), ("a", None)], "id string, kid string")
    keys = ["id", "kid"]
    assert unrepeated(one, two, keys) == {"unique": True, "unique_target": True}  # NULL keys match nothing
    assert unrepeated(one, two, keys, ["kid"]) == {"unique": False, "unique_target": False}
    assert unrepeated(two, one, keys, ["kid"]) == {"unique": True, "unique_target": False}
    assert unrepeated(one.selectExpr("id i"), two.selectExpr("id j"), [("i", "j")]) == {"unique": False, "unique_target": False}
