"""Several arrays at several levels to tables, and types that grow inside."""

import pytest
from pyspark.sql import types as T

from tests.test_tables import envelopes, land
from tidemark import CollectionSpec, align_to_schema, flatten_levels, initial_load, merge_into, merge_types
from tidemark.functions.docs import DATE, LONG, REAL, TEXT, list_of, record
from tidemark.plans.loads import table_for
from tidemark.sources.tables import drop_table

NESTED = "id int, name string, orders array<struct<no: int, lines: array<struct<k: string>>, tags: array<string>>>, flags array<int>"
ROWS = [
    (1, "both", [(10, [("a",), ("b",)], ["x"]), (11, [], None)], [7, None]),
    (2, "empty", [], []),
    (3, "none", None, None),
    (4, "nested empty", [(12, None, []), None, (13, [None, ("c",)], ["y"])], [8]),
]
LEVELS = ["orders.lines", "orders", "orders.tags", "flags"]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_levels(spark):
    tables = flatten_levels(spark.createDataFrame(ROWS, NESTED), ["id"], LEVELS)
    assert {p: t.columns for p, t in tables.items()} == {
        "": ["id", "name", "orders_n", "flags_n"],
        "orders": ["id", "orders_pos", "orders_no", "orders_lines_n", "orders_tags_n"],
        "flags": ["id", "flags_pos", "flags_value"],
        "orders.lines": ["id", "orders_pos", "lines_pos", "lines_k"],
        "orders.tags": ["id", "orders_pos", "tags_pos", "tags_value"],
    }
    assert as_rows(tables[""]) == [(1, "both", 2, 2), (2, "empty", 0, 0), (3, "none", None, None), (4, "nested empty", 3, 1)]
    assert as_rows(tables["orders"]) == [(1, 0, 10, 2, 1), (1, 1, 11, 0, None), (4, 0, 12, None, 0), (4, 1, None, None, None), (4, 2, 13, 2, 1)]
    assert as_rows(tables["orders.lines"]) == [(1, 0, 0, "a"), (1, 0, 1, "b"), (4, 2, 0, None), (4, 2, 1, "c")]
    assert as_rows(tables["orders.tags"]) == [(1, 0, 0, "x"), (4, 2, 0, "y")]
    assert as_rows(tables["flags"]) == [(1, 0, 7), (1, 1, None), (4, 0, 8)]


def test_levels_read_their_own_files_and_take_edge_cases(spark):
    df = spark.createDataFrame(ROWS, NESTED)
    tables = flatten_levels(df, ["id"], LEVELS)
    assert all("__level=" in f for f in tables["flags"].inputFiles())
    plan = tables["flags"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__level" in plan and "__e1" not in plan.split("ReadSchema")[1] and "Exchange" not in plan
    assert all(t.count() == 0 for t in flatten_levels(df.limit(0), ["id"], LEVELS).values())
    assert as_rows(flatten_levels(df.union(df), ["id"], ["flags"])["flags"]) == sorted(2 * [(1, 0, 7), (1, 1, None), (4, 0, 8)], key=repr)
    assert as_rows(flatten_levels(df, ["id"], [])[""].select("id")) == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError, match="no array"):
        flatten_levels(df, ["id"], ["orders.lines"])
    with pytest.raises(ValueError, match="twice"):
        flatten_levels(df.withColumnRenamed("id", "orders_no"), ["orders_no"], ["orders"])


def test_merge_types():
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("s", record(x=LONG)), T.StructField("l", list_of(k=TEXT))])
    new = T.StructType([T.StructField("l", list_of(n=LONG, k=TEXT)), T.StructField("s", record(y=DATE)), T.StructField("a", LONG)])
    assert merge_types(old, new).simpleString() == "struct<a:bigint,s:struct<x:bigint,y:struct<$date:bigint>>,l:array<struct<k:string,n:bigint>>>"
    assert merge_types(new, old)["a"].dataType == LONG, "the wider type stays"
    pair = lambda a, b: merge_types(T.MapType(TEXT, a), T.MapType(TEXT, b)).valueType
    assert pair(T.DecimalType(5, 2), T.DecimalType(6, 1)) == T.DecimalType(7, 2) and pair(T.NullType(), TEXT) == TEXT
    for a, b in [(LONG, TEXT), (LONG, REAL), (record(x=LONG), LONG), (T.DecimalType(38, 0), T.DecimalType(38, 38))]:
        with pytest.raises(TypeError, match="^l\\[\\]: .* no common type"):
            merge_types(record(l=T.ArrayType(a)), record(l=T.ArrayType(b)))


def test_align_goes_by_names_at_every_depth(spark):
    have = "s struct<b: int, a: string>, l array<struct<n: int, gone: int>>, m map<string, struct<x: int>>"
    rows = spark.createDataFrame([((1, "one"), [(5, 6), None], {"k": (3,)}), (None, None, None), ((2, None), [], {})], have)
    want = T._parse_datatype_string("s struct<a: string, b: bigint, c: string>, l array<struct<m: string, n: bigint>>, m map<string, struct<x: bigint, y: int>>")
    got = align_to_schema(rows, want)
    assert got.schema.simpleString() == want.simpleString()
    expected = [(("one", 1, None), [(None, 5), None], {"k": (3, None)}), (None, None, None), ((None, 2, None), [], {})]
    assert [tuple(r) for r in got.collect()] == expected


FIRST = record(_id=TEXT, at=record(city=TEXT), n=T.IntegerType(), kids=list_of(k=TEXT))
LATER = record(_id=TEXT, at=record(city=TEXT, zip=record(code=LONG)), n=LONG, kids=list_of(age=LONG, k=TEXT), new=TEXT)
OLD_DOC = '{"_id":"%s","at":{"city":"c"},"n":1,"kids":[{"k":"x"}]}'
NEW_DOC = '{"_id":"%s","at":{"city":"d","zip":{"code":9}},"n":5000000000,"kids":[{"k":"y","age":3}],"new":"w"}'


@pytest.mark.parametrize("on_read", [False, True])
def test_a_stored_table_gains_nested_fields(spark, tmp_path, on_read):
    spec = CollectionSpec(name="grow", doc_schema=FIRST, buckets=4, on_read=on_read)
    landing, path = str(tmp_path / "landing"), str(tmp_path / "table")
    land(spark, f"{landing}/grow", [(k, 1, None, OLD_DOC % k) for k in "abc"], "LOAD", with_op=False)
    table = initial_load(spark, spec, landing, path)
    merge_into(spec, table, envelopes(spark, [("U", "c", 2, None, OLD_DOC % "c")]), "before")
    later = spec.with_(doc_schema=LATER)
    grown = table_for(spark, later, path)
    merge_into(later, grown, envelopes(spark, [("U", "b", 3, None, NEW_DOC % "b"), ("I", "z", 3, None, NEW_DOC % "z")]), "later")
    old = {"at": {"city": "c", "zip": None}, "n": 1, "kids": [{"k": "x", "age": None}], "new": None}
    new = {"at": {"city": "d", "zip": {"code": 9}}, "n": 5000000000, "kids": [{"k": "y", "age": 3}], "new": "w"}

    def shown(t):
        return {r["_id"]: r.asDict(recursive=True) for r in t.read().select("_id", "at", "n", "kids", "new").collect()}

    assert shown(grown) == {k: {"_id": k, **row} for k, row in zip("abcz", [old, new, old, new])}
    assert spark.table(grown.name).where("at.zip.code = 9").count() == 2
    merge_into(later, grown, envelopes(spark, [("D", "z", 4, None, NEW_DOC % "z"), ("U", "a", 4, None, NEW_DOC % "a")]), "last")
    if on_read:
        grown.compact()
    # the catalog is lost, and a job with the newest schema finds the table by its files
    drop_table(spark, grown.name)
    drop_table(spark, grown.rows_name)
    again = table_for(spark, later, path)
    assert again.exists() and shown(again) == {k: {"_id": k, **row} for k, row in zip("abc", [new, new, old])}


def test_keys_and_single_values_without_a_common_type_are_refused(spark, tmp_path):
    spec = CollectionSpec(name="grow", doc_schema=record(_id=T.IntegerType(), n=LONG), buckets=2)
    landing, path = str(tmp_path / "landing"), str(tmp_path / "table")
    land(spark, f"{landing}/grow", [("1", 1, None, '{"_id":1,"n":2}')], "LOAD", with_op=False)
    table = initial_load(spark, spec, landing, path)
    with pytest.raises(ValueError, match="keys .*_id"):
        table_for(spark, spec.with_(doc_schema=record(_id=LONG, n=LONG)), path).widen()
    with pytest.raises(TypeError, match="n: bigint and string"):
        table_for(spark, spec.with_(doc_schema=record(_id=T.IntegerType(), n=TEXT)), path).widen()
    assert table.read().count() == 1
