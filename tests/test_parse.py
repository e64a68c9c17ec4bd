import pytest
from pyspark.sql import Row

from tidemark import flatten, parse_docs, quarantine, unwrap_dates
from tidemark.functions.docs import DATE, FLAG, LONG, OID, TEXT, list_of, record
from tidemark.sources.envelope import envelope_schema

FIELDS = record(_id=TEXT, n=LONG, b=FLAG, at=DATE, kids=list_of(s=TEXT))


def parse(spark, *docs, fields=None, schema=FIELDS):
    rows = [("U", str(i), i, None, d) for i, d in enumerate(docs)]
    df = parse_docs(spark.createDataFrame(rows, envelope_schema()), schema, fields)
    return [r.asDict() for r in df.orderBy("transact_seq").collect()]


@pytest.mark.parametrize("text", [None, "", "{broken", '{"_id":"a","n":1', "[]", '[{"_id":"a"}, {"_id":"b"}]'])
def test_no_document_gives_nulls(spark, text):
    (row,) = parse(spark, text)
    assert row["_orig_id"] == "0" and all(row[f] is None for f in FIELDS.names)


@pytest.mark.parametrize(
    "text, field, value",
    [
        ('{"_id":"a","n":"5"}', "n", None),
        ('{"_id":"a","n":1.5}', "n", None),
        ('{"_id":"a","b":"yes"}', "b", None),
        ('{"_id":"a","at":"2020-01-01"}', "at", None),
        ('{"_id":"a","at":{"$date":{"$numberLong":"5"}}}', "at", Row(**{"$date": None})),
        ('{"_id":"a","at":{"$date":5}}', "at", Row(**{"$date": 5})),
        ('{"_id":"a","kids":"x"}', "kids", None),
        ('{"_id":"a","kids":[{"s":"x"}, 3]}', "kids", None),
        ('{"_id":"a","kids":[]}', "kids", []),
        ('{"_id":"a","kids":[null]}', "kids", [None]),
        ('{"_id":"a","n":1,"n":2}', "n", 2),
        ('{"_id":"a","extra":1,"n":3}', "n", 3),
        ('{"_id":"a","n":3} trailing', "n", 3),
    ],
)
def test_one_field(spark, text, field, value):
    (row,) = parse(spark, text)
    assert row["_id"] == "a" and row[field] == value


def test_object_under_text_and_case(spark):
    first, second = parse(spark, '{"_id":{"$oid":"zz"}}', '{"_ID":"a"}')
    assert first["_id"] == '{"$oid":"zz"}' and second["_id"] is None


def test_fields_left_out_are_not_columns(spark):
    (row,) = parse(spark, '{"_id":"a","n":1}', fields=["_id"])
    assert list(row) == ["Op", "_orig_id", "transact_seq", "transact_change_timestamp", "_id"]


def test_json_is_parsed_once(spark):
    rows = spark.createDataFrame([("U", "1", 1, None, "{}")], envelope_schema())
    plan = parse_docs(rows, FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_quarantine(spark):
    rows = [("U", str(i), i, None, d) for i, d in enumerate(['{"_id":"a"}', "{bad", None, '{"n":1}'])]
    good, bad = quarantine(parse_docs(spark.createDataFrame(rows, envelope_schema()), FIELDS))
    assert [r["_orig_id"] for r in good.collect()] == ["0"]
    assert sorted(r["_orig_id"] for r in bad.collect()) == ["1", "2", "3"]


def test_unwrap(spark):
    rows = spark.createDataFrame([("U", "1", 1, None, '{"_id":"a","at":{"$date":1000}}')], envelope_schema())
    parsed = parse_docs(rows, FIELDS)
    assert unwrap_dates(parsed).first()["at"] == 1000
    assert unwrap_dates(parsed, ["at"]).schema["at"].dataType == LONG
    assert unwrap_dates(parsed, to_timestamp=True).selectExpr("unix_millis(at) m").first()["m"] == 1000


def test_flatten_names_and_childless(spark):
    schema = record(_id=OID, kids=list_of(a=TEXT, kids=TEXT))
    docs = ['{"_id":{"$oid":"x"},"kids":[{"a":"1","kids":"k"},{"a":"2"}]}', '{"_id":{"$oid":"y"}}',
            '{"_id":{"$oid":"z"},"kids":[]}', '{"_id":{"$oid":"w"},"kids":[null]}']
    rows = spark.createDataFrame([("U", str(i), i, None, d) for i, d in enumerate(docs)], envelope_schema())
    parsed = parse_docs(rows, schema).select("_id", "kids")
    dotted = flatten(parsed, "kids", ["a", "kids"], "kids.")
    assert dotted.columns == ["_id", "kids.a", "kids.kids"]
    got = sorted((r[0][0], r[1] or "", r[2] or "") for r in dotted.collect())
    assert got == [("w", "", ""), ("x", "1", "k"), ("x", "2", ""), ("y", "", ""), ("z", "", "")]
    assert flatten(parsed, "kids", ["a", "kids"]).columns == ["_id", "a", "kids"]
    assert flatten(parsed, "kids", ["a"], "k_").columns == ["_id", "k_a"]
