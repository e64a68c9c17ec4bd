"""Raw documents against declared schemas."""

from tidemark import field_paths, field_rejects, undeclared_fields
from tidemark.functions.docs import DATE, LONG, TEXT, list_of, record

DOCS = [
    '{"a":1,"b":{"$date":5},"c":[{"x":"t"},{"x":1,"y":null}],"d.e":true}',
    '{"a":"12","b":7,"c":{"x":1}}',
    "{broken",
    '[1,{"q":2}]',
    "5",
    None,
    '{"a":1.5,"b":{"$date":"z"},"c":[3,{"x":[1]}],"n":null}',
    '{"a":99999999999999999999}',
    "{}",
]
SCHEMA = record(a=LONG, b=DATE, c=list_of(x=TEXT, y=LONG))


def docs(spark):
    return spark.createDataFrame([(str(i), d) for i, d in enumerate(DOCS)], "_id string, _doc string")


def test_paths(spark):
    found = {(r.path, r.type): r.n for r in field_paths(docs(spark)).collect()}
    assert found["a", "bigint"] == 1 and found["a", "decimal"] == 2 and found["c[]", "object"] == 3 and found["c[].x", "string"] == 1
    assert found["b.$date", "bigint"] == 1 and found["c[].y", "void"] == 1 and found["[].q", "bigint"] == 1 and found["d.e", "boolean"] == 1
    assert len(found) == 22
    assert {r.path for r in undeclared_fields(docs(spark), SCHEMA).collect()} == {"d.e", "n", "[]", "[].q", "c.x", "c[].x[]"}
    assert field_paths(docs(spark).limit(0)).count() == 0


def test_rejects_are_what_the_parse_loses(spark):
    rejects = field_rejects(docs(spark), SCHEMA)
    found = sorted((r["_id"], r.field, r.found, r.text) for r in rejects.na.fill("-").collect())
    assert found == [
        ("1", "a", "string", '"12"'), ("1", "b", "bigint", "7"), ("1", "c", "object", '{"x":1}'), ("2", "", "-", "-"),
        ("3", "", "array", '[1,{"q":2}]'), ("4", "", "bigint", "5"), ("6", "a", "decimal", "1.5"), ("6", "b.$date", "string", '"z"'),
        ("6", "c[]", "bigint", "3"), ("7", "a", "decimal", "99999999999999999999"),
    ]
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse") == 1, "each text is parsed once"
