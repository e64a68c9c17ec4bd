"""Landing scans, parsing, flattening, drift."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from showcase import feeds, sql
from showcase.feeds import landing_dir, scalars, write_landing
from showcase.registry import query
from tidemark import (
    align_to_schema,
    dropped_fields,
    field_rejects,
    flatten,
    flatten_levels,
    parse_docs,
    quarantine,
    read_changes,
    read_full_load,
    read_unprocessed,
    record_files,
    undeclared_fields,
    unprocessed_files,
    unwrap_dates,
)
from tidemark.functions.docs import FLAG, LONG, TEXT, list_of, record
from tidemark.plans.collections import ACCESS, ERRORS, REPORTS, UPLOAD_CHANGE_FIELDS, UPLOADS
from tidemark.plans.loads import changes_to_rows, snapshot_to_rows
from tidemark.sources.ledger import create_ledger
from tidemark.session import scratch_dir

_SCANNED = ["_orig_id", "transact_seq", "transact_change_timestamp", "fileName", "errorMessage"]


def _landed(spark, sf_dir):
    folder = landing_dir(spark, "errors")
    write_landing(feeds.error_snapshot(spark, sf_dir), folder, "LOAD")
    write_landing(feeds.error_changes(spark, sf_dir, broken=False), folder, "change")
    return folder


@query(sql.select({n: sql.error(1)[n] for n in _SCANNED}, f"pages WHERE {feeds.PAGE_OLD}"))
def scan_full_load(spark, sf_dir):
    parsed = parse_docs(read_full_load(spark, _landed(spark, sf_dir)), ERRORS.doc_schema)
    return scalars(parsed).select(*_SCANNED)


@query(sql.select({"Op": sql.ERROR_OP, **{n: sql.error(2)[n] for n in _SCANNED}}, "pages"))
def scan_changes(spark, sf_dir):
    parsed = parse_docs(read_changes(spark, _landed(spark, sf_dir)), ERRORS.doc_schema)
    return scalars(parsed).select("Op", *_SCANNED)


@query(sql.select({n: sql.error(2)[n] for n in _SCANNED}, f"pages WHERE NOT ({feeds.PAGE_OLD})"), name="unprocessed_files")
def unprocessed_rows(spark, sf_dir):
    folder, ledger = landing_dir(spark, "ledger"), scratch_dir(spark, "ledger")
    create_ledger(spark, ledger)
    write_landing(feeds.error_changes(spark, sf_dir, broken=False, where=feeds.PAGE_OLD), folder, "first")
    record_files(unprocessed_files(spark, folder, ledger), ledger, "2024-01-01")
    write_landing(feeds.error_changes(spark, sf_dir, broken=False, where=f"NOT ({feeds.PAGE_OLD})"), folder, "second")
    parsed = parse_docs(read_unprocessed(spark, folder, ledger), ERRORS.doc_schema)
    return scalars(parsed).select(*_SCANNED)


@query(f"SELECT 'second' AS kind, count(*) AS documents FROM pages WHERE NOT ({feeds.PAGE_OLD})")
def unprocessed_file_kinds(spark, sf_dir):
    folder, ledger = landing_dir(spark, "ledger"), scratch_dir(spark, "ledger")
    create_ledger(spark, ledger)
    write_landing(feeds.error_changes(spark, sf_dir, where=feeds.PAGE_OLD), folder, "first")
    record_files(unprocessed_files(spark, folder, ledger), ledger, "2024-01-01")
    write_landing(feeds.error_changes(spark, sf_dir, where=f"NOT ({feeds.PAGE_OLD})"), folder, "second")
    kind = F.regexp_extract("path", "([a-z]+)-[^/]*$", 1)
    files = unprocessed_files(spark, folder, ledger)
    rows = read_changes(spark, folder).withColumn("path", F.col("_metadata.file_path")).join(files, "path")
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("documents"))


@query(sql.select(sql.EVENT_CHANGE, "events"), name="parse_docs")
def parse_documents(spark, sf_dir):
    return scalars(parse_docs(feeds.event_feed(spark, sf_dir), feeds.EVENT_SPEC.doc_schema))


@query(sql.select({"_id": "user_id::VARCHAR", "transact_seq": "event_id", "at": "epoch_us(ts) // 1000"}, "events"), name="unwrap_dates")
def unwrap_dates_to_timestamp(spark, sf_dir):
    parsed = parse_docs(feeds.event_feed(spark, sf_dir), feeds.EVENT_SPEC.doc_schema, fields=["_id", "at"])
    return scalars(unwrap_dates(parsed, to_timestamp=True).select("_id", "transact_seq", "at"))


@query(
    sql.with_(
        {"lines": sql.LINES},
        sql.select(
            {n: sql.report(1)[n] for n in ("_id", "completedDate", "fromDate", "uploadTime", "completedTime")},
            f"orders WHERE {sql.ORDERS_BEFORE}",
        ),
    )
)
def unwrap_dates_to_numbers(spark, sf_dir):
    fields = ["_id", "completedDate", "fromDate", "uploadTime", "completedTime"]
    parsed = parse_docs(feeds.report_snapshot(spark, sf_dir), REPORTS.doc_schema, fields=fields)
    return unwrap_dates(parsed).select(*fields)


@query(sql.select({"Op": sql.ERROR_OP, **sql.error(2, feeds.PAGE_BROKEN)}, "pages"))
def parse_malformed(spark, sf_dir):
    return scalars(parse_docs(feeds.error_changes(spark, sf_dir), ERRORS.doc_schema))


@query(
    sql.select(
        {"_orig_id": "page_id::VARCHAR", "part": f"CASE WHEN {feeds.PAGE_BROKEN} THEN 'bad' ELSE 'good' END"}, "pages"
    )
)
def parse_quarantine(spark, sf_dir):
    good, bad = quarantine(parse_docs(feeds.error_changes(spark, sf_dir), ERRORS.doc_schema))
    return good.select("_orig_id", F.lit("good").alias("part")).unionByName(
        bad.select("_orig_id", F.lit("bad").alias("part"))
    )


_REPORT_CHILD = ["_id", "status", "uploadTime", "patient__id", "patient_numOfRetries", "patient_status"]


@query(sql.with_({"lines": sql.LINES, "t": sql.REPORTS["t"]}, f"SELECT {sql.names(_REPORT_CHILD)} FROM t"))
def flatten_children(spark, sf_dir):
    parsed = parse_docs(feeds.report_snapshot(spark, sf_dir), REPORTS.doc_schema)
    return scalars(flatten(parsed, "patients", REPORTS.child_fields, "patient_").select(*_REPORT_CHILD))


_UPLOAD_CHILD = ["_id", "ehr", "uploadTime", "fileName", "inputType"]


@query(sql.with_({"lines": sql.LINES, "t": sql.UPLOADS["t"]}, f"SELECT {sql.names(_UPLOAD_CHILD)} FROM t"))
def flatten_children_unprefixed(spark, sf_dir):
    parsed = parse_docs(feeds.upload_snapshot(spark, sf_dir), UPLOADS.doc_schema)
    return scalars(flatten(parsed, "files", UPLOADS.child_fields).select(*_UPLOAD_CHILD))


@query(
    sql.with_(
        {n: sql.ACCESSES[n] for n in ("parts", "docs", "t")}, f"SELECT {sql.names(sql.ACCESS)} FROM t"
    )
)
def flatten_dotted(spark, sf_dir):
    return scalars(snapshot_to_rows(ACCESS, feeds.access_feed(spark, sf_dir, 1)))


_NESTED = record(_id=TEXT, priority=T.ArrayType(TEXT), flags=list_of(flag=TEXT, lines=list_of(no=LONG, n=LONG)))
_FLAGS = """SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY flag) - 1 AS place FROM (
  SELECT l_orderkey, flag, count(*) FILTER (flag <> 'R') AS lines_n FROM lines GROUP BY l_orderkey, flag)"""
_KEPT_LINES = """SELECT l_orderkey, flag, l_linenumber, n, row_number() OVER (PARTITION BY l_orderkey, flag ORDER BY l_linenumber) - 1 AS line_place
  FROM lines WHERE flag <> 'R'"""


@query(
    sql.with_(
        {"lines": sql.LINES, "flags": _FLAGS, "kept": _KEPT_LINES, "sizes": "SELECT l_orderkey, count(*) AS flags_n FROM flags GROUP BY l_orderkey"},
        """SELECT 'order' AS level, o_orderkey::VARCHAR AS _id, NULL::BIGINT AS place, NULL::BIGINT AS line_place, NULL::VARCHAR AS value,
          CASE WHEN o_orderstatus = 'P' THEN 0 ELSE flags_n END AS n FROM orders LEFT JOIN sizes ON o_orderkey = l_orderkey
        UNION ALL SELECT 'priority', o_orderkey::VARCHAR, generate_subscripts(string_split(o_orderpriority, '-'), 1) - 1, NULL,
          unnest(string_split(o_orderpriority, '-')), NULL FROM orders
        UNION ALL SELECT 'flag', o_orderkey::VARCHAR, place, NULL, flag, lines_n FROM orders JOIN flags ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'
        UNION ALL SELECT 'line', o_orderkey::VARCHAR, place, line_place, l_linenumber::VARCHAR, n
          FROM orders JOIN flags f ON o_orderkey = f.l_orderkey AND o_orderstatus <> 'P' JOIN kept k ON k.l_orderkey = f.l_orderkey AND k.flag = f.flag""",
    ),
    name="flatten_levels",
)
def flatten_orders(spark, sf_dir):
    """Two arrays of a document, one of them with an array in it: four tables from one pass, put under each other."""
    tables = flatten_levels(parse_docs(feeds.nested_feed(spark, sf_dir), _NESTED), ["_id"], ["priority", "flags", "flags.lines"])

    def under(path, level, place, line_place, value, n):
        columns = {"place": place, "line_place": line_place, "value": value, "n": n}
        kinds = {"place": "long", "line_place": "long", "value": "string", "n": "long"}
        return tables[path].select(
            F.lit(level).alias("level"), "_id", *[(F.col(c) if c else F.lit(None)).cast(kinds[k]).alias(k) for k, c in columns.items()]
        )

    rows = under("", "order", None, None, None, "flags_n").union(under("priority", "priority", "priority_pos", None, "priority_value", None))
    rows = rows.union(under("flags", "flag", "flags_pos", None, "flags_flag", "flags_lines_n"))
    return rows.union(under("flags.lines", "line", "flags_pos", "lines_pos", "lines_no", "lines_n"))


_DRIFT = {
    "automatedStatus": "count(o_orderstatus)",
    "dobFormat": "count(NULL)",
    "isLocked": "count(*) FILTER (o_orderstatus = 'F')",
    "isQueued": "count(NULL)",
    "isSingleThreaded": "count(NULL)",
    "message": "count(NULL)",
    "physicianSpecialty": "count(NULL)",
    "practiceId": "count(o_custkey)",
    "uploadStatus": "count(*) FILTER (kept_n > 1)",
}


@query(
    sql.with_(
        {"lines": sql.LINES, "u": "SELECT * FROM orders JOIN lines ON o_orderkey = l_orderkey AND kept_n > 0"},
        " UNION ALL ".join(f"SELECT '{n}' AS field, ({e})::BIGINT AS filled FROM u" for n, e in _DRIFT.items()),
    )
)
def schema_drift(spark, sf_dir):
    rows = changes_to_rows(UPLOADS, feeds.upload_changes(spark, sf_dir), fields=UPLOAD_CHANGE_FIELDS.fieldNames())
    return dropped_fields(rows, ["Op", *UPLOADS.table_schema().fieldNames()])


@query(
    sql.with_(
        {"lines": sql.LINES, "s": sql.UPLOADS["s"]},
        f"SELECT {sql.names(sql.UPLOAD)}, NULL::BIGINT AS \"addedLater\" FROM s",
    )
)
def schema_evolve_add_columns(spark, sf_dir):
    wider = UPLOADS.table_schema().add("addedLater", "long")
    rows = changes_to_rows(UPLOADS, feeds.upload_changes(spark, sf_dir))
    return scalars(align_to_schema(rows, wider))


_AUDIT = {"": "turn", ".audit": "role", ".date": "turn", ".date.$date": "turn", ".newValue": "text", ".reportId": "turn", ".user": "role"}
_AUDIT_TYPES = {"": "object", ".date": "object", ".date.$date": "bigint"}


@query(
    sql.with_(
        {"parts": sql.PARTS},
        "SELECT * FROM (SELECT 'audit' AS path, 'array' AS type, count(DISTINCT part) AS n FROM parts UNION ALL "
        + " UNION ALL ".join(
            f"SELECT 'audit[]{p}', '{_AUDIT_TYPES.get(p, 'string')}', count({c}) FROM parts" for p, c in _AUDIT.items()
        )
        + " UNION ALL SELECT 'practiceId', 'string', count(DISTINCT part) FROM parts) WHERE n > 0",
    )
)
def schema_drift_undeclared(spark, sf_dir):
    """Every path of the documents that a schema without the audit trail and the practice does not list."""
    declared = T.StructType([f for f in ACCESS.doc_schema if f.name not in ("audit", "practiceId")])
    return undeclared_fields(feeds.access_feed(spark, sf_dir, 2), declared)


@query("SELECT 'event_type' AS field, count(event_type) AS n FROM events UNION ALL SELECT 'value', count(value) FROM events UNION ALL SELECT 'at.$date', count(ts) FROM events")
def parse_field_rejects(spark, sf_dir):
    """Values that the declared types do not take: they are NULL after the parse."""
    narrow = record(_id=TEXT, event_type=FLAG, value=LONG, at=record(**{"$date": FLAG}))
    return field_rejects(feeds.event_feed(spark, sf_dir), narrow).groupBy("field").agg(F.count("*").alias("n"))
