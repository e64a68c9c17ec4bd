"""Whole jobs: full load, incremental load, mapping, catalog, stored tables, stream."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showcase import feeds, sql
from showcase.feeds import EVENT_SPEC, landing_dir, scalars, write_landing
from showcase.registry import query
from tidemark import (
    CollectionSpec,
    apply_changes,
    drop_database,
    flatten,
    hash_mapping_merge,
    id_hash_mapping,
    initial_load,
    merge_into,
    newest_row,
    read_changes,
    record_files,
    register_parquet,
    run,
    save_table,
    snapshot_to_rows,
    stream_changes,
    table_exists,
    unprocessed_files,
)
from tidemark.functions.docs import LONG, TEXT, list_of, record, to_doc
from tidemark.operators.merge import merge_colocated, unrepeated
from tidemark.plans.collections import ACCESS, ERRORS, REPORTS, UPLOADS
from tidemark.plans.loads import RunError, bad_documents, changes_to_rows, table_for
from tidemark.session import scratch_dir, stage
from tidemark.sources.ledger import create_ledger, read_ledger
from tidemark.sources.tables import BUCKET

REPORT_ROWS = {n: sql.REPORTS[n] for n in ("lines", "t")}
_BUCKETS = 8


def _loaded(spark, spec, snapshot):
    """Full load of a snapshot through landing files into a stored table."""
    landing = landing_dir(spark, spec.name)
    write_landing(snapshot, f"{landing}/{spec.name}", "LOAD")
    return initial_load(spark, spec.with_(buckets=_BUCKETS), landing, scratch_dir(spark, f"table-{spec.name}"))


@query(sql.with_(REPORT_ROWS, f"SELECT {sql.names(sql.REPORT)} FROM t"))
def initial_load_c1(spark, sf_dir):
    return scalars(_loaded(spark, REPORTS, feeds.report_snapshot(spark, sf_dir)).read())


@query(sql.with_({n: sql.UPLOADS[n] for n in ("lines", "t")}, f"SELECT {sql.names(sql.UPLOAD)} FROM t"))
def initial_load_c2(spark, sf_dir):
    return scalars(_loaded(spark, UPLOADS, feeds.upload_snapshot(spark, sf_dir)).read())


@query(sql.with_({n: sql.ACCESSES[n] for n in ("parts", "docs", "t")}, f"SELECT {sql.names(sql.ACCESS)} FROM t"))
def initial_load_c3(spark, sf_dir):
    return scalars(_loaded(spark, ACCESS, feeds.access_feed(spark, sf_dir, 1)).read())


@query(sql.with_({"t": sql.ERRORS["t"]}, f"SELECT {sql.names(sql.ERROR)} FROM t"))
def initial_load_c4(spark, sf_dir):
    return scalars(_loaded(spark, ERRORS, feeds.error_snapshot(spark, sf_dir)).read())


_ERRORS_ONCE = sql.with_({"t": sql.ERRORS["t"]}, f"SELECT {sql.names(sql.ERROR)} FROM t")
_ERRORS_ALL = sql.select(sql.error(1), "pages")


def _loaded_twice(spark, sf_dir, reload):
    landing, path = landing_dir(spark, "twice"), scratch_dir(spark, "table-twice")
    spec = ERRORS.with_(buckets=_BUCKETS)
    write_landing(feeds.error_snapshot(spark, sf_dir), f"{landing}/{spec.name}", "LOAD")
    initial_load(spark, spec, landing, path)
    rest = feeds.error_snapshot(spark, sf_dir, where=f"NOT ({feeds.PAGE_OLD})")
    write_landing(rest, f"{landing}/{spec.name}", "LOAD-later")
    return scalars(initial_load(spark, spec, landing, path, reload=reload).read())


@query(_ERRORS_ONCE, name="initial_load")
def initial_load_guarded(spark, sf_dir):
    """The table is there: a snapshot file that comes later is not taken."""
    return _loaded_twice(spark, sf_dir, reload=False)


@query(_ERRORS_ALL)
def initial_load_again(spark, sf_dir):
    """The same with a reload asked for: all snapshot files make the new table."""
    return _loaded_twice(spark, sf_dir, reload=True)


@query(sql.with_(sql.REPORTS, sql.merged(sql.REPORT, sql.REPORT_KEY)))
def incremental_c1(spark, sf_dir):
    target = snapshot_to_rows(REPORTS, feeds.report_snapshot(spark, sf_dir))
    return scalars(apply_changes(REPORTS, target, feeds.report_changes(spark, sf_dir)))


@query(sql.with_(sql.UPLOADS, sql.merged(sql.UPLOAD, sql.UPLOAD_KEY)))
def incremental_c2(spark, sf_dir):
    target = snapshot_to_rows(UPLOADS, feeds.upload_snapshot(spark, sf_dir))
    return scalars(apply_changes(UPLOADS, target, feeds.upload_changes(spark, sf_dir)))


@query(sql.with_(sql.ACCESSES, sql.merged(sql.ACCESS, sql.ACCESS_KEY)))
def incremental_c3(spark, sf_dir):
    target = snapshot_to_rows(ACCESS, feeds.access_feed(spark, sf_dir, 1))
    return scalars(apply_changes(ACCESS, target, feeds.access_feed(spark, sf_dir, 2)))


@query(sql.with_(sql.ERRORS, sql.merged(sql.ERROR, "s._id = t._id")))
def incremental_c4(spark, sf_dir):
    target = snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir))
    return scalars(apply_changes(ERRORS, target, feeds.error_changes(spark, sf_dir)))


_WHOLE_RUN = {
    "reports": (REPORTS, sql.REPORTS, sql.merged(sql.REPORT, sql.REPORT_KEY), "_id", '"patient__id"', '"status"', '"patient_numOfRetries"'),
    "uploads": (UPLOADS, sql.UPLOADS, sql.merged(sql.UPLOAD, sql.UPLOAD_KEY), "_id", '"fileName"', '"type"', '"inputType"'),
    "access": (ACCESS, sql.ACCESSES, sql.merged(sql.ACCESS, sql.ACCESS_KEY), "_id", '"audit_reportId"', '"audit_newValue"', '"ehr"'),
    "errors": (ERRORS, sql.ERRORS, sql.merged(sql.ERROR, "s._id = t._id"), "_id", '"fileName"', '"errorMessage"', '"errorDate"'),
}


def _run_sql(leave_out: str = "") -> str:
    """The four tables, each as its name, sequence and four of its columns as text."""
    parts = []
    for name, (_, ctes, merged, *columns) in _WHOLE_RUN.items():
        if name == leave_out:
            continue
        texts = ", ".join(f"{c}::VARCHAR AS c{i}" for i, c in enumerate(columns))
        parts.append(f"SELECT '{name}' AS collection, transact_seq, {texts} FROM ({sql.with_(ctes, merged)})")
    return " UNION ALL ".join(parts)


def _run_landed(spark, sf_dir, leave_out=()):
    """Landing files of all four collections, one run into a new database; some snapshots never come."""
    landing, work = landing_dir(spark, "run"), scratch_dir(spark, "run")
    database = f"run_{uuid.uuid4().hex}"
    for spec, snapshot, changes, *version in (
        (REPORTS, feeds.report_snapshot, feeds.report_changes),
        (UPLOADS, feeds.upload_snapshot, feeds.upload_changes),
        (ACCESS, feeds.access_feed, feeds.access_feed, 1, 2),
        (ERRORS, feeds.error_snapshot, feeds.error_changes),
    ):
        if spec.name not in leave_out:
            write_landing(snapshot.fresh(spark, sf_dir, *version[:1]), f"{landing}/{spec.name}", "LOAD")
        write_landing(changes.fresh(spark, sf_dir, *version[1:]), f"{landing}/{spec.name}", "change")
    specs = [spec.with_(buckets=_BUCKETS) for spec, *_ in _WHOLE_RUN.values()]
    failed = []
    try:
        run(spark, specs, landing, f"{work}/tables", f"{work}/checkpoints", database=database)
    except RunError as e:
        failed = sorted(e.failures)
        if failed != sorted(leave_out):
            raise
    parts = []
    for name, (spec, _, _, *columns) in _WHOLE_RUN.items():
        if name not in failed:
            flat = scalars(spark.table(f"{database}.{spec.name}").drop(BUCKET))
            texts = [F.col(c.strip('"')).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
            parts.append(flat.select(F.lit(name).alias("collection"), "transact_seq", *texts))
    return reduce(DataFrame.unionAll, parts)


@query(_run_sql())
def run_all(spark, sf_dir):
    """Landing files of all four collections, one run: full loads, then the change streams; read from the catalog."""
    return _run_landed(spark, sf_dir)


@query(_run_sql(leave_out="uploads"))
def run_with_failure(spark, sf_dir):
    """The snapshot of one collection never came: its changes fail, and the three others land."""
    return _run_landed(spark, sf_dir, leave_out=("uploads",))


@query(sql.with_(sql.ACCESSES, sql.merged(sql.ACCESS, sql.ACCESS_KEY)), name="stream_changes")
def stream_access(spark, sf_dir):
    table = _loaded(spark, ACCESS, feeds.access_feed(spark, sf_dir, 1))
    landing = landing_dir(spark, "stream")
    write_landing(feeds.access_feed(spark, sf_dir, 2), landing, "change")
    spec = ACCESS.with_(buckets=_BUCKETS)
    stream_changes(spark, spec, landing, table, scratch_dir(spark, "stream"), timeout=600)
    return scalars(table.read())


_MAPPING = {
    "id": "_id",
    "patient_id": "patient__id",
    # each part after its length, NULL as a mark: no two pairs give the same text
    "ehr_id_hash": "CASE WHEN _id IS NOT NULL THEN sha256(length(_id) || ':' || _id || "
    "CASE WHEN patient__id IS NULL THEN '-' ELSE length(patient__id) || ':' || patient__id END) END",
}


@query(sql.with_(REPORT_ROWS, sql.select(_MAPPING, "t")), name="id_hash_mapping")
def hash_mapping(spark, sf_dir):
    return id_hash_mapping(snapshot_to_rows(REPORTS, feeds.report_snapshot(spark, sf_dir)))


@query(
    sql.with_(
        REPORT_ROWS,
        "SELECT _id AS id, patient__id AS patient_id, sha256(l.flag || '-' || l.n) AS ehr_id_hash "
        "FROM t LEFT JOIN lines l ON t._id = l.l_orderkey::VARCHAR AND t.patient__id = l.l_linenumber::VARCHAR",
    )
)
def id_hash_lookup(spark, sf_dir):
    """The hashed value comes from a lookup table; no value, no hash."""
    lookup = feeds.order_lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_linenumber").cast("string").alias("patient_id"),
        F.concat_ws("-", "flag", "n").alias("value"),
    )
    return id_hash_mapping(snapshot_to_rows(REPORTS, feeds.report_snapshot(spark, sf_dir)), lookup=lookup)


@query(
    sql.with_(
        {
            "lines": sql.LINES,
            "t0": sql.REPORTS["t"],
            "s0": sql.REPORTS["s"],
            "t": sql.select(_MAPPING, "t0"),
            "s": sql.select({"Op": '"Op"', **_MAPPING}, "s0"),
        },
        sql.merged(_MAPPING, "s.id = t.id AND s.patient_id = t.patient_id"),
    )
)
def id_hash_mapping_merge(spark, sf_dir):
    mapping = id_hash_mapping(snapshot_to_rows(REPORTS, feeds.report_snapshot(spark, sf_dir)))
    changes = changes_to_rows(REPORTS, feeds.report_changes(spark, sf_dir))
    batch = stage(changes.select("Op", "_id", "patient__id"), "mapping-batch")  # a merge reads its source several times
    return hash_mapping_merge(mapping, batch, **unrepeated(mapping, batch, [("id", "_id"), ("patient_id", "patient__id")]))


@query(
    sql.with_(
        REPORT_ROWS,
        f'SELECT {sql.names(sql.REPORT)} FROM t ORDER BY "uploadTime" DESC, _id DESC, patient__id DESC NULLS LAST LIMIT 1',
    )
)
def latest_report(spark, sf_dir):
    """Asked of the catalog, as after a load."""
    table = _loaded(spark, REPORTS, feeds.report_snapshot(spark, sf_dir))
    return scalars(newest_row(spark, table.name, "uploadTime", "_id", "patient__id").drop(BUCKET))


_HALVES = ("page_id % 2 = 0", "page_id % 2 = 1")


@query(sql.with_(sql.ERRORS, sql.merged(sql.ERROR, "s._id = t._id")))
def merge_catalog_table(spark, sf_dir):
    """Two batches into a table of the catalog, which is then read by its name."""
    name = f"landed.errors_{uuid.uuid4().hex}"
    landing = landing_dir(spark, "catalog")
    write_landing(feeds.error_snapshot(spark, sf_dir), f"{landing}/{ERRORS.name}", "LOAD")
    spec = ERRORS.with_(buckets=_BUCKETS)
    table = initial_load(spark, spec, landing, scratch_dir(spark, "table-catalog"), name=name)
    for i, half in enumerate(_HALVES):
        merge_into(spec, table, feeds.error_changes(spark, sf_dir, where=half), f"batch-{i}")
    return scalars(spark.table(name).drop(BUCKET))


@query(sql.with_(sql.REPORTS, sql.merged(sql.REPORT, sql.REPORT_KEY)))
def merge_colocated_buckets(spark, sf_dir):
    """A batch of all orders into a stored table: joined where the table's buckets lie."""
    table = _loaded(spark, REPORTS, feeds.report_snapshot(spark, sf_dir))
    merge_into(REPORTS.with_(buckets=_BUCKETS), table, feeds.report_changes(spark, sf_dir), "all orders")
    return scalars(table.read())


@query(
    sql.with_(
        sql.REPORTS,
        f"""SELECT count(*) FILTER (t.transact_seq IS NULL) AS inserted, count(*) FILTER (t.transact_seq = 1 AND s."Op" <> 'D') AS updated,
        count(*) FILTER (t.transact_seq = 1 AND s."Op" = 'D') AS deleted, 0::BIGINT AS ignored FROM s LEFT JOIN t ON {sql.REPORT_KEY}""",
    )
)
def merge_counts(spark, sf_dir):
    """What a commit did, from the note beside the table; the counts are gathered in the job that writes it."""
    table = _loaded(spark, REPORTS, feeds.report_snapshot(spark, sf_dir))
    merge_into(REPORTS.with_(buckets=_BUCKETS), table, feeds.report_changes(spark, sf_dir), "all orders")
    counts = table.counts()
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} long" for n in counts))


@query(
    sql.with_(
        sql.UPLOADS,
        f"SELECT 'written' AS phase, * FROM t UNION ALL SELECT 'published', * FROM ({sql.merged(sql.UPLOAD, sql.UPLOAD_KEY)})",
    )
)
def merge_publish_once(spark, sf_dir):
    """What readers of the table see when a batch is written, but not published, and after that."""
    table = _loaded(spark, UPLOADS, feeds.upload_snapshot(spark, sf_dir))
    batch = stage(table.in_table_types(changes_to_rows(UPLOADS, feeds.upload_changes(spark, sf_dir))))
    touched = table.buckets_of(batch)
    merged = merge_colocated(table.read(touched), batch, UPLOADS.keys, table.buckets)
    table.prepare(merged, touched, "uploads", placed=True)
    seen = table.read()
    table.finish()
    return scalars(seen).select(F.lit("written").alias("phase"), "*").union(scalars(table.read()).select(F.lit("published"), "*"))


def _event_parts():
    """Three batches one after the other, each its newest event of a user: `t1` to `t3` are the table after each."""
    ctes = {"t0": sql.select(sql.EVENT, "events WHERE false")}
    for i in range(3):
        ctes[f"s{i}"] = sql.select(sql.EVENT_CHANGE, sql.newest_events(f"event_id % 3 = {i}"))
        ctes[f"t{i + 1}"] = sql.merged(sql.EVENT, "s._id = t._id", t=f"t{i}", s=f"s{i}")
    return ctes


@query(sql.with_(_event_parts(), "SELECT 'waiting' AS phase, * FROM t3 UNION ALL SELECT 'compacted', * FROM t3"))
def merge_on_read(spark, sf_dir):
    """Three batches that are only appended: read as they are, and read again after they are folded in."""
    table = _loaded(spark, EVENT_SPEC.with_(on_read=True), feeds.event_feed(spark, sf_dir, "false").drop("Op"))
    for i in range(3):
        spec = EVENT_SPEC.with_(buckets=_BUCKETS, on_read=True)
        merge_into(spec, table, feeds.event_feed(spark, sf_dir, f"event_id % 3 = {i}"), f"part-{i}")
    waiting = stage(scalars(table.read()), "waiting")
    table.compact()
    return waiting.select(F.lit("waiting").alias("phase"), "*").union(scalars(table.read()).select(F.lit("compacted"), "*"))


_TYPED = {
    "_orig_id": "o_orderkey::VARCHAR",
    "transact_seq": "1::BIGINT",
    "_id": "o_orderkey",
    "status": "'old'",
}
_TYPED_NEW = {**_TYPED, "transact_seq": "2::BIGINT", "status": "o_orderstatus"}


@query(
    sql.with_(
        {
            "t": sql.select(_TYPED, f"orders WHERE {sql.ORDERS_BEFORE}"),
            "s": sql.select({"Op": sql.ORDER_OP, **_TYPED_NEW}, "orders WHERE o_orderkey % 3 = 0"),
        },
        sql.merged(_TYPED, "s._id = t._id"),
    )
)
def commit_key_type_differs(spark, sf_dir):
    """The key is a number in the table and text in the changes: buckets go by the table's type."""
    orders = feeds.table(spark, sf_dir, "orders").withColumn("_key", F.col("o_orderkey").cast("string"))
    spec = CollectionSpec(
        name="typed", doc_schema=record(_id=LONG, status=TEXT), change_schema=record(_id=TEXT, status=TEXT), buckets=_BUCKETS
    )
    old = to_doc({"_id": F.col("o_orderkey"), "status": F.lit("old")})
    new = to_doc({"_id": F.col("_key"), "status": F.col("o_orderstatus")})
    landing = landing_dir(spark, "typed")
    before = feeds.envelope(orders.where(feeds.ORDERS_BEFORE), F.col("_key"), F.lit(1), F.lit(0), old)
    write_landing(before, f"{landing}/typed", "LOAD")
    table = initial_load(spark, spec, landing, scratch_dir(spark, "table-typed"))
    changes = feeds.envelope(orders.where("o_orderkey % 3 = 0"), F.col("_key"), F.lit(2), F.lit(0), new, feeds.order_op())
    merge_into(spec, table, changes, "text keys")
    return table.read().select(*_TYPED)


_WIDER = {**sql.error(1), "later": "CASE WHEN NOT (" + feeds.PAGE_OLD + ") THEN url END"}


@query(sql.with_({}, sql.select(_WIDER, "pages")).removeprefix("WITH \n"))
def register_after_widening(spark, sf_dir):
    """A column comes in with a later batch; the table of that name has it, NULL in the old rows."""
    table = _loaded(spark, ERRORS, feeds.error_snapshot(spark, sf_dir))
    wider = ERRORS.with_(doc_schema=T.StructType([*ERRORS.doc_schema.fields, T.StructField("later", TEXT)]), buckets=_BUCKETS)
    doc = F.from_json("_doc", "map<string,string>")
    fresh = feeds.error_snapshot(spark, sf_dir, where=f"NOT ({feeds.PAGE_OLD})")
    with_later = F.concat(F.expr("left(_doc, length(_doc) - 1)"), F.lit(',"later":'), F.to_json(F.array(doc["fileName"])).substr(2, 1 << 20))
    text = F.regexp_replace(with_later, r"\]$", "}")
    changes = fresh.select(F.lit("I").alias("Op"), "_id", "transact_seq", "transact_change_timestamp", text.alias("_doc"))
    grown = table_for(spark, wider, table.path, table.name)
    merge_into(wider, grown, changes, "wider")
    return scalars(spark.table(table.name).drop(BUCKET))


def _grown_sql(state, n, flag, where):
    columns = f"o_custkey AS customer, {state} AS state, l_linenumber::VARCHAR AS line_no, {n} AS line_n, {flag} AS line_flag"
    return f"SELECT o_orderkey::VARCHAR AS _id, {columns} FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE {where}"


@query(
    sql.with_(
        {"lines": sql.LINES},
        _grown_sql("NULL::VARCHAR", "n", "NULL::VARCHAR", f"{sql.ORDERS_BEFORE} AND o_orderstatus = 'O'")
        + " UNION ALL "
        + _grown_sql("o_orderstatus", "NULL::BIGINT", "flag", f"o_orderstatus = 'P' OR (o_orderstatus = 'F' AND NOT {sql.ORDERS_BEFORE})"),
    )
)
def schema_evolve_nested(spark, sf_dir):
    """Documents grow inside a struct and inside the elements of an array, and a count gets wider: the stored table takes all
    that with the batch, and its old rows are not written again."""
    first = record(_id=TEXT, customer=record(id=LONG), lines=list_of(no=TEXT, n=T.IntegerType()))
    later = record(_id=TEXT, customer=record(id=LONG, state=TEXT), lines=list_of(flag=TEXT, no=TEXT, n=LONG))
    table = _loaded(spark, CollectionSpec(name="growing", doc_schema=first), feeds.growing_feed(spark, sf_dir, 1))
    spec = CollectionSpec(name="growing", doc_schema=later, buckets=_BUCKETS)
    grown = table_for(spark, spec, table.path, table.name)
    merge_into(spec, grown, feeds.growing_feed(spark, sf_dir, 2), "grown")
    shown = spark.table(grown.name).select("_id", F.col("customer.id").alias("customer"), F.col("customer.state").alias("state"), "lines")
    return flatten(shown, "lines", ("no", "n", "flag"), "line_")


@query()
def sample_rows(spark, sf_dir):
    """Any five rows: the look at a table after a load."""
    return scalars(snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir)).limit(5))


@query(sql.with_({"t": sql.ERRORS["t"]}, f"SELECT {sql.names(sql.ERROR)} FROM t"))
def register_table(spark, sf_dir):
    path, name = scratch_dir(spark, "external"), f"errors_{uuid.uuid4().hex}"
    snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir)).write.mode("errorifexists").parquet(path)
    register_parquet(spark, name, path)
    return scalars(spark.table(name))


@query(sql.with_({"t": sql.ERRORS["t"]}, f"SELECT {sql.names(sql.ERROR)} FROM t"))
def register_view(spark, sf_dir):
    """A view over a loaded table: it shows the newest state without being made again."""
    table = _loaded(spark, ERRORS, feeds.error_snapshot(spark, sf_dir))
    name = f"errors_{uuid.uuid4().hex}"
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {table.name}")
    return scalars(spark.table(name).drop(BUCKET))


@query(f"SELECT 'there' AS kind, true AS found, count(*) AS n FROM pages UNION ALL SELECT 'not there', false, count(*) FROM pages WHERE {feeds.PAGE_OLD}")
def table_lookup(spark, sf_dir):
    """A managed table is saved and found, another one is not; a database goes with its tables."""
    database = f"lookup_{uuid.uuid4().hex}"
    pages = feeds.table(spark, sf_dir, "pages")
    save_table(pages.select("page_id"), f"{database}.there")
    there, other = table_exists(spark, f"{database}.There"), table_exists(spark, f"{database}.other")
    counted = stage(spark.table(f"{database}.there").agg(F.count("*").alias("n")))
    drop_database(spark, database, cascade=True)
    found = counted.select(F.lit("there").alias("kind"), F.lit(there).alias("found"), "n")
    rest = pages.where(feeds.PAGE_OLD).agg(F.count("*").alias("n"))
    return found.union(rest.select(F.lit("not there").alias("kind"), F.lit(other).alias("found"), "n"))


@query(f"SELECT page_id, url FROM pages WHERE {feeds.PAGE_OLD}", name="save_table")
def save_managed(spark, sf_dir):
    name = f"saved_{uuid.uuid4().hex}"
    save_table(feeds.table(spark, sf_dir, "pages").where(feeds.PAGE_OLD).select("page_id", "url"), name)
    return spark.table(name)


@query("SELECT true AS today, count(*) AS documents FROM pages")
def ledger_run_date(spark, sf_dir):
    """Files are recorded under the day of the run, in UTC."""
    folder, ledger = landing_dir(spark, "dated"), scratch_dir(spark, "ledger")
    create_ledger(spark, ledger)
    write_landing(feeds.error_changes(spark, sf_dir), folder, "change")
    first = datetime.now(timezone.utc).date()
    record_files(unprocessed_files(spark, folder, ledger), ledger)
    days = [first, datetime.now(timezone.utc).date()]
    rows = read_changes(spark, folder).withColumn("path", F.col("_metadata.file_path"))
    dated = rows.join(read_ledger(spark, ledger), "path")
    return dated.groupBy(F.col("run_date").isin(days).alias("today")).agg(F.count("*").alias("documents"))


_LATE = {
    "all_newest": f"SELECT * FROM {sql.newest_events()}",
}


@query(sql.with_(_LATE, sql.select(sql.EVENT, f"all_newest WHERE {sql.EVENT_OP} <> 'D'")))
def merge_seq_guard_late_update(spark, sf_dir):
    """The batches come newest first; what was deleted later stays deleted."""
    spec = EVENT_SPEC.with_(options={"seq_guard": "transact_seq", "insert_deletes": False}, buckets=_BUCKETS)
    landing = landing_dir(spark, "late")
    none = feeds.event_feed(spark, sf_dir, "false").drop("Op")
    write_landing(none, f"{landing}/{spec.name}", "LOAD")
    table = initial_load(spark, spec, landing, scratch_dir(spark, "table-late"))
    for i, part in enumerate((2, 1, 0)):
        merge_into(spec, table, feeds.event_feed(spark, sf_dir, f"event_id % 3 = {part}"), f"part-{i}")
    return scalars(table.read())


_SIDES = {
    "s": sql.ERRORS["s"],
    "t": sql.ERRORS["t"],
    "good": "SELECT * FROM s WHERE _id IS NOT NULL",
    "bad": "SELECT _orig_id, transact_seq FROM s WHERE _id IS NULL",
}
_MAIN = sql.merged(sql.ERROR, "s._id = t._id", s="good")


@query(
    sql.with_(
        _SIDES,
        f"SELECT 'table' AS side, _orig_id, transact_seq FROM ({_MAIN}) m UNION ALL SELECT 'bad', _orig_id, transact_seq FROM bad",
    )
)
def run_quarantine(spark, sf_dir):
    """Documents that cannot be read go to the side table; sent again, they add nothing."""
    spec = ERRORS.with_(buckets=_BUCKETS, keep_bad=True)
    table = _loaded(spark, ERRORS, feeds.error_snapshot(spark, sf_dir))
    merge_into(spec, table, feeds.error_changes(spark, sf_dir), "first")
    again = feeds.error_changes(spark, sf_dir).where(F.col("_doc").startswith("{{"))
    merge_into(spec, table, again, "again")
    main = scalars(table.read()).select(F.lit("table").alias("side"), "_orig_id", "transact_seq")
    bad = bad_documents(spec, table).read().select(F.lit("bad").alias("side"), F.col("_id").alias("_orig_id"), "transact_seq")
    return main.union(bad)
