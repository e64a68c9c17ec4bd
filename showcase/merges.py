"""The merge and each of its options."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase import feeds, sql
from showcase.feeds import EVENT_SPEC, scalars
from showcase.registry import query
from tidemark import merge, replace_children, snapshot_to_rows
from tidemark.plans.collections import ACCESS, ERRORS, REPORTS
from tidemark.operators.merge import unrepeated
from tidemark.plans.loads import changes_to_rows
from tidemark.session import stage


def _event_table(spark, sf_dir, where):
    """State of the table when the first part of the feed is in."""
    rows = changes_to_rows(EVENT_SPEC, feeds.event_feed(spark, sf_dir, where))
    return rows.where("Op <> 'D'").drop("Op")


def _event_rows(spark, sf_dir, where):
    return changes_to_rows(EVENT_SPEC, feeds.event_feed(spark, sf_dir, where))


_EVENTS = {
    "t": sql.select(sql.EVENT, f"{sql.newest_events(sql.EVENTS_BEFORE)} e WHERE {sql.EVENT_OP} <> 'D'"),
    "s": sql.select(sql.EVENT_CHANGE, f"{sql.newest_events(sql.EVENTS_SINCE)} e"),
}
_SAME_ID = "s._id = t._id"


@query(sql.with_(_EVENTS, sql.merged(sql.EVENT, _SAME_ID)))
def merge_single_key(spark, sf_dir):
    target = _event_table(spark, sf_dir, feeds.EVENTS_BEFORE)
    return scalars(merge(target, _event_rows(spark, sf_dir, feeds.EVENTS_SINCE), ["_id"]))


@query(
    sql.with_(
        _EVENTS,
        'SELECT t._orig_id, coalesce(s.transact_seq, t.transact_seq) AS transact_seq, t.transact_change_timestamp, '
        't._id, t.event_type, coalesce(s.value, t.value) AS value, t."at" FROM t LEFT JOIN '
        "(SELECT * FROM s WHERE \"Op\" = 'U') s ON s._id = t._id UNION ALL "
        "SELECT NULL, transact_seq, NULL, _id, NULL, value, NULL FROM s WHERE \"Op\" = 'U' "
        "AND NOT EXISTS (SELECT 1 FROM t WHERE s._id = t._id)",
    )
)
def merge_update(spark, sf_dir):
    """Only the mapped columns change; a row added has NULL in the others."""
    target = _event_table(spark, sf_dir, feeds.EVENTS_BEFORE)
    source = _event_rows(spark, sf_dir, feeds.EVENTS_SINCE).where("Op = 'U'")
    mapping = {c: F.col(c) for c in ("_id", "transact_seq", "value")}
    return scalars(merge(target, source, ["_id"], mapping=mapping))


def _reports(spark, sf_dir, where="true"):
    """The table, and a batch of those changes; it is staged, as a merge reads its source several times."""
    target = snapshot_to_rows(REPORTS, feeds.report_snapshot(spark, sf_dir))
    return target, stage(changes_to_rows(REPORTS, feeds.report_changes(spark, sf_dir)).where(where), "reports-batch")


def _merged(target, source, **options):
    """By the two keys of the reports, in one join if neither side repeats one. The table is staged: the check reads it, too."""
    target = stage(target, "reports-table")
    checked = unrepeated(target, source, REPORTS.keys, options.get("null_safe", ()))
    return scalars(merge(target, source, REPORTS.keys, **checked, **options))


@query(sql.with_(_EVENTS, sql.merged(sql.EVENT, _SAME_ID)))
def merge_null_op(spark, sf_dir):
    """A change without an operation code is an upsert."""
    target = _event_table(spark, sf_dir, feeds.EVENTS_BEFORE)
    source = _event_rows(spark, sf_dir, feeds.EVENTS_SINCE)
    return scalars(merge(target, source.withColumn("Op", F.expr("nullif(Op, 'U')")), ["_id"]))


@query(sql.with_(sql.REPORTS, sql.merged(sql.REPORT, sql.REPORT_KEY)))
def merge_two_key(spark, sf_dir):
    return _merged(*_reports(spark, sf_dir))


@query(
    sql.with_(
        {**sql.REPORTS, "s2": f"SELECT * FROM s WHERE transact_change_timestamp >= epoch_ms(TIMESTAMP '{feeds.ORDERS_UNTIL}')"},
        f"SELECT {sql.names(sql.REPORT)} FROM t UNION ALL SELECT {sql.names(sql.REPORT)} FROM s2",
    )
)
def merge_insert(spark, sf_dir):
    """Orders placed after the snapshot: nothing matches, all come in."""
    later = F.unix_millis("transact_change_timestamp") >= feeds.ntz_millis(F.lit(feeds.ORDERS_UNTIL).cast("timestamp_ntz"))
    return _merged(*_reports(spark, sf_dir, later))


@query(
    sql.with_(
        {**sql.REPORTS, "s2": "SELECT * FROM s WHERE \"Op\" = 'D'"},
        f"SELECT {sql.names(sql.REPORT)} FROM t WHERE NOT EXISTS (SELECT 1 FROM s2 s WHERE {sql.REPORT_KEY})",
    )
)
def merge_delete(spark, sf_dir):
    return _merged(*_reports(spark, sf_dir, "Op = 'D'"), insert_deletes=False)


@query(sql.with_({n: sql.REPORTS[n] for n in ("lines", "t")}, f"SELECT {sql.names(sql.REPORT)} FROM t"))
def merge_empty_batch(spark, sf_dir):
    return _merged(*_reports(spark, sf_dir, "Op = 'no such code'"))


@query(sql.with_(sql.ERRORS, sql.merged(sql.ERROR, _SAME_ID)))
def merge_struct_key(spark, sf_dir):
    target = snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir))
    return scalars(merge(target, changes_to_rows(ERRORS, feeds.error_changes(spark, sf_dir)), ERRORS.keys))


@query(sql.with_(sql.ACCESSES, sql.merged(sql.ACCESS, sql.ACCESS_KEY)))
def merge_struct_and_dotted_key(spark, sf_dir):
    target = snapshot_to_rows(ACCESS, feeds.access_feed(spark, sf_dir, 1))
    return scalars(merge(target, changes_to_rows(ACCESS, feeds.access_feed(spark, sf_dir, 2)), ACCESS.keys))


@query(sql.with_(sql.REPORTS, sql.merged(sql.REPORT, sql.REPORT_KEY, insert_deletes=False)))
def merge_insert_deletes_off(spark, sf_dir):
    return _merged(*_reports(spark, sf_dir), insert_deletes=False)


@query(
    sql.with_(
        sql.REPORTS, sql.merged(sql.REPORT, "s._id = t._id AND s.patient__id IS NOT DISTINCT FROM t.patient__id")
    )
)
def merge_null_safe(spark, sf_dir):
    return _merged(*_reports(spark, sf_dir), null_safe=["patient__id"])


_BY_KIND = {
    "t": sql.select(sql.EVENT, f"{sql.newest_events("event_type IN ('view', 'click')")} e"),
    "s": sql.select(sql.EVENT_CHANGE, f"{sql.newest_events("event_type NOT IN ('view', 'click')")} e"),
}


@query(sql.with_(_BY_KIND, sql.merged(sql.EVENT, _SAME_ID, newer="s.transact_seq > t.transact_seq")))
def merge_seq_guard(spark, sf_dir):
    """Newest views and clicks, then a batch of the other events, older for some users."""
    target = _event_table(spark, sf_dir, "event_type IN ('view', 'click')")
    source = _event_rows(spark, sf_dir, "event_type NOT IN ('view', 'click')")
    return scalars(merge(target, source, ["_id"], seq_guard="transact_seq"))


@query(
    sql.with_(
        sql.REPORTS,
        f"SELECT {sql.names(sql.REPORT)} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s._id = t._id) "
        f"UNION ALL SELECT {sql.names(sql.REPORT)} FROM s WHERE \"Op\" <> 'D'",
    )
)
def merge_replace_children(spark, sf_dir):
    target, source = _reports(spark, sf_dir)
    kept, added = replace_children(target, source, ["_id"])
    return scalars(kept.unionByName(added))


_LINE_ROWS = {
    "t": "SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS part, min(l_suppkey) AS supp, "
    "min(l_extendedprice) AS price, min(l_quantity) AS quantity FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2",
    "s": "SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_suppkey AS supp, l_extendedprice AS price, "
    "l_quantity AS quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1",
}


@query(
    sql.with_(
        _LINE_ROWS,
        "SELECT k, n, part, supp, price, quantity FROM t WHERE NOT EXISTS "
        "(SELECT 1 FROM s WHERE s.k = t.k AND s.n = t.n) UNION ALL SELECT k, n, part, supp, price, quantity FROM s",
    )
)
def merge_latest_on_duplicate(spark, sf_dir):
    """Plain line items have several rows of one order and line number."""
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("n"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
    )
    values = ["part", "supp", "price", "quantity"]
    target = lines.where("flag = 'R'").groupBy("k", "n").agg(*[F.min(c).alias(c) for c in values])
    return merge(
        target, lines.drop("flag"), ["k", "n"], delete_when=F.lit(False), on_duplicate="latest", order=values
    )


_BARE = {
    "t": sql.ERRORS["t"],
    "s": sql.select({"Op": sql.ERROR_OP, **sql.error(2, feeds.PAGE_DELETED)}, "pages"),
}


@query(sql.with_(_BARE, sql.merged(sql.ERROR, "s._orig_id = t._orig_id")))
def merge_envelope_key(spark, sf_dir):
    """Deletes that come without a document find their row by the envelope's key."""
    target = snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir))
    changes = feeds.error_changes(spark, sf_dir, broken=False, bare_deletes=True)
    return scalars(merge(target, changes_to_rows(ERRORS, changes), ["_orig_id"]))


@query(sql.with_(_BARE, sql.merged(sql.ERROR, _SAME_ID)))
def merge_bare_deletes(spark, sf_dir):
    """The same by the document's key: a delete without a document becomes a row of NULLs."""
    target = snapshot_to_rows(ERRORS, feeds.error_snapshot(spark, sf_dir))
    changes = feeds.error_changes(spark, sf_dir, broken=False, bare_deletes=True)
    return scalars(merge(target, changes_to_rows(ERRORS, changes), ["_id"]))


