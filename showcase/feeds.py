"""The given tables as change feeds: every row of a table becomes part of a document.

Nothing is sampled. What is snapshot and what is change, what is deleted and what is
malformed, follows from the data (dates, statuses, addresses).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import CollectionSpec
from tidemark.functions.columns import col
from tidemark.functions.docs import (
    CHANGED_AT,
    DATE,
    DOC,
    KEY,
    OP,
    REAL,
    SEQ,
    TEXT,
    ntz_millis,
    record,
    to_doc,
    wrap_date,
    wrap_oid,
)
from tidemark.session import CODEC, scratch_dir
from tidemark.sources.envelope import envelope_schema, has_files

EVENT_SPEC = CollectionSpec(
    name="events",
    doc_schema=record(_id=TEXT, event_type=TEXT, value=REAL, at=DATE),
)
EVENTS_UNTIL = "2024-01-16"
ORDERS_UNTIL = "1998-01-01"
# A conversation longer than this is several documents, as a document store has a size limit.
TURNS_PER_DOC = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def envelope(df: DataFrame, key, seq, millis, doc, op=None) -> DataFrame:
    lead = [op.alias(OP)] if op is not None else []
    return df.select(
        *lead,
        key.cast("string").alias(KEY),
        seq.cast("long").alias(SEQ),
        F.timestamp_millis(millis).alias(CHANGED_AT),
        doc.alias(DOC),
    )


def scalars(df: DataFrame) -> DataFrame:
    """Comparable form of a result: one-field structs and timestamps as plain values, and
    `_` for dots in names."""
    out = []
    for f in df.schema:
        value = col(f.name)
        if isinstance(f.dataType, T.StructType) and len(f.dataType) == 1:
            value = value.getField(f.dataType[0].name)
        elif isinstance(f.dataType, T.TimestampType):
            value = F.unix_millis(value)
        out.append(value.alias(f.name.replace(".", "_")))
    return df.select(*out)


def write_landing(df: DataFrame, folder: str, basename: str, mode: str = "append") -> None:
    """Write a feed into a landing folder under a file name prefix of its kind."""
    df.write.mode(mode).option("mapreduce.output.basename", basename).option("compression", CODEC).parquet(folder)


_LANDED: dict[tuple, str] = {}


def _is_written(spark: SparkSession, key: tuple) -> bool:
    key = (spark.sparkContext.applicationId, *key)
    return key in _LANDED and has_files(spark, _LANDED[key])


def _once(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> str:
    """The folder where these rows are: written to the shared folder once per application and key."""
    written = _is_written(spark, key)
    key = (spark.sparkContext.applicationId, *key)
    if not written:
        _LANDED[key] = scratch_dir(spark, key[1])
        build().write.mode("errorifexists").option("compression", CODEC).parquet(_LANDED[key])
    return _LANDED[key]


def landed(name: str, dealt: bool = False):
    """A feed that is written to the shared folder once per application and table set, and
    read from there: as in life, the operators start from parquet envelopes in many files.
    `feed.fresh` gives the same rows for a landing folder of their own: where no query has written the feed, it is not
    written, as they would then be on the disks twice.

    `dealt`: its rows come out of a join by their key, so they are dealt out already and are not shuffled again."""

    def wrap(build):
        def rows(spark: SparkSession, sf_dir: str, *args, **kwargs) -> DataFrame:
            built = build(spark, sf_dir, *args, **kwargs)
            return built if dealt else built.repartition(spark.sparkContext.defaultParallelism, F.xxhash64(KEY, SEQ))

        def key(sf_dir: str, args: tuple, kwargs: dict) -> tuple:
            return (name, sf_dir, args, tuple(sorted(kwargs.items())))

        def feed(spark: SparkSession, sf_dir: str, *args, **kwargs) -> DataFrame:
            path = _once(spark, key(sf_dir, args, kwargs), lambda: rows(spark, sf_dir, *args, **kwargs))
            with_op = OP in spark.read.parquet(path).columns
            return spark.read.schema(envelope_schema(with_op)).parquet(path)

        def fresh(spark: SparkSession, sf_dir: str, *args, **kwargs) -> DataFrame:
            written = _is_written(spark, key(sf_dir, args, kwargs))
            return (feed if written else rows)(spark, sf_dir, *args, **kwargs)

        feed.fresh = fresh
        return feed

    return wrap


def landing_dir(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, f"landing-{label}")


# events: flat documents, many versions per key


def event_op():
    return F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")


@landed("event_feed")
def event_feed(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Envelopes of events; `where` cuts the feed in time or by kind."""
    events = table(spark, sf_dir, "events").where(where)
    doc = to_doc(
        {
            "_id": F.col("user_id").cast("string"),
            "event_type": F.col("event_type"),
            "value": F.col("value"),
            "at": wrap_date(ntz_millis(F.col("ts"))),
        }
    )
    return envelope(events, F.col("user_id"), F.col("event_id"), ntz_millis(F.col("ts")), doc, event_op())


EVENTS_BEFORE = f"ts < TIMESTAMP_NTZ'{EVENTS_UNTIL}'"
EVENTS_SINCE = f"ts >= TIMESTAMP_NTZ'{EVENTS_UNTIL}'"


# orders and lineitem: documents with an array


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order, one per line number: the numbers are few, so the arrays
    built of them are short, and equal lines are combined before any shuffle."""
    kept = F.col("l_returnflag") != "R"
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("l_returnflag").alias("flag"),
            F.count(F.when(kept, 1)).alias("kept_n"),
            F.min(F.when(kept, F.col("l_returnflag"))).alias("kept_flag"),
        )
    )
    return lines


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two versions of their lines: all, and those not returned. Written once: the lines are grouped and joined
    once for the feeds of snapshots and of changes."""
    return spark.read.parquet(_once(spark, ("orders_with_lines", sf_dir), lambda: _orders_with_lines(spark, sf_dir)))


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one narrow list is shuffled; both versions are made of it behind the shuffle
    line = F.struct("l_linenumber", "n", "flag", "kept_n", "kept_flag")
    lists = order_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))

    def version(lines, n: str, flag: str):
        return F.transform(
            lines, lambda x: F.struct(x["l_linenumber"].cast("string").alias("_id"), x[n].alias("numOfRetries"), x[flag].alias("status"))
        )

    arrays = lists.select(
        "l_orderkey",
        version("lines", "n", "flag").alias("lines_1"),
        version(F.filter("lines", lambda x: x["kept_n"] > 0), "kept_n", "kept_flag").alias("lines_2"),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(arrays, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def order_op():
    return F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "P", "I").otherwise("U")


def report_doc(version: int):
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    placed = wrap_date(ntz_millis(F.col("o_orderdate")))
    final = F.col("o_orderstatus") == "F"
    return to_doc(
        {
            "_class": F.lit("order"),
            "_id": key,
            "completedDate": F.when(final, placed),
            "ehr": F.col("o_orderpriority"),
            "fromDate": placed,
            "message": F.concat(F.lit("order "), key),
            "npi": cust.cast("string"),
            "numOfRetries": F.lit(version).cast("long"),
            "orginalReportId": key,
            "patients": F.col(f"lines_{version}"),
            "priority": F.col("o_orderpriority"),
            "singleThreaded": final,
            "status": F.lit("N") if version == 1 else F.col("o_orderstatus"),
            "toDate": placed,
            "type": F.lit("report"),
            "uploadTime": placed,
            "practiceId": cust,
            "completedTime": F.when(final, placed),
        }
    )


ORDERS_BEFORE = f"o_orderdate < TIMESTAMP_NTZ'{ORDERS_UNTIL}'"


@landed("nested_feed", dealt=True)
def nested_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines under each return flag, and the parts of their priority. Orders that are only placed have no
    flags yet, lines that came back have left an empty list, and an order without lines has no list at all."""
    line = F.struct(F.col("l_linenumber").cast("long").alias("no"), F.col("n"))
    lines = order_lines(spark, sf_dir).groupBy("l_orderkey", "flag").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    kept = F.when(F.col("flag") == "R", F.slice("lines", 1, 0)).otherwise(F.col("lines"))
    flags = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("flag", kept.alias("lines")))).alias("flags"))
    orders = table(spark, sf_dir, "orders").join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = to_doc(
        {
            "_id": F.col("o_orderkey").cast("string"),
            "priority": F.split("o_orderpriority", "-"),
            "flags": F.when(F.col("o_orderstatus") == "P", F.slice(F.coalesce("flags", F.array().cast(flags.schema["flags"].dataType)), 1, 0)).otherwise(F.col("flags")),
        }
    )
    return envelope(orders, F.col("o_orderkey"), F.lit(1), ntz_millis(F.col("o_orderdate")), doc)


@landed("growing_feed", dealt=True)
def growing_feed(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Orders whose documents grow inside: first a customer's number and counted lines, later also a state and flags."""
    number = F.col("l_linenumber").cast("string").alias("no")
    line = F.struct(number, F.col("n")) if version == 1 else F.struct(number, F.col("flag"))
    lines = order_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    orders = table(spark, sf_dir, "orders").where(ORDERS_BEFORE if version == 1 else "o_orderstatus <> 'O'")
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    state = [] if version == 1 else [F.col("o_orderstatus").alias("state")]
    doc = to_doc({"_id": F.col("o_orderkey").cast("string"), "customer": F.struct(F.col("o_custkey").alias("id"), *state), "lines": F.col("lines")})
    lead = [] if version == 1 else [order_op()]
    return envelope(rows, F.col("o_orderkey"), F.lit(version), ntz_millis(F.col("o_orderdate")), doc, *lead)


@landed("report_snapshot", dealt=True)
def report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_lines(spark, sf_dir).where(ORDERS_BEFORE)
    return envelope(orders, F.col("o_orderkey"), F.lit(1), ntz_millis(F.col("o_orderdate")), report_doc(1))


@landed("report_changes", dealt=True)
def report_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_lines(spark, sf_dir)
    return envelope(
        orders, F.col("o_orderkey"), F.lit(2), ntz_millis(F.col("o_orderdate")), report_doc(2), order_op()
    )


@landed("upload_snapshot", dealt=True)
def upload_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_lines(spark, sf_dir).where(ORDERS_BEFORE)
    files = F.transform(
        "lines_1",
        lambda x: F.struct(F.concat(F.lit("line-"), x["_id"]).alias("fileName"), x["status"].alias("inputType")),
    )
    placed = wrap_date(ntz_millis(F.col("o_orderdate")))
    doc = to_doc(
        {
            "_class": F.lit("upload"),
            "_id": F.col("o_orderkey").cast("string"),
            "ehr": F.col("o_orderpriority"),
            "files": files,
            "fromDate": placed,
            "npi": F.col("o_custkey").cast("string"),
            "toDate": placed,
            "type": F.lit("first"),
            "uploadId": F.col("o_orderkey").cast("string"),
            "uploadTime": placed,
        }
    )
    return envelope(orders, F.col("o_orderkey"), F.lit(1), ntz_millis(F.col("o_orderdate")), doc)


@landed("upload_changes", dealt=True)
def upload_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat documents, one per kept line: several of one key share its newest sequence."""
    orders = orders_with_lines(spark, sf_dir).withColumn("line", F.explode("lines_2"))
    placed = wrap_date(ntz_millis(F.col("o_orderdate")))
    doc = to_doc(
        {
            "_class": F.lit("upload"),
            "_id": F.col("o_orderkey").cast("string"),
            "automatedStatus": F.col("o_orderstatus"),
            "ehr": F.col("o_orderpriority"),
            "fileName": F.concat(F.lit("line-"), F.col("line._id")),
            "fromDate": placed,
            "inputType": F.col("line.status"),
            "isLocked": F.when(F.col("o_orderstatus") == "F", F.lit(True)),
            "npi": F.col("o_custkey").cast("string"),
            "practiceId": F.col("o_custkey").cast("string"),
            "toDate": placed,
            "type": F.lit("second"),
            "uploadId": F.col("o_orderkey").cast("string"),
            "uploadStatus": F.when(F.col("line.numOfRetries") > 1, F.lit("repeated")),
            "uploadTime": placed,
        }
    )
    return envelope(orders, F.col("o_orderkey"), F.lit(2), ntz_millis(F.col("o_orderdate")), doc, order_op())


# conversations: wrapped ids, an array whose columns get dotted names


def access_docs(spark: SparkSession, sf_dir: str, version: int, turns: int = TURNS_PER_DOC) -> DataFrame:
    """A document for each conversation and each `turns` of its turns, keyed by both, whatever its length.

    Version 1 has the user's turns only; a part with a system turn is deleted in version 2."""
    turns = table(spark, sf_dir, "conversations").withColumn(
        "part", F.concat_ws("-", F.col("conv_id"), F.floor(F.col("turn") / turns))
    )
    entry = F.struct(
        F.col("role").alias("audit"),
        wrap_date(F.col("turn")).alias("date"),
        F.col("text").alias("newValue"),
        F.col("turn").cast("string").alias("reportId"),
        F.col("role").alias("user"),
    )
    seen = entry if version == 2 else F.when(F.col("role") == "user", entry)
    return turns.groupBy("part").agg(
        F.collect_list(seen).alias("entries"),
        F.max(F.col("role") == "system").alias("has_system"),
        F.max("conv_id").alias("conv_id"),
    )


@landed("access_feed", dealt=True)
def access_feed(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    docs = access_docs(spark, sf_dir, version)
    doc = to_doc(
        {
            "_class": F.lit("access"),
            "_id": wrap_oid(F.col("part")),
            "audit": F.col("entries"),
            "ehr": F.lit(f"v{version}"),
            "isSuspended": F.col("has_system"),
            "practiceId": F.col("conv_id").cast("string"),
        }
    )
    op = F.when(F.col("has_system"), "D").otherwise("U") if version == 2 else None
    return envelope(docs, F.col("part"), F.lit(version), F.col("conv_id") * 1000, doc, op)


# pages: wrapped ids, flat documents of whole web pages, some of them malformed

PAGE_DELETED = "url LIKE '%example.org%'"
PAGE_BROKEN = "url LIKE '%#top'"
PAGE_OLD = "url LIKE 'https:%'"


def page_doc():
    return to_doc(
        {
            "_class": F.lit("page"),
            "_id": wrap_oid(F.col("page_id")),
            "errorDate": wrap_date(F.col("page_id") * 1000),
            "errorMessage": F.col("html"),
            "fileName": F.col("url"),
        }
    )


@landed("error_snapshot")
def error_snapshot(spark: SparkSession, sf_dir: str, where: str = PAGE_OLD) -> DataFrame:
    pages = table(spark, sf_dir, "pages").where(where)
    return envelope(pages, F.col("page_id"), F.lit(1), F.col("page_id") * 1000, page_doc())


@landed("error_changes")
def error_changes(
    spark: SparkSession, sf_dir: str, broken: bool = True, bare_deletes: bool = False, where: str = "true"
) -> DataFrame:
    """`broken`: a stray brace in front of some documents; `bare_deletes`: deletes come
    without a document."""
    pages = table(spark, sf_dir, "pages").where(where)
    doc = page_doc()
    if broken:
        doc = F.when(F.expr(PAGE_BROKEN), F.concat(F.lit("{"), doc)).otherwise(doc)
    if bare_deletes:
        doc = F.when(~F.expr(PAGE_DELETED), doc)
    op = F.when(F.expr(PAGE_DELETED), "D").otherwise("U")
    return envelope(pages, F.col("page_id"), F.lit(2), F.col("page_id") * 1000, doc, op)


