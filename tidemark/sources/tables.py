"""Curated tables: parquet files in buckets of the key, behind a view that a merge moves on in one step.

The rows are a catalog table `<name>_rows`, partitioned by the commit that wrote them and the bucket of their key, and
stored in Spark's own buckets of the key. A commit writes each touched bucket once, into partitions of its own that no
reader sees yet; then a note beside the files says which commit each bucket is at, and the view `<name>` is altered to
that: one change in the catalog, so readers see the whole batch or nothing of it. What the view before it showed is kept
until the next commit, for readers that are still at it.

If a job dies before the note, nothing has happened; after it, the next use of the table moves the view on. The notes are
files, so a catalog that has lost the table gets it back as it was. One writer at a time.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_null, bucket_of, col, columns_sql, names, quote, type_sql
from tidemark.operators.evolve import conform, merge_types
from tidemark.operators.merge import MergeCounts
from tidemark.session import CODEC, files_under, read_text, remove, write_text

BUCKET, COMMIT, GONE = "in_bucket", "in_commit", "in_delete"
#: Columns of the catalog's tables that no reader of the view gets (but for the bucket).
NOT_ROWS = (BUCKET, COMMIT, GONE)
#: View properties: the last batch that is in, and the commit that the view shows.
BATCH, SHOWN = "tidemark.batch", "tidemark.commit"
PLACE = (T.StructField(COMMIT, T.IntegerType()), T.StructField(BUCKET, T.IntegerType()))


class BucketTable:
    """`name` in the catalog, files under `path`, rows of `schema` in buckets of `keys`: as many as its notes say, `buckets` if they
    do not. It is made with more for rows that would fill them too far (`create`), and then keeps their number."""

    def __init__(
        self, spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
    ) -> None:
        self.spark = spark
        self.name = ".".join(quote(part.strip("`")) for part in name.split("."))
        self.rows_name = f"{self.name[:-1]}_rows`"
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self._asked = buckets
        self._making: int | None = None

    @property
    def buckets(self) -> int:
        """The number that the table is stored in."""
        return self._making or self._buckets_in(self._newest_note())

    def _buckets_in(self, note: Mapping | None) -> int:
        return (note or {}).get("buckets", self._asked)

    def exists(self) -> bool:
        """Whether the table is there. Files that the catalog does not know (a new session of a catalog in
        memory) are entered into it as their newest note says."""
        if table_exists(self.spark, self.name):
            return True
        note = self._newest_note()
        if note is None:
            return False
        self._enter_rows()
        self._show(note)
        return True

    def create(self, df: DataFrame, least: int = 1) -> None:
        """The table from these rows, in place of one that may be there. It gets `least` buckets, if that is more than asked for;
        one that is made anew keeps those it has, as its readers may still be at them."""
        note = self._newest_note()
        self._making = max(self._asked, self._buckets_in(note) if note else least)
        try:
            drop_table(self.spark, self.rows_name)
            self._enter_rows()
            self.replace(df, range(self.buckets), "")
        finally:
            self._making = None

    def _enter_rows(self, schema: T.StructType | None = None) -> None:
        """Makes the catalog table of the rows, of files that may be there; where it is known already, nothing."""
        create_database_of(self.spark, self.name)
        if table_exists(self.spark, self.rows_name):
            return
        keys = ", ".join(names(self.keys))
        self.spark.sql(
            f"CREATE TABLE {self.rows_name} ({columns_sql([*(schema or self.schema), *PLACE])}) USING parquet OPTIONS (compression '{CODEC}') "
            f"PARTITIONED BY ({COMMIT}, {BUCKET}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{escaped(self.path)}'"
        )
        if self._stored():
            self.spark.sql(f"MSCK REPAIR TABLE {self.rows_name}")

    def read(self, buckets: Collection[int] | None = None) -> DataFrame:
        """The table, or only its rows in the given buckets: other partitions are not listed or opened."""
        rows = self.spark.table(self.name)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(*buckets) if buckets else F.lit(False))
        return rows.select(*names(self.schema.names))

    def widen(self) -> list[str]:
        """Adds the columns of `schema` that the stored table does not have, and the fields that its structs do not have, at
        any depth; old rows have NULL in them. Single values may become wider (`merge_types`), keys may not: rows lie by
        them. Returns the columns that are new or have changed."""
        if not table_exists(self.spark, self.rows_name):
            self._enter_rows()  # a job has died while it entered the table anew
        gained = self._widen_entry(self.rows_name, self._enter_rows)
        if gained:
            self._show(self._newest_note())
        return gained

    def _widen_entry(self, entry: str, enter: Callable[[T.StructType], None]) -> list[str]:
        """Columns at the end are added to the catalog's table. If a type changes, the table is entered anew over the same
        files, which takes no rewrite: they are read as the wider type. A reader that comes in that moment fails."""
        stored = self.spark.table(entry).schema
        own = T.StructType([f for f in stored if f.name not in NOT_ROWS])
        wider = merge_types(own, self.schema)
        there = {f.name: type_sql(f.dataType) for f in own}
        changed = [f.name for f in wider if f.name in there and there[f.name] != type_sql(f.dataType)]
        if keys := sorted({*changed} & {*self.keys}):
            raise ValueError(f"keys {keys} cannot change their type: the table lies in buckets of them")
        new = [f for f in wider if f.name not in there]
        if changed:
            self.spark.sql(f"DROP TABLE {entry}")
            enter(wider)
        elif new:
            self.spark.sql(f"ALTER TABLE {entry} ADD COLUMNS ({columns_sql(new)})")
        self.schema = T.StructType([wider[f.name] for f in self.schema])
        return [f.name for f in new] + changed

    def in_table_types(self, rows: DataFrame) -> DataFrame:
        """Columns that the table has too, in its types: a key must fall into the bucket it is stored in."""
        types = {f.name: f.dataType for f in self.schema}
        return rows.select(*[conform(col(f.name), f.dataType, types[f.name]).alias(f.name) if f.name in types else col(f.name) for f in rows.schema])

    def buckets_of(self, rows: DataFrame) -> set[int]:
        """Buckets of the rows' keys: at most `buckets` numbers reach the driver."""
        keys = self.in_table_types(rows.select(*names(self.keys)))
        return {r[0] for r in keys.select(bucket_of(self.keys, self.buckets)).distinct().collect()}

    def buckets_and_repeats(self, rows: DataFrame) -> tuple[set[int], bool]:
        """Buckets of the rows' keys, and whether a key without NULL comes twice: one job over the keys."""
        keys = self.in_table_types(rows.select(*names(self.keys)))
        counts = keys.groupBy(*names(self.keys)).agg(F.count(F.lit(1)).alias("__rows"))
        often = F.max(F.when(any_null(self.keys), 1).otherwise(F.col("__rows")))
        found = counts.groupBy(bucket_of(self.keys, self.buckets).alias("b")).agg(often.alias("often")).collect()
        return {r.b for r in found}, any(r.often > 1 for r in found)

    def largest(self, touched: Collection[int]) -> int:
        """File bytes of the largest of these buckets."""
        note = self._newest_note() or {"live": {}}
        return max([note["live"].get(b, (0, 0))[1] for b in touched], default=0)

    def replace(
        self, rows: DataFrame, touched: Collection[int], batch: str, placed: bool = False, counts: MergeCounts | None = None
    ) -> None:
        """Puts `rows` in place of all rows of the touched buckets, as this batch."""
        self.prepare(rows, touched, batch, placed, counts)
        self.finish()

    def counts(self) -> dict[str, int] | None:
        """What the last commit did: rows inserted, updated, deleted, and changes ignored. None if it did not count."""
        return (self._newest_note() or {}).get("counts")

    def prepare(
        self, rows: DataFrame, touched: Collection[int], batch: str, placed: bool = False, counts: MergeCounts | None = None
    ) -> None:
        """Writes the rows that are to replace those of the touched buckets, each once; `finish` shows them.

        `placed`: the rows of a bucket lie in one task each, as `merge_colocated` leaves them. Others are shuffled by
        bucket, a bucket too large for one task to several.
        """
        commit = self._next_commit()
        stored = [c for c in self.spark.table(self.rows_name).columns if c not in (COMMIT, BUCKET)]
        sliced = self.in_table_types(rows).select(*names(stored), F.lit(commit).alias(COMMIT), bucket_of(self.keys, self.buckets).alias(BUCKET))
        (sliced if placed else sliced.hint("rebalance", BUCKET)).write.insertInto(self.rows_name)
        filled: dict[int, int] = {}
        for file, size in files_under(self.spark, f"{self.path}/{COMMIT}={commit}"):
            if found := re.search(rf"/{BUCKET}=(\d+)/[^/_.][^/]*$", file):
                filled[int(found[1])] = filled.get(int(found[1]), 0) + size
        stray = sorted(set(filled) - set(touched))
        if stray:
            self._forget((commit, b) for b in filled)
            raise ValueError(f"rows of buckets {stray}, which the batch does not touch")
        before = self._newest_note()
        live = {b: at for b, at in before["live"].items() if b not in set(touched)} if before else {}
        note = {"commit": commit, "batch": batch, "live": live | {b: (commit, size) for b, size in filled.items()}, "buckets": self.buckets}
        note["counts"] = counts.get() if counts else None
        write_text(self.spark, self._note_path(commit), json.dumps(note))

    def finish(self) -> None:
        """Shows what is written and noted but not yet in the view, in one step; usually nothing is."""
        note = self._newest_note()
        if note and not (table_exists(self.spark, self.name) and self.properties().get(SHOWN) == str(note["commit"])):
            self._show(note)

    def has_batch(self, batch: str) -> bool:
        """Whether this batch was the last one to go in; batches come one after the other."""
        return self.properties().get(BATCH) == batch

    def properties(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def files(self) -> DataFrame:
        """`in_bucket`, `files`, `bytes` of the buckets that the view shows."""
        file = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_size"))
        listed = self.spark.table(self.rows_name).where(self._live_sql(self._newest_note())).select(BUCKET, file.alias("f")).distinct()
        return listed.groupBy(BUCKET).agg(F.count("*").alias("files"), F.sum("f.file_size").alias("bytes"))

    # notes, and the view over them

    def _note_path(self, commit: int) -> str:
        return f"{self.path}/_notes/{commit:010d}.json"

    def _notes(self) -> list[int]:
        found = (re.search(r"/(\d{10})\.json$", file) for file, _ in files_under(self.spark, f"{self.path}/_notes"))
        return sorted(int(m[1]) for m in found if m)

    def _note(self, commit: int) -> dict:
        note = json.loads(read_text(self.spark, self._note_path(commit)))
        return note | {"live": {int(b): tuple(at) for b, at in note["live"].items()}}

    def _newest_note(self) -> dict | None:
        commits = self._notes()
        return self._note(commits[-1]) if commits else None

    def _next_commit(self) -> int:
        """A number that no file has, also none that a job left which died."""
        return max([c for c, _ in self._stored()] + self._notes(), default=0) + 1

    def _stored(self) -> set[tuple[int, int]]:
        """(commit, bucket) of all partitions that there are as folders."""
        found = (re.search(rf"/{COMMIT}=(\d+)/{BUCKET}=(\d+)/", file) for file, _ in files_under(self.spark, self.path))
        return {(int(m[1]), int(m[2])) for m in found if m}

    def _live_sql(self, note: Mapping) -> str:
        at = ", ".join(str(note["live"].get(b, (0, 0))[0]) for b in range(self._buckets_in(note)))
        return f"{COMMIT} = element_at(array({at}), {BUCKET} + 1)"

    def _body(self, note: Mapping) -> str:
        """What the view selects. Which partitions that are is settled when a query is planned, from their names alone."""
        shown = [c for c in self.spark.table(self.rows_name).columns if c != COMMIT]
        return f"SELECT {', '.join(names(shown))} FROM {self.rows_name} WHERE {self._live_sql(note)}"

    def _show(self, note: Mapping) -> None:
        known = table_exists(self.spark, self.name)
        self.spark.sql(f"{'ALTER' if known else 'CREATE'} VIEW {self.name} AS {self._body(note)}")
        self.spark.sql(f"ALTER VIEW {self.name} SET TBLPROPERTIES ('{BATCH}' = '{escaped(note['batch'])}', '{SHOWN}' = '{note['commit']}')")
        self._sweep(note)

    def _sweep(self, note: Mapping) -> None:
        """Removes what neither this note nor the one before it shows."""
        commits = [c for c in self._notes() if c <= note["commit"]]
        kept = {(at[0], b) for c in commits[-2:] for b, at in self._note(c)["live"].items()}
        self._forget(self._stored() - kept)
        for commit in commits[:-2]:
            remove(self.spark, self._note_path(commit))

    def _forget(self, partitions: Iterable[tuple[int, int]]) -> None:
        gone = sorted(partitions)
        if not gone:
            return
        listed = ", ".join(f"PARTITION ({COMMIT} = {c}, {BUCKET} = {b})" for c, b in gone)
        self.spark.sql(f"ALTER TABLE {self.rows_name} DROP IF EXISTS {listed}")
        whole = {c for c, _ in gone} - {c for c, _ in self._stored() - set(gone)}
        for path in [f"{COMMIT}={c}" for c in sorted(whole)] + [f"{COMMIT}={c}/{BUCKET}={b}" for c, b in gone if c not in whole]:
            remove(self.spark, f"{self.path}/{path}")


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def default_name(collection: str, path: str) -> str:
    """A catalog name for a table that is given by its path only."""
    plain = "".join(c if c.isalnum() else "_" for c in collection)
    return f"{plain}_{zlib.crc32(path.rstrip('/').encode()):08x}"


def create_database_of(spark: SparkSession, name: str) -> None:
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    """A database with tables in it is only dropped with `cascade`."""
    spark.sql(f"DROP DATABASE IF EXISTS {quote(name)}" + " CASCADE" * cascade)


def table_exists(spark: SparkSession, name: str) -> bool:
    """One catalog lookup; names are not case-sensitive."""
    return spark.catalog.tableExists(name)


def register_parquet(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """External table over files that are there, unless the name is taken."""
    create_database_of(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")


def save_table(df: DataFrame, name: str) -> None:
    """Managed table; it is an error if the name is taken."""
    create_database_of(df.sparkSession, name)
    df.write.mode("errorifexists").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drops a table or a view, if there is one; files outside the warehouse stay."""
    if table_exists(spark, name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def newest_row(spark: SparkSession, name: str, by: str, *breakers: str) -> DataFrame:
    """The row of a catalog table with the greatest `by`; NULL comes last."""
    order = ", ".join(f"{quote(c)} DESC" for c in (by, *breakers))
    return spark.sql(f"SELECT * FROM {name} ORDER BY {order} LIMIT 1")
