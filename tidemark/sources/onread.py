"""Curated tables whose batches are appended and resolved when they are read, until a job folds them in.

Beside the rows lies a second catalog table, `<name>_changes`, in the same buckets of the same key: one row for each change of
a batch, under the number of its commit. An append writes the batch and nothing else, however large the table is. The view
takes each key's changes that are newer than its bucket, in the order of their commits, and joins them with the rows; both
sides lie by key, so neither is shuffled. `compact` writes what the view shows as rows. Both appear by one change of the view,
as in `BucketTable`, and a merge that cannot be appended goes on working: it reads the view and writes rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_null_sql, bucket_of, columns_sql, names, quote
from tidemark.session import CODEC, files_under, remove, write_text
from tidemark.sources.tables import BUCKET, COMMIT, GONE, PLACE, SHOWN, BucketTable, drop_table, escaped, table_exists


class OnReadTable(BucketTable):
    """`insert_deletes`: whether a delete that meets no row is added as one, as in `merge`."""

    def __init__(self, *args, insert_deletes: bool = True) -> None:
        super().__init__(*args)
        self.insert_deletes = insert_deletes
        self.changes_name = f"{self.name[:-1]}_changes`"
        self.changes_path = f"{self.path}_changes"

    def append(self, rows: DataFrame, delete: Column, batch: str) -> None:
        """Adds the changes of a batch: all columns of the table, no key twice; `delete` tells which of them are deletes."""
        self._enter_changes()
        commit = self._next_commit()
        stored = [c for c in self.spark.table(self.changes_name).columns if c not in (COMMIT, BUCKET)]
        marked = self.in_table_types(rows.withColumn(GONE, F.coalesce(delete, F.lit(False))))
        sliced = marked.select(*names(stored), F.lit(commit).alias(COMMIT), bucket_of(self.keys, self.buckets).alias(BUCKET))
        sliced.hint("rebalance", BUCKET).write.insertInto(self.changes_name)
        before = self._newest_note()
        note = {"commit": commit, "batch": batch, "live": before["live"], "buckets": self.buckets}
        write_text(self.spark, self._note_path(commit), json.dumps(note))
        self.finish()

    def compact(self, buckets: Collection[int] | None = None) -> set[int]:
        """Folds the changes of these buckets (all that have some) into their rows; returns the buckets."""
        self.finish()
        waiting = self._waiting(self._shown())
        touched = waiting if buckets is None else waiting & set(buckets)
        if touched:
            batch = self._shown()["batch"]
            self.replace(self.read(touched), touched, batch, placed=True)
        return touched

    def read(self, buckets: Collection[int] | None = None) -> DataFrame:
        if buckets is None:
            return super().read()
        if not buckets:
            return super().read([])
        return self.spark.sql(self._body(self._shown(), buckets)).select(*names(self.schema.names))

    def widen(self) -> list[str]:
        if not table_exists(self.spark, self.rows_name) or self._stored_changes():
            self._enter_rows()
        if table_exists(self.spark, self.changes_name):
            self._widen_entry(self.changes_name, self._enter_changes)
        return super().widen()

    def create(self, df: DataFrame, least: int = 1) -> None:
        drop_table(self.spark, self.changes_name)
        super().create(df, least)

    def _enter_rows(self, schema: T.StructType | None = None) -> None:
        super()._enter_rows(schema)
        if self._stored_changes():
            self._enter_changes()

    def _enter_changes(self, schema: T.StructType | None = None) -> None:
        if table_exists(self.spark, self.changes_name):
            return
        keys = ", ".join(names(self.keys))
        rows = [f for f in schema or self.spark.table(self.rows_name).schema if f.name not in (COMMIT, BUCKET)]
        columns = columns_sql([*rows, T.StructField(GONE, T.BooleanType()), *PLACE])
        self.spark.sql(
            f"CREATE TABLE {self.changes_name} ({columns}) USING parquet OPTIONS (compression '{CODEC}') PARTITIONED BY ({COMMIT}, {BUCKET}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{escaped(self.changes_path)}'"
        )
        if self._stored_changes():
            self.spark.sql(f"MSCK REPAIR TABLE {self.changes_name}")

    def _shown(self) -> dict:
        return self._note(int(self.properties()[SHOWN]))

    def _stored_changes(self) -> set[tuple[int, int]]:
        found = (re.search(rf"/{COMMIT}=(\d+)/{BUCKET}=(\d+)/", file) for file, _ in files_under(self.spark, self.changes_path))
        return {(int(m[1]), int(m[2])) for m in found if m}

    def _next_commit(self) -> int:
        return max([super()._next_commit(), *[c + 1 for c, _ in self._stored_changes()]])

    @staticmethod
    def _seen(note: Mapping, commit: int, bucket: int) -> bool:
        """Whether a change is in what the note shows, and not in the bucket's rows already."""
        return note["live"].get(bucket, (0, 0))[0] < commit <= note["commit"]

    def _waiting(self, note: Mapping) -> set[int]:
        return {b for c, b in self._stored_changes() if self._seen(note, c, b)}

    def _sweep(self, note: Mapping) -> None:
        commits = [c for c in self._notes() if c <= note["commit"]][-2:]
        shown = [self._note(c) for c in commits]
        gone = sorted((c, b) for c, b in self._stored_changes() if not any(self._seen(n, c, b) for n in shown))
        if gone:
            listed = ", ".join(f"PARTITION ({COMMIT} = {c}, {BUCKET} = {b})" for c, b in gone)
            self.spark.sql(f"ALTER TABLE {self.changes_name} DROP IF EXISTS {listed}")
            for c, b in gone:
                remove(self.spark, f"{self.changes_path}/{COMMIT}={c}/{BUCKET}={b}")
        super()._sweep(note)

    def _body(self, note: Mapping, buckets: Collection[int] | None = None) -> str:
        waiting = self._waiting(note)
        waiting = waiting if buckets is None else waiting & set(buckets)
        only = f" AND {BUCKET} IN ({', '.join(map(str, sorted(buckets)))})" if buckets is not None else ""
        if not waiting:
            return super()._body(note) + only
        columns = [c for c in self.spark.table(self.rows_name).columns if c != COMMIT]
        keys = names(self.keys)
        at = ", ".join(str(note["live"].get(b, (0, 0))[0]) for b in range(self._buckets_in(note)))
        newer = f"{COMMIT} > element_at(array({at}), {BUCKET} + 1) AND {COMMIT} <= {note['commit']}{only}"
        null_key = any_null_sql(self.keys)
        insert = str(self.insert_deletes).lower()

        def there(base: str) -> str:
            """After all changes of a key in their order: whether it has a row, if it had one or not before them."""
            return f"aggregate(__changes, {base}, (s, c) -> NOT c.{GONE} OR (NOT s AND {insert}))"

        folded = (
            f"SELECT {', '.join(f'{k} AS __k{i}' for i, k in enumerate(keys))}, element_at(__changes, -1) AS __last, "
            f"{there('true')} AS __if_row, {there('false')} AS __if_none FROM ("
            f"SELECT {', '.join(keys)}, array_sort(collect_list(struct(*)), (a, b) -> a.{COMMIT} - b.{COMMIT}) AS __changes "
            f"FROM {self.changes_name} WHERE {newer} AND NOT {null_key} GROUP BY {', '.join(keys)})"
        )
        rows = f"SELECT {', '.join(names(columns))}, true AS __row FROM {self.rows_name} WHERE {self._live_sql(note)}{only}"
        same = " AND ".join(f"r.{k} = f.__k{i}" for i, k in enumerate(keys))
        shown = ", ".join(f"CASE WHEN f.__last IS NULL THEN r.{quote(c)} ELSE f.__last.{quote(c)} END AS {quote(c)}" for c in columns)
        # a key that is null meets nothing: each such change is a row of its own
        alone = f"SELECT {', '.join(names(columns))} FROM {self.changes_name} WHERE {newer} AND {null_key} AND (NOT {GONE} OR {insert})"
        return (
            f"SELECT {shown} FROM ({rows}) r FULL JOIN ({folded}) f ON {same} "
            f"WHERE f.__last IS NULL OR CASE WHEN coalesce(r.__row, false) THEN f.__if_row ELSE f.__if_none END UNION ALL {alone}"
        )
