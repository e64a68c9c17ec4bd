"""Full load, incremental load and the whole run, for any collection."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_null, col
from tidemark.functions.docs import DELETE, KEY, OP, SEQ
from tidemark.operators.evolve import align_to_schema
from tidemark.operators.flatten import flatten
from tidemark.operators.latest import keep_latest
from tidemark.operators.merge import MergeCounts, merge, merge_colocated, merge_parts, no_repeats, replace_children, unrepeated
from tidemark.operators.parse import parse_docs, unreadable, unwrap_dates
from tidemark.plans.spec import CollectionSpec
from tidemark.session import CODEC, files_under, memory_bytes, remove, scratch_dir, stage, staged_bytes
from tidemark.sources.envelope import LOAD_PREFIX, envelope_schema, has_files, read_full_load
from tidemark.sources.onread import OnReadTable
from tidemark.sources.tables import BucketTable, create_database_of, default_name

# A staged batch is broadcast to the merge up to this many bytes in memory; a larger one is shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024
# A stored bucket of up to this many file bytes, with its share of the batch, is merged by one task; larger ones are shuffled to more.
# (Files of `CODEC` take 0.75 of what the session's did for tables and batches, and 0.57 for documents: these bounds stand for as many rows.)
TASK_BYTES = 48 * 1024 * 1024
# Buckets over this many file bytes are merged by joins that can split a key, too.
BUCKET_BYTES = 384 * 1024 * 1024
# A table is made with a bucket for so many bytes of its snapshot files at least: rows are 20 to 40 times larger in memory, where
# one task sorts those of a bucket and what a batch brings to it.
LANDED_BYTES = 4 * 1024 * 1024


def snapshot_to_rows(spec: CollectionSpec, envelopes: DataFrame) -> DataFrame:
    """Snapshot envelopes to rows of the curated table. No shuffle."""
    rows = unwrap_dates(parse_docs(envelopes, spec.doc_schema), spec.unwrap)
    if spec.array:
        rows = flatten(rows, spec.array, spec.child_fields, spec.child_prefix)
    return rows


def newest_changes(envelopes: DataFrame) -> DataFrame:
    """`keep_latest` of envelopes in files, after a job over their keys and sequences: which keys came at several sequences.

    Where none did, all rows stay as they lie; where these keys are small enough to broadcast, they drop the older rows. In
    neither case are the documents shuffled.
    """
    rows = envelopes.where(~any_null([KEY, SEQ]))
    ends = rows.groupBy(col(KEY).alias("__key")).agg(F.min(col(SEQ)).alias("__first"), F.max(col(SEQ)).alias("__newest"))
    several = ends.where("__first < __newest").select("__key", "__newest")
    size = memory_bytes(several)
    if not size:
        return rows
    if size > BROADCAST_BYTES:
        return keep_latest(envelopes)
    older = (col(KEY) == F.col("__key")) & (col(SEQ) < F.col("__newest"))
    return rows.join(F.broadcast(several), older, "left_anti")


def changes_to_rows(
    spec: CollectionSpec, envelopes: DataFrame, fields: Sequence[str] | None = None, newest: Callable[[DataFrame], DataFrame] = keep_latest
) -> DataFrame:
    """Change envelopes to the newest rows, with their operation code.

    Reduced (by `newest`) before parsing, so only surviving documents are parsed, and of those only the
    fields the table takes (or `fields`).
    """
    newest = newest(envelopes)
    schema = spec.change_schema or spec.doc_schema
    rows = unwrap_dates(parse_docs(newest, schema, fields or spec.change_fields()), spec.unwrap)
    if spec.array and spec.flatten_changes:
        rows = flatten(rows, spec.array, spec.child_fields, spec.child_prefix)
    return rows


def merge_rows(
    spec: CollectionSpec, target: DataFrame, rows: DataFrame, small_source: bool = False
) -> tuple[DataFrame, DataFrame]:
    if spec.parents:
        return replace_children(target, rows, spec.parents, small_source=small_source, **spec.options)
    unique = no_repeats(rows, spec.keys, spec.options.get("null_safe", ()))
    return merge_parts(target, rows, spec.keys, small_source=small_source, unique=unique, **spec.options)


def colocated(spec: CollectionSpec) -> bool:
    """Whether the merge goes by the very key that the table is stored by, and by nothing that `merge_colocated` lacks."""
    return not spec.parents and set(spec.options) <= {"insert_deletes", "seq_guard", "delete_when"}


def appendable(spec: CollectionSpec, rows: DataFrame) -> bool:
    """Whether a batch can wait beside the table: what it does must not hang on the values of the rows it meets."""
    return spec.on_read and colocated(spec) and "seq_guard" not in spec.options and set(spec.table_schema().names) <= set(rows.columns)


def is_small(staged: DataFrame) -> bool:
    """Whether a staged frame may be broadcast: by its size in memory. Files larger than the bound
    are not even measured, as rows are never smaller than their files."""
    return staged_bytes(staged) <= BROADCAST_BYTES and memory_bytes(staged) <= BROADCAST_BYTES


def staged_batch(spec: CollectionSpec, changes: DataFrame) -> tuple[DataFrame, bool, str]:
    """The reduced batch in the shared folder, whether it is small enough to broadcast, and the folder.

    A merge reads its source several times; staged, it is parsed once, and its true size
    decides between broadcast and shuffle.
    """
    path = scratch_dir(changes.sparkSession, f"{spec.name}-batch")
    rows = stage(changes_to_rows(spec, changes, newest=newest_changes), path=path, codec=CODEC)
    return rows, is_small(rows), path


def apply_changes(spec: CollectionSpec, target: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after a batch of changes. The batch is staged now, the merge is lazy."""
    rows, small, _ = staged_batch(spec, changes)
    if not small and not spec.parents and spec.options.get("on_duplicate", "error") == "error":
        checked = unrepeated(target, rows, spec.keys, spec.options.get("null_safe", ()))
        return merge(target, rows, spec.keys, **checked, **spec.options)
    kept, added = merge_rows(spec, target, rows, small_source=small)
    return kept.unionByName(added)


def table_for(spark: SparkSession, spec: CollectionSpec, path: str, name: str | None = None) -> BucketTable:
    own = (spark, name or default_name(spec.name, path), path, spec.table_schema(), spec.bucket_keys, spec.buckets)
    if spec.on_read:
        return OnReadTable(*own, insert_deletes=spec.options.get("insert_deletes", True))
    return BucketTable(*own)


def initial_load(
    spark: SparkSession, spec: CollectionSpec, landing: str, path: str, reload: bool = False, name: str | None = None
) -> BucketTable | None:
    """Create the table from the snapshot files; a table that exists is left alone unless
    `reload`. Without a snapshot file there is nothing to do, and no table. A large snapshot
    gets more buckets than the collection asks for.
    """
    table = table_for(spark, spec, path, name)
    if table.exists() and not reload:
        return table
    if not has_files(spark, f"{landing}/{spec.name}", f"{LOAD_PREFIX}*.parquet"):
        return None
    envelopes = read_full_load(spark, f"{landing}/{spec.name}", spec.seq_type)
    least = -(-landed_bytes(spark, f"{landing}/{spec.name}") // LANDED_BYTES)
    table.create(align_to_schema(snapshot_to_rows(spec, envelopes), spec.table_schema()), least)
    return table


def landed_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the snapshot files in a landing folder, from one listing."""
    return sum(size for file, size in files_under(spark, folder) if re.search(rf"/{LOAD_PREFIX}[^/]*\.parquet$", file))


def merge_into(spec: CollectionSpec, table: BucketTable, changes: DataFrame, batch: str) -> bool:
    """Merge one batch into the catalog table, once: a batch that is in already is skipped.

    Only the buckets its keys fall in are read and written. Columns that the collection has gained are added.
    """
    if not table.exists():
        raise ValueError(f"changes for {spec.name!r}, but its full load never came: no table at {table.path}")
    table.finish()
    if spec.keep_bad:
        bad = unreadable(spec.change_schema or spec.doc_schema)
        _upsert(bad_documents(spec, table), changes.where(bad), batch, SEQ)
        changes = changes.where(~bad)
    guard = spec.options.get("seq_guard")
    if table.has_batch(batch) and not (guard and not deleted_keys(spec, table, guard).has_batch(batch)):
        return False
    table.widen()
    path = scratch_dir(table.spark, f"{spec.name}-batch")
    rows = table.in_table_types(stage(changes_to_rows(spec, changes, newest=newest_changes), path=path, codec=CODEC))
    deleted = deleted_keys(spec, table, guard) if guard else None
    new = not table.has_batch(batch)
    if new:
        fresh = newer_than_deletes(spec, rows, deleted, guard) if deleted and deleted.exists() else rows
        touched, repeats = table.buckets_and_repeats(rows)
        if not repeats and appendable(spec, fresh):
            delete = spec.options.get("delete_when", f"{OP} = '{DELETE}'")
            table.append(fresh, F.expr(delete) if isinstance(delete, str) else delete, batch)
        elif not repeats and colocated(spec) and table.largest(touched) <= BUCKET_BYTES:
            counts = MergeCounts() if touched else None
            # a table may have outgrown its buckets, or the batch may be much larger than they are
            share = sum(size for _, size in files_under(table.spark, path)) // max(1, len(touched))
            placed = table.largest(touched) + share <= TASK_BYTES
            merged = merge_colocated(table.read(touched), fresh, spec.keys, table.buckets if placed else None, counts=counts, **spec.options)
            table.replace(merged, touched, batch, placed=placed, counts=counts)
        else:
            kept, added = merge_rows(spec, table.read(touched), fresh, small_source=is_small(fresh))
            table.replace(kept.unionByName(added), touched, batch)
    if deleted:
        gone = rows.where(F.col(OP) == DELETE).groupBy(*[col(k) for k in table.keys]).agg(F.max(col(guard)).alias(guard))
        _upsert(deleted, gone, batch, guard, seq_guard=guard)
    remove(table.spark, path)
    return new


def _side_table(table: BucketTable, label: str, schema: T.StructType, keys: Sequence[str]) -> BucketTable:
    """A table beside another one: what its merges have to remember."""
    name = f"{table.name[:-1]}_{label}`"
    return BucketTable(table.spark, name, f"{table.path}_{label}", schema, keys, table.buckets)


def deleted_keys(spec: CollectionSpec, table: BucketTable, seq: str) -> BucketTable:
    """Newest delete of each key. A change that is not newer must not bring the row back, so batches
    may come in any order (with `insert_deletes=False`; deletes that are added as rows are their own mark)."""
    fields = [f for f in table.schema if f.name in (*table.keys, seq)]
    return _side_table(table, "deleted", T.StructType(fields), table.keys)


def bad_documents(spec: CollectionSpec, table: BucketTable) -> BucketTable:
    """Changes whose document cannot be parsed, as they came."""
    return _side_table(table, "bad", envelope_schema(seq_type=spec.seq_type), [KEY])


def newer_than_deletes(spec: CollectionSpec, rows: DataFrame, deleted: BucketTable, seq: str) -> DataFrame:
    marks = deleted.read(deleted.buckets_of(rows)).toDF(*[f"__{c}" for c in deleted.schema.names])
    same = [col(k) == F.col(f"__{k}") for k in deleted.keys]
    return rows.join(marks, reduce(lambda a, b: a & b, [*same, col(seq) <= F.col(f"__{seq}")]), "left_anti")


def _upsert(table: BucketTable, rows: DataFrame, batch: str, seq: str, **options) -> None:
    """Merges rows into a side table, which is made with the first ones."""
    if not table.exists():
        table.create(table.spark.createDataFrame([], table.schema))
    table.finish()
    if table.has_batch(batch):
        return
    path = scratch_dir(table.spark, "side-rows")
    staged = stage(table.in_table_types(rows), path=path)
    touched = table.buckets_of(staged)
    kept, added = merge_parts(table.read(touched), staged, table.keys, delete_when=F.lit(False), on_duplicate="latest", order=[seq], **options)
    table.replace(kept.unionByName(added), touched, batch)
    remove(table.spark, path)


class RunError(RuntimeError):
    """Some collections of a run failed: `failures` by collection name; `tables` are those of the others, which went on."""

    def __init__(self, failures: dict[str, BaseException], tables: dict[str, BucketTable]) -> None:
        super().__init__("; ".join(f"{name}: {error}" for name, error in failures.items()))
        self.failures, self.tables = failures, tables


def run(
    spark: SparkSession,
    specs: Sequence[CollectionSpec],
    landing: str,
    tables: str,
    checkpoints: str,
    database: str | None = None,
    at_once: int = 4,
) -> dict[str, BucketTable]:
    """The daily run: for each collection the full load if it is due, then all change files
    that no earlier run has taken. Returns the tables by collection name; with a `database` they are
    its tables of that name.

    So many collections go `at_once`, each in a thread with the caller's session and a scheduler pool of its name (which
    shares the cluster evenly if `spark.scheduler.mode` is FAIR). One that fails does not hold up the others: what failed
    is raised at the end, as `RunError`.
    """
    from tidemark.streaming.changes import stream_changes

    if twice := sorted({s.name for s in specs if [t.name for t in specs].count(s.name) > 1}):
        raise ValueError(f"collections {twice} are there more than once: one writer a table")

    def one(spec: CollectionSpec) -> BucketTable:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        source, path = f"{landing}/{spec.name}", f"{tables}/{spec.name}"
        name = f"{database}.{spec.name}" if database else None
        table = initial_load(spark, spec, landing, path, name=name) or table_for(spark, spec, path, name)
        if has_files(spark, source):
            stream_changes(spark, spec, source, table, f"{checkpoints}/{spec.name}")
        return table

    if database:
        create_database_of(spark, f"{database}.any")
    done: dict[str, BucketTable] = {}
    failures: dict[str, BaseException] = {}
    with ThreadPoolExecutor(at_once, "collection") as threads:
        # a thread's local properties are those of the caller, so each job takes a copy of them along
        waiting = {spec.name: threads.submit(inheritable_thread_target(spark)(one), spec) for spec in specs}
        for name, job in waiting.items():
            try:
                done[name] = job.result()
            except Exception as e:
                failures[name] = e
    if failures:
        raise RunError(failures, done)
    return done
