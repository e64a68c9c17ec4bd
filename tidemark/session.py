"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quote

# What is staged is read from its files, so the shuffles behind it can go as soon as it is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# How tables and batches lie on the disks: half of what Spark's default takes, for some more CPU seconds.
CODEC = "zstd"

# Runtime settings the operators count on; a cluster may set them higher or lower.
SETTINGS = {
    CLEANUP: "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # a stored bucket is one sorted file, so a join by its key need not sort it again
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Scratch folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is named (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\[\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared scratch folder, used by nobody else."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Cuts the lineage, fixes the rows for every later use, and gives the planner
    (and `staged_bytes`) the true size instead of an estimate. Survives the loss of
    executors, because nothing of it lives on them. `codec`: of the files, else the session's.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").options(**({"compression": codec} if codec else {})).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a staged folder that nothing needs any more."""
    place, system = _file_system(spark, path)
    system.delete(place, True)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of every file below a folder, from one recursive listing; none if it is not there."""
    place, system = _file_system(spark, path)
    if not system.exists(place):
        return []
    found, files = [], system.listFiles(place, True)
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen()))
    return found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside its place, then renamed."""
    place, system = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(beside, True)
    out.write(text.encode())
    out.close()
    if not system.rename(beside, place):
        raise OSError(f"{path} is there already")


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _file_system(spark, path)
    opened = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def memory_bytes(df: DataFrame) -> int:
    """Bytes of the rows in memory: measured text and nested values, 16 for each other value.

    Files say nothing about this: parquet keeps a text that many rows repeat only once.
    """
    wide = [f for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    measured = [
        f"coalesce(octet_length({quote(f.name)}), 0)"
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
        else f"coalesce(octet_length(to_json(struct({quote(f.name)}))), 0)"
        for f in wide
    ]
    each = " + ".join([*measured, str(16 * len(df.schema))])
    return df.selectExpr(f"coalesce(sum({each}), 0)").first()[0]


def staged_bytes(staged: DataFrame) -> int:
    """File bytes of a staged frame, from file metadata; one number reaches the driver."""
    files = staged.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
