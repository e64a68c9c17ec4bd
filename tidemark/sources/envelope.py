"""Change-feed envelopes: declared schemas and the two landing scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.docs import CHANGED_AT, DOC, KEY, OP, SEQ

# Fixed value: snapshot files are told from change files by this name prefix.
LOAD_PREFIX = "LOAD"


def envelope_schema(with_op: bool = True, seq_type: T.DataType | None = None) -> T.StructType:
    """`transact_seq` may be any orderable type; a text sequence compares as text."""
    fields = [
        T.StructField(KEY, T.StringType()),
        T.StructField(SEQ, seq_type or T.LongType()),
        T.StructField(CHANGED_AT, T.TimestampType()),
        T.StructField(DOC, T.StringType()),
    ]
    return T.StructType(([T.StructField(OP, T.StringType())] if with_op else []) + fields)


def read_full_load(spark: SparkSession, landing: str, seq_type: T.DataType | None = None) -> DataFrame:
    """Every snapshot file of one collection; the name pattern is applied when listing."""
    return (
        spark.read.schema(envelope_schema(with_op=False, seq_type=seq_type))
        .option("pathGlobFilter", f"{LOAD_PREFIX}*.parquet")
        .parquet(landing)
    )


def is_change_file():
    return ~F.col("_metadata.file_name").startswith(LOAD_PREFIX)


def read_changes(spark: SparkSession, landing: str, seq_type: T.DataType | None = None) -> DataFrame:
    """Every change file of one collection: all parquet files that are not snapshots."""
    return (
        spark.read.schema(envelope_schema(seq_type=seq_type))
        .option("pathGlobFilter", "*.parquet")
        .parquet(landing)
        .where(is_change_file())
    )


def has_files(spark: SparkSession, landing: str, pattern: str = "*.parquet") -> bool:
    """Whether the folder is there and holds such a file; no file is opened."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(landing)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return not files.select("path").isEmpty()
