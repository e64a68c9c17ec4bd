"""Which landing files were already taken in: a ledger table instead of moving files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.envelope import envelope_schema, is_change_file

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("run_date", T.DateType()),
    ]
)


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """One row per landing change file: name and size only, the content is never read. The
    name is written as the change scan writes it, so the two can be compared."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(landing)
        .where(is_change_file())
        .select(F.col("_metadata.file_path").alias("path"), "length")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def create_ledger(spark: SparkSession, ledger: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(ledger)


def unprocessed_files(spark: SparkSession, landing: str, ledger: str) -> DataFrame:
    return list_files(spark, landing).join(read_ledger(spark, ledger), "path", "left_anti")


def read_unprocessed(
    spark: SparkSession, landing: str, ledger: str, seq_type: T.DataType | None = None
) -> DataFrame:
    """Change rows of the files that the ledger does not list yet; no other file is opened.

    Only names of new files reach the driver, where Spark plans the scan of them anyway.
    """
    new = [unquote(r["path"]) for r in unprocessed_files(spark, landing, ledger).select("path").collect()]
    schema = envelope_schema(seq_type=seq_type)
    return spark.read.schema(schema).parquet(*new) if new else spark.createDataFrame([], schema)


def record_files(files: DataFrame, ledger: str, run_date: str | None = None) -> None:
    """Append the files of a finished run; `run_date` (UTC) makes a rerun repeatable."""
    day = F.lit(run_date).cast("date") if run_date else F.to_date(F.to_utc_timestamp(F.now(), F.current_timezone()))
    files.select("path", day.alias("run_date")).write.mode("append").parquet(ledger)
