"""The change feed as a file stream: every file is taken once, without moving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.spec import CollectionSpec
from tidemark.sources.envelope import envelope_schema, is_change_file
from tidemark.sources.tables import BucketTable


def change_stream(
    spark: SparkSession,
    spec: CollectionSpec,
    landing: str,
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Streaming scan of a collection's change files; `archive` moves taken files there."""
    reader = spark.readStream.schema(envelope_schema(seq_type=spec.seq_type)).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(landing).where(is_change_file())


def stream_changes(
    spark: SparkSession,
    spec: CollectionSpec,
    landing: str,
    table: BucketTable,
    checkpoint: str,
    files_per_batch: int | None = None,
    archive: str | None = None,
    timeout: int | None = None,
) -> BucketTable:
    """Merge every change file not taken yet, then stop.

    The checkpoint remembers the files. A batch that ran but was not recorded is run
    again with the same number, and the table skips a number that is in. With a `timeout`
    (seconds) that is not enough, the stream is stopped and TimeoutError raised.
    """
    from tidemark.plans.loads import merge_into

    def take(batch: DataFrame, number: int) -> None:
        merge_into(spec, table, batch, f"{spec.name}-{number}")

    query = (
        change_stream(spark, spec, landing, files_per_batch, archive)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"changes of {spec.name!r} not all merged after {timeout} s; the next run goes on from there")
    return table
