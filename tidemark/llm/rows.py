"""What the text operators share: choosing columns, and running a function over Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import tidemark
from tidemark.functions.columns import col

#: ASCII white space: what separates words everywhere in this folder.
SPACE = r"\x20\x09-\x0D"


def utf8(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty. Costs nothing: Spark keeps text as UTF-8."""
    return F.coalesce(col(text).cast("binary"), F.lit(b""))


_SHIPPED: set[str] = set()


def ship(context: SparkContext) -> None:
    """Gives the workers this package, once for an application: Spark sends them the archive."""
    if context.applicationId in _SHIPPED:
        return
    root = Path(tidemark.__file__).parent
    handle, path = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Memory that is no longer used goes back to the system. A worker lives on after its task, and keeps it through other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


#: Rows that a function gets at a time, where it does not ask for more.
ROWS = 2000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of a batch on the way to Python, and one row at least: some rows hold megabytes.
BYTES = 4_000_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_rows(
    df: DataFrame, kept: int, added: str, function: Callable[[Iterator[list]], Iterator[list]], rows: int = ROWS
) -> DataFrame:
    """Rows by a function in Python: it gets an iterator over batches, each a list of columns (lists), and yields such batches.

    The result has the first `kept` columns of `df`, as they are, and the `added` ones (a DDL text). One batch of at
    most `rows` rows and about `BYTES` bytes is in a task's memory at a time; tasks keep nothing between batches unless the
    function does, and what they held goes back to the system at their end.
    """
    before, new = df.schema.fields[:kept], T._parse_datatype_string(added).fields if added else []
    # any name is taken: columns travel under names of their own
    out = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*before, *new])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)
        parts = (batch.slice(i, rows) for batch in batches for i in range(0, batch.num_rows, rows))
        columns = ([c.to_pylist() for c in part.columns] for part in parts)
        try:
            for result in function(columns):
                if result and len(result[0]):
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(result, arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        finally:
            result = arrays = None
            give_back()

    ship(df.sparkSession.sparkContext)
    # batches on the way to Python, too: by default they have five times as many rows
    conf = df.sparkSession.conf
    if int(conf.get(BATCH)) > ROWS:
        conf.set(BATCH, ROWS)
    conf.set(BATCH_BYTES, f"{BYTES}b")
    moved = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return moved.mapInArrow(run, out).toDF(*[f.name for f in [*before, *new]])
