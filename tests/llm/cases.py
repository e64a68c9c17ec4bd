"""Documents with the edge cases that every operator must take, and the given small tables."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
# names that operators use for themselves, as columns of the caller
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, n_words string, __text string, k0 string, row string, `a.b` string"

TEXTS = [
    None,
    "",
    " ",
    "\n\t \x0b\x0c\r\n",
    "one",
    "One two",
    "one two three",
    "a b   c",
    "ünïcödé 日本語 \U0001f600 naïve",
    "same words here again " * 30,
    "same words here again " * 30,
    "\x00 nul \x01",
    "x" * 5000,
    "the long one " + " ".join(f"w{i % 977} v{i}" for i in range(20000)),
    "line one is here\nline one is here\n\n  \nline two $$$ ### |\nline one is here",
    "ab" * 700 + " tail",
    "...!!! ??? ''s 's 're",
]


def edge_rows() -> list[tuple]:
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else "s", None, "x", "y", "z", "k", "r", "d") for i, t in enumerate(TEXTS)]
    rows += [(None, "null id here", "en", "s", 1, *"xyzkrd"), (3, "repeated row", "en", "s", 1, *"xyzkrd")]
    return rows + rows[-1:]


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def given(table: str = "documents", sf: str = SF) -> list[dict]:
    return pq.read_table(f"{sf}/{table}.parquet").to_pylist()
