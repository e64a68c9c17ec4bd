"""A corpus run: documents in, training tokens out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next stage's
documents. All but the last return the columns of `documents`.

In every stage a null text counts as an empty one and stays null where the text is returned. A null doc_id, lang, source or
n_chars is carried on as it is, repeated rows are decided alike (of copies with words, one row stays), an empty table gives no rows,
columns beyond those of `documents` are left out whatever their names, and texts are taken whole at any length.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, contamination, jaccard_join, personal_data, toxicity
from tidemark.llm.queries import RANKS
from tidemark.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labels of the others' documents too."""
    model = toxicity.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep=COLUMNS).where("predicted = 0").select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies (runs of five words, 0.8 of them shared) the first document stays."""
    return jaccard_join.one_of_each(docs, rule=jaccard_join.Rule(percent=80, size=5)).select(*COLUMNS)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go in which at least one word in twenty belongs to a passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.find_contamination(docs, items, keep=COLUMNS)
    return found.where(~contamination.mask_contaminated(found)).select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind; every document stays."""
    found = personal_data.redact(personal_data.find_personal_data(docs))
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    coded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source", "text"), round_trip=True)
    whole = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        "ids",
        (F.col("decoded") == whole).alias("round_trip"),
    )


#: One after the other; the name of each and its function.
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near copies", without_copies),
    ("decontamination", without_benchmarks),
    ("personal data", without_personal_data),
    ("tokens", tokens),
]

#: No SQL: the stages learn a classifier, join on similarity and run a tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
