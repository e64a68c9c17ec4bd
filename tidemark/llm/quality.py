"""Quality rules, and robust multivariate outliers by language and source. DataFrame functions only.

Counts of each text are turned into a vector; for each cell (language, source) the minimum-covariance-
determinant estimate of centre and covariance is found by concentration steps: fit the rows nearest so far,
measure all rows, keep the nearest, again. Rows far away by Mahalanobis distance are rejected. Every cell has a
centre of its own. Its covariance is drawn towards the average within all cells, which counts as much as a
fixed number of its rows: the fewer rows a cell has, the more, and at no size there is a switch. The texts are
read once; the steps run over the staged numbers, as sums by cell that are formed before any shuffle, so a cell
of any size is no hot key. Cutting at the nearest share uses a histogram of distances, not a sort.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.rows import SPACE
from tidemark.session import stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The vector: what it holds, and the least spread (standard deviation) each part is taken to have in any cell.
#: The floor keeps a part that is constant in most texts from rejecting every text that differs.
VECTOR = {
    "log_words": ("log10(n_words)", 0.25),
    "word_length": ("log10(word_chars / n_words)", 0.05),
    "symbols": ("sqrt(n_symbols / word_chars)", 0.03),
    "dup_lines": ("sqrt(n_dup_lines / n_words)", 0.05),
    "repeats": ("sqrt(n_repeat_words / n_words)", 0.1),
}


@dataclass(frozen=True)
class Robust:
    """share: of a cell's rows that are fitted. steps: concentration steps. quantile: of the chi-square distribution,
    beyond which a squared distance is rejected, in units in which the median row has that distribution's median.
    shared: rows of a cell that the average covariance within all cells counts for."""

    share: float = 0.75
    steps: int = 4
    quantile: float = 0.99999
    shared: float = 30.0

    @property
    def cutoff(self) -> float:
        """The quantile, for as many degrees as the vector has parts (5), by halving."""
        low, high = 0.0, 1000.0
        for _ in range(100):
            x = (low + high) / 2
            below = math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
            low, high = (x, high) if below < self.quantile else (low, x)
        return low


#: Median of the chi-square distribution with as many degrees as the vector has parts (5).
MEDIAN = 4.351
#: Histogram bins in each doubling of the distance.
BINS = 16


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs` and the five counts (long). Null counts as empty."""
    whole = F.coalesce(col(text), F.lit(""))
    words = F.filter(F.split(whole, f"[{SPACE}]+", -1), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    cut = docs.withColumns({"__words": words, "__lines": lines})
    w = F.col("__words")
    cut = cut.withColumn("__triples", F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(_triples(w)))
    triple = F.col("__triples")
    return cut.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.when(F.size(F.array_distinct(triple)) == F.size(triple), 0).otherwise(_covered(triple)).cast("long"),
        }
    ).drop("__words", "__lines", "__triples")


def _triples(words: Column) -> Column:
    """64-bit hash of each run of three words."""
    n = F.size(words)
    two = F.zip_with(words, F.slice(words, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    three = F.zip_with(F.slice(two, F.lit(1), n - 2), F.slice(words, F.lit(3), n), lambda x, c: F.xxhash64(x["a"], x["b"], c))
    return three


def _covered(triples: Column) -> Column:
    """Words in runs whose hash comes twice: equal hashes are neighbours once sorted with their places."""
    placed = F.sort_array(F.transform(triples, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(
        F.slice(placed, F.lit(1), F.size(triples) - 1),
        F.slice(placed, F.lit(2), F.size(triples)),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)),
    )
    return F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def _cell(columns: tuple[str, ...]) -> Column:
    """One text for the values of the columns; null is a value of its own, and no two lists give the same text."""
    parts = [F.coalesce(F.concat(F.length(col(c).cast("string")), F.lit(":"), col(c).cast("string")), F.lit("null")) for c in columns]
    return F.concat_ws(" ", F.lit("cell"), *parts)


def _fit(rows: DataFrame, parts: list[str], floors: list[float], shared: float) -> DataFrame:
    """By cell: mean and Cholesky factor of the covariance (blended with the average one, floors added on its diagonal)."""
    below = [(i, j) for i in range(len(parts)) for j in range(i + 1)]
    sums = [F.avg(p).alias(f"m_{p}") for p in parts]
    cross = [F.covar_pop(parts[i], parts[j]).alias(f"c_{i}_{j}") for i, j in below]
    fit = stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sums, *cross), "quality-sums")
    # one row of fifteen numbers
    average = fit.agg(*[(F.sum(F.col("n") * F.col(f"c_{i}_{j}")) / F.sum("n")).alias(f"c_{i}_{j}") for i, j in below]).first()
    for i, j in below:
        common = F.lit(float(average[f"c_{i}_{j}"] or 0.0))
        blended = (F.col("n") * F.col(f"c_{i}_{j}") + shared * common) / (F.col("n") + shared)
        rest = blended - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            fit = fit.withColumn(f"l_{i}_{i}", F.sqrt(F.greatest(rest, F.lit(0.0)) + F.lit(floors[i] ** 2)))
        else:
            fit = fit.withColumn(f"l_{i}_{j}", rest / F.col(f"l_{j}_{j}"))
    return fit.select("cell", *[f"m_{p}" for p in parts], *[f"l_{i}_{j}" for i, j in below])


def _measure(rows: DataFrame, fit: DataFrame, parts: list[str]) -> DataFrame:
    """Rows with their squared distance `d2` from the fit of their cell."""
    wanted = rows.columns
    out = rows.drop("d2").join(fit, "cell", "left")
    for i, p in enumerate(parts):
        rest = F.col(p) - F.col(f"m_{p}") - sum((F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(parts))), F.lit(0.0))
    return out.select(*[c for c in wanted if c != "d2"], d2.alias("d2"))


def _quantile(rows: DataFrame, share: float) -> DataFrame:
    """By cell: the distance that `share` of the rows do not pass, to the width of a histogram bin."""
    binned = F.floor(BINS * F.log2(F.greatest("d2", F.lit(1e-9)))).alias("bin")
    # staged by cell and bin, so that what is ordered by cell are bins, a few hundred each, whatever the rows
    bars = stage(rows.groupBy("cell", binned).agg(F.count("*").alias("n")), "quality-bins")
    run = bars.selectExpr(
        "cell", "bin", "sum(n) OVER (PARTITION BY cell ORDER BY bin) AS upto", "sum(n) OVER (PARTITION BY cell) AS total"
    )
    return run.where(F.col("upto") >= share * F.col("total")).groupBy("cell").agg(F.pow(F.lit(2.0), (F.min("bin") + 1) / BINS).alias("cut"))


def judge(
    docs: DataFrame,
    text: str = "text",
    cell: tuple[str, ...] = ("lang", "source"),
    keep: tuple[str, ...] = ("doc_id",),
    robust: Robust = Robust(),
) -> DataFrame:
    """`keep` columns, the five counts, `base_failed`, `kept` and `distance2`.

    A text that fails the base rules is not kept, is not fitted and has no distance. The others are kept up to
    the cutoff. Null and empty texts fail the base rules. A null language or source is a value of its own. Rows
    with the distance of the cutoff are kept. Equal rows get equal verdicts, and repeated rows each get one. Columns of `docs` that are not named play no part.
    Counts and estimates cover all rows; an empty table gives none.
    """
    slim = docs.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], _cell(cell).alias("__cell"), col(text).alias("text"))
    counted = stage(text_counts(slim).drop("text").withColumn("base_failed", base_failed()), "quality")
    judged = _verdicts(counted, robust)
    return judged.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *COUNTS, "base_failed", "kept", "distance2")


def _verdicts(counted: DataFrame, robust: Robust) -> DataFrame:
    parts, floors = list(VECTOR), [floor for _, floor in VECTOR.values()]
    vector = [F.expr(VECTOR[p][0]).alias(p) for p in parts]
    good = counted.where("NOT base_failed")
    rows = good.select(F.col("__cell").alias("cell"), *vector)

    centre = rows.groupBy("cell").agg(*[F.percentile_approx(p, [0.25, 0.5, 0.75], 1000).alias(p) for p in parts])
    first = centre.select(
        "cell",
        *[F.col(p)[1].alias(f"m_{p}") for p in parts],
        *[
            (F.sqrt(F.pow((F.col(parts[i])[2] - F.col(parts[i])[0]) / 1.349, 2) + F.lit(floors[i] ** 2)) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}")
            for i in range(len(parts))
            for j in range(i + 1)
        ],
    )
    fit = stage(first, "quality-fit")
    for _ in range(robust.steps):
        measured = _measure(rows, fit, parts)
        cut = stage(_quantile(measured, robust.share), "quality-cut")
        fit = stage(_fit(measured.join(cut, "cell").where("d2 <= cut"), parts, floors, robust.shared), "quality-fit")
    scale = stage(_quantile(_measure(rows, fit, parts), 0.5).select("cell", F.greatest(F.col("cut") / MEDIAN, F.lit(1.0)).alias("scale")), "quality-scale")

    kept = counted.columns
    # a text without words has no vector, and a join may have it computed for every row: its divisions are for the others only
    of_good = [F.when(~F.col("base_failed"), F.expr(VECTOR[p][0])).alias(p) for p in parts]
    vectors = counted.select(*[col(c) for c in kept], F.col("__cell").alias("cell"), *of_good)
    d2 = _measure(vectors, fit, parts).join(scale, "cell", "left")
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    return d2.select(
        *[col(c) for c in kept if c != "__cell"],
        F.coalesce(distance <= robust.cutoff, F.lit(False)).alias("kept"),
        distance.alias("distance2"),
    )
