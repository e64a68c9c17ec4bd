"""A toxicity classifier that is regularised by counterfactuals.

Logistic regression on the distinct words of a text and the beginnings of those words, hashed. Long words, and those
in scripts that mostly go without spaces, are looked at in all their places, by short pieces. In labelled texts
that mention a group, the terms are swapped for other groups' terms; the squared change of the score between
the two is part of the loss, so mentioning a group, by itself, is kept from moving the score.

Features are made where the rows are; the fit takes a bounded, documented sample of labelled rows; the model is
one vector of fixed size, so its broadcast is bounded.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, names
from tidemark.llm.contamination import NORMAL
from tidemark.llm.rows import map_rows, utf8

#: Size of the hashed feature space, and so of the model.
SPACE = 1 << 18
#: Words a task remembers; later new ones are hashed each time. Bounds memory, not results.
REMEMBERED = 400_000
#: Beginnings of a word that are features of their own, in bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Words longer than this, or with characters of three bytes or more, have pieces of so many bytes from each character on.
WORD_BYTES, PIECE = 64, 6

# Words for groups of people that are swapped for each other, one list for each kind and language.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("woman", "man"),
    ("women", "men"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "foreigner"),
    ("immigrants", "refugees", "foreigners"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("musulmán", "cristiano", "judío", "hindú", "budista"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)


@dataclass(frozen=True)
class Fit:
    """per_class: labelled rows of each class that are fitted, at most (the lowest by a hash of the id).
    counterfactual: weight of the squared score changes. l1: shrinkage. positive: total weight of class 1 as a
    share of class 0. steps, rate: of AdaGrad. least_texts: sampled texts a feature must be in."""

    per_class: int = 4000
    counterfactual: float = 1.0
    l1: float = 0.5
    positive: float = 1.0
    steps: int = 150
    rate: float = 0.3
    least_texts: int = 2
    terms: tuple[tuple[str, ...], ...] = field(default=IDENTITY_TERMS)


def features(word: bytes) -> tuple[int, ...]:
    parts = [b"w" + word, *(b"%d" % n + word[:n] for n in BEGINNINGS if len(word) > n)]
    if len(word) > WORD_BYTES or max(word, default=0) >= 0xE0:
        parts += {b"p" + word[i : i + PIECE] for i in range(len(word) - PIECE + 1) if word[i] & 0xC0 != 0x80}
    return tuple({zlib.crc32(p) % SPACE: None for p in parts})


def words_of(text: bytes) -> set[bytes]:
    return set(text.lower().translate(NORMAL).split())


def _features_of(words: set[bytes]) -> set[int]:
    return {f for w in words for f in features(w)}


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[bytes, bytes]:
    """Each term and the next one of its list."""
    return {a.encode(): b.encode() for group in terms for a, b in zip(group, group[1:] + group[:1]) if a != b}


def counterfactual(words: set[bytes], swap: dict[bytes, bytes]) -> set[bytes] | None:
    """The words with identity terms swapped; None if there is none to swap."""
    return {swap.get(w, w) for w in words} if not words.isdisjoint(swap) else None


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _sparse(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each entry."""
    sizes = [len(p) // 4 for p in packed]
    return np.repeat(np.arange(len(packed), dtype=np.int64), sizes), np.frombuffer(b"".join(packed), dtype=np.int32).astype(np.int64)


def train(texts: list[bytes], swapped: list[bytes | None], labels: list[int], fit: Fit) -> Model:
    """From packed feature ids of texts, and of their counterfactuals where there are any."""
    y, n = np.array(labels, dtype=float), len(labels)
    ones = y.sum()
    if not 0 < ones < n:
        return Model(np.zeros(SPACE, dtype=np.float32), float(np.log((ones + 0.5) / (n - ones + 0.5))))
    row, feature = _sparse(texts)
    common = np.bincount(feature, minlength=SPACE) >= fit.least_texts
    row, feature = row[common[feature]], feature[common[feature]]
    # a pair counts by the features in which its two texts differ
    plus, minus = [], []
    for own, other in zip(texts, swapped):
        if other is not None:
            a, b = set(np.frombuffer(own, dtype=np.int32).tolist()), set(np.frombuffer(other, dtype=np.int32).tolist())
            plus.append(np.array(sorted(a - b), dtype=np.int32).tobytes())
            minus.append(np.array(sorted(b - a), dtype=np.int32).tobytes())
    (row_p, feat_p), (row_m, feat_m), pairs = _sparse(plus), _sparse(minus), len(plus)
    weight = np.where(y == 1, fit.positive * (n - ones) / ones, 1.0)
    w, b = np.zeros(SPACE), -1.0
    seen, seen_b = np.full(SPACE, 1e-6), 1e-6
    for _ in range(fit.steps):
        z = np.bincount(row, w[feature], n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        slope = np.bincount(feature, error[row], SPACE)
        if pairs:
            change = np.bincount(row_p, w[feat_p], pairs) - np.bincount(row_m, w[feat_m], pairs)
            slope += 2 * fit.counterfactual * (np.bincount(feat_p, change[row_p], SPACE) - np.bincount(feat_m, change[row_m], SPACE))
        seen += slope * slope
        seen_b += error.sum() ** 2
        w -= fit.rate * slope / np.sqrt(seen)
        b -= fit.rate * error.sum() / np.sqrt(seen_b)
        w = np.sign(w) * np.maximum(np.abs(w) - fit.rate * fit.l1 / np.sqrt(seen), 0)
    return Model(w.astype(np.float32), float(b))


def held_out(key: str = "doc_id") -> Column:
    """Rows that are not learnt from."""
    return F.coalesce(F.crc32(col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", fit: Fit = Fit()) -> Model:
    """Fits the labelled, not held-out rows, up to `fit.per_class` of each class. Rows without a key or a label
    are not fitted; a key with several labels has its largest; no rows, or one class: a constant score."""
    known = labels.select(col(key).alias("key"), col(label).cast("int").alias("label")).dropna().groupBy("key").agg(F.max("label").alias("label"))
    known = known.where(~held_out("key"))
    some = [known.where(F.col("label") == x).orderBy(F.xxhash64("key"), "key").limit(fit.per_class) for x in (0, 1)]
    # at most 2 x per_class keys
    sample = docs.select(col(key).alias("key"), utf8(text).alias("text")).join(F.broadcast(some[0].union(some[1])), "key")
    swap = swaps(fit.terms)

    def run(batches):
        pack = lambda words: np.array(sorted(_features_of(words)), dtype=np.int32).tobytes()
        for texts, marks in batches:
            words = [words_of(t) for t in texts]
            others = [counterfactual(w, swap) for w in words]
            yield [[pack(w) for w in words], [None if o is None else pack(o) for o in others], marks]

    rows = map_rows(sample.select("text", "label"), 0, "own binary, other binary, label int", run).orderBy(F.xxhash64("own"), "own", "label")
    # a key that many documents share must not take the sample over its bound
    rows = rows.limit(2 * fit.per_class).collect()
    return train([bytes(r.own) for r in rows], [None if r.other is None else bytes(r.other) for r in rows], [r.label for r in rows], fit)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `score` (0 to 1) and `predicted` (1 from 0.5 on).

    Only the text is looked at, whole; null and empty texts get the score of a text without words. Rows are
    scored where they are; repeated rows each give a row; columns that are not kept play no part.
    """
    chosen = docs.select(*names(keep), utf8(text).alias("__text"))
    weights = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
    shared, bias = docs.sparkSession.sparkContext.broadcast(weights), model.bias

    def run(batches):
        own, known = shared.value, {}

        def look(word: bytes) -> tuple[int, ...]:
            found = tuple(f for f in features(word) if f in own)
            if len(known) < REMEMBERED and len(word) <= WORD_BYTES:
                known[word] = found
            return found

        for *kept, texts in batches:
            logits = []
            for t in texts:
                found: set[int] = set()
                for w in words_of(t):
                    hit = known.get(w)
                    if hit is None:
                        hit = look(w)
                    if hit:
                        found.update(hit)
                logits.append(bias + sum(own[f] for f in sorted(found)))
            scores = (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()
            yield [*kept, scores, [int(s >= 0.5) for s in scores]]

    return map_rows(chosen, len(keep), "score double, predicted int", run)
