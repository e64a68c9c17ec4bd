"""Ranked lexical search: no random access (NRA) over impact-sorted lists.

What a term adds to a document's score depends on the pair alone, so each term has a list of its documents, largest
share first. The lists of an item's terms are read from the front only, a portion at a time. A document's lower bound is
the sum of the shares read so far; its upper bound adds, for each list it has not been met in, the share at which reading
stands (nothing, once the list is at its end). Reading goes on until no unmet document can come among the best any more,
and each that still can has all its shares known: then membership, ties and scores are final. Lists that no open document
waits for are read no further.

The documents are cut into blocks with lists of their own, so that a frequent term's list is cut too, and memory is
bounded by the block. A task goes through its blocks with the best documents so far in hand; their last score is the bar
that the next block's lists are read against, which is why most of them are read only a little. Only the best of each
task are shuffled.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.rows import map_rows, utf8
from tidemark.session import stage

#: Documents whose lists are in memory at a time; fewer, where an item has so many terms that the marks of what was met
#: where would take more than so many bytes.
BLOCK, MARKS = 8192, 1 << 26
#: Item sets with more bytes of text are taken in parts, each searching all documents.
ITEM_BYTES = 2 * 1024 * 1024
#: Entries read from a list at first; each further portion is twice the one before.
PORTION = 64

#: All but letters, digits and bytes of other scripts separates terms; A-Z become small.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def weight(docs: int, holding: int) -> int:
    """A term's weight, from the numbers of documents with terms, and of those that hold it."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


class Lists:
    """Impact-sorted lists of a block: for each term its documents and shares, largest share first."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, share: np.ndarray, n_terms: int, n_docs: int) -> None:
        order = np.lexsort((doc, -share, term))
        self.doc, self.share = doc[order], share[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_docs = n_docs

    def best(self, wanted: list[tuple[int, int]], top: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and final scores of all that can be among the `top` best, none of them under `bar`.

        `wanted` are terms and what their shares count in the item. Ties are kept whole.
        """
        wanted = [(t, w) for t, w in wanted if self.start[t] < self.start[t + 1]]
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = np.array([self.start[t] for t, _ in wanted])
        stop = np.array([self.start[t + 1] for t, _ in wanted])
        times = np.array([w for _, w in wanted], np.int64)
        lower = np.zeros(self.n_docs, np.int64)
        met = np.zeros((len(wanted), self.n_docs), bool)
        at, size = start.copy(), PORTION
        needed = at < stop
        while True:
            for i in np.flatnonzero(needed):
                upto = min(at[i] + size, stop[i])
                docs = self.doc[at[i] : upto]
                lower[docs] += times[i] * self.share[at[i] : upto]
                met[i, docs] = True
                at[i] = upto
            size *= 2
            # the next share of a list bounds all that follow it
            ahead = np.where(at < stop, times * self.share[np.minimum(at, len(self.share) - 1)], 0)
            bar = max(bar, int(np.partition(lower, -top)[-top]) if self.n_docs >= top else 0, 1)
            open_docs = np.flatnonzero(lower > 0)
            upper = lower[open_docs] + ahead.sum() - ahead @ met[:, open_docs]
            open_docs = open_docs[upper >= bar]
            if ahead.sum() >= bar:
                needed = at < stop  # a document not met anywhere could still come in
            else:
                needed = (at < stop) & ~met[:, open_docs].all(axis=1)
            if not needed.any():
                final = open_docs[lower[open_docs] >= bar]
                return final, lower[final]


def _searcher(items: list[tuple[list[tuple[int, int]], int]], n_terms: int, mean: tuple[int, int], top: int):
    """Searches block after block for all items, and gives the best of the whole task at the end."""
    docs_total, terms_total = mean

    def run(batches: Iterator[list]) -> Iterator[list]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        ids: list = []

        def search(block: list[tuple]) -> None:
            rows = [np.frombuffer(packed, np.int64).reshape(2, -1) for *_, packed in block]
            sizes = np.array([r.shape[1] for r in rows])
            pairs = np.concatenate(rows, axis=1) if rows else np.zeros((2, 0), np.int64)
            m = np.array([75 + 25 * n * docs_total // terms_total for _, n, _ in block], np.int64)
            doc = np.repeat(np.arange(len(block)), sizes)
            share = (1_000_000_000 * pairs[1]) // (1000 * pairs[1] + 12 * m[doc])
            lists = Lists(pairs[0], doc, share, n_terms, len(block))
            first = len(ids)
            ids.extend(key for key, _, _ in block)
            for i, (wanted, _) in enumerate(items):
                if not wanted:
                    continue
                found, scores = best[i]
                bar = int(scores.min()) if len(scores) >= top else 0
                more, their = lists.best(wanted, top, bar)
                if len(more):
                    best[i] = _least_ids(np.concatenate([found, more + first]), np.concatenate([scores, their]), ids, top)
            kept = sorted({int(d) for found, _ in best for d in found})
            place = {d: j for j, d in enumerate(kept)}
            ids[:] = [ids[d] for d in kept]
            for i, (found, scores) in enumerate(best):
                best[i] = (np.array([place[int(d)] for d in found], np.int64), scores)

        size = max(1, min(BLOCK, MARKS // max([1, *(len(wanted) for wanted, _ in items)])))
        block: list[tuple] = []
        for columns in batches:
            for row in zip(*columns):
                block.append(row)
                if len(block) == size:
                    search(block)
                    block = []
        if block:
            search(block)
        for (found, scores), (_, item) in zip(best, items):
            yield [[item] * len(found), [ids[d] for d in found], scores.tolist()]

    return run


def _order(key) -> tuple:
    return (key is None, 0 if key is None else key)


def _least_ids(docs: np.ndarray, scores: np.ndarray, ids: list, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The `top` best: by score, then by ascending id; a null id comes last."""
    ranked = sorted(range(len(docs)), key=lambda i: (-scores[i], _order(ids[docs[i]])))[:top]
    return docs[ranked], scores[ranked]


def _parts(items: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items in parts of bounded size, as their place in the staged frame and their text."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 if total <= limit else 2 * -(-total // limit)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("place"), F.lit(n)) == i)
        yield [(r.place, bytes(r.text)) for r in part.select("place", "text").collect()]


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Each item's `top` best documents with a score above 0: `item_key`, `rank` (from 1), `key`, `score`.

    Equal scores rank by ascending document key, which is a number; a null key comes last. Repeated documents are
    ranked each, as are repeated items (with rows of their own, also under one key). A null or empty text has no terms: such a document is never found and
    not counted, such an item has no rows; neither has an item whose terms no document holds. Empty tables give an empty
    result. Other columns play no part, whatever their names. Items beyond `item_bytes` are searched in parts, one after
    the other, with the same result.
    """
    spark = docs.sparkSession
    own = items.select(col(item_key).alias("item"), utf8(item_text).alias("text"))
    own = stage(own.withColumn("place", F.monotonically_increasing_id()), "search-items")
    found: list[DataFrame] = []
    for part in _parts(own, item_bytes):
        found.append(_search_part(docs, part, top, text, key))
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    ranked = Window.partitionBy("place").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    rows = rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    # one row for each item and rank: small beside the documents
    keyed = rows.join(own.select("place", "item"), "place")
    return keyed.select(F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _search_part(docs: DataFrame, part: list[tuple[int, bytes]], top: int, text: str, key: str) -> DataFrame:
    """Unranked candidates of some items: `place`, `id`, `score`."""
    spark = docs.sparkSession
    counted = [(place, Counter(terms_of(t))) for place, t in part]
    numbers = {t: i for i, t in enumerate(sorted({t for _, terms in counted for t in terms}))}
    shared, name = spark.sparkContext.broadcast(numbers), uuid.uuid4().hex

    def index(batches):
        known = shared.value
        for ids, texts in batches:
            out_n, out = [], []
            for t in texts:
                words = terms_of(t)
                held = {known[w]: n for w, n in Counter(words).items() if w in known} if words else {}
                out_n.append(len(words))
                out.append(np.array([list(held), list(held.values())], np.int64).tobytes())
            yield [ids, out_n, out]

    # what the lists are made of: each document's length and its frequencies of the items' terms
    plain = docs.select(col(key).alias("id"), utf8(text).alias("text"))
    held = stage(map_rows(plain, 1, "n long, held binary", index), "search-index").where("n > 0")
    total = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def frequencies(batches):
        counts = np.zeros(len(numbers), np.int64)
        for (packed,) in batches:
            for p in packed:
                counts[np.frombuffer(p, np.int64).reshape(2, -1)[0]] += 1
        there = np.flatnonzero(counts)
        yield [there.tolist(), counts[there].tolist()]

    parts = map_rows(held.select("held"), 0, "term int, n long", frequencies)
    holding = {r.term: r.n for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    weights = {t: weight(total[0], n) for t, n in holding.items()}
    asked = []
    for place, terms in counted:
        wanted = [(numbers[t], n * weights[numbers[t]]) for t, n in terms.items() if weights.get(numbers[t], 0) > 0]
        asked.append((wanted, place))
    wanted_by_task = spark.sparkContext.broadcast(asked)

    def run(batches):
        yield from _searcher(wanted_by_task.value, len(numbers), (total[0], total[1]), top)(batches)

    return map_rows(held.select("id", "n", "held"), 0, "place long, id long, score long", run)
