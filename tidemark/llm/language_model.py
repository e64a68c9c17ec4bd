"""LM scoring from a log-frequency Bloom filter.

The filter holds each n-gram once for every level of its logarithmic count, from 1 up; probing level after level
until one is missing gives the quantised count, never too low, and too high with a probability that falls with
each level. Counts of all training text are summed on the executors; each task of the last step builds the block
of the filter that its n-grams hash to. The filter grows with the training text (`Shape.bits_per_token`), so its
error does not (see `Model.filled`). No one holds it whole: blocks have a bounded size and stay staged. To score,
texts are turned into portions of word numbers; the distinct n-grams of a portion go to the tasks that hold their
blocks, and the levels found there come back to the portion.

Probabilities mix the word pair's share of its history with the word's own smoothed frequency. The base score
needs exact counts: those of frequent words are broadcast (a bounded number), the others are joined.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.jaccard_join import mix
from tidemark.llm.rows import map_rows, utf8
from tidemark.session import stage

#: One end after each text; no word is empty.
END = b""


@dataclass(frozen=True)
class Shape:
    """base: of the logarithmic counts. probes: bits for each level of an n-gram. bits_per_token: size of the
    filter. pair_weight: of the pair's share. frequent: so many words at most, the most frequent ones, have their
    exact counts broadcast. task_tokens: training tokens for each block of the filter, and each task that counts
    n-grams."""

    base: float = 1.5
    probes: int = 3
    bits_per_token: int = 8
    pair_weight: float = 0.3
    frequent: int = 150_000
    task_tokens: int = 4_000_000


_PAIR, _START = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD)


#: Words a task remembers. Bounds memory, not results.
REMEMBERED = 300_000
#: Bytes of text that are split into words at a time, and whose n-grams are counted before they are sent.
SPLIT_BYTES, COUNT_BYTES = 2_000_000, 16_000_000
#: N-grams whose bits are set together.
AT_A_TIME = 250_000
#: Bytes of text whose n-grams go to the filter together.
PORTION_BYTES = 6_000_000


class Numbered(dict):
    """A number for each word, and the word's hash and exact count (0: not frequent) by number.

    Looking a word up gives it a number. Past the bound numbers are for one use only: see `forget`.
    """

    def __init__(self, common: dict[bytes, int]):
        super().__init__()
        self.common, self.hashes, self.counts = common, array("Q"), array("q")

    def __missing__(self, word: bytes) -> int:
        number = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word) >> 16)
        self.counts.append(self.common.get(word, 0))
        if number < REMEMBERED and len(word) <= 48:
            self[word] = number
        return number

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and exact counts of the words."""
        numbers = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        found = np.array(self.hashes, dtype=np.uint64)[numbers], np.array(self.counts, dtype=np.int64)[numbers]
        del self.hashes[REMEMBERED:], self.counts[REMEMBERED:]
        return found


def portions(data: list[bytes], most: int) -> list[tuple[int, int]]:
    """Bounds of consecutive texts of about so many bytes, one text at least."""
    out, at, size = [], 0, 0
    for i, t in enumerate(data):
        size += len(t)
        if size >= most:
            out.append((at, i + 1))
            at, size = i + 1, 0
    return [*out, (at, len(data))] if at < len(data) else out


def words_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def pairs(own: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the histories and of the pairs of all tokens; the first of a text follows a start."""
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.cumsum([0, *sizes])[:-1][: len(sizes)]] = _START
    return before, mix(mix(before * _PAIR) + own) >> np.uint64(16)


def _pack(grams: np.ndarray) -> bytes:
    """Hashes of n-grams have 48 bits."""
    return grams.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _summed(once: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram and its count, of some that came once and others that came `n` times."""
    grams = np.concatenate([once, more])
    order = np.argsort(grams)
    grams = grams[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(grams)), dtype=bool), grams[1:] != grams[:-1]]))
    counts = np.concatenate([np.ones(len(once), dtype=np.int64), n])[order]
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def _below(spread: np.ndarray, limit: int) -> np.ndarray:
    """Evenly spread 64-bit values to 0 ... limit - 1; a multiplication takes a fraction of a division's time."""
    return ((spread >> np.uint64(32)) * np.uint64(limit) >> np.uint64(32)).astype(np.int64)


class Filter:
    """Blocks of bits; the n-gram's hash says which block, and where in it each level's bits are."""

    def __init__(self, blocks: int, block_bits: int, shape: Shape, bits: np.ndarray | None = None):
        self.blocks, self.block_bits, self.shape, self.bits = blocks, block_bits, shape, bits

    def block(self, grams: np.ndarray) -> np.ndarray:
        return _below(mix(grams), self.blocks)

    def places(self, grams: np.ndarray, level: int) -> np.ndarray:
        """Bit numbers inside the block: a row for each probe."""
        one = mix(grams + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
        two = mix(one) | np.uint64(1)
        return np.stack([_below(one + two * np.uint64(i), self.block_bits) for i in range(self.shape.probes)])

    def level(self, counts: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(self.shape.base) + 1e-9).astype(np.int64)

    def build(self, grams: np.ndarray, counts: np.ndarray) -> bytes:
        """One block from all its n-grams, some at a time."""
        bits = np.zeros(self.block_bits, dtype=bool)
        for at in range(0, len(grams), AT_A_TIME):
            some, levels = grams[at : at + AT_A_TIME], self.level(counts[at : at + AT_A_TIME])
            for level in range(1, int(levels.max(initial=0)) + 1):
                bits[self.places(some[levels >= level], level).ravel()] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, grams: np.ndarray, bits: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """Levels found in one block, 0 for what is not in it; with `first`, in blocks that begin at these bits."""
        out, left = np.zeros(len(grams), dtype=np.uint8), np.arange(len(grams))
        level = 1
        while len(left) and level <= 200:
            at = self.places(grams[left], level)
            if first is not None:
                at += first[left]
            hit = np.ones(len(left), dtype=bool)
            for row in at:
                hit &= (bits[row >> 3] >> (row & 7).astype(np.uint8)) & 1 == 1
            left = left[hit]
            out[left] = level
            level += 1
        return out

    def middle(self, levels: np.ndarray) -> np.ndarray:
        """The middle of the counts of each level."""
        low = self.shape.base ** (np.arange(256) - 1.0)
        return np.concatenate([[0.0, 1.0], low[2:] * (1 + self.shape.base) / 2])[levels]

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Quantised counts, 0 for what is not in the filter; it must be here whole."""
        return self.middle(self.levels(grams, self.bits, self.block(grams) * self.block_bits))


@dataclass
class Model:
    """filter: its shape only; blocks: the number of each block that is not empty, its bits, and how many are set."""

    vocabulary: DataFrame
    tokens: int
    words: int
    frequent: dict[bytes, int]
    filter: Filter
    blocks: DataFrame

    @property
    def filled(self) -> float:
        """Share of the bits that are set: an absent n-gram passes with this to the power of the probes."""
        return (self.blocks.agg(F.sum("ones")).first()[0] or 0) / (self.filter.blocks * self.filter.block_bits)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are not learnt from."""
    return F.coalesce(F.crc32(col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _vocabulary(texts: DataFrame) -> DataFrame:
    def run(batches):
        for (data,) in batches:
            counts: Counter = Counter()
            for t in data:
                counts.update(t.lower().split())
                counts[END] += 1
                if len(counts) > 300_000:
                    yield [list(counts), list(counts.values())]
                    counts = Counter()
            yield [list(counts), list(counts.values())]

    return map_rows(texts, 0, "token binary, n long", run).groupBy("token").agg(F.sum("n").alias("n"))


def _filter(texts: DataFrame, tokens: int, shape: Shape) -> tuple[Filter, DataFrame]:
    blocks = max(16, -(-tokens // shape.task_tokens))
    bits = max(1 << 16, shape.bits_per_token * tokens)
    made = Filter(blocks, -(-bits // blocks // 8) * 8, shape)

    def count(batches):
        words = Numbered({})
        for (data,) in batches:
            for start, stop in portions(data, COUNT_BYTES):
                grams = [np.full(stop - start, _START)]
                for a, b in portions(data[start:stop], SPLIT_BYTES):
                    split = [words_of(t) for t in data[start + a : start + b]]
                    own, _ = words.look_up(list(chain.from_iterable(split)))
                    grams += [own, pairs(own, [len(s) for s in split])[1]]
                yield send(*np.unique(np.concatenate(grams), return_counts=True))

    def send(grams, n):
        block = made.block(grams)
        order = np.argsort(block, kind="stable")
        edges = np.searchsorted(block[order], np.arange(blocks + 1))
        out = []
        for b in np.flatnonzero(np.diff(edges)):
            some = order[edges[b] : edges[b + 1]]
            once = n[some] == 1
            more = some[~once]
            # most n-grams come once: their counts are not sent
            out.append((int(b), _pack(grams[some[once]]), _pack(grams[more]), n[more].astype(np.int64).tobytes()))
        return [list(x) for x in zip(*out)]

    def build(batches):
        found: dict[int, list] = {}
        for columns in batches:
            for b, once, more, n in zip(*columns):
                found.setdefault(b, []).append((once, more, n))
        for b in list(found):
            once, more, n = (b"".join(x) for x in zip(*found.pop(b)))
            bits = made.build(*_summed(_unpack(once), _unpack(more), np.frombuffer(n, dtype=np.int64)))
            yield [[b], [bits], [int(np.bitwise_count(np.frombuffer(bits, dtype=np.uint8)).sum())]]

    sent = map_rows(texts, 0, "block int, once binary, more binary, n binary", count, rows=10_000)
    built = map_rows(sent.repartitionById(blocks, F.col("block")), 0, "block int, bits binary, ones long", build)
    return made, stage(built, "model-filter")


def _least(vocabulary: DataFrame, shape: Shape) -> int:
    """The least count that no more than `shape.frequent` words reach, to a histogram's width (few hundred bars)."""
    bar = F.floor(8 * F.log2("n")).cast("int").alias("bar")
    bars = sorted(((r.bar, r.words) for r in vocabulary.groupBy(bar).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, words = None, 0
    for at, more in bars:
        words += more
        if words > shape.frequent:
            break
        least = at
    # counts of a bar are not less than this, and those of the bar below are
    return (1 << 62) if least is None else math.ceil(2 ** (least / 8) - 1e-9)


def learn(docs: DataFrame, text: str = "text", shape: Shape = Shape()) -> Model:
    """Counts of all given rows. Null and empty texts are an end each."""
    texts = docs.select(utf8(text).alias("text"))
    vocabulary = stage(_vocabulary(texts), "model-words")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = {bytes(r.token): r.n for r in vocabulary.where(F.col("n") >= _least(vocabulary, shape)).collect()}  # at most shape.frequent
    made = _filter(texts, total[0], shape)
    return Model(vocabulary, total[0], total[1], common, *made)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Null and empty texts are one end. With nothing learnt, every word is unknown. Every row is scored whole,
    repeated ones each; columns that are not kept play no part.
    """
    own, bound = model.filter, model.tokens + model.words + 1
    shared_words = docs.sparkSession.sparkContext.broadcast(model.frequent)
    chosen = docs.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], utf8(text).alias("text"))

    def run(batches):
        """A row for each text, and one for each portion, by the number of its first text, with `data`."""
        words = Numbered(shared_words.value)
        row = TaskContext.get().partitionId() << 33
        for *kept, data in batches:
            for start, stop in portions(data, PORTION_BYTES):
                parts = []
                for a, b in portions(data[start:stop], SPLIT_BYTES):
                    a, b = start + a, start + b
                    part, columns = _base(data[a:b], words)
                    parts.append(part)
                    yield [*(k[a:b] for k in kept), list(range(row + a - start, row + b - start)), *columns, [None] * (b - a)]
                yield [*([None] for _ in kept), [row], [None], [None], [None], [None], [_Portion.of(parts).pack()]]
                row += stop - start

    def ask(batches):
        for rows, data in batches:
            for row, packed in zip(rows, data):
                grams = _distinct(_Portion.unpack(packed).grams())
                order, edges = _dealt(grams, own)
                some = np.flatnonzero(np.diff(edges))
                yield [[row] * len(some), some.tolist(), [_pack(grams[order[edges[b] : edges[b + 1]]]) for b in some]]

    def answer(batches):
        held, bits = None, None
        for columns in batches:
            out = []
            for row, b, data in zip(*columns):
                if row == _FIRST:
                    held, bits = b, np.frombuffer(data, dtype=np.uint8)
                else:
                    grams = _unpack(data)
                    found = own.levels(grams, bits) if held == b else np.zeros(len(grams), dtype=np.uint8)
                    out.append((row, b, found.tobytes()))
            yield [list(x) for x in zip(*out)]

    def add(batches):
        row, portion, found = None, None, []
        for columns in batches:
            for r, b, data in zip(*columns):
                if b == _FIRST:
                    if portion is not None:
                        yield _score(row, portion, b"".join(found), own, bound)
                    row, portion, found = r, _Portion.unpack(data), []
                else:
                    found.append(data)
        if portion is not None:
            yield _score(row, portion, b"".join(found), own, bound)

    added = "row long, n_tokens long, known long, logs double, rare array<struct<token: binary, n: int>>, data binary"
    staged = stage(map_rows(chosen, len(keep), added, run), "model-texts")
    scored, portioned = staged.where("data IS NULL").drop("data"), staged.where("data IS NOT NULL").select("row", "data")

    first, dealt = F.lit(_FIRST), "row long, block int, data binary"
    asked = map_rows(portioned, 0, dealt, ask).union(model.blocks.select(first.cast("long"), "block", "bits"))
    # staged, so that what was asked is off the disks before the portions are shuffled
    answers = stage(map_rows(asked.repartitionById(own.blocks, F.col("block")).sortWithinPartitions("block", "row"), 0, dealt, answer), "model-answers")
    met = portioned.select("row", first.cast("int").alias("block"), "data").union(answers)
    scores = stage(map_rows(met.repartition("row").sortWithinPartitions("row", "block"), 0, "row long, score double", add), "model-scores")

    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    counts = model.vocabulary.select("token", F.col("n").alias("c"))
    joined = rare.join(counts, "token", "left").groupBy("row")
    sums = joined.agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more_logs"),
    )
    whole = scored.drop("rare").join(sums, "row", "left").join(scores, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return whole.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(bound)))).alias("base_score"),
        "score",
    )


#: Comes before all rows and blocks.
_FIRST = -1


@dataclass
class _Portion:
    """Some texts: tokens of each; hashes and exact counts (0: not frequent) of their distinct words; the word of each token."""

    sizes: np.ndarray
    hashes: np.ndarray
    exact: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[list[int], np.ndarray, np.ndarray]]) -> _Portion:
        sizes, hashes, exact = (np.concatenate(x) for x in zip(*parts))
        distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        return cls(sizes, distinct, exact[first], word)

    def pack(self) -> bytes:
        head = np.array([len(self.sizes), len(self.hashes)], dtype=np.int64)
        # bytes of like weight side by side: most of the upper ones are zero, and are compressed
        word = self.word.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
        return b"".join(x.tobytes() for x in (head, self.sizes.astype(np.int64), self.hashes, self.exact, word))

    @classmethod
    def unpack(cls, packed: bytes) -> _Portion:
        texts, words = np.frombuffer(packed, dtype=np.int64, count=2).tolist()
        body = np.frombuffer(packed, dtype=np.int64, count=texts + 2 * words, offset=16)
        word = np.frombuffer(packed, dtype=np.uint8, offset=16 + 8 * len(body)).reshape(4, -1)
        hashes, exact = body[texts : texts + words].view(np.uint64), body[texts + words :]
        return cls(body[:texts], hashes, exact, np.ascontiguousarray(word.T).view(np.uint32).ravel())

    def grams(self) -> np.ndarray:
        """What the filter is asked for: pairs of all tokens, words that are not frequent, and the start."""
        both = pairs(self.hashes[self.word], self.sizes.tolist())[1]
        return np.concatenate([both, self.hashes[self.exact == 0], [_START]])


def _distinct(grams: np.ndarray) -> np.ndarray:
    """Each n-gram once, in order. `np.unique` does the same by hashing, which takes many times as long for this many."""
    grams = np.sort(grams)
    return grams[np.append(True, grams[1:] != grams[:-1])]


def _dealt(grams: np.ndarray, own: Filter) -> tuple[np.ndarray, np.ndarray]:
    """An order of the n-grams by block, and where in it each block begins."""
    block = own.block(grams)
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(own.blocks + 1))


def _base(data: list[bytes], words: Numbered) -> tuple[tuple[list[int], np.ndarray, np.ndarray], list]:
    """Tokens of each text, hash and exact count of each token; and the columns that need no filter."""
    split = [words_of(t) for t in data]
    sizes = [len(s) for s in split]
    hashes, exact = words.look_up(list(chain.from_iterable(split)))
    rare, begins = exact == 0, np.cumsum([0, *sizes])[:-1]
    logs = np.add.reduceat(np.where(rare, 0.0, np.log10(exact + 1)), begins)
    known = np.add.reduceat((~rare).astype(np.int64), begins)
    unknown = [Counter(s[i] for i in np.flatnonzero(rare[b : b + n]).tolist()) for s, b, n in zip(split, begins.tolist(), sizes)]
    tokens = pa.array(list(chain.from_iterable(unknown)), type=pa.binary())
    times = pa.array(list(chain.from_iterable(u.values() for u in unknown)), type=pa.int32())
    ends = pa.array(np.cumsum([0, *map(len, unknown)]), type=pa.int32())
    listed = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([tokens, times], names=["token", "n"]))
    return (sizes, hashes, exact), [sizes, known.tolist(), logs.tolist(), listed]


def _score(row: int, portion: _Portion, found: bytes, own: Filter, bound: int) -> list:
    """Numbers and scores of a portion's texts; `found`: levels of its n-grams, block after block."""
    grams, where = np.unique(portion.grams(), return_inverse=True)
    levels = np.zeros(len(grams), dtype=np.uint8)
    levels[_dealt(grams, own)[0]] = np.frombuffer(found, dtype=np.uint8)
    counts = own.middle(levels)[where]

    tokens, rare = len(portion.word), portion.exact == 0
    each = portion.exact.astype(float)
    each[rare] = counts[tokens:-1]
    count = each[portion.word]
    # the count of a history is that of the token before; a start's is in the filter
    history = np.empty(tokens)
    history[1:] = count[:-1]
    begins = np.cumsum([0, *portion.sizes])[:-1]
    history[begins] = counts[-1]
    share = np.minimum(1.0, counts[:tokens] / np.maximum(history, 1))
    probability = own.shape.pair_weight * share + (1 - own.shape.pair_weight) * (count + 1) / bound
    return [list(range(row, row + len(begins))), np.add.reduceat(np.log10(probability), begins).tolist()]
