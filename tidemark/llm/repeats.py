"""Removal of byte strings that also start earlier in the corpus, by longest-previous-factor arrays.

A byte goes if a string of `length` bytes that covers it starts earlier too: if the longest previous factor of
some suffix reaches `length`. One suffix array over a corpus would be one task, so suffixes are dealt so that
equal strings meet: of all short grams in a string, the one of least hash is its anchor. It depends on the
string alone, so equal strings have equal anchors, at the same place. Strings that follow each other mostly share
their anchor; together they are one context, at most `2 * length` bytes, and a text has one for each forty bytes
or so.

1. Contexts meet by anchor as hashes. Of equal contexts all but the earliest are repeats, whole. In a batch of
   rows this is settled before the shuffle, so a text in a third of all rows is sent once a batch.
2. Different contexts with the same anchor may share part of their strings. Their bytes are fetched, and the
   suffixes in them are sorted as far as `length` bytes, ties by place. In that order, the previous smaller place
   is the left neighbour if it reaches `length`, and the next smaller one never is nearer; so the factor
   reaches `length` where the rank equals the left neighbour's.
3. The spans found are joined with the texts.

An anchor that is very frequent in different contexts (the edge of a passage that a third of all rows hold)
would put too many contexts in one task: its strings are dealt one by one, by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.jaccard_join import mix
from tidemark.llm.rows import map_rows, utf8
from tidemark.session import stage

#: Bytes of text hashed at a time; places inside a piece take this many bits.
PIECE_BITS = 19
#: Bytes of text for each task of the first step.
TASK_BYTES = 24_000_000
#: Bytes of contexts that are sorted together in the second step.
SORT_BYTES = 2_000_000
#: An anchor is dealt by its strings if it has more than one in so many of all contexts; at most so many are.
FREQUENT = 50_000
#: Contexts of one anchor in a batch from which on they are counted for that.
COUNTED = 8

_BYTE = np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Contexts:
    """Columns: anchor's hash, hash of the context, text it is in, first string, strings after the first."""

    key: np.ndarray
    whole: np.ndarray
    text: np.ndarray
    start: np.ndarray
    more: np.ndarray

    def take(self, which: np.ndarray) -> Contexts:
        return Contexts(*(getattr(self, f)[which] for f in self.__dataclass_fields__))


def _join(parts: list[Contexts]) -> Contexts:
    return Contexts(*(np.concatenate([getattr(p, f) for p in parts]) for f in Contexts.__dataclass_fields__))


class Anchors:
    def __init__(self, length: int):
        if length < 32:
            raise ValueError("strings of 32 bytes or more")
        self.length, self.gram = length, length // 4
        n = (1 << PIECE_BITS) + 1
        self.power, self.inverse = (np.multiply.accumulate(np.full(n, b)) * inv for b, inv in ((_BASE, _INVERSE), (_INVERSE, _BASE)))
        self.none = np.zeros(0, dtype=np.uint64)

    def pieces(self, texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
        """Lists of (text, offset, bytes) that are hashed together. Long texts are cut, with an overlap."""
        most, now, size = (1 << PIECE_BITS) - 1, [], 0
        for i, t in enumerate(texts):
            if len(t) < self.length:
                continue
            step = most - self.length + 1
            for at in range(0, max(1, len(t) - self.length + 1), step):
                part = t[at : at + most] if len(t) > most else t
                if size + len(part) > most:
                    yield now
                    now, size = [], 0
                now.append((i, at, part))
                size += len(part)
        if now:
            yield now

    def of(self, texts: list[bytes], frequent: np.ndarray | None = None) -> Contexts:
        """All contexts of the texts; with `frequent` anchors, their strings one by one."""
        parts = [self._piece(p, frequent) for p in self.pieces(texts)]
        return _join(parts) if parts else Contexts(self.none, self.none, *(self.none.astype(np.int64) for _ in range(3)))

    def _piece(self, parts: list[tuple[int, int, bytes]], frequent: np.ndarray | None) -> Contexts:
        length, gram = self.length, self.gram
        data = np.frombuffer(b"".join(p for _, _, p in parts), dtype=np.uint8)
        n = len(data)
        upto = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * self.power[:n], out=upto[1:])
        grams = mix((upto[gram:] - upto[: n - gram + 1]) * self.inverse[: n - gram + 1])
        mask = np.uint64((1 << PIECE_BITS) - 1)
        # the least gram, the leftmost of equal ones
        value = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        width = length - gram + 1
        padded = np.full(-(-len(value) // width) * width, np.uint64(2**64 - 1))
        padded[: len(value)] = value
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        strings = n - length + 1
        anchor = (np.minimum(behind[:strings], ahead[width - 1 : width - 1 + strings]) & mask).astype(np.int64)

        inside = np.zeros(strings, dtype=bool)
        begins, at = [], 0
        for _, _, p in parts:
            begins.append(at)
            inside[at : at + len(p) - length + 1] = True
            at += len(p)
        place = np.flatnonzero(inside)
        edge = np.flatnonzero(np.diff(anchor[place])) + 1
        first, last = place[np.concatenate([[0], edge])], place[np.concatenate([edge - 1, [len(place) - 1]])]
        key = grams[anchor[first]] >> np.uint64(16)
        more = last - first
        if frequent is not None and len(frequent):
            hot = np.isin(key, frequent)
            single = np.repeat(first[hot], more[hot] + 1) + _within(more[hot] + 1)
            first, more = np.concatenate([first[~hot], single]), np.concatenate([more[~hot], np.zeros(len(single), dtype=np.int64)])
            own = mix((upto[single + length] - upto[single]) * self.inverse[single]) >> np.uint64(16)
            key = np.concatenate([key[~hot], own])
        stop = first + more + length
        shape = mix((more + ((anchor[first] - first) << 20)).astype(np.uint64))
        whole = mix((upto[stop] - upto[first]) * self.inverse[first] + shape) >> np.uint64(16)
        part = np.searchsorted(begins, first, "right") - 1
        text = np.array([i for i, _, _ in parts], dtype=np.int64)[part]
        offset = np.array([o for _, o, _ in parts], dtype=np.int64) - np.array(begins)
        return Contexts(key, whole, text, first + offset[part], more)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _repeats(order: np.ndarray, same: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """In an order by `same` and then `place`: whether a row leads its class; whether it repeats the leader elsewhere."""
    n = len(order)
    lead = np.ones(n, dtype=bool)
    if n:
        lead[1:] = np.any([np.diff(c[order]) != 0 for c in same], axis=0)
    leader = np.maximum.accumulate(np.where(lead, np.arange(n), 0))
    repeated = np.any([c[order] != c[order][leader] for c in place], axis=0) if n else lead
    return lead, repeated


def _spans(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each text, joined where they touch."""
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    if not len(text):
        return text, start, stop
    # the running end, kept apart by text
    base = np.cumsum(np.concatenate([[0], np.diff(text) != 0])) * (np.int64(1) << 33)
    reach = np.maximum.accumulate(stop + base)
    new = np.concatenate([[True], (start + base)[1:] > reach[:-1]])
    ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(text) - 1]])
    return text[new], start[new], (reach - base)[ends]


def equal_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix by its first `length` bytes (past the end: zeros), by doubling."""
    padded = np.concatenate([data, np.zeros(2 * length, dtype=np.uint8)])
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(">u8").ravel()
    rank = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    known = 8
    while known < length:
        step = min(known, length - known)
        pair = (rank[:-step] << np.uint64(32)) | rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        known += step
    return rank[: len(data)]


def earlier_strings(contexts: list[bytes], places: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each context, which of its strings also start earlier in one of the contexts, at another place.

    `places`: columns (most significant first, the last is the offset of the context's first string).
    """
    strings = np.array([len(c) - length + 1 for c in contexts], dtype=np.int64)
    begins = np.cumsum([0, *map(len, contexts)])[:-1]
    rank = equal_ranks(np.frombuffer(b"".join(contexts), dtype=np.uint8), length)
    within = _within(strings)
    own = rank[np.repeat(begins, strings) + within]
    columns = [np.repeat(p, strings) for p in places]
    columns[-1] = columns[-1] + within
    order = np.lexsort((*columns[::-1], own))
    _, repeated = _repeats(order, [own], columns)
    found = np.zeros(len(own), dtype=bool)
    found[order] = repeated
    return np.split(found, np.cumsum(strings)[:-1])


_PACKED = (("key", 6), ("whole", 6), ("id", 8), ("hash", 8), ("start", 4), ("more", 4))


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns one after the other, each value in as many bytes as it needs."""
    wide = [np.ascontiguousarray(c).astype("<i8" if c.dtype.kind == "i" else "<u8") for c in columns]
    return b"".join(w.view(np.uint8).reshape(-1, 8)[:, :size].tobytes() for w, (_, size) in zip(wide, _PACKED))


def _unpack(blobs: list[bytes]) -> list[np.ndarray]:
    row, out = sum(size for _, size in _PACKED), [[] for _ in _PACKED]
    for blob in blobs:
        n, at = len(blob) // row, 0
        for values, (_, size) in zip(out, _PACKED):
            wide = np.zeros((n, 8), dtype=np.uint8)
            wide[:, :size] = np.frombuffer(blob, dtype=np.uint8, count=n * size, offset=at).reshape(n, size)
            values.append(wide.view("<i8").ravel())
            at += n * size
    return [np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in out]


def _text_order(ids: list[int], hashes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids_, hashes_ = np.array(ids, dtype=np.int64), np.array(hashes, dtype=np.int64)
    order = np.lexsort((hashes_, ids_))
    # equal texts of one id are one text
    step = np.concatenate([[0], (np.diff(ids_[order]) != 0) | (np.diff(hashes_[order]) != 0)]) if len(order) else order
    rank = np.zeros(len(order), dtype=np.int64)
    rank[order] = np.cumsum(step)
    return ids_, hashes_, rank


def _settled(found: Contexts, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch: the contexts that lead (first of equal ones), and those that repeat a leader."""
    place = [rank[found.text], found.start]
    order = np.lexsort((place[1], place[0], found.whole, found.key))
    lead, repeated = _repeats(order, [found.key, found.whole], place)
    return order[lead], order[repeated]


def _frequent(texts: DataFrame, length: int, total: int) -> np.ndarray:
    """Anchors in very many different contexts: at most FREQUENT, so small enough for every task."""

    def run(batches):
        own = Anchors(length)
        for ids, hashes, data in batches:
            found = own.of(data)
            lead, _ = _settled(found, _text_order(ids, hashes)[2])
            keys, counts = np.unique(found.key[lead], return_counts=True)
            often = counts >= COUNTED
            yield [keys[often].astype(np.int64).tolist(), counts[often].tolist()]

    counts = map_rows(texts, 0, "key long, n long", run, rows=10_000).groupBy("key").agg(F.sum("n").alias("n"))
    least = max(1000, total * 2 // length // FREQUENT)
    return np.array([r.key for r in counts.where(F.col("n") >= least).select("key").collect()], dtype=np.uint64)


def _by_context(texts: DataFrame, length: int, tasks: int, frequent: np.ndarray) -> DataFrame:
    """First step: `id`, `hash`, `start`, `stop`, and `key` for contexts that are still open (null: a repeat)."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def deal(batches):
        own = Anchors(length)
        for ids, hashes, data in batches:
            found = own.of(data, shared.value)
            ids_, hashes_, rank = _text_order(ids, hashes)
            lead, repeated = _settled(found, rank)
            spans = _spans(found.text[repeated], found.start[repeated], found.start[repeated] + found.more[repeated] + length)
            blobs = [(i % tasks, np.stack([ids_[spans[0][i::tasks]], hashes_[spans[0][i::tasks]], spans[1][i::tasks], spans[2][i::tasks]]).tobytes(), True) for i in range(min(tasks, len(spans[0])))]
            lead = np.sort(lead)
            task = (found.key[lead] % np.uint64(tasks)).astype(np.int64)
            order = np.argsort(task, kind="stable")
            edges = np.searchsorted(task[order], np.arange(tasks + 1))
            for t in np.unique(task):
                some = found.take(lead[order[edges[t] : edges[t + 1]]])
                blobs.append((int(t), _pack([some.key, some.whole, ids_[some.text], hashes_[some.text], some.start, some.more]), False))
            yield [list(x) for x in zip(*blobs)] or [[], [], []]

    def meet(batches):
        blobs = []
        for _, data, done in batches:
            blobs += [d for d, x in zip(data, done) if not x]
            spans = [np.frombuffer(d, dtype=np.int64).reshape(4, -1) for d, x in zip(data, done) if x]
            if spans:
                ids, hashes, start, stop = np.concatenate(spans, axis=1).tolist()
                yield [ids, hashes, start, stop, [None] * len(ids)]
        key, whole, ids, hashes, start, more = _unpack(blobs)
        order = np.lexsort((start, hashes, ids, whole, key))
        lead, repeated = _repeats(order, [key, whole], [ids, hashes, start])
        at = order[repeated]
        yield [x[at].tolist() for x in (ids, hashes, start)] + [(start + more + length)[at].tolist(), [None] * len(at)]
        first = order[lead]
        if len(first):
            alike = np.diff(key[first]) == 0
            shared_key = np.concatenate([alike, [False]]) | np.concatenate([[False], alike])
            at = first[shared_key]
            for i in range(0, len(at), 100_000):
                some = at[i : i + 100_000]
                yield [x[some].tolist() for x in (ids, hashes, start)] + [(start + more + length)[some].tolist(), key[some].tolist()]

    dealt = map_rows(texts, 0, "task int, data binary, done boolean", deal, rows=10_000)
    return map_rows(dealt.repartitionById(tasks, F.col("task")), 0, "id long, hash long, start long, stop long, key long", meet)


def _by_bytes(texts: DataFrame, open_contexts: DataFrame, length: int) -> DataFrame:
    """Second step: `id`, `hash`, `start`, `stop` of repeats in contexts that share an anchor only."""
    listed = open_contexts.groupBy("id", "hash").agg(F.collect_list(F.struct("key", "start", "stop")).alias("contexts"))  # of one text

    def cut(batches):
        for ids, hashes, data, contexts in batches:
            out = [(c["key"], i, h, c["start"], t[c["start"] : c["stop"]]) for i, h, t, cs in zip(ids, hashes, data, contexts) for c in cs]
            for at in range(0, len(out), 20_000):
                yield [list(x) for x in zip(*out[at : at + 20_000])]

    def sort(batches):
        def spans(rows):
            if len(rows) < 2:
                return
            _, ids, hashes, start, data = zip(*rows)
            places = [np.array(x, dtype=np.int64) for x in (ids, hashes, start)]
            out = []
            for i, found in enumerate(earlier_strings(list(data), places, length)):
                edges = np.flatnonzero(np.diff(np.concatenate([[0], found.view(np.int8), [0]])))
                out += [(ids[i], hashes[i], start[i] + int(a), start[i] + int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2])]
            if out:
                yield [list(x) for x in zip(*out)]

        rows, size = [], 0
        for batch in batches:
            for row in zip(*batch):
                if size > SORT_BYTES and row[0] != rows[-1][0]:
                    yield from spans(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[-1])
        yield from spans(rows)

    cut_out = map_rows(texts.join(listed, ["id", "hash"]), 0, "key long, id long, hash long, start long, data binary", cut, rows=10_000)
    return map_rows(cut_out.repartition("key").sortWithinPartitions("key"), 0, "id long, hash long, start long, stop long", sort)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = (), length: int = 100) -> DataFrame:
    """`key` and `keep` columns, `n_bytes`, `removed` (byte spans, joined where they touch), `kept` (the other bytes).

    A byte is removed if a string of `length` bytes that covers it also starts earlier: in a row of smaller key,
    or in the same row at a smaller offset. Everything is judged on the input. Texts are UTF-8 bytes, null none;
    strings do not reach over the end of a text. Rows without a key come last; among equal keys, different
    texts are ordered by a hash, and equal texts are one text, all of whose rows get the same result. Columns
    that are not named play no part.
    """
    spark = docs.sparkSession
    identity = [F.coalesce(col(key), F.lit(_LAST)).cast("long").alias("id"), F.coalesce(F.xxhash64(col(text)), F.lit(0)).alias("hash")]
    texts = docs.select(*identity, utf8(text).alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    frequent = _frequent(texts, length, total)
    first = stage(_by_context(texts, length, tasks, frequent), "repeats-contexts")
    second = stage(_by_bytes(texts, first.where("key IS NOT NULL"), length), "repeats-strings")

    spans = first.where("key IS NULL").select("id", "hash", "start", "stop").union(second)
    listed = spans.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # of one text
    kept = [f"k{i}" for i in range(len(keep) + 1)]
    whole = docs.select(*[col(c).alias(k) for c, k in zip((key, *keep), kept)], *identity, utf8(text).alias("text"))
    joined = whole.join(listed, ["id", "hash"], "left").select(*kept, "text", "spans")

    def run(batches):
        for *rest, data, spans in batches:
            out = []
            for t, found in zip(data, spans):
                pairs = np.array([(s["start"], s["stop"]) for s in found or ()], dtype=np.int64).reshape(-1, 2)
                _, start, stop = _spans(np.zeros(len(pairs), dtype=np.int64), pairs[:, 0], pairs[:, 1])
                edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(t)]
                left = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(t), [{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist())], left))
            yield [*rest, *(list(x) for x in zip(*out))]

    done = map_rows(joined, len(kept), "n_bytes long, removed array<struct<start: long, stop: long>>, kept binary", run)
    return done.toDF(*[key, *keep], "n_bytes", "removed", "kept")
