"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Text is normalised once: ASCII letters to lower case, every other ASCII character that is no digit to a
separator. The automaton holds every window of the items as a pattern with a separator on both sides, so it
can only match whole words, and one scan of the normalised text gives every occurrence. Words of the
normalised text and of the original one correspond one to one, which maps hits back to offsets.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, names
from tidemark.llm.rows import map_rows, utf8
from tidemark.session import stage

#: Bytes of normalised item text that one automaton (and one broadcast) may hold; more are taken in blocks.
BLOCK_BYTES = 4_000_000
#: For each byte: itself, its lower case, or a space where words end.
NORMAL = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(NORMAL).split()


def windows(words: list[bytes], size: int) -> set[bytes]:
    """All runs of `size` words; shorter texts are one window; no words, no window."""
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def automaton(items: list[tuple[int | None, bytes]], size: int) -> ahocorasick.Automaton:
    owners: dict[bytes, list] = {}
    for key, text in items:
        for window in windows(words_of(text), size):
            owners.setdefault(window, []).append(key)
    found = ahocorasick.Automaton()
    for window, keys in owners.items():
        # one character for each byte: the library wants text
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(keys)))
    found.make_automaton()
    return found


_BUILT: dict[str, ahocorasick.Automaton] = {}


def _built(name: str, shared, size: int) -> ahocorasick.Automaton:
    """The automaton of a broadcast block: built once in a worker process, the last one is kept."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = automaton(shared.value, size)
    return _BUILT[name]


def scan(text: bytes, found: ahocorasick.Automaton) -> tuple[int, bytearray | None, set]:
    """Number of words, a byte for each word that is 1 if it is hit (None: no hit), keys of the items found."""
    words = words_of(text)
    if not words or not len(found):
        return len(words), None, set()
    line = f" {b' '.join(words).decode('latin-1')} "
    hit, keys, seen, last = None, set(), 0, 1
    for end, (length, owners) in found.iter(line):
        seen += line.count(" ", last, end + 1)
        last = end + 1
        hit = hit if hit is not None else bytearray(len(words))
        hit[seen - length : seen] = b"\x01" * length
        keys.update(owners)
    return len(words), hit, keys


def spans_of(text: bytes, hit: bytearray) -> list[tuple[int, int]]:
    """Character offsets in the original text of maximal runs of hit words."""
    spans, chars, at = [], 0, 0
    start = None
    for word, flag in zip(WORD.finditer(text.lower()), hit):
        if flag:
            chars, at = chars + len(text[at : word.start()].decode("utf-8", "replace")), word.start()
            start = chars if start is None else start
            chars, at = chars + len(text[at : word.end()].decode("utf-8", "replace")), word.end()
            stop = chars
        elif start is not None:
            spans.append((start, stop))
            start = None
    return spans if start is None else [*spans, (start, stop)]


def _overlay(old: list[tuple[int, int]], new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted([*old, *new]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _blocks(items: DataFrame, text: str, key: str, limit: int) -> list[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size. The number of blocks comes from a count on the executors."""
    chosen = items.select(col(key).cast("string").alias("key"), utf8(text).alias("text")).where("octet_length(text) > 0")
    total = chosen.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total <= limit:
        return [[(r.key, bytes(r.text)) for r in chosen.collect()]]
    # cutting by a hash of the item keeps a block near the limit; the last ones are read one at a time
    n = 2 * -(-total // limit)
    part = F.pmod(F.xxhash64("key", "text"), F.lit(n))
    return ([(r.key, bytes(r.text)) for r in chosen.where(part == i).collect()] for i in range(n))


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    size: int = 13,
    keep: tuple[str, ...] = ("doc_id",),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`keep` columns, `n_words`, `hits` (offsets and words of hit runs), `n_hit`, `items` (their keys as text).

    Documents are scanned where they are read; nothing is shuffled. Item sets over `block_bytes` are taken in
    blocks, one after the other, each block scanning what the one before wrote; results are the same.

    A null or empty text has no words and no hits; an item without words is never found. An item without a key
    marks words but is not listed. Equal items are each listed. Repeated documents each give a row. No items:
    no hits. Columns that are not kept play no part, whatever their names.
    """
    spark = docs.sparkSession
    kept = [f"k{i}" for i in range(len(keep))]
    now = docs.select(*[col(c).alias(k) for c, k in zip(keep, kept)], utf8(text).alias("text"))
    found = "n_words long, hits array<struct<start: int, stop: int>>, words array<struct<start: int, stop: int>>, items array<string>"

    def runs(hit: bytearray) -> list[tuple[int, int]]:
        return [(m.start(), m.end()) for m in re.finditer(rb"\x01+", hit)]

    def scanner(shared, first: bool):
        name = uuid.uuid4().hex

        def run(batches):
            own = _built(name, shared, size)
            for columns in batches:
                *rest, texts = columns[: len(kept) + 1]
                old = columns[len(kept) + 1 :]
                out = []
                for i, t in enumerate(texts):
                    n, hit, keys = scan(t, own)
                    spans, words = ([], []) if hit is None else (spans_of(t, hit), runs(hit))
                    if not first:
                        # runs of words are joined where they touch, as in one scan
                        words = _overlay([tuple(x.values()) for x in old[2][i]], words)
                        marks = bytearray(n)
                        for a, b in words:
                            marks[a:b] = b"\x01" * (b - a)
                        spans = spans_of(t, marks) if words else []
                        keys |= set(old[3][i])
                    as_rows = [[{"start": a, "stop": b} for a, b in x] for x in (spans, words)]
                    out.append((n, *as_rows, sorted(k for k in keys if k is not None)))
                yield [*rest, texts if not last else [None] * len(texts), *(list(x) for x in zip(*out))]

        return run

    blocks = _blocks(items, item_text, item_key, block_bytes)
    last = isinstance(blocks, list)
    for i, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(block)
        now = map_rows(now, len(keep) + 1, found, scanner(shared, i == 0))
        now = now if last else stage(now, "contamination")
    n_hit: Column = F.expr("aggregate(words, 0L, (n, w) -> n + w.stop - w.start)")
    return now.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "n_words", "hits", n_hit.alias("n_hit"), "items")


def mask_contaminated(found: DataFrame, share: int = 20) -> Column:
    """True where at least one word in `share` is hit."""
    return (found.n_hit > 0) & (share * found.n_hit >= found.n_words)
