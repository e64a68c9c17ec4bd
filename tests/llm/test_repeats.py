"""Removal of repeated strings against a dictionary of all strings seen so far."""

import hashlib
import random

import numpy as np
import pytest

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import repeats
from tidemark.llm.queries import QUERIES


def brute(rows, length=100):
    """rows: (key, text), keys distinct. Result by key: bytes kept, number of removed runs."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(s)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (bytes(b for b, g in zip(data, gone) if not g), runs)
    return out


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {r.doc_id: (bytes(r.kept), len(r.removed)) for r in repeats.remove_repeats(docs, **more).collect()}


def mixed(rnd, n):
    passages = ["".join(rnd.choice("abcdefgh é") for _ in range(rnd.choice([40, 99, 100, 101, 130, 180, 300, 700]))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            a, b = sorted((rnd.randrange(len(p)), rnd.randrange(len(p) + 1)))
            parts.append(p if rnd.random() < 0.5 else p[a:b])
            parts.append("".join(rnd.choice("xyz ") for _ in range(rnd.choice([0, 1, 7, 60]))))
        rows.append((i * 7 % n, "".join(parts)))
    return rows


def test_mixed_texts(spark):
    rows = mixed(random.Random(5), 211)
    assert run(spark, rows) == brute(rows)


def test_frequent_anchors_and_small_pieces(spark, monkeypatch):
    """The strings one by one, texts cut into pieces, sorting in small runs: all the same."""
    rows = mixed(random.Random(6), 150) + [(1000, "ab" * 900), (1001, "a" * 1500), (1002, "b" + "ab" * 300)]
    monkeypatch.setattr(repeats, "SORT_BYTES", 500)
    monkeypatch.setattr(repeats, "_frequent", lambda texts, length, total: all_keys(rows))
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(repeats, "_frequent", lambda texts, length, total: np.zeros(0, dtype=np.uint64))
    assert run(spark, rows, length=40) == brute(rows, 40)


def all_keys(rows):
    return np.unique(repeats.Anchors(100).of([t.encode() for _, t in rows]).key)[::2]


@pytest.mark.parametrize("bits", [9, 19])
def test_anchors_cover_every_string_once(monkeypatch, bits):
    monkeypatch.setattr(repeats, "PIECE_BITS", bits)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab c") for _ in range(n)).encode() for n in (99, 100, 101, 400, 411, 412, 413, 2000)]
    found = repeats.Anchors(100).of(texts)
    got = sorted((int(t), int(s) + j) for t, s, m in zip(found.text, found.start, found.more) for j in range(m + 1))
    assert got == [(i, j) for i, t in enumerate(texts) for j in range(len(t) - 99)]
    # equal strings, equal anchors
    keys: dict = {}
    for k, t, s, m in zip(found.key, found.text, found.start, found.more):
        for j in range(s, s + m + 1):
            assert keys.setdefault(texts[t][j : j + 100], k) == k


def test_ranks():
    data = np.frombuffer(bytes(random.Random(2).choice(b"ab\x00") for _ in range(700)), dtype=np.uint8)
    for length in (32, 33, 64, 100):
        rank = repeats.equal_ranks(data, length)
        padded = data.tobytes() + bytes(length)
        keys = [padded[i : i + length] for i in range(len(data))]
        order = sorted(set(keys))
        assert [order.index(k) for k in keys] == [sorted(set(rank.tolist())).index(r) for r in rank.tolist()]


def test_edge_cases(spark):
    out = repeats.remove_repeats(edge_documents(spark), keep=("k0", "a.b")).collect()
    assert len(out) == len(edge_rows()) and out[0].__fields__ == ["doc_id", "k0", "a.b", "n_bytes", "removed", "kept"]
    want = brute([(r[0], r[1]) for r in edge_rows() if r[0] is not None and r[1] != "repeated row"])
    for r in out:
        if r.doc_id is not None and r.n_bytes != len("repeated row"):
            assert (bytes(r.kept), len(r.removed)) == want[r.doc_id]
    assert repeats.remove_repeats(no_documents(spark)).count() == 0


def test_repeated_rows_are_one_text(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(40)) * 1 + "the quick brown fox jumps over " * 5
    rows = [(1, text), (1, text), (None, text), (None, text), (2, "x" + text)]
    got = sorted(((r.doc_id is None, r.doc_id, len(r.kept)) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    one = len(brute([(1, text)])[1][0])
    assert got == sorted([(False, 1, one)] * 2 + [(False, 2, 1)] + [(True, None, 0)] * 2, key=repr)


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_repeats"](spark, SF).collect()}
    want, removed = brute([(d["doc_id"], d["text"]) for d in given()]), 0
    assert len(rows) == len(want)
    for d in given():
        r, (kept, runs), n = rows[d["doc_id"]], want[d["doc_id"]], len((d["text"] or "").encode())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), runs, hashlib.sha256(kept).hexdigest())
        removed += r.n_removed
    assert removed


def test_long_strings(spark):
    """Contexts of more than 255 strings."""
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh é") for _ in range(3000))
    rows = [(i, "".join(rnd.choice("xyz ") for _ in range(50)) + passage[i * 90 : i * 90 + 1500]) for i in range(15)]
    assert run(spark, rows, length=400) == brute(rows, 400)
