"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import lexical_search as ls
from tidemark.llm.queries import QUERIES


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    """docs and items: (key, text); rows (item, rank, doc, score)."""
    held = [(k, Counter(terms(t)), len(terms(t))) for k, t in docs]
    held = [x for x in held if x[2]]
    total, length = len(held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    rows = []
    for item, text in items:
        scored = []
        for key, c, n in held:
            m = 100 - 25 + (25 * n * total) // length
            score = 0
            for w in terms(text):
                if w in c:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key if key is not None else 0, key))
        rows += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return sorted(rows, key=repr)


ITEMS = [(1, "One two"), (2, "same words here"), (3, None), (4, "..."), (None, "naïve w7 w7 w8"), (5, "nowhere"), (1, "one line line row"), (6, "One two")]


def items_of(spark):
    return spark.createDataFrame([(*x, "t") for x in ITEMS], "item_id long, text string, doc_id string")


def test_edge_cases(spark):
    expected = brute([(r[0], r[1]) for r in edge_rows()], ITEMS)
    assert len(expected) > 10
    for item_bytes in (1 << 20, 40):
        out = ls.search(edge_documents(spark), items_of(spark), item_bytes=item_bytes)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in out.collect()), key=repr) == expected
    few = ls.search(edge_documents(spark), items_of(spark), top=1)
    assert sorted((tuple(r) for r in few.collect()), key=repr) == brute([(r[0], r[1]) for r in edge_rows()], ITEMS, 1)
    assert ls.search(no_documents(spark), items_of(spark)).count() == 0
    assert ls.search(edge_documents(spark), items_of(spark).limit(0)).count() == 0


def test_ties_between_blocks(spark, monkeypatch):
    """Many equal documents: the least ids win, whatever the blocks and partitions."""
    rows = [(i, "red green blue" if i % 3 else "red red") for i in range(700)]
    random.Random(1).shuffle(rows)
    monkeypatch.setattr(ls, "BLOCK", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "green"), (2, "red blue")], "item_id long, text string")
    assert sorted((tuple(r) for r in ls.search(docs, items).collect()), key=repr) == brute(rows, [(1, "green"), (2, "red blue")])


def test_intervals_close_on_the_best(monkeypatch):
    """Random lists: exactly the best come out, with final scores, and a high bar stops the reading early."""
    monkeypatch.setattr(ls, "PORTION", 4)
    rng = np.random.default_rng(3)
    for trial in range(40):
        n_docs, n_terms = int(rng.integers(1, 400)), 6
        pairs = rng.random((n_terms, n_docs)) < rng.random((n_terms, 1))
        term, doc = np.nonzero(pairs)
        share = rng.integers(1, 30, len(term))
        lists = ls.Lists(term, doc, share, n_terms, n_docs)
        wanted = [(t, int(rng.integers(1, 4))) for t in range(n_terms) if rng.random() < 0.7]
        if not wanted or not len(term):
            continue
        whole = np.zeros(n_docs, np.int64)
        for t, times in wanted:
            np.add.at(whole, doc[term == t], times * share[term == t])
        bar = int(rng.integers(0, 60))
        found, scores = lists.best(wanted, 5, bar)
        least = max(bar, 1, int(np.sort(whole)[-5]) if n_docs >= 5 else 0)
        assert dict(zip(found.tolist(), scores.tolist())) == {int(d): int(whole[d]) for d in np.flatnonzero(whole >= least)}


def test_query(spark):
    out = sorted((tuple(r) for r in QUERIES["op12_lexical_search"](spark, SF).collect()), key=repr)
    docs, items = given(), given("benchmark")
    assert out == brute([(d["doc_id"], d["text"]) for d in docs], [(b["item_id"], b["text"]) for b in items])
