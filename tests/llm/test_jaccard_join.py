"""The join against all pairs of whole sets."""

import random
import re

import numpy as np
import pytest

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import jaccard_join as jj
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def shingle_set(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=90, size=3):
    """rows: (key, text). Returns (key, size, component) of each, sorted."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[find(i)] = find(j)
    least: dict = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=repr)


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jj.similar_documents(docs, **more).collect()), key=repr)


def variants(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rnd.randrange(len(out))
        kind = rnd.random()
        if kind < 0.4:
            out[i] = f"new{rnd.randrange(10**6)}"
        elif kind < 0.7 and len(out) > 2:
            del out[i]
        else:
            out.insert(i, f"ins{rnd.randrange(10**6)}")
    return " ".join(out)


def test_random_variants(spark):
    rnd, rows = random.Random(9), []
    for n in (3, 9, 11, 12, 13, 17, 18, 19, 20, 21, 22, 28, 29, 40, 41, 60, 90, 150, 400):
        base = [f"b{n}_{rnd.randrange(10**6)}" for _ in range(n)]
        rows += [(len(rows) + i, variants(rnd, base, rnd.choice([0, 1, 1, 2, 3, n // 30, n // 20]))) for i in range(9)]
        # one element more or less at the ends: the closest misses and hits
        rows += [(len(rows) + i, " ".join(base[: n - i])) for i in range(4) if n - i > 0]
    rnd.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_other_rule(spark):
    rnd, rows = random.Random(4), []
    for n in (6, 12, 15, 40, 90):
        base = [f"d{n}_{i}" for i in range(n)]
        rows += [(len(rows) + i, variants(rnd, base, rnd.choice([0, 1, 2, n // 20]))) for i in range(12)]
    assert run(spark, rows, rule=jj.Rule(percent=80, size=5)) == brute(rows, 80, 5)


def test_small_filter_changes_nothing(spark, monkeypatch):
    rnd, rows = random.Random(14), []
    for n in (30, 60):
        base = [f"e{n}_{i}" for i in range(n)]
        rows += [(len(rows) + i, variants(rnd, base, rnd.choice([0, 1, 2]))) for i in range(12)]
    monkeypatch.setattr(jj, "FILTER_BITS", 1 << 16)
    assert run(spark, rows) == brute(rows)


def test_long_chain_and_common_passage(spark):
    base = [f"w{i}" for i in range(120)]
    chain = [(i, " ".join(base[i : i + 60])) for i in range(50)]
    passage = " ".join(f"p{i}" for i in range(40))
    shared = [(100 + i, f"{passage} " + " ".join(f"q{i}_{j}" for j in range(8))) for i in range(60)]
    assert run(spark, chain + shared) == brute(chain + shared)


@pytest.mark.parametrize("few", [0, 1000])
def test_group_around_the_threshold(spark, monkeypatch, few):
    """Copies of one text that mostly just miss each other: compared by differences, and pair by pair."""
    monkeypatch.setattr(jj, "FEW", few)
    rnd, rows = random.Random(21), []
    for n, most in ((120, 5), (60, 3)):
        base = [f"c{n}_{i}" for i in range(n)]
        rows += [(len(rows) + i, variants(rnd, base, rnd.randint(1, most))) for i in range(60)]
        # families that share edits, far from the others
        for _ in range(6):
            other = variants(rnd, base, most + 4).split()
            rows += [(len(rows) + i, variants(rnd, other, rnd.randint(0, 2))) for i in range(5)]
    rnd.shuffle(rows)
    want = brute(rows)
    assert run(spark, rows) == want
    assert 10 < len({c for _, _, c in want}) < len(rows) - 10


@pytest.mark.parametrize("few", [0, 1000])
def test_copies_that_miss_each_other_make_few_pairs(spark, monkeypatch, few):
    """Copies share many lists; what they were changed from is one of them, and not the first."""
    seen, staged = [], jj.stage

    def counted(df, label="stage", path=None):
        out = staged(df, label, path)
        if label in ("join-pairs", "join-near"):
            seen.append(out.count())
        return out

    monkeypatch.setattr(jj, "FEW", few)
    monkeypatch.setattr(jj, "stage", counted)
    rnd, base = random.Random(17), [f"o{i}" for i in range(200)]

    def changed(edits):
        at = set(rnd.sample(range(200), edits))
        return " ".join(f"n{rnd.randrange(10**9)}" if i in at else w for i, w in enumerate(base))

    # those with three linked with what they come from, not with each other; those with eight linked with nothing
    rows = [(i, changed(3 if i % 3 else 8)) for i in range(40)] + [(40, " ".join(base))] + [(41 + i, changed(3)) for i in range(10)]
    rule = jj.Rule(percent=80, size=5)
    got = run(spark, rows, rule=rule)
    assert got == brute(rows, 80, 5) and 2 < len({c for _, _, c in got}) < 30
    assert seen[2] + seen[3] < len(rows), "pairs left after the hubs, and those compared by whole sets"


@pytest.mark.parametrize("percent", [90, 80])
def test_sketches_tell_no_linked_pair_apart(percent):
    rnd, rule, missed = np.random.default_rng(2), jj.Rule(percent), 0
    for _ in range(3000):
        n = int(rnd.integers(1, 400))
        a = rnd.integers(1, 2**63, n).astype(np.uint64)
        drop, add = int(rnd.integers(0, n // 4 + 1)), int(rnd.integers(0, n // 4 + 2))
        b = np.concatenate([a[drop:], rnd.integers(1, 2**63, add).astype(np.uint64)])
        x, y = (np.frombuffer(rule.sketch(v), dtype=np.int8)[None] for v in (a, b))
        alike = rule.alike(x, y, np.array([len(a)]), np.array([len(b)]))[0]
        if 100 * (n - drop) >= percent * (n + add):
            assert alike, (n, drop, add)
        else:
            missed += not alike
    assert missed > 800


@pytest.mark.parametrize("percent", [90, 80])
def test_keys_meet_for_every_linked_pair(percent):
    """Without Spark: whatever the sizes, linked sets have a key in common."""
    rnd, rule = np.random.default_rng(1), jj.Rule(percent)
    for _ in range(3000):
        n = int(rnd.integers(1, 300))
        a = rnd.integers(1, 2**63, n).astype(np.uint64)
        drop, add = int(rnd.integers(0, n // 5 + 1)), int(rnd.integers(0, n // 4 + 2))
        b = np.concatenate([a[drop:], rnd.integers(1, 2**63, add).astype(np.uint64)])
        common, union = n - drop, n + add
        if 100 * common >= percent * union and (drop or add):
            assert set(rule.keys(np.unique(a)).tolist()) & set(rule.keys(np.unique(b)).tolist()), (n, drop, add)


def test_edge_cases(spark):
    out = jj.similar_documents(edge_documents(spark), keep=("n_words", "a.b"))
    assert out.columns == ["doc_id", "n_words", "a.b", "n_shingles", "component_id"]
    got = sorted(((r[0], r[3], r[4]) for r in out.collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in edge_rows()])
    assert jj.similar_documents(no_documents(spark)).count() == 0


def test_one_of_each(spark):
    out = jj.one_of_each(edge_documents(spark))
    assert out.columns == edge_documents(spark).columns
    want, seen = [], set()
    rows = [(r[0], r[1]) for r in edge_rows()]
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = shingle_set(text)
        if not words or all(100 * len(words & s) < 90 * len(words | s) for s in seen):
            want.append((key, text))
            seen |= {frozenset(words)} if words else set()
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert jj.one_of_each(no_documents(spark)).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(6, 60)] + [(7, 7)]
    links += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(70)]
    label = {x: x for e in links for x in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == label


def test_query(spark):
    got = sorted((tuple(r) for r in QUERIES["op7_jaccard_join"](spark, SF).collect()), key=repr)
    want = brute([(d["doc_id"], d["text"]) for d in given()])
    assert got == want and any(k != c for k, _, c in want)
