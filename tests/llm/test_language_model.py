"""Base scores against plain counting; the model against the same model with exact counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import language_model as lm
from tidemark.llm.queries import QUERIES


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def base(train, texts):
    counts = Counter(t for x in train for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for x in texts:
        t = tokens(x)
        out.append((len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)))
    return out


def quantised(n, b=1.5):
    level = 1 + math.floor(math.log(n) / math.log(b) + 1e-9)
    return 1 if level == 1 else b ** (level - 1) * (1 + b) / 2


def exact_model(train, texts, weight=0.3):
    """The model with the exact unigram counts (all words of these small tables are frequent) and no false hits."""
    counts, after, starts = Counter(), Counter(), len(train)
    for x in train:
        t = tokens(x)
        counts.update(t)
        after.update(zip(["start", *t], t))
    bound = sum(counts.values()) + len(counts) + 1
    for x in texts:
        t = tokens(x)
        total = 0.0
        for u, w in zip(["start", *t], t):
            history = quantised(starts) if u == "start" else counts[u]
            pair = quantised(after[u, w]) if after[u, w] else 0
            total += math.log10(weight * min(1, pair / max(history, 1)) + (1 - weight) * (counts[w] + 1) / bound)
        yield total


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_language_model"](spark, SF).collect()}
    docs = given()
    out = lambda d: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2
    train = [d["text"] for d in docs if not out(d)]
    assert len(rows) == len(docs)
    close = []
    for d, want, exact in zip(docs, base(train, [d["text"] for d in docs]), exact_model(train, [d["text"] for d in docs])):
        r = rows[d["doc_id"]]
        assert r.held_out == out(d)
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and math.isclose(r.base_score, want[3], rel_tol=1e-9)
        close.append((r.score, exact, r.n_tokens))
    # false hits of the filter only raise counts, and seldom
    assert np.mean([abs(a - b) / n for a, b, n in close]) < 0.1
    assert np.corrcoef([a / n for a, _, n in close], [b / n for _, b, n in close])[0, 1] > 0.95


def test_filter_never_counts_too_low():
    rng = np.random.default_rng(3)
    shape = lm.Shape()
    made = lm.Filter(4, 80_000, shape)
    grams, counts = rng.integers(1, 2**48, 20_000).astype(np.uint64), rng.geometric(0.3, 20_000) ** 3
    block, parts = made.block(grams), []
    for b in range(4):
        parts.append(made.build(grams[block == b], counts[block == b]))
    made.bits = np.frombuffer(b"".join(parts), dtype=np.uint8)
    got = made.counts(grams)
    assert (made.level(np.maximum(got, 1)) >= made.level(counts)).all()
    assert (made.level(np.maximum(got, 1)) == made.level(counts)).mean() > 0.5


def test_few_frequent_words_give_the_same_base(spark):
    docs = spark.createDataFrame([(d["doc_id"], d["text"]) for d in given()[:80]], "doc_id long, text string")
    model = lm.learn(docs, shape=lm.Shape(frequent=5, task_tokens=3000))
    assert len(model.frequent) <= 5 and 0 < model.filled < 0.6
    texts = [d["text"] for d in given()[:80]]
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    for d, want in zip(given(), base(texts, texts)):
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and math.isclose(r.base_score, want[3], rel_tol=1e-9)


def test_edge_cases(spark):
    docs = edge_documents(spark)
    model = lm.learn(docs.where("doc_id % 2 = 0"))
    out = lm.score(docs, model, keep=("doc_id", "n_words", "row", "a.b")).collect()
    assert out[0].__fields__[:4] == ["doc_id", "n_words", "row", "a.b"]
    train = [r[1] for r in edge_rows() if r[0] is not None and r[0] % 2 == 0]
    want = sorted((str(r[0]), *b[:3], round(b[3], 6)) for r, b in zip(edge_rows(), base(train, [r[1] for r in edge_rows()])))
    assert sorted((str(r[0]), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    nothing = lm.learn(no_documents(spark))
    assert lm.score(docs, nothing).where("n_known = 0").count() == len(edge_rows())
    assert lm.score(no_documents(spark), model).count() == 0


def test_filter_grows_with_the_text(spark):
    """Bits for each token stay the same past the 67 million tokens of a 64 MB filter, in blocks of a bounded size."""
    shape = lm.Shape()
    for tokens in (1_000_000, 80_000_000, 4_200_000_000):
        made, _ = lm._filter(no_documents(spark).selectExpr("CAST('' AS BINARY) AS text").limit(0), tokens, shape)
        assert made.blocks * made.block_bits >= shape.bits_per_token * tokens
        assert made.block_bits <= shape.bits_per_token * shape.task_tokens + 8


def test_portions_score_as_the_whole_filter(spark, monkeypatch):
    """Levels that come back from many blocks to many portions give the score that the filter in one piece gives."""
    monkeypatch.setattr(lm, "PORTION_BYTES", 3000)
    texts = [d["text"] for d in given()[:120]] + [None, "", "only once here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = docs.where("doc_id % 3 > 0")
    model = lm.learn(train, shape=lm.Shape(frequent=40, task_tokens=2000))
    assert model.filter.blocks > 16 and 0 < model.filled < 0.6
    whole = np.zeros(model.filter.blocks * model.filter.block_bits // 8, dtype=np.uint8)
    for r in model.blocks.collect():
        at = r.block * model.filter.block_bits // 8
        whole[at : at + len(r.bits)] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    own = lm.Filter(model.filter.blocks, model.filter.block_bits, model.filter.shape, whole)
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    assert len(got) == len(texts)
    words, bound = lm.Numbered(model.frequent), model.tokens + model.words + 1
    for i, t in enumerate(texts):
        split = lm.words_of((t or "").encode())
        hashes, exact = words.look_up(split)
        before, both = lm.pairs(hashes, [len(split)])
        count = np.where(exact > 0, exact, own.counts(hashes))
        history = np.concatenate([own.counts(before[:1]), count[:-1]])
        p = 0.3 * np.minimum(1, own.counts(both) / np.maximum(history, 1)) + 0.7 * (count + 1) / bound
        assert math.isclose(got[i].score, np.log10(p).sum(), rel_tol=1e-9) and got[i].score <= 0


def test_what_was_asked_is_off_the_disks_before_portions_are_shuffled(spark, monkeypatch):
    """The levels are staged, so the last shuffle has only portions and levels behind it."""
    staged = {}
    real = lm.stage

    def watched(df, label="stage", path=None):
        staged[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, label, path)

    monkeypatch.setattr(lm, "stage", watched)
    docs = spark.createDataFrame([(i, f"a b c {i}") for i in range(40)], "doc_id long, text string")
    assert lm.score(docs, lm.learn(docs)).where("score < 0").count() == 40
    assert "model-answers" in staged and staged["model-scores"].count("MapInArrow") == 1


def test_distinct_n_grams_are_those_of_numpy():
    for n in (1, 2, 5000):
        grams = np.random.default_rng(n).integers(0, 3000, n, dtype=np.uint64)
        assert np.array_equal(lm._distinct(grams.copy()), np.unique(grams))


def test_a_block_is_the_same_whatever_is_set_together(monkeypatch):
    """N-grams that came once and others are summed, and set in the block some at a time."""
    rng = np.random.default_rng(5)
    made = lm.Filter(4, 80_000, lm.Shape())
    once, more, n = rng.integers(0, 9000, 6000).astype(np.uint64), rng.integers(0, 9000, 3000).astype(np.uint64), rng.integers(2, 60, 3000)
    counts = Counter(once.tolist())
    for g, k in zip(more.tolist(), n.tolist()):
        counts[g] += k
    grams, summed = lm._summed(once, more, n)
    assert dict(zip(grams.tolist(), summed.tolist())) == counts
    whole = made.build(grams, summed)
    monkeypatch.setattr(lm, "AT_A_TIME", 700)
    assert made.build(grams, summed) == whole
    none = lm._summed(once[:0], more[:0], n[:0])
    assert len(none[0]) == len(none[1]) == 0


def test_batches_to_python_are_bounded_in_bytes(spark):
    """Rows of some megabytes come a few at a time, or a batch of them is held by Spark and by the worker as a whole."""
    from tidemark.llm.rows import BYTES, map_rows

    large = spark.range(0, 40, 1, 1).selectExpr("repeat(string(id % 10), 1000000) AS data")
    sizes = [r.n for r in map_rows(large, 0, "n long", lambda batches: ([[sum(map(len, data))]] for (data,) in batches)).collect()]
    assert sum(sizes) == 40_000_000 and max(sizes) <= BYTES + 2_000_000
    assert map_rows(large.limit(0), 0, "n long", lambda batches: ([[1]] for _ in batches)).count() == 0
