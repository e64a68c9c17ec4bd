"""Counts against plain Python; the robust fit against planted outliers."""

import random
import re

import numpy as np

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import quality
from tidemark.llm.queries import QUERIES


def counts(text: str | None) -> tuple:
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen: dict = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_edge_cases(spark):
    out = quality.text_counts(edge_documents(spark).select("doc_id", "text")).collect()
    got = sorted((str(r.doc_id), *(r[c] for c in quality.COUNTS)) for r in out)
    assert got == sorted((str(r[0]), *counts(r[1])) for r in edge_rows())
    judged = quality.judge(edge_documents(spark), keep=("doc_id", "k0", "a.b"))
    assert judged.columns[:3] == ["doc_id", "k0", "a.b"] and judged.count() == len(edge_rows())
    assert quality.judge(no_documents(spark)).count() == 0


def test_random_counts(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["a ", "b ", "c\n", "é#", " ", "\t", "d "]) for _ in range(rnd.choice([3, 10, 80, 400]))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in quality.text_counts(df).collect():
        assert tuple(r[c] for c in quality.COUNTS) == counts(texts[r.doc_id])


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op5_quality"](spark, SF).collect()}
    docs = given()
    assert len(rows) == len(docs)
    for d in docs:
        want, r = counts(d["text"]), rows[d["doc_id"]]
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_outliers_do_not_move_the_fit(spark):
    """A fifth of a cell is junk of one kind; it is rejected, ordinary texts stay, in a cell of any size."""
    rnd = random.Random(11)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(n))

    def junk(n):
        return " ".join(rnd.choice("abcd") * rnd.randint(20, 30) + "###$$$%%%" for _ in range(n))

    rows = [(i, junk(80) if i % 5 == 0 else prose(rnd.randint(60, 400)), "en", "big" if i % 3 else "small") for i in range(1200)]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in out)


def test_plan_is_native(spark):
    plan = quality.judge(edge_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def prose(rnd, n, low=3, high=8):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(low, high))) for _ in range(n))


def brute_verdicts(texts, cells, robust):
    """The same estimate in numpy, cell by cell: squared distances, None where the base rules fail."""
    floors = np.array([floor for _, floor in quality.VECTOR.values()])
    vectors, good = [], []
    for t in texts:
        n, chars, symbols, lines, again = counts(t)
        good.append(not (n < 50 or 100 * again > 50 * n))
        vectors.append([np.log10(n), np.log10(chars / n), np.sqrt(symbols / chars), np.sqrt(lines / n), np.sqrt(again / n)] if good[-1] else [0] * 5)
    vectors, good = np.array(vectors, float), np.array(good)
    own = {c: np.flatnonzero(good & (np.array(cells) == c)) for c in set(cells)}
    own = {c: i for c, i in own.items() if len(i)}

    def measured(fits):
        return {c: (np.linalg.solve(low, (vectors[i] - m).T) ** 2).sum(axis=0) for c, i in own.items() for m, low in [fits[c]]}

    def cut(d2, share):
        bins = np.sort(np.floor(quality.BINS * np.log2(np.maximum(d2, 1e-9))))
        return 2.0 ** ((bins[int(np.ceil(share * len(bins))) - 1] + 1) / quality.BINS)

    fits = {}
    for c, i in own.items():
        low, mid, high = (np.sort(vectors[i], axis=0)[int(np.ceil(q * len(i))) - 1] for q in (0.25, 0.5, 0.75))
        fits[c] = mid, np.diag(np.sqrt(((high - low) / 1.349) ** 2 + floors**2))
    for _ in range(robust.steps):
        d2 = measured(fits)
        near = {c: i[d2[c] <= cut(d2[c], robust.share)] for c, i in own.items()}
        spread = {c: np.cov(vectors[i].T, bias=True) for c, i in near.items()}
        average = sum(len(near[c]) * spread[c] for c in own) / sum(len(near[c]) for c in own)
        for c, i in near.items():
            blended = (len(i) * spread[c] + robust.shared * average) / (len(i) + robust.shared)
            fits[c] = vectors[i].mean(axis=0), np.linalg.cholesky(blended + np.diag(floors**2))
    out = [None] * len(texts)
    d2 = measured(fits)
    for c, i in own.items():
        scale = max(cut(d2[c], 0.5) / quality.MEDIAN, 1.0)
        for j, x in zip(i, d2[c]):
            out[j] = x / scale
    return out


def test_verdicts_against_numpy(spark):
    rnd = random.Random(7)
    texts, cells = [], []
    for cell, n in (("a", 120), ("b", 60), ("c", 9), ("d", 2), ("e", 1)):
        for i in range(n):
            t = prose(rnd, rnd.randint(30, 300), 3, 8 if cell != "b" else 14)
            texts.append(t + " ###$$$" * 40 if i % 11 == 10 else t + ("\n" + t[:60]) * (i % 4))
            cells.append(cell)
    df = spark.createDataFrame([(i, t, c, None) for i, (t, c) in enumerate(zip(texts, cells))], "doc_id long, text string, lang string, source string")
    robust = quality.Robust()
    expected = brute_verdicts(texts, cells, robust)
    out = quality.judge(df, robust=robust)
    assert out.columns[:8] == ["doc_id", *quality.COUNTS, "base_failed", "kept"]
    for r in out.collect():
        want = expected[r.doc_id]
        assert (r.distance2 is None) == (want is None)
        if want is not None:
            assert abs(r.distance2 - want) <= 1e-6 * max(1, want) and r.kept == (want <= robust.cutoff)
    assert any(not r.kept for r in out.where("NOT base_failed").collect())


def test_a_small_cell_is_judged_by_itself(spark):
    """Ordinary texts of longer words, whatever the sizes of their cell and the other one."""
    rnd = random.Random(9)
    for few, many in ((40, 190), (40, 500), (210, 190), (3, 300)):
        rows = [(i, prose(rnd, rnd.randint(60, 300)), "en", "x") for i in range(many)]
        rows += [(many + i, prose(rnd, rnd.randint(60, 300), 12, 18), "fi", "y") for i in range(few)]
        out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
        assert out.where("NOT kept").count() == 0


def test_texts_without_words_in_any_join(spark):
    """They have no vector, and nothing is divided by their words, whether the fits are broadcast or shuffled to the rows."""
    rnd = random.Random(3)
    rows = [(i, prose(rnd, rnd.randint(60, 200)), "en", "x" if i % 3 else None) for i in range(60)]
    rows += [(60 + i, t, "en", "x") for i, t in enumerate([None, "", " \n\t ", "\u2003", "one"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for most in ("10m", "-1"):
            for n in names:
                spark.conf.set(n, most)
            out = {r.doc_id: r for r in quality.judge(docs).collect()}
            assert len(out) == len(rows) and all(out[i].distance2 is not None and out[i].kept for i in range(60))
            assert all(out[60 + i].base_failed and not out[60 + i].kept and out[60 + i].distance2 is None for i in range(5))
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_cutoff():
    assert abs(quality.Robust(quantile=0.999).cutoff - 20.515) < 1e-3 and abs(quality.Robust(quantile=0.5).cutoff - quality.MEDIAN) < 1e-3
