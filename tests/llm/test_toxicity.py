"""The classifier on held-out rows, and what mentioning a group does to a score."""

import random

from tests.llm.cases import edge_documents, edge_rows, given, no_documents
from tidemark.llm import toxicity as tox
from tidemark.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, MEDIUM).collect()}
    assert len(rows) == len(given(sf=MEDIUM))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    marked = {r["doc_id"]: r["toxic"] for r in given("labels", MEDIUM)}
    held = [(rows[i].score, t) for i, t in marked.items() if rows[i].held_out]
    ones, zeros = [s for s, t in held if t], [s for s, t in held if not t]
    ranked = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    assert ones and zeros and ranked > 0.85
    assert sum(s >= 0.5 for s in zeros) <= 0.02 * len(zeros) + 1


def test_edge_cases(spark):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(17)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    model = tox.fit_model(edge_documents(spark), labels)
    out = tox.score(edge_documents(spark), model, keep=("doc_id", "k0", "a.b"))
    assert out.columns == ["doc_id", "k0", "a.b", "score", "predicted"] and out.count() == len(edge_rows())
    empty = {r.doc_id: r.score for r in out.where("doc_id < 3").collect()}
    assert empty[0] == empty[1] == empty[2]
    none = tox.fit_model(no_documents(spark), labels)
    assert tox.score(edge_documents(spark), none).count() == len(edge_rows())
    assert tox.score(no_documents(spark), model).count() == 0


def test_counterfactuals_lower_false_positives():
    """Toxic texts mention one group more often; without the penalty the mention itself is learnt."""
    rnd = random.Random(4)
    filler = [f"word{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        words = set(rnd.sample(filler, 8)) | ({"horrid"} if bad and rnd.random() < 0.7 else set())
        words |= {"muslim"} if rnd.random() < (0.8 if bad else 0.05) else {"christian"} if rnd.random() < 0.3 else set()
        texts.append({w.encode() for w in words})
        labels.append(int(bad))
    swap = tox.swaps(tox.IDENTITY_TERMS)

    def mention(weight: float) -> float:
        pack = lambda words: tox.np.array(sorted(tox._features_of(words)), dtype=tox.np.int32).tobytes()
        other = [tox.counterfactual(w, swap) for w in texts]
        model = tox.train([pack(w) for w in texts], [o and pack(o) for o in other], labels, tox.Fit(counterfactual=weight, l1=0.0))
        on = lambda word: sum(model.weights[f] for f in tox.features(word))
        return abs(on(b"muslim") - on(b"christian"))

    assert mention(10.0) < 0.3 * mention(0.0)


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    model = tox.fit_model(docs, labels, fit=tox.Fit(per_class=5))
    assert model.weights.shape == (tox.SPACE,)


def test_recall_at_the_cut(spark):
    """Of held-out toxic texts most are found, long ones too."""
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, sf).collect()}
    chars = {d["doc_id"]: len(d["text"] or "") for d in given(sf=sf)}
    held = [(rows[r["doc_id"]].predicted, r["toxic"], chars[r["doc_id"]]) for r in given("labels", sf) if rows[r["doc_id"]].held_out]

    def recall(least: int) -> float:
        found = [p for p, t, n in held if t and n > least]
        return sum(found) / len(found)

    assert recall(0) >= 0.8 and recall(3000) >= 0.8 and recall(10_000) >= 0.8
    assert sum(p for p, t, _ in held if not t) <= 0.01 * len(held)


def test_runs_without_spaces_are_looked_at_whole():
    """What is learnt is far behind the first 64 bytes of the only word, in Chinese and in one unbroken ASCII run."""
    rnd = random.Random(8)
    for letters, bad in (("天地人山水火木金土日月星雨雪風", "壞惡毒"), ("abcdefghijklmno", "vwxyzzyx")):
        made = ["".join(rnd.choices(letters, k=150)) for _ in range(240)]
        labels = [i % 2 for i in range(240)]
        texts = [(t[:100] + bad + t[100:] if y else t).encode() for t, y in zip(made, labels)]
        packed = [tox.np.array(sorted(tox._features_of(tox.words_of(t))), dtype=tox.np.int32) for t in texts]
        model = tox.train([p.tobytes() for p in packed[:160]], [None] * 160, labels[:160], tox.Fit())
        logits = [model.bias + model.weights[p].sum() for p in packed[160:]]
        assert sum((z >= 0) == y for z, y in zip(logits, labels[160:])) >= 76
