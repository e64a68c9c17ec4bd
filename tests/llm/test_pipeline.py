"""Each stage of the corpus run by itself, on the edge cases, an empty table and rows that are known to go or stay."""

import re

import corpus_pipeline as corpus
import pyarrow.parquet as pq
import pytest

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tests.llm.test_contamination import brute

STAGES = dict(corpus.STAGES)


def as_is(rows):
    return sorted(((r[0], r[1]) for r in rows), key=repr)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return None
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


@pytest.mark.parametrize("name", STAGES)
def test_no_documents(spark, name):
    out = STAGES[name](spark, no_documents(spark), SF)
    assert out.count() == 0
    if name != "tokens":
        assert out.columns == list(corpus.COLUMNS)


def test_toxicity_keeps_what_is_not_called_toxic(spark):
    out = STAGES["toxicity"](spark, edge_documents(spark), SF).collect()
    kept = as_is(out)
    assert set(kept) <= set(as_is(edge_rows()))
    assert all(sum(k == x for k in kept) in (0, as_is(edge_rows()).count(x)) for x in set(as_is(edge_rows()))), "repeated rows go or stay together"


def test_one_of_each_group_of_copies_stays(spark):
    base = [f"w{i}" for i in range(200)]
    near = [*base[:100], "other", *base[101:]]  # 191 of 201 runs of five are shared
    far = [*(f"v{i}" if i % 8 == 0 else w for i, w in enumerate(base))]
    rows = [(100, " ".join(near)), (101, " ".join(base)), (102, " ".join(base)), (103, " ".join(far))]
    more = spark.createDataFrame([(*r, "en", "s", None, *"xyzkrd") for r in rows], edge_documents(spark).schema)
    out = STAGES["near copies"](spark, edge_documents(spark).union(more), SF).collect()
    kept = sorted((r.doc_id for r in out if r.doc_id is not None), key=int)
    assert [i for i in kept if i >= 100] == [100, 103]
    sets = [(i, shingles(t)) for i, t, *_ in edge_rows()]
    wordless = [i for i, s in sets if s is None]
    assert sorted(r.doc_id for r in out if shingles(r.text) is None) == sorted(wordless), "texts without words all stay"
    classes = {frozenset(s) for _, s in sets if s}
    assert len(out) == len(classes) + len(wordless) + 2, "no two different texts of the edge cases are near"


def test_contaminated_documents_go(spark):
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    of = brute([(r["item_id"], r["text"]) for r in items])
    planted = next(r["text"] for r in items if len((r["text"] or "").split()) >= 13)
    docs = edge_documents(spark)
    more = spark.createDataFrame([(200, planted, "en", "s", None, *"xyzkrd"), (201, "clean " * 30, "en", "s", None, *"xyzkrd")], docs.schema)
    out = STAGES["decontamination"](spark, docs.union(more), SF).collect()
    rows = [(r[0], r[1]) for r in edge_rows()] + [(200, planted), (201, "clean " * 30)]
    stay = [(i, t) for i, t in rows if not (of(t)[1] and 20 * of(t)[1] >= of(t)[0])]
    assert as_is(out) == sorted(stay, key=repr) and 200 not in {r.doc_id for r in out}


def test_personal_data_goes_and_every_document_stays(spark):
    docs = edge_documents(spark)
    text = "write to some.one@example.org now"
    more = spark.createDataFrame([(300, text, "en", "s", len(text), *"xyzkrd")], docs.schema)
    out = STAGES["personal data"](spark, docs.union(more), SF).collect()
    assert as_is(r for r in out if r.doc_id != 300) == as_is(edge_rows())
    (one,) = [r for r in out if r.doc_id == 300]
    assert one.text == "write to <email> now" and one.n_chars == len(one.text)


def test_tokens_decode_to_the_text(spark):
    out = STAGES["tokens"](spark, edge_documents(spark), SF).collect()
    assert len(out) == len(edge_rows()) and all(r.round_trip and 4 * r.n_tokens == len(r.ids) for r in out)
    texts = {i: t for i, t, *_ in edge_rows() if i not in (None, 3)}
    assert all((r.n_tokens == 0) == (not texts[r.doc_id]) for r in out if r.doc_id in texts)


def test_run_goes_through_all_stages(spark):
    out = corpus.run(spark, SF)
    keys = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(keys) == len(set(keys)) < len(given())
