"""Byte-level BPE against the tiktoken library, and the round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES, RANKS

CODEC = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def ids(packed: bytes) -> list[int]:
    return memoryview(packed).cast("I").tolist()


@pytest.mark.parametrize("alphabet", ["a", "ab", "=-", "0123", " \n", "日本語中文", "the ing tion", "éèàüß", "aA1 !\n's"])
def test_random_texts(alphabet):
    rnd = random.Random(alphabet)
    for length in [0, 1, 5, 47, 48, 49, 97, 400, 3000] * 6:
        text = "".join(rnd.choice(alphabet) for _ in range(length))
        assert ids(CODEC.encode(text)) == LIBRARY.encode_ordinary(text)
        assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_tree_equals_direct_merging():
    rnd = random.Random(3)
    for _ in range(300):
        piece = bytes(rnd.choice(b"aabbcet hin") for _ in range(rnd.randint(1, 700)))
        assert CODEC.tree(piece) == CODEC.merge_long(piece) if len(piece) > bpe.LEAF else True


def test_long_match():
    for text in ("ab" * 100_000, "=" * 50_000):
        assert ids(CODEC.encode(text)) == LIBRARY.encode_ordinary(text)


def test_memory_bound_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "LONG_TEXT", 5)
    own = bpe.Codec(CODEC.ranks, public_tokenizers.PATTERN)
    for r in given()[:20]:
        assert own.encode(r["text"]) == CODEC.encode(r["text"])


def test_edge_cases(spark):
    docs = edge_documents(spark)
    out = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "spans"), round_trip=True)
    assert out.columns == ["doc_id", "spans", "ids", "decoded"]
    got = sorted((str(r.doc_id), ids(bytes(r.ids)), bytes(r.decoded)) for r in out.collect())
    want = sorted((str(r[0]), LIBRARY.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in edge_rows())
    assert got == want
    back = bpe.decode_documents(out.select("doc_id", "ids"), RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back.collect()) == sorted((a, c) for a, _, c in want)
    assert bpe.encode_documents(no_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, SF).collect()}
    docs = given()
    assert len(rows) == len(docs)
    for d in docs:
        want = LIBRARY.encode_ordinary(d["text"] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in want)
        r = rows[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_matches_are_remembered_to_a_bound(monkeypatch):
    """What was met lately stays remembered, whatever has come between; ids do not hang on it."""
    own, fresh = (bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN) for _ in range(2))
    monkeypatch.setattr(bpe, "MATCHES", 50)
    for i in range(400):
        text = f"often often w{i}x y{i * 7919}z " + "abc" * (i % 40)
        packed = own.encode(text)
        assert packed == b"".join(fresh.encode_match(m) for m in fresh.split.findall(text))
        assert len(own.known) + len(own.older) <= 100 and {" often", "often"} <= {*own.known, *own.older}
