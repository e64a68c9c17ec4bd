"""Greedy piece counts against a search for the longest piece at each step."""

import itertools

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import piece_lengths as pl
from tidemark.llm.bpe import read_ranks
from tidemark.llm.queries import QUERIES, RANKS


def greedy(word, starts, rest):
    at, n, pieces = 0, 0, starts
    while at < len(word):
        stop = next((j for j in range(len(word), at, -1) if word[at:j] in pieces), None)
        if stop is None:
            return 1, False
        at, n, pieces = stop, n + 1, rest
    return n, True


def test_all_short_words():
    starts, rest = {b"ab", b"a", b"abcd"}, {b"b", b"bc", b"c", b"cde"}
    own = pl.Automaton(starts, rest)
    for n in range(7):
        for word in map(bytes, itertools.product(b"abcde", repeat=n)):
            assert own.count(word) == greedy(word, starts, rest)


def brute(text):
    tokens = read_ranks(RANKS)
    starts, rest = {t for t in tokens if t[:1] == b" "}, {t for t in tokens if t[:1] != b" "}
    found = [greedy(b" " + w, starts, rest) for w in (text or "").encode().split()]
    return len(found), sum(n for n, _ in found), sum(not cut for _, cut in found)


def test_edge_cases(spark):
    out = pl.piece_counts(edge_documents(spark).where("doc_id != 13 OR doc_id IS NULL"), lambda: pl.byte_level(RANKS), keep=("doc_id", "n_words"))
    got = sorted((str(r[0]), r[2], r.n_pieces, r.n_unknown) for r in out.collect())
    assert got == sorted((str(r[0]), *brute(r[1])) for r in edge_rows() if r[0] != 13)
    assert pl.piece_counts(no_documents(spark), lambda: pl.byte_level(RANKS)).count() == 0


def test_unknown_words(spark):
    docs = spark.createDataFrame([(1, "ab xx abc ab"), (2, "x")], "doc_id long, text string")
    out = pl.piece_counts(docs, lambda: pl.Automaton([b"ab"], [b"c"]), prefix=b"").collect()
    assert sorted((r.doc_id, r.n_words, r.n_pieces, r.n_unknown) for r in out) == [(1, 4, 5, 1), (2, 1, 1, 1)]


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_piece_lengths"](spark, SF).collect()}
    for d in given()[:60]:
        r = rows[d["doc_id"]]
        assert (r.n_words, r.n_pieces, r.n_unknown) == brute(d["text"])
