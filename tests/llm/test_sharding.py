"""Shards against an exhaustive search, and the rules that hold for any input."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.cases import SF, edge_documents, edge_rows, given, no_documents
from tidemark.llm import sharding
from tidemark.llm.queries import QUERIES


def best(sizes, shards):
    """Smallest possible largest sum of a contiguous cut, by dynamic programming."""
    n, inf = len(sizes), float("inf")
    upto = [0]
    for s in sizes:
        upto.append(upto[-1] + s)
    cost = [0] + [inf] * n
    for _ in range(shards):
        cost = [min((max(cost[j], upto[i] - upto[j]) for j in range(i + 1)), default=0) for i in range(n + 1)]
    return cost[n]


@pytest.mark.parametrize("bits, step, ranges", [(16, 10, 256), (3, 2, 2)])
def test_smallest_capacity(spark, monkeypatch, bits, step, ranges):
    for name, value in (("FIRST_BITS", bits), ("STEP_BITS", step), ("RANGES", ranges)):
        monkeypatch.setattr(sharding, name, value)
    rnd = random.Random(2)
    for n, shards, hot in ((40, 8, 0), (60, 5, 900), (5, 8, 0), (30, 3, 5)):
        sizes = {rnd.getrandbits(64) - (1 << 63): rnd.randint(1, 60) for _ in range(n)}
        if hot:
            sizes[rnd.getrandbits(62)] = hot
        bounds = sharding.cut_points(spark.createDataFrame(list(sizes.items()), "h long, size long"), shards)
        filled = Counter()
        for h, size in sizes.items():
            filled[sum(h >= b for b in bounds if b is not None)] += size
        assert max(filled.values()) == best([s for _, s in sorted(sizes.items())], shards)
        assert len(bounds) == shards - 1


def rules(rows, texts, shards):
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values()) and set(by_shard) <= set(range(shards))
    got = Counter((r.size, r.text_crc32) for r in rows)
    assert got == Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)


def test_edge_cases(spark):
    rows = sharding.shard_by_bytes(edge_documents(spark).where("text IS NOT NULL"), 3, keep=("doc_id", "k0", "row")).collect()
    rules(rows, [r[1] for r in edge_rows() if r[1] is not None], 3)
    assert sharding.shard_by_bytes(edge_documents(spark), 8).count() == len(edge_rows())
    assert sharding.shard_by_bytes(no_documents(spark), 8).count() == 0


def test_one_group_of_a_third(spark):
    texts = ["the same text" * 3] * 300 + [f"another {i} text" * 3 for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shard_by_bytes(docs, 8).collect()
    rules(rows, texts, 8)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert len(sizes) == 8  # the rest is still spread over the other shards


def test_query(spark):
    rows = QUERIES["op1_sharding"](spark, SF).collect()
    rules(rows, [d["text"] for d in given()], 8)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert max(sizes.values()) <= 1.25 * sum(sizes.values()) / 8
