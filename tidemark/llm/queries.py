"""The queries of this folder, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, contamination, jaccard_join, language_model, lexical_search, page_text, personal_data, piece_lengths, prefix_trie, quality, repeats, sharding, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(documents(spark, sf_dir), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_documents(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, round_trip=True)
    return found.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    base = personal_data.base_kinds()

    def of(kinds: list[str]) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(kinds))

    return found.select(
        "doc_id",
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(personal_data.described(of(base)), 256).alias("base_sha256"),
        personal_data.described(F.col("spans")).alias("spans"),
    )


@query
def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        contamination.mask_contaminated(found).alias("contaminated"),
    )


@query
def op9_piece_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lengths.piece_counts(documents(spark, sf_dir), lambda: piece_lengths.byte_level(RANKS))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(documents(spark, sf_dir))


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", language_model.held_out())
    model = language_model.learn(docs.where("NOT held_out"))
    return language_model.score(docs, model, keep=("doc_id", "held_out"))


@query
def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.number_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(*prefix_trie.graft(turns))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".replace("{text}", _LOWER)
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')".replace("{text}", _LOWER)

ORACLE["op8_contamination"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_RUNS} AS w FROM documents),
b AS (SELECT item_id, {_RUNS} AS w, least(len(w), 13) AS s FROM benchmark),
starts AS (SELECT item_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM b WHERE s > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, s, array_to_string(w[i : i + s - 1], ' ') AS t FROM starts),
places AS (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, (SELECT DISTINCT s FROM windows) WHERE len(w) >= s),
hits AS MATERIALIZED (
  SELECT p.doc_id, p.i, p.s, v.item_id::VARCHAR AS item
  FROM (SELECT doc_id, s, i, array_to_string(w[i : i + s - 1], ' ') AS t FROM places) p JOIN windows v ON v.s = p.s AND v.t = p.t
),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + s)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op7_jaccard_join"] = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w, least(len(w), 3) AS s FROM documents),
starts AS (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d WHERE s > 0),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + s - 1], ' ') AS t FROM starts),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM least LEFT JOIN sizes USING (doc_id)
"""

_TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".replace("{text}", _LOWER)

ORACLE["op12_lexical_search"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
i AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
wanted AS MATERIALIZED (SELECT i, item_id, t, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS t FROM i) GROUP BY ALL),
held AS MATERIALIZED (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM wanted) GROUP BY ALL
),
total AS MATERIALIZED (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
weights AS MATERIALIZED (
  SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), total
),
lengths AS (SELECT r, doc_id, 75 + (25 * len(w) * n) // l AS m FROM d, total WHERE len(w) > 0),
shares AS MATERIALIZED (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS share FROM held JOIN lengths USING (r) JOIN weights USING (t)),
scores AS (SELECT i, item_id, r, doc_id, sum(times * share)::BIGINT AS score FROM wanted JOIN shares USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({c}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"""

ORACLE["op13_prefix_trie"] = f"""
WITH own AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS MATERIALIZED (SELECT DISTINCT c, c - c % 100 AS base, {_CRC32.format(c='c')} % 6 AS h FROM own),
parts AS (
  SELECT v.c, 0 AS part, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.pos <= v.h
  UNION ALL SELECT o.c, 1, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h
),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM parts),
steps AS (SELECT c, d, length(text) AS chars, sha256(length(role) || ':' || role || text) AS turn FROM turns),
members AS MATERIALIZED (
  SELECT c, d, chars, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d) AS path FROM steps
  UNION ALL SELECT c, 0, 0, '' FROM convs
),
nodes AS MATERIALIZED (SELECT path, d, min(c) AS c, count(*) AS n, any_value(chars) AS chars FROM members GROUP BY path, d),
ends AS (
  SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
  FROM (SELECT c, max_by(path, d) AS path FROM members GROUP BY c) GROUP BY path
),
children AS MATERIALIZED (SELECT left(path, length(path) - 64) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT a.path, sum((b.n - 1) * b.chars)::BIGINT AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes a JOIN nodes b ON starts_with(b.path, a.path) LEFT JOIN children k ON k.path = b.path GROUP BY a.path
)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN children k USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON n.d > 0 AND p.path = left(n.path, length(n.path) - 64)
"""
