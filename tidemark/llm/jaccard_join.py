"""N-gram Jaccard join: size-aware, light sets by subsets, heavy sets by inverted lists.

Two sets link if their shared share is at least `percent`. Sets up to a boundary can only link if one is the
other plus one element, so a light set enumerates itself and its subsets of one element less; equal subsets
meet. Beyond the boundary subsets of two elements less are needed, whose number grows with the square, while
lists cost a fixed share of the size: that is where the cost puts the boundary.

A heavy set is dealt by hash into more parts than a linked set can differ from it in elements, so two linked
sets have a part in common, and each inverted list holds the sets with one same part. Lists of parts, not of
single elements, because a passage that many documents share would put them all into the lists of its elements,
but does not make a whole part equal. The number of parts depends on the size, in bands; a set near the lower
edge of its band also has parts for the band below. Most lists have one set: a filter of fixed size, made of all
keys before, tells which keys came once only, and those are never sent. (A filter too small for the data lets
more through; it drops no key that came twice.)

Equal sets are one node. In each list all nodes are compared with its hub first, the node that meets most others
in all its lists: of near copies the one that was changed least, which most of them link with. Only what is not
yet connected after that is compared among itself: in a long list by what the sets differ in from the hub, which
they share only if they are alike; in a short one by counts of their elements in bins, within the task that has
the list, so that pairs which just miss each other are not sent once for each list they share. No link is lost.
Every pair that may link by these bounds is compared by the whole sets.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, names
from tidemark.llm.components import components
from tidemark.llm.rows import SPACE, map_rows, utf8
from tidemark.session import remove, scratch_dir, stage

#: Words a task remembers the hash of. Bounds memory, not results.
REMEMBERED = 300_000
#: Open lists with more sets are compared by their differences from the hub, shorter ones pair by pair by their counts
#: in bins. Either way finds all links.
FEW = 1000
#: Sizes of heavy sets fall into bands of this ratio, which must not be less than the largest ratio of linked sizes.
BAND = 1.25
#: Bits of the filter, at most (32 MB); a power of two. Blocks it is made in, at most.
FILTER_BITS, BLOCKS = 1 << 28, 1 << 12
#: Bins of the counts that tell unlike sets apart without looking at the sets.
BINS = 128

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def hash(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self.known) < REMEMBERED and len(word) <= 48:
            self.known[word] = found
        return found

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known, new = self.known.get, self.hash
        return np.fromiter((known(w) or new(w) for w in words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `size` words; shorter texts are one run; no words, no run."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, size)
    total = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        total = mix(total + words[i : n - width + 1 + i]) * _ODD[i % 3]
    found = np.sort(mix(total))  # sorting takes a fraction of the time and memory that `np.unique` takes to hash them
    return found[np.append(True, found[1:] != found[:-1])]


@dataclass(frozen=True)
class Rule:
    """Shares as integer percent; what follows from them for sizes."""

    percent: int = 90
    size: int = 3

    @property
    def boundary(self) -> int:
        """Largest light set: two sets that differ in two elements and link have one that is larger."""
        return -(-2 * self.percent // (100 - self.percent))

    def edge(self, k: int) -> int:
        """Least size in band k."""
        return int(self.boundary * BAND**k)

    def band(self, n: int) -> int:
        k = 0
        while n >= self.edge(k + 1):
            k += 1
        return k

    @lru_cache(maxsize=None)
    def parts(self, k: int) -> tuple[int, int]:
        """Number of parts for pairs whose smaller set is in band k; how many of them may be empty.

        One part more than the elements in which linked sets can differ, and one for each part that may be
        empty: so a part that is equal and not empty is left. Only a set with more empty parts lists those.
        """
        least, largest = self.edge(k), self.edge(k + 1) - 1
        differ = (100 - self.percent) * (100 * largest // self.percent) // 100
        empty = 1
        for _ in range(20):
            often = (differ + 1 + empty) * math.exp(-least / (differ + 1 + empty))
            empty = 1 + math.ceil(often + 3 * math.sqrt(often))
        return differ + 1 + empty, empty

    def keys(self, items: np.ndarray) -> np.ndarray:
        """Keys under which a set with these (distinct) hashes meets all sets it may link with."""
        n, out = len(items), []
        spread = mix(items ^ _ODD[0])
        if n <= self.boundary:
            whole = spread.sum(dtype=np.uint64)
            # one element less or more links only from this size on
            if 100 * n >= self.percent * (n + 1):
                out.append(np.array([whole], dtype=np.uint64))
            if 100 * (n - 1) >= self.percent * n:
                out.append(whole - spread)
        if n >= self.boundary:
            own = self.band(n)
            for k in {own, own - 1} if own and -(-self.percent * n // 100) < self.edge(own) else {own}:
                parts, empty = self.parts(k)
                part = ((items >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)
                sums = np.zeros(parts, dtype=np.uint64)
                np.add.at(sums, part, spread)
                full = np.bincount(part, minlength=parts) > 0
                key = mix(sums ^ mix(np.arange(parts, dtype=np.uint64) + np.uint64((k + 1) << 32)))
                out.append(key if parts - full.sum() > empty else key[full])
        return mix(np.concatenate(out)) if out else items[:0]

    def sketch(self, items: np.ndarray) -> bytes:
        """How many elements fall into each bin. Two sets differ in at least what their bins differ in."""
        return np.minimum(np.bincount((items >> np.uint64(40)).astype(np.int64) % BINS, minlength=BINS), 127).astype(np.int8).tobytes()

    def alike(self, x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
        """Which pairs may link, by their sketches (a row each) and sizes: p <= common / union, where both follow from sizes and difference."""
        differ = np.abs(x - y).sum(axis=1, dtype=np.int64)
        return (100 + self.percent) * differ <= (100 - self.percent) * (n_x + n_y)

    def fits(self, n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(n_x, n_y) >= self.percent * np.maximum(n_x, n_y)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(offsets, values.view(np.int64))


def _repeated_keys(texts: DataFrame, rule: Rule) -> tuple[np.ndarray, int]:
    """The filter: a bit for each place that keys of two different sets fall on; and how far keys are shifted."""
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = 1 << max(16, min(FILTER_BITS.bit_length() - 1, int(total).bit_length()))
    blocks = min(BLOCKS, max(16, -(-total // 16_000_000)), bits // 4096)
    blocks = 1 << (blocks.bit_length() - 1)
    shift, size = 64 - (bits.bit_length() - 1), bits // blocks

    def place(batches):
        words, seen, found, n = Words(), set(), [], 0
        for (data,) in batches:
            for t in data:
                items = shingles(words.hashes(t.lower().split()), rule.size)
                same = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
                if same not in seen:  # equal sets are one
                    seen.add(same)
                    found.append(rule.keys(items) >> np.uint64(shift))
                    n += len(found[-1])
            if n > 1_000_000:
                yield send(found)
                seen, found, n = set(), [], 0
        yield send(found)

    def send(found):
        places, n = np.unique(np.concatenate([*found, np.zeros(0, dtype=np.uint64)]), return_counts=True)
        edges = np.searchsorted(places, np.arange(blocks + 1, dtype=np.uint64) * np.uint64(size))
        own = (places % np.uint64(size)).astype(np.uint32)
        out = [(b, own[i:j][n[i:j] == 1].tobytes(), own[i:j][n[i:j] > 1].tobytes()) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return [list(x) for x in zip(*out)]

    def mark(batches):
        once, twice = {}, {}
        for columns in batches:
            for b, single, several in zip(*columns):
                seen, again = once.setdefault(b, np.zeros(size, dtype=bool)), twice.setdefault(b, np.zeros(size, dtype=bool))
                single, several = np.frombuffer(single, dtype=np.uint32), np.frombuffer(several, dtype=np.uint32)
                again[single[seen[single]]] = True
                again[several] = True
                seen[single] = True
        if twice:
            yield [list(twice), [np.packbits(x, bitorder="little").tobytes() for x in twice.values()]]

    sent = map_rows(texts, 0, "block int, once binary, several binary", place)
    marked = map_rows(sent.repartitionById(blocks, F.col("block")), 0, "block int, bits binary", mark)
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in marked.collect():  # FILTER_BITS together
        out[r.block * size // 8 : (r.block + 1) * size // 8] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return out, shift


def _nodes(docs: DataFrame, keep: tuple[str, ...], text: str, rule: Rule) -> DataFrame:
    """A row for each document: `keep`, `row` (unique), `n` (size), `same` (digest of the set), `place`, and
    the `keys` that another set may have."""
    chosen = docs.select(*names(keep), F.xxhash64(col(text)).alias("place"), utf8(text).alias("text"))
    kept = len(keep) + 1
    bits, shift = _repeated_keys(chosen.select("text"), rule)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        words, row, own = Words(), TaskContext.get().partitionId() << 33, shared.value

        def listed(items: np.ndarray) -> np.ndarray:
            keys = rule.keys(items)
            at = (keys >> np.uint64(shift)).astype(np.int64)
            return keys[(own[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]

        for *rest, texts in batches:
            sets = [shingles(words.hashes(t.lower().split()), rule.size) for t in texts]
            rows = list(range(row, row + len(texts)))
            row += len(texts)
            same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield [*rest, rows, [len(s) for s in sets], same, _lists([listed(s) for s in sets])]

    return map_rows(chosen, kept, "row long, n long, same binary, keys array<long>", run)


def _sets(docs: DataFrame, wanted: DataFrame, text: str, rule: Rule) -> tuple[DataFrame, str]:
    """`node`, `n`, `items`, `sketch` of the wanted (`place`, `node`, `same`): their texts are found again by hash, and checked.

    Staged, and the folder."""
    texts = docs.select(F.xxhash64(col(text)).alias("place"), utf8(text).alias("text")).join(wanted, "place")

    def run(batches):
        words, before = Words(), None
        for nodes, same, texts in batches:
            # the rows of one text come together: its set is made once
            new = [i for i, node in enumerate(nodes) if node != (nodes[i - 1] if i else before)]
            before = nodes[-1] if nodes else before
            nodes, same, texts = ([x[i] for i in new] for x in (nodes, same, texts))
            sets = [shingles(words.hashes(t.lower().split()), rule.size) for t in texts]
            good = [i for i, s in enumerate(sets) if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == same[i]]
            yield [[nodes[i] for i in good], [len(sets[i]) for i in good], _lists([sets[i] for i in good]), [rule.sketch(sets[i]) for i in good]]

    sets = map_rows(texts.select("node", "same", "text"), 0, "node long, n long, items array<long>, sketch binary", run)
    staged, path = put(sets, "join-sets")
    # a text that very many documents share may have been dealt to several tasks
    if staged.groupBy("node").count().where("count > 1").isEmpty():
        return staged, path
    once = put(staged.dropDuplicates(["node"]), "join-sets")
    remove(docs.sparkSession, path)
    return once


def put(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Staged rows, and the folder that can be removed when nothing needs them any more."""
    path = scratch_dir(df.sparkSession, label)
    return stage(df, label, path), path


def _sketches(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.int8).reshape(len(column), BINS)


def _alike(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (`a`, `b`) that may link, by the counts of their elements in bins."""
    x, y = (sets.selectExpr(f"node AS {side}", f"n AS n_{side}", f"sketch AS s_{side}") for side in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches):
        for a, b, n_a, n_b, s_a, s_b in batches:
            good = rule.alike(_sketches(s_a), _sketches(s_b), np.array(n_a), np.array(n_b))
            yield [pa.array(np.array(v)[good]) for v in (a, b)]

    return map_rows(both, 0, "a long, b long", run)


def _in_lists(short: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (`a` < `b`) of different components that share a list and may link, from `key`, `node`, `n`, `component`, `sketch`.

    A task takes whole lists, some at a time, each of them `FEW` rows at most; pairs that several of those lists hold are
    given once.
    """

    def run(batches):
        kept: list[list] = [[] for _ in range(5)]
        for columns in batches:
            for k, c in zip(kept, columns):
                k += c
            if len(kept[0]) >= 8 * FEW:
                # the last list may go on
                end = int(np.searchsorted(np.array(kept[0]), kept[0][-1]))
                if end:
                    yield compared(*(k[:end] for k in kept))
                    kept = [k[end:] for k in kept]
        if kept[0]:
            yield compared(*kept)

    def compared(keys, nodes, n, component, sketch):
        keys, nodes, n, component, sketch = np.array(keys), np.array(nodes), np.array(n), np.array(component), _sketches(sketch)
        first, found, step = np.arange(len(keys)), [np.zeros((0, 2), np.int64)], 0
        while len(first):
            # each row with the row so many steps on in its list
            step += 1
            first = first[first + step < len(keys)]
            first = first[keys[first] == keys[first + step]]
            i = first[(component[first] != component[first + step]) & rule.fits(n[first], n[first + step])]
            i = i[rule.alike(sketch[i], sketch[i + step], n[i], n[i + step])]
            pair = np.stack([nodes[i], nodes[i + step]], axis=1)
            found.append(np.sort(pair, axis=1))
        found = np.unique(np.concatenate(found), axis=0)
        return [pa.array(found[:, 0]), pa.array(found[:, 1])]

    ordered = short.select("key", "node", "n", "component", "sketch").repartition("key").sortWithinPartitions("key")
    return map_rows(ordered, 0, "a long, b long", run)


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (`a`, `b`) that link: by their counts in bins first, then by their whole sets."""
    near, path = put(_alike(pairs, sets, rule), "join-near")
    left, right = sets.selectExpr("node AS a", "items AS x"), sets.selectExpr("node AS b", "items AS y")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    links = stage(near.join(left, "a").join(right, "b").where(100 * common >= rule.percent * union).select("a", "b"), "join-links")
    remove(pairs.sparkSession, path)
    return links


def _by_difference(rest: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (`a` < `b`) of different components, in lists with the same hub, that may link.

    Sets that hold most of a hub share most elements, but what they differ in from the hub they share only if
    they are alike. Two sets link if few elements are in one of their differences only; so if one of the sets
    does not link with the hub, the differences have a least number of elements in common, and meet in the
    first elements of both, the rarest ones of the hub's lists first. (Two that link with the hub are in one
    component already.)
    """
    q, p = 100 - rule.percent, rule.percent
    one = rest.select("hub", "node", "component").distinct()
    both = one.join(sets.selectExpr("node AS hub", "items AS h"), "hub").join(sets.selectExpr("node", "items AS x"), "node")
    new = both.select("hub", "node", "component", "h", "x", F.array_except("x", "h").alias("new"))
    sized = new.select(
        "hub", "node", "component", F.size("x").alias("n"), F.size("new").alias("i"), F.size("h").alias("n_h"), F.concat("new", F.array_except("h", "x")).alias("all")
    )
    linked = 100 * (F.col("n") - F.col("i")) >= p * (F.col("n_h") + F.col("i"))
    differing = stage(
        sized.select("hub", "node", "component", "n", "i", linked.alias("linked"), F.size("all").alias("d"), F.explode("all").alias("item")),
        "join-differences",
    )
    held = differing.groupBy("hub", "item").agg(F.count("*").alias("held"))
    ranked = differing.join(held, ["hub", "item"]).selectExpr(
        "*",
        "row_number() OVER (PARTITION BY hub, node ORDER BY held, item) AS place",  # of one set
        "count_if(held > 1) OVER (PARTITION BY hub, node) AS common",  # at most so many are in another difference, too
        # more than (d - q i) / 2 in common with a set that does not link with the hub
        f"d - (100 * d - {q} * i) div 200 AS first",
        # d less the largest difference in common with any set that links
        f"{q} * (100 * n div {p}) div 100 + 1 AS first_any",
    )
    ranked = stage(ranked.where("place <= greatest(first, first_any)"), "join-ranked")
    near, far = ranked.where("linked AND place <= first"), ranked.where("NOT linked")
    few = f"{100 + p} * (x.d + y.d - 2 * least(x.common, y.common)) <= {q} * (x.n + y.n)"
    fits = f"x.hub = y.hub AND x.item = y.item AND x.component != y.component AND {_fits('x.n', 'y.n', rule)} AND {few}"
    some = far.where("place <= first")
    one_far = far.where("place <= first_any").alias("x").join(near.alias("y"), F.expr(fits))
    both_far = some.alias("x").join(some.alias("y"), F.expr(f"{fits} AND x.node < y.node"))
    return one_far.union(both_far).selectExpr("least(x.node, y.node) AS a", "greatest(x.node, y.node) AS b")


def _fits(a: str, b: str, rule: Rule) -> str:
    return f"100 * least({a}, {b}) >= {rule.percent} * greatest({a}, {b})"


def similar_documents(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = (), rule: Rule = Rule()
) -> DataFrame:
    """`key` and `keep` columns, `n_shingles`, `component_id` (least key reachable by links, its own included).

    Sets are the distinct runs of `rule.size` words, ASCII letters in lower case; a shorter text is one run; a
    text without words, or null, has none and links with nothing. Equal sets link, also of rows that repeat. A
    null key is no least key unless a component has no other. Keys that repeat stand for separate documents.
    Columns that are not named play no part. No partner is left out: lists have no limit.
    """
    kept = [f"k{i}" for i in range(len(keep) + 1)]
    named = docs.select(*[col(c).alias(k) for c, k in zip((key, *keep), kept)], col(text).alias("text"))
    rows, _, by_class = _resolved(named, kept, rule)
    output = [*[F.col(k).alias(c) for c, k in zip((key, *keep), kept)], F.col("n").alias("n_shingles")]
    alone = rows.where("same IS NULL").select(*output, F.col("k0").alias("component_id"))
    together = rows.where("same IS NOT NULL").join(by_class, "same")
    return together.select(*output, F.col("best.k0").alias("component_id")).union(alone)


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", rule: Rule = Rule()) -> DataFrame:
    """All columns of one row of each component: that with the least key, the first of them if it repeats.

    Texts without words are linked with nothing, so they all stay, as do their repetitions.
    """
    own = docs.columns
    named = docs.select(col(key).alias("k0"), col(text).alias("text"))
    _, folder, by_class = _resolved(named, ["k0"], rule)
    remove(docs.sparkSession, folder)
    best = by_class.select(F.col("best.k0").alias("__key"), F.col("best.place").alias("__place")).distinct()
    wordless = F.coalesce(~col(text).rlike(f"[^{SPACE}]"), F.lit(True))
    marked = docs.withColumn("__text_hash", F.xxhash64(col(text)))
    on = col(key).eqNullSafe(F.col("__key")) & (F.col("__text_hash") == F.col("__place"))
    chosen = marked.where(~wordless).join(best, on).dropDuplicates([key, "__text_hash"])
    return chosen.select(*names(own)).union(docs.where(wordless))


def _resolved(named: DataFrame, kept: list[str], rule: Rule) -> tuple[DataFrame, str, DataFrame]:
    """Staged rows of all documents, their folder, and of each class of equal sets: `same`, `best` (the least row of its component)."""
    rows, folder = put(_nodes(named, tuple(kept), "text", rule), "join-rows")
    least = F.struct(F.col("k0").isNull().alias("none"), F.col("k0"), F.col("row"), F.col("place"))
    classes = stage(
        rows.where("same IS NOT NULL").groupBy("same").agg(F.min("row").alias("node"), F.min(least).alias("best")), "join-classes"
    )
    listed = rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi").selectExpr("row AS node", "n", "place", "same", "keys")
    entries = listed.selectExpr("explode(keys) AS key", "node", "n")
    several = entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    shared, sharing = put(entries.join(several, "key"), "join-shared")
    # the hub is the node that meets most others: the more nodes link with it, the fewer lists stay open
    weights = shared.groupBy("node").agg(F.sum("m").alias("weight"))
    best_of = F.max(F.struct("weight", (-F.col("node")).alias("node"), "n")).alias("best")
    hubs = shared.join(weights, "node").groupBy("key").agg(best_of).selectExpr("key", "best.n AS hub_n", "-best.node AS hub")
    members, lists = put(shared.drop("m").join(hubs, "key"), "join-lists")
    remove(named.sparkSession, sharing)

    met = members.select("node").distinct()
    wanted = listed.select("node", "place", "same").join(met, "node", "left_semi")
    sets, held = _sets(named, wanted, "text", rule)

    tried = stage(members.where(f"node != hub AND {_fits('n', 'hub_n', rule)}").selectExpr("least(hub, node) AS a", "greatest(hub, node) AS b").distinct(), "join-pairs")
    links = _linked(tried, sets, rule)

    # what the hubs did not connect: only lists that hold more than one component go on
    found = components(links)
    of_members = members.select("key", "hub", "node", "n").join(found, "node", "left")
    placed, places = put(of_members.withColumn("component", F.coalesce("component", "node")), "join-placed")
    remove(named.sparkSession, lists)
    of_list = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m"))
    rest, opened = put(placed.join(of_list.where("low != high").select("key", "m"), "key"), "join-open")
    remove(named.sparkSession, places)
    short = rest.where(F.col("m") <= FEW).select("key", "node", "n", "component").join(sets.select("node", "sketch"), "node")
    pairs = _in_lists(short, rule).union(_by_difference(rest.where(F.col("m") > FEW), sets, rule)).distinct().join(tried, ["a", "b"], "left_anti")
    more = _linked(stage(pairs, "join-pairs"), sets, rule)
    remove(named.sparkSession, held)
    remove(named.sparkSession, opened)

    final = stage(components(links.union(more)), "join-components")
    component = classes.join(final, "node", "left").select("same", "best", F.coalesce("component", "node").alias("component"))
    best = component.groupBy("component").agg(F.min("best").alias("best"))
    return rows, folder, stage(component.drop("best").join(best, "component").select("same", "best"), "join-result")
