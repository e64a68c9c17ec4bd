"""Conversation prefix trie, and what its subtrees hold, by an Euler tour.

A node is a distinct sequence of turns that conversations begin with. It is named by the exclusive or of hashes of its
turns, each with its position in it, so all prefixes of a conversation come from running totals, and a prefix's parent from
its own name. One sort puts each node before its children: neighbours in it give every node an enter and an exit arc and
link them into a tour of the whole trie. The tour is ranked by taking out arcs whose hash is greater than both neighbours'
until few are left, walking those, and putting the others back behind the arc before them. Positions make prefix sums, and what
a subtree holds is what the sums gain between its enter and exit arc.

Nothing is gathered by conversation, prefix or parent: a conversation of any length, a first turn that most conversations
share and a node with any number of children are spread by range. Only the list of conversations that end at one node is
hashed by one task, as a running digest, because SHA-256 goes through its bytes in order.
"""

from __future__ import annotations

import hashlib

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.rows import map_rows
from tidemark.llm.scans import PART, running_totals, sort_out
from tidemark.session import stage

#: The rest of a tour that one task walks.
WALKED = 10_000
#: A depth beyond all others: the row that ends the sort.
BEYOND = (1 << 31) - 1


def number_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """`conv`, `pos` (from 1, by turn, null first), `x1`, `x2` (hashes of role and text), `chars` of the text.

    Null roles and texts are empty. Equal turn numbers are ordered by a hash of role and text, so always alike. Rows
    without a conversation key belong to none and are left out.
    """
    said, words = F.coalesce(col(role).cast("string"), F.lit("")), F.coalesce(col(text), F.lit(""))
    rows = turns.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"),
        col(turn).isNotNull().alias("t0"),
        F.coalesce(col(turn).cast("long"), F.lit(0)).alias("t1"),
        F.xxhash64(said, words).alias("x1"),
        F.xxhash64(F.lit(1), words, said).alias("x2"),
        F.length(words).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("pos"),
    )
    return running_totals(rows, ["conv"], ["t0", "t1", "x1", "x2"], sums=["pos"]).select("conv", F.col("pos_upto").alias("pos"), "x1", "x2", "chars")


def graft(numbered: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of another one: (turns as of `number_turns`, all conversation keys).

    Conversation c takes the first h turns of conversation c - c % span in place of its own first h, where h is the
    CRC-32 of its decimal key modulo `most`; fewer, if there are fewer.
    """
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    convs = stage(numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")), "conversations").select(
        "conv", "turns", (F.col("conv") - F.col("conv") % span).alias("base"), taken.alias("h")
    )
    first = numbered.where(F.col("pos") < most)
    grafted = convs.select(F.col("conv").alias("c"), "base", "h").join(first, [F.col("base") == F.col("conv"), F.col("pos") <= F.col("h")])
    # where the base is shorter than asked, what follows moves up
    bases = convs.select(F.col("conv").alias("b"), F.col("turns").alias("there"))
    short = convs.join(bases, F.col("base") == F.col("b"), "left").withColumn("up", F.col("h") - F.coalesce("there", F.lit(0)))
    short = short.where("up > 0 AND turns > h").select(F.col("conv").alias("s"), "up")
    own = numbered.where(F.col("pos") > taken).join(short, F.col("conv") == F.col("s"), "left")
    own = own.withColumn("pos", F.col("pos") - F.coalesce("up", F.lit(0))).select("conv", "pos", "x1", "x2", "chars")
    return grafted.select(F.col("c").alias("conv"), "pos", "x1", "x2", "chars").union(own), convs.select("conv")


def _prefixes(turns: DataFrame) -> DataFrame:
    """`conv`, `depth`, `chars`, the prefix's name `f1`, `f2` and its parent's `p1`, `p2`."""
    placed = turns.withColumn("h1", F.xxhash64("x1", "x2", "pos")).withColumn("h2", F.xxhash64("pos", "x2", "x1", F.lit(1)))
    total = running_totals(placed.select("conv", "pos", "chars", "h1", "h2"), ["conv"], ["pos"], xors=["h1", "h2"])
    return total.select(
        "conv", F.col("pos").alias("depth"), "chars", F.col("h1_upto").alias("f1"), F.col("h2_upto").alias("f2"),
        F.col("h1_upto").bitwiseXOR(F.col("h1")).alias("p1"), F.col("h2_upto").bitwiseXOR(F.col("h2")).alias("p2"),
    )


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the keys of the conversations that end at a prefix, ascending, by running digests."""

    def run(batches):
        key, digest = None, None
        for columns in batches:
            out = []
            for *now, conv in zip(*columns):
                if now == key:
                    digest.update(f",{conv}".encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(str(conv).encode())
            yield [list(c) for c in zip(*out)]
        if key is not None:
            yield [[k] for k in (*key, digest.hexdigest())]

    own = ["depth", "f1", "f2"]
    lined = ends.select(*own, "conv").repartition(*own).sortWithinPartitions(*own, "conv")
    return map_rows(lined, 0, "depth long, f1 long, f2 long, ends_sha256 string", run)


def _families(nodes: DataFrame) -> DataFrame:
    """Each node's row followed by its children's, in one order; each row with the one before it and its parent's key.

    A row tells what comes after the one before it in the tour: `from_conv`, `from_arc` to `to_conv`, `to_arc` (an arc is
    twice the depth, and one more on leaving), `leaf` and `saved` of the first. Rows of children also give `child`, `depth`, `parent`.
    """
    as_parent = nodes.select("depth", "f1", "f2", F.lit(0).alias("kind"), "conv", "saved")
    as_child = nodes.where("depth > 0").select(F.col("depth") - 1, "p1", "p2", F.lit(1), "conv", "saved")
    end = nodes.sparkSession.range(1).select(F.lit(BEYOND).cast("long"), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0))
    lined = as_parent.union(as_child).union(end)
    order = ["depth", "f1", "f2", "kind", "conv"]

    def run(batches):
        part, before, parent, seq = TaskContext.get().partitionId(), None, None, 0
        for columns in batches:
            out = []
            for depth, f1, f2, kind, conv, saved in zip(*columns):
                if kind == 0:
                    upper, parent = parent, conv
                else:
                    upper = parent
                out.append((depth, f1, f2, kind, conv, saved, parent, upper, before, part, seq))
                before = {"depth": depth, "f1": f1, "f2": f2, "kind": kind, "conv": conv, "saved": saved}
                seq += 1
            yield [list(c) for c in zip(*out)]

    one = "struct<depth: long, f1: long, f2: long, kind: int, conv: long, saved: long>"
    local = stage(
        map_rows(sort_out(lined, order), 0, f"depth long, f1 long, f2 long, kind int, conv long, saved long, parent long, upper long, prev {one}, {PART} int, seq long", run),
        "families",
    )
    # the last row of each partition, for the first of the next: all that reaches the driver
    row = F.struct("depth", "f1", "f2", "kind", "conv", "saved")
    ends = local.groupBy(PART).agg(F.max_by(F.struct(row.alias("row"), "parent"), "seq").alias("last")).orderBy(PART).collect()
    rows, last, parent = [], None, None
    for r in ends:
        rows.append((r[PART], last, parent))
        last = tuple(r["last"]["row"])
        parent = parent if r["last"]["parent"] is None else r["last"]["parent"]
    carried = nodes.sparkSession.createDataFrame(rows, f"{PART} int, carried {one}, carried_parent long")
    both = local.join(F.broadcast(carried), PART).withColumns(
        {"prev": F.coalesce("prev", "carried"), "parent": F.coalesce("parent", "carried_parent"), "upper": F.coalesce("upper", "carried_parent")}
    )
    enter, leave = F.col("prev.depth") * 2, (F.col("prev.depth") + 1) * 2 + 1
    was_child, is_child = F.col("prev.kind") == 1, F.col("kind") == 1
    leaf = ~was_child & ~is_child
    return both.select(
        F.col("prev.conv").alias("from_conv"),
        F.when(was_child, leave).otherwise(enter).alias("from_arc"),
        F.when(is_child, F.col("conv")).when(leaf, F.col("prev.conv")).otherwise(F.col("upper")).alias("to_conv"),
        F.when(is_child, (F.col("depth") + 1) * 2).otherwise(enter + 1).alias("to_arc"),
        leaf.cast("long").alias("leaf"),
        F.when(was_child, F.lit(0)).otherwise(F.col("prev.saved")).alias("saved"),
        F.when(is_child, F.col("conv")).alias("child"),
        (F.col("depth") + 1).alias("depth"),
        F.when(is_child, F.col("parent")).alias("parent"),
    )


def rank_list(links: DataFrame, walked: int = WALKED) -> DataFrame:
    """Places (from 0) of the members `c`, `a` of one linked list, given as `c`, `a` -> `nc`, `na`; the last has no row.

    Each round takes out the members whose hash is greater than both neighbours', a third of all, which never are
    neighbours; the list that is left is a round's input to the next.
    """
    spark = links.sparkSession
    none = F.lit(None).cast("long")
    ahead = links.select("c", "a", "nc", "na", none.alias("pc"), none.alias("pa"))
    behind = links.select(F.col("nc").alias("c"), F.col("na").alias("a"), none, none, F.col("c"), F.col("a"))

    def joined(rows: DataFrame) -> DataFrame:
        return rows.groupBy("c", "a").agg(*[F.max(x).alias(x) for x in ("nc", "na", "pc", "pa")], F.sum("w").alias("w"))

    now = stage(joined(ahead.union(behind).withColumn("w", F.when(F.col("nc").isNotNull(), F.lit(1).cast("long")))), "tour")
    own = F.xxhash64("c", "a")
    goes = F.coalesce((own > F.xxhash64("nc", "na")) & F.col("nc").isNotNull() & (own > F.xxhash64("pc", "pa")) & F.col("pc").isNotNull(), F.lit(False))
    out: list[DataFrame] = []
    while now.count() > walked:
        gone = now.where(goes)
        rest = now.where(~goes)
        # the member before one that goes: what it goes on to, and how far that is
        to_prev = gone.select(F.col("pc").alias("c"), F.col("pa").alias("a"), "nc", "na", none.alias("pc"), none.alias("pa"), "w")
        to_next = gone.select(F.col("nc").alias("c"), F.col("na").alias("a"), none.alias("nc"), none.alias("na"), "pc", "pa", none.alias("w"))
        tagged = rest.withColumn("old", F.lit(True)).unionByName(to_prev.withColumn("old", F.lit(False))).unionByName(to_next.withColumn("old", F.lit(False)))
        new = lambda x: F.coalesce(F.max(F.when(~F.col("old"), F.col(x))), F.max(x)).alias(x)
        step = F.max(F.when(F.col("old"), F.col("w"))).alias("step")
        after = tagged.groupBy("c", "a").agg(new("nc"), new("na"), new("pc"), new("pa"), F.sum("w").alias("w"), step)
        staged = stage(after, "tour")
        # how far each that goes is behind the one before it
        out.append(gone.select("c", "a", "pc", "pa").join(staged.select(F.col("c").alias("pc"), F.col("a").alias("pa"), "step"), ["pc", "pa"]))
        now = staged.drop("step")

    def walk(batches):
        following, heads = {}, []
        for columns in batches:
            for c, a, nc, na, pc, w in zip(*columns):
                following[c, a] = (nc, na, w)
                if pc is None:
                    heads.append((c, a))
        for c, a in heads:
            rows, at = [], 0
            while c is not None:
                nc, na, w = following[c, a]
                rows.append((c, a, at))
                c, a, at = nc, na, at + (w or 0)
            yield [list(x) for x in zip(*rows)]

    ranks = map_rows(now.select("c", "a", "nc", "na", "pc", "w").coalesce(1), 0, "c long, a long, place long", walk, rows=walked)
    for gone in reversed(out):
        ranks = stage(ranks, "ranks")
        found = gone.join(ranks.select(F.col("c").alias("pc"), F.col("a").alias("pa"), "place"), ["pc", "pa"])
        ranks = ranks.union(found.select("c", "a", F.col("place") + F.col("step")))
    return stage(ranks, "ranks")


def prefix_trie(turns: DataFrame, convs: DataFrame, walked: int = WALKED) -> DataFrame:
    """Nodes of the trie of all conversations: `turns` as `number_turns` gives them, `convs` with every key in `conv`.

    Columns: `conv_id` (smallest member), `depth`, `parent_conv_id` (root: null), `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens` (over the subtree, each node's members but one times the characters of its last text), `ends_sha256` (of the
    keys of the members that end here). A conversation without turns is a member of the root alone. Repeated rows of a
    conversation are turns of it. Without conversations there are no nodes, not even a root.
    """
    prefixes = stage(_prefixes(turns), "prefixes")
    none = F.lit(0).cast("long")
    roots = convs.select("conv", none.alias("depth"), none.alias("chars"), none.alias("f1"), none.alias("f2"), none.alias("p1"), none.alias("p2"))
    members = prefixes.union(roots)
    nodes = members.groupBy("depth", "f1", "f2").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), *[F.min(x).alias(x) for x in ("p1", "p2", "chars")]
    )
    nodes = stage(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    last = members.groupBy("conv").agg(F.max(F.struct("depth", "f1", "f2")).alias("last")).select("last.*", "conv")

    tour = stage(_families(nodes).where("from_conv IS NOT NULL"), "tour")
    arcs = tour.select(F.col("from_conv").alias("c"), F.col("from_arc").alias("a"), F.col("to_conv").alias("nc"), F.col("to_arc").alias("na"), "leaf", "saved")
    ranks = rank_list(arcs.select("c", "a", "nc", "na"), walked)
    weighted = ranks.join(arcs.select("c", "a", "leaf", "saved"), ["c", "a"], "left").na.fill(0, ["leaf", "saved"])
    sums = running_totals(weighted, [], ["place"], sums=["leaf", "saved"])
    depth, leaving = F.floor(F.col("a") / 2).alias("depth"), F.col("a") % 2 == 1

    def held(value: str) -> Column:
        inside = F.max(F.when(leaving, F.col(f"{value}_upto"))) - F.max(F.when(~leaving, F.col(f"{value}_upto")))
        return inside + F.max(F.when(~leaving, F.col(value)))

    below = sums.groupBy(F.col("c").alias("conv"), depth).agg(held("leaf").alias("n_leaves"), held("saved").alias("saved_tokens"))
    children = tour.where("child IS NOT NULL")
    parents = children.select(F.col("child").alias("conv"), "depth", F.col("parent").alias("parent_conv_id"))
    n_children = children.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    empty = hashlib.sha256(b"").hexdigest()
    whole = (
        nodes.join(_digests(last), ["depth", "f1", "f2"], "left")
        .join(below, ["conv", "depth"])
        .join(parents, ["conv", "depth"], "left")
        .join(n_children, ["conv", "depth"], "left")
    )
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
