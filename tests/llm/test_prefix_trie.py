"""The trie against one built in plain Python."""

import hashlib
import random
import zlib

from tests.llm.cases import SF, given
from tidemark.llm import prefix_trie as pt
from tidemark.llm.queries import QUERIES
from tidemark.llm.scans import running_totals


def rebuilt(rows, span=100, most=6):
    """rows: (conv, turn, role, text); equal turns must be equal rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        base = abs(c) // span * span * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    rows = []

    def below(path):
        saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        leaves = 0 if path in children else 1
        for child in children.get(path, []):
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        rows.append((min(members[path]), len(path), parent, len(members[path]), len(children.get(path, [])), leaves, saved, digest))
        return leaves, saved

    if members:
        below(())
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, x1 string, depth long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)


def conversations(seed=5):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), 100, 105, 199, 207, 208, -3, -100, -107]:
        for t in range(rng.choice([1, 2, 3, 9])):
            text = rng.choice(["hi", "hi", "", None, "日本語 \U0001f600"]) if t < 2 else f"t{rng.randrange(3)}"
            rows.append((c, t if t != 1 else None, rng.choice(["user", None]) if t else "user", text))
    rows += [(7, t, "user", "long") for t in range(300)] + [(8, t, "user", "long") for t in range(300)]
    rows += [(None, 1, "user", "belongs to none"), (105, 50, "a", "twice"), (105, 50, "a", "twice")]
    return rows


def test_edge_cases(spark):
    rows = [r for r in dict.fromkeys(conversations())] + [(105, 50, "a", "twice")]
    # turns of one number in one conversation must be equal for the plain version to know their order
    seen = {}
    rows = [r for r in rows if seen.setdefault(r[:2], r) == r]
    turns = pt.number_turns(frame(spark, rows).repartition(7))
    expected = brute(rebuilt(rows))
    assert any(not turns for turns in rebuilt(rows).values()), "a conversation without turns is among them"
    assert found(pt.prefix_trie(*pt.graft(turns))) == expected
    assert found(pt.prefix_trie(*pt.graft(turns), walked=20)) == expected, "the same with rounds of taking arcs out"
    assert pt.prefix_trie(*pt.graft(pt.number_turns(frame(spark, [])))).count() == 0
    assert found(pt.prefix_trie(*pt.graft(pt.number_turns(frame(spark, [(4, 1, None, None)]))))) == brute(rebuilt([(4, 1, None, None)]))


def test_equal_turn_numbers_are_ordered_alike(spark):
    rows = [(c, 1, "user", f"same number {i}") for c in (200, 300) for i in range(6)]
    both = [{(r.pos, r.x1) for r in pt.number_turns(frame(spark, rows).repartition(n)).where(f"conv = {c}").collect()} for n, c in ((1, 200), (5, 300))]
    assert both[0] == both[1]


def test_running_totals_of_groups_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3, 9]), i, rng.randrange(100), rng.getrandbits(63)) for i in range(3000)]
    expected, totals = {}, {}
    for g, i, v, x in sorted(rows):
        s, y = totals.get(g, (0, 0))
        totals[g] = (s + v, y ^ x)
        expected[i] = totals[g]
    df = spark.createDataFrame(rows, "g long, i long, v long, x long").repartition(6)
    got = running_totals(df, ["g"], ["i"], sums=["v"], xors=["x"])
    assert {r.i: (r.v_upto, r.x_upto) for r in got.collect()} == expected
    whole = {r.i: r.v_upto for r in running_totals(df, [], ["i"], sums=["v"]).collect()}
    assert whole[2999] == sum(r[2] for r in rows) and whole[0] == rows[0][2]


def test_query(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given("conversations")]
    assert found(QUERIES["op13_prefix_trie"](spark, SF)) == brute(rebuilt(rows))
