from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest
from helpers import with_extras

from skyledger.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_loops(rows):
    """The trie by dictionaries, from rows of distinct turns."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def built(spark, rows):
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


def some_rows(convs, seed, most=12, words=3):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "é" * rng.randint(0, words)))
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small(monkeypatch):
    for name, value in (("STRETCH", 2), ("CHUNK", 20), ("MOST_ROWS", 5)):
        monkeypatch.setattr(prefix_trie, name, value)


@pytest.mark.parametrize(("seed", "most", "words"), [(1, 12, 1), (2, 40, 0), (3, 5, 5)])
def test_equals_loops(spark, small, seed, most, words):
    rows = some_rows([*range(60), *range(100, 160), *range(205, 230), 1000, 7700], seed, most, words)
    assert built(spark, rows) == by_loops(rows)


def test_one_long_conversation_and_its_copies(spark, small):
    long = [("user" if i % 2 else "assistant", f"turn {i % 50}") for i in range(700)]
    rows = [(c, i, *x) for c in (0, 3, 8) for i, x in enumerate(long)]
    rows += [(4, i, *x) for i, x in enumerate(long[:650])] + [(205, i, *x) for i, x in enumerate(long[:33])]
    rows += [(c, 0, "user", "short") for c in range(20, 60)]
    assert built(spark, rows) == by_loops(rows)


def test_turnless_conversations_end_at_the_root(spark):
    shared = [c for c in range(200, 300) if zlib.crc32(str(c).encode()) % 6 >= 2]
    rows = [(c, t, "user", "x") for c in shared for t in range(2) if c != 200]
    want = by_loops(rows)
    assert built(spark, rows) == want
    assert want[[w[1] for w in want].index(0)][7] != prefix_trie.NO_ENDS
    assert len(want) == 1


def test_edges(spark, small):
    assert built(spark, []) == []
    rows = some_rows([*range(20), -5, -105, -100], 9)
    odd = [(None, 0, "user", "x"), (3, None, None, None), (4, None, "user", ""), (4, 50, "user", None)]
    assert built(spark, rows + odd) == by_loops(rows + odd)
    again = rows + [r for r in rows if r[0] == 7] * 2
    assert built(spark, again) == by_loops(again)
    frame = with_extras(spark.createDataFrame(rows, SCHEMA), "pos", "block", "a", "n", "depth")
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(frame).collect()), key=repr) == by_loops(rows)


def test_ties_are_ordered_by_role_then_by_a_hash(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (7, 0, "user", "q")]
    got = built(spark, rows)
    assert got == built(spark, rows[::-1])
    assert max(r[1] for r in got) <= 3


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (7, 0, "", "abc"), (9, 0, None, "abc")]
    rows = [(c + 1000, t, r, x) for c, _, r, x in rows for t in range(7)]
    assert built(spark, rows) == by_loops(rows)


def test_levels_past_the_end_are_left_out_before_the_shuffle(spark):
    rows = spark.createDataFrame(some_rows(range(30), 4), SCHEMA)
    blocks = prefix_trie.blocks_of(prefix_trie.rebuilt(prefix_trie.numbered(rows)))
    plan = prefix_trie.rolled_up(blocks, "count(*) as n")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Filter") < plan.index("Expand")


def test_parts_of_the_sorted_turns(spark):
    rows = [(c, t, "user", "") for c in range(3) for t in range(400 if c == 1 else 3)]
    got = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA)).groupBy("conv_id").agg({"pos": "max", "turn_id": "count"})
    assert {r[0]: (r["max(pos)"], r["count(turn_id)"]) for r in got.collect()} == {0: (3, 3), 1: (400, 400), 2: (3, 3)}
