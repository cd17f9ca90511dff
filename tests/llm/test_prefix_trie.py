"""The prefix trie against brute force over whole paths, with small blocks, shards and cuts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderlens.llm import prefix_trie as pt


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    ordered = {}
    for c, turns in convs.items():
        def code(t):
            return hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()[:16]
        ordered[c] = [(t[2], t[3]) for t in sorted(turns, key=lambda t: (t[0], t[1], t[2], code(t)))]
    members = defaultdict(list)
    for c in sorted(ordered):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(ordered.get(c - c % 100, [])[:h] + ordered[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append((c, len(seq) == d))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[x] for x in children[p])
        ends = ",".join(str(c) for c, end in members[p] if end)
        parent = members[p[:-1]][0][0] if p else None
        out.append((members[p][0][0], len(p), parent, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, convs=260, alphabet=4, longest=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randrange(0, 900), 100 * rng.randrange(0, 9), rng.randrange(0, 40)])
        for t in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None, ""]) if rng.random() < 0.2 else "user", rng.choice([None, "", "añb🙂"] + ["x" * k for k in range(1, alphabet)])))
    rows += [(7, 0, "user", "same")] * 3 + [(None, 0, "user", "nobody's"), (None, None, None, None)] + [(150_001, 0, "u", "alone")]
    rows += [(c, t, "system", "hot") for c in range(2000, 2400) for t in range(3)]
    rows += [(100_000, t, "user", f"t{t}") for t in range(300)] + [(100_300 + k, t, "user", f"t{t}") for k in range(2) for t in range(200 + 7 * k)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("longest,block", [(4096, 1 << 17), (4096, 1), (4096, 40), (20, 25), (3, 9)])
def test_matches_brute_force(spark, longest, block):
    rows = made(longest + block)
    got = pt.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), longest, block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.fixture
def many_partitions(spark):
    """As many shards as shuffle partitions, however few rows they have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("longest,block", [(4096, 1 << 17), (20, 25)])
def test_shards_that_share_paths(spark, many_partitions, longest, block):
    rows = made(99)
    got = pt.trie(spark.createDataFrame(rows, SCHEMA), longest, block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_one_partition_and_clashing_columns(spark):
    rows = made(1, convs=60)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, pos int").coalesce(1)
    assert sorted((tuple(r) for r in pt.trie(df).collect()), key=str) == brute(rows)


def test_turnless_and_empty(spark):
    # 1102 takes nothing from an absent first conversation and loses its only turn
    c = next(i for i in range(1101, 1200) if zlib.crc32(str(i).encode()) % 6 > 1)
    rows = [(c, 0, "user", "gone")]
    assert [tuple(r) for r in pt.trie(spark.createDataFrame(rows, SCHEMA)).collect()] == brute(rows)
    assert brute(rows)[0][1:6] == (0, None, 1, 0, 1)
    assert pt.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert pt.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_tree_is_balanced_and_ordered():
    sequences = [[i] for i in range(1000)]
    tree = pt.TernaryTree()
    ends = tree.insert_sorted(sequences)

    def depth(node):
        return 0 if node < 0 else 1 + max(depth(tree.low[node]), depth(tree.high[node]))

    assert depth(tree.equal[0]) == 10
    order, parent = tree.preorder()
    assert [tree.symbol[x] for x in order[1:]] == list(range(1000)) and all(parent[e] == 0 for e in ends)
    assert tree.insert([500]) == ends[500]
