import random
import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from strata.llm import trie
from strata.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        n = zlib.crc32(str(c).encode()) % 6
        turns = (*own.get(c - c % 100, [])[:n], *own[c][n:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), len(children[p]), leaves[p], saved[p], sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


def found(spark, rows, change=lambda d: d):
    got = trie.prefix_trie(change(spark.createDataFrame(rows, SCHEMA)), Scratch(spark, "t")).select(*COLUMNS).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def test_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(260), rng.randrange(4), rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "", None])) for _ in range(1500)]
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(100, None, None, None)] * 3 + [(100, 1, "a", "x"), (100, 1, "a", "y"), (100, 1, "", ""), (103, 2, None, "long" * 50_000)]
    rows += [(None, 1, "a", "x"), (7, None, "", None), (299, 0, "z", "\0"), (200, 1, "1", ":a"), (201, 1, "", "1:a"), (2**62, 1, "q", "q")]
    clash = lambda d: d.select("*", F.lit(1).alias("depth"), F.lit(2).alias("key"), F.lit(3).alias("conv"))
    assert found(spark, rows, clash) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    # Conversations without a base whose turns are all among the first h: only the root.
    rows = [(c, 1, "u", "t") for c in range(901, 960) if zlib.crc32(str(c).encode()) % 6 > 0]
    assert found(spark, rows) == brute(rows)
    assert len(brute(rows)) == 1


def test_many_equal_conversations_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 16)
    monkeypatch.setattr(trie, "DEPTHS", 3)
    rows = [(c, k, "u", f"t{k}") for c in range(120) for k in range(10)]
    rows += [(500, k, "u", f"t{k}") for k in range(100)]  # one long conversation
    assert found(spark, rows) == brute(rows)


def tree_of(kind, n):
    """Node names 0.. with parents; 0 is the root."""
    if kind == "chain":
        return [None, *range(n - 1)]
    if kind == "star":
        return [None] + [0] * (n - 1)
    if kind == "caterpillar":  # even nodes make the spine, odd ones hang from it
        return [None] + [i - 1 if i % 2 else i - 2 for i in range(1, n)]
    rng = random.Random(n)
    return [None] + [rng.randrange(max(0, i - 4), i) for i in range(1, n)]


def test_subtree_sums(spark):
    """Several trees at once, the roots of which have no parent."""
    rows, want = [], []
    for kind, n in [("chain", 500), ("star", 200), ("caterpillar", 201), ("random", 300), ("chain", 1), ("chain", 2)]:
        up, at = tree_of(kind, n), len(rows)
        depth, leaves, saved = [0] * n, [0] * n, [i * 3 % 11 for i in range(n)]
        for i in range(1, n):
            depth[i] = depth[up[i]] + 1
        rows += [(at + i, depth[i], None if up[i] is None else at + up[i], saved[i]) for i in range(n)]
        for i in range(n - 1, -1, -1):
            leaves[i] += i not in set(up)
            if up[i] is not None:
                leaves[up[i]] += leaves[i]
                saved[up[i]] += saved[i]
        want += [(at + i, depth[i], leaves[i], saved[i]) for i in range(n)]
    nodes = spark.createDataFrame(rows, "conv long, depth long, up long, saved long")
    got = trie.subtree_sums(nodes, Scratch(spark, "s")).collect()
    assert sorted((r["conv"], r["depth"], r["leaves"], r["saved"]) for r in got) == sorted(want)
