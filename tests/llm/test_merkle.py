import hashlib

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.common import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def rise(level):
    """All levels from these digests up to the top."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
        levels.append(level)
    return levels


def siblings(levels, rank):
    out = []
    for level in levels[:-1]:
        run = level[rank // 8 * 8 : rank // 8 * 8 + 8]
        out.append((run[: rank % 8], run[rank % 8 + 1 :]))
        rank //= 8
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, path) of every row."""
    key = lambda v: (v is not None, (v or "").encode())
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {k: sorted(trees[k]) for k in sorted(trees, key=key)}
    levels = {k: rise([x[2] for x in v]) for k, v in trees.items()}
    upper = rise([v[-1][0] for v in levels.values()])
    out = []
    for nr, (k, v) in enumerate(trees.items()):
        for rank, (known, doc, leaf) in enumerate(v):
            path = siblings(levels[k], rank) + siblings(upper, nr)
            out.append((doc if known else None, leaf, levels[k][-1][0], upper[-1][0], h(*("".join(a + b) for a, b in path))))
    return sorted(out, key=str)


def found(spark, rows, scratch, extra=None):
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        docs = extra(docs)
    m = merkle.build(docs, scratch)
    got = merkle.verify(m, m.leaves.select("tree", "rank", F.struct("row.doc_id", "leaf").alias("ask"), "leaf"), scratch).collect()
    assert all(r["verified"] and r["folded_root"] == m.root for r in got)
    return sorted([(r["ask"]["doc_id"], r["ask"]["leaf"], r["subroot"], m.root, r["proof_sha256"]) for r in got], key=str)


def rows_of(n, langs):
    return [(i * 7 % n, f"s{i % 3}", langs[i * i % len(langs)], i, f"tëxt {i} \t") for i in range(n)]


@pytest.mark.parametrize("n", [1, 9, 600])
def test_brute_force(spark, n):
    rows = rows_of(n, ["en", "en", "en", "fr", "de"])
    assert found(spark, rows, Scratch(spark, "m")) == brute(rows)


def test_many_languages_nulls_ties_and_repeats(spark):
    rows = rows_of(90, [f"l{i}" for i in range(13)] + [None, "", "é", "Z", "zz"])
    rows += [(None, None, None, None, None)] * 2 + [(5, "s", "en", None, ""), (5, "s", "en", None, "other"), (6, "", "en", 3, None)] * 3
    clash = lambda d: d.select("*", F.lit(1).alias("leaf"), F.lit(2).alias("rank"), F.lit(3).alias("a.b"), F.lit(4).alias("_salt"))
    assert found(spark, rows, Scratch(spark, "m"), clash) == brute(rows)


def test_one_language_and_long_text(spark):
    rows = [(i, None, None, 1, "x" * 3_000_000 if i == 3 else "") for i in range(20)]
    assert found(spark, rows, Scratch(spark, "m")) == brute(rows)


def test_empty_table(spark):
    scratch = Scratch(spark, "m")
    m = merkle.build(spark.createDataFrame([], SCHEMA), scratch)
    assert m.root is None
    shown = m.leaves.select("tree", "rank", F.lit(1).alias("ask"), "leaf")
    assert merkle.verify(m, shown, scratch).collect() == []


def test_some_requests_tampered_repeated_and_absent(spark):
    rows = rows_of(200, ["en", "fr"])
    scratch = Scratch(spark, "m")
    m = merkle.build(spark.createDataFrame(rows, SCHEMA), scratch)
    want = [r for r in m.leaves.collect() if r["rank"] in (3, 99)]
    shown = [(r["tree"], r["rank"], k, r["leaf"]) for r in want for k in ("good", "again")]
    shown += [(want[0]["tree"], want[0]["rank"], "bad", "0" * 64), (0, 10**6, "absent", "0" * 64), (9, 0, "absent", "0" * 64)]
    got = merkle.verify(m, spark.createDataFrame(shown, "tree long, rank long, ask string, leaf string"), scratch).collect()
    assert sorted((r["ask"], r["verified"]) for r in got) == sorted([("good", True)] * len(want) + [("again", True)] * len(want) + [("bad", False)])


def test_records_lead_from_the_root_to_every_leaf(spark):
    rows = rows_of(150, ["en", "fr", None])
    m = merkle.build(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "m"))
    children = {r["digest"]: r["children"] for t in m.records + m.upper for r in t.collect()}
    assert all(h(*c) == d for d, c in children.items())
    reached, at = set(), [m.root]
    while at:
        reached |= set(at)
        at = [c for d in at for c in children.get(d, [])]
    assert {leaf_of(r) for r in rows} <= reached
