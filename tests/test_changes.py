"""Changed rows by a hash tree, against multisets counted in Python."""

import random
from collections import Counter

import pytest

from strata.operators.changes import change_counts, differing_nodes, row_changes, _signed

SCHEMA = "k string, v double, note string"


def brute(old, new, key_at):
    came, went = Counter(new) - Counter(old), Counter(old) - Counter(new)
    keys = {}
    for rows, side in ((came, 0), (went, 1)):
        for row, n in rows.items():
            keys.setdefault(row[key_at], [0, 0])[side] += n
    return sorted(((k, a - min(a, r), r - min(a, r), min(a, r)) for k, (a, r) in keys.items()), key=repr)


def frames(spark, *tables):
    return [spark.createDataFrame(t, SCHEMA) for t in tables]


@pytest.mark.parametrize("levels", [(1,), (1, 1), (3, 3), (2, 1, 4)])
def test_random_versions_match_counting(spark, levels):
    rnd = random.Random(7)
    row = lambda: (rnd.choice(["a", "b", "", None]), rnd.choice([0.0, 1.5, None]), rnd.choice(["x", "y:1", None]))
    old = [row() for _ in range(300)]
    new = old[20:] + [row() for _ in range(35)]
    a, b = frames(spark, old, new)
    got = sorted((tuple(r) for r in row_changes(a, b, a.columns, ["k"], levels).collect()), key=repr)
    assert got == brute(old, new, 0)
    assert change_counts(a, b, a.columns, ["k"], levels) == {
        "added": sum(g[1] for g in got), "removed": sum(g[2] for g in got), "changed": sum(g[3] for g in got)}


def test_without_a_key_nothing_is_changed(spark):
    a, b = frames(spark, [("a", 1.0, None), ("b", 2.0, None)], [("a", 1.0, None), ("b", 3.0, None), ("c", 3.0, None)])
    assert change_counts(a, b, a.columns) == {"added": 2, "removed": 1, "changed": 0}
    assert change_counts(a, b, a.columns, ["k"]) == {"added": 1, "removed": 0, "changed": 1}


def test_equal_and_empty_versions(spark):
    a, empty = frames(spark, [("a", 1.0, "x")] * 3, [])
    zero = {"added": 0, "removed": 0, "changed": 0}
    assert change_counts(a, a.repartition(4), a.columns) == change_counts(empty, empty, a.columns, ["k"]) == zero
    assert row_changes(a, a, a.columns, ["k"]).count() == 0
    assert tuple(row_changes(empty, empty, a.columns).first()) == (0, 0, 0)
    assert change_counts(empty, a, a.columns, ["k"]) == {"added": 3, "removed": 0, "changed": 0}


def test_other_columns_and_clashing_names_do_not_count(spark):
    a = spark.createDataFrame([("a", 1, 5)], "side string, digest long, extra long")
    b = spark.createDataFrame([("a", 2, 9)], "side string, digest long, node long")
    assert [tuple(r) for r in row_changes(a, b, ["side", "digest"], ["side"]).collect()] == [("a", 0, 0, 1)]
    assert change_counts(a, b, ["side"]) == {"added": 0, "removed": 0, "changed": 0}


def test_only_differing_parts_are_descended(spark):
    old = [(str(i), float(i), None) for i in range(5000)]
    a, b = frames(spark, old, old[:-1] + [("4999", 0.5, None)])
    nodes, digits = differing_nodes(_signed(a, b, a.columns, ["k"]))
    assert digits == 6 and nodes.count() == 2  # the old and the new row, of 5,000
    plan = row_changes(a, b, a.columns, ["k"])._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


def test_levels_are_checked(spark):
    a, b = frames(spark, [], [])
    for levels in ((), (0, 3), (40, 20)):
        with pytest.raises(ValueError):
            row_changes(a, b, a.columns, ["k"], levels)
