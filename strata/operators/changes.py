"""Which rows changed between two versions of a table.

Both versions are cut into the nodes of a hash tree by the digits of each row's
SHA-256. A node holds how many rows lie under it and the sum of their digests,
new minus old, so equal nodes come out as zero. Level by level only the rows
under nodes that differ are looked at again; at the end the rows under the last
such nodes are compared one by one. Nodes are partial aggregates: what is
shuffled for equal parts of a table is a row per node and task, and only rows
under differing nodes are shuffled themselves.

Versions are multisets: a row that the new version holds twice more often has
been added twice. Of a key's rows, as many as went and came are taken as
changed, the rest as added or removed. Null keys are one key. Two parts that
differ are taken as equal with a chance of 2^-60 (the digest's bits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.digest import hex_to_decimal, row_hash
from strata.operators.joins import checked_broadcast

# Digits of the hash that each level of the tree adds: 4,096 nodes under the
# root, 4,096 under each of them.
LEVELS = (3, 3)
# The node's digits begin after those that ``hex_to_decimal`` sums.
FIRST_DIGIT = 16


def _signed(old: DataFrame, new: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """(side, digest, key) for the rows of both versions; side is 1 for new, -1 for old."""
    def one(df: DataFrame, side: int) -> DataFrame:
        k = F.struct(*[F.col(c) for c in key]) if key else F.lit(None).cast("string")
        return df.select(F.lit(side).cast("long").alias("side"), row_hash([F.col(c) for c in columns]).alias("digest"), k.alias("key"))

    return one(new, 1).unionAll(one(old, -1))


def _node(digits: int) -> Column:
    return F.substring("digest", FIRST_DIGIT, digits)


def differing_nodes(rows: DataFrame, levels: tuple[int, ...] = LEVELS) -> tuple[DataFrame, int]:
    """(nodes of the last level that differ, their number of digits) of ``_signed`` rows."""
    if not levels or min(levels) < 1 or FIRST_DIGIT + sum(levels) > 65:
        raise ValueError(f"levels must add 1 to {65 - FIRST_DIGIT} digits, each at least one: {levels}")
    under, digits = None, 0
    for more in levels:
        here = rows if under is None else _rows_under(rows, under, digits)
        digits += more
        value = hex_to_decimal(F.col("digest"))
        nodes = here.groupBy(_node(digits).alias("node")).agg(
            F.sum("side").alias("n"), F.sum(F.when(F.col("side") > 0, value).otherwise(-value)).alias("d"))
        under = checked_broadcast(nodes.where("n <> 0 OR d <> 0").select("node"))
    return under, digits


def _rows_under(rows: DataFrame, nodes: DataFrame, digits: int) -> DataFrame:
    return rows.withColumn("node", _node(digits)).join(nodes, "node", "left_semi").drop("node")


def row_changes(old: DataFrame, new: DataFrame, columns: list[str], key: list[str] | None = None,
                levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(key..., n_added, n_removed, n_changed) for every key with a difference in
    ``columns``; without ``key`` one row of totals, in which nothing is 'changed'.
    Columns of other names are not looked at. Equal versions, empty ones
    included, give no row (without ``key``: zeros)."""
    key = list(key or [])
    rows = _signed(old, new, columns, key)
    nodes, digits = differing_nodes(rows, levels)
    net = _rows_under(rows, nodes, digits).groupBy("digest", "key").agg(F.sum("side").alias("net")).where("net <> 0")
    came, went = F.sum(F.greatest("net", F.lit(0))), F.sum(F.greatest(-F.col("net"), F.lit(0)))
    per_key = (net.groupBy("key") if key else net.groupBy()).agg(came.alias("came"), went.alias("went"))
    changed = F.least("came", "went") if key else F.lit(0).cast("long")
    n = {"n_added": F.col("came") - changed, "n_removed": F.col("went") - changed, "n_changed": changed}
    names = [F.col("key")[c].alias(c) for c in key]
    return per_key.select(*names, *[F.coalesce(c, F.lit(0).cast("long")).alias(name) for name, c in n.items()])


def change_counts(old: DataFrame, new: DataFrame, columns: list[str], key: list[str] | None = None,
                  levels: tuple[int, ...] = LEVELS) -> dict[str, int]:
    """Totals over all keys: ``{"added": ..., "removed": ..., "changed": ...}``."""
    names = ["added", "removed", "changed"]
    totals = row_changes(old, new, columns, key, levels).agg(*[F.sum(f"n_{c}").alias(c) for c in names]).first()
    return {c: int(totals[c] or 0) for c in names}
