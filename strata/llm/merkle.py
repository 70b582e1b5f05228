"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs
by descent from the root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, as_row, quoted, ranked

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "struct<before: string, after: string>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


@dataclass
class Manifest:
    """``leaves`` (row, leaf, tree, rank): every document's digest and place;
    ``trees`` (tree, lang, n, subroot); ``records`` by height, each (digest,
    children): of the documents' trees, and ``upper`` of the tree over the
    subroots; ``root``, null for an empty table. Trees are numbered in the order
    of their languages."""

    leaves: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    upper: list[DataFrame]
    root: str | None


def build(
    docs: DataFrame,
    scratch: Scratch,
    columns: tuple[str, ...] = COLUMNS,
    by: str = "lang",
    order: str = "doc_id",
    carry: list[Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``. Each row is a leaf, the digest of ``columns``;
    the leaves of one ``by`` value ascend by ``order`` (null first, rows of
    one id by their digests; equal rows are leaves each). While a tree has several
    nodes, every ``FANOUT`` consecutive ones become their digest; what remains is
    the subroot. The subroots, ordered by ``by`` (null first, bytewise), give
    the root likewise. ``row`` has the columns of ``docs``, or ``carry``.

    Leaves are dealt by ranges of (by, order), so a language with a third of
    all rows, or with all of them, lies in many tasks; a level is one aggregate
    of groups of at most ``FANOUT`` rows."""
    row = F.struct(*carry).alias("row") if carry else as_row(docs)
    leaf = leaf_digest([quoted(c) for c in columns])
    found = docs.select(row, quoted(by).cast("string").alias("lang"), quoted(order).alias("id"), leaf.alias("leaf"))
    placed, parts = ranked(found, "lang", [F.col("id").asc_nulls_first(), F.col("leaf")], scratch, "leaves")

    langs = parts.select(F.lit(0).alias("all"), "lang", "n").distinct()
    langs, lang_parts = ranked(langs, "all", [F.col("lang").asc_nulls_first()], scratch, "langs")
    langs = langs.join(lang_parts.select("part", "shift", F.col("n").alias("trees")), "part")
    langs = scratch.put(langs.select((F.col("pos") + F.col("shift")).alias("tree"), "lang", "n", "trees"), "trees")

    numbered = parts.alias("p").join(langs.alias("t"), F.expr("p.lang <=> t.lang")).select("p.lang", "part", "shift", "p.n", "tree")
    joined = placed.alias("l").join(numbered.alias("p"), F.expr("l.part = p.part and l.lang <=> p.lang"))
    rank = (F.col("pos") + F.col("shift")).alias("rank")
    leaves = scratch.put(joined.select("row", "leaf", "tree", rank, "n"), "placed")
    scratch.drop(placed)

    records, tops = _levels(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "n"), scratch, "record")
    trees = scratch.put(langs.join(tops, "tree").select("tree", "lang", "n", F.col("digest").alias("subroot")), "subroots")
    upper, top = _levels(trees.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), F.col("subroot").alias("digest"), F.lit(langs.count()).cast("long").alias("n")), scratch, "upper")
    root = top.first()
    return Manifest(leaves, trees, records, upper, root["digest"] if root else None)


def _levels(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of every height from 1 on, and the top (tree, digest) of each
    tree, from its lowest nodes (tree, rank, digest, n nodes)."""
    records, tops = [], nodes.where("n = 1").select("tree", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = nodes.where("n > 1").groupBy("tree", F.floor(F.col("rank") / FANOUT).alias("rank"), F.ceil(F.col("n") / FANOUT).alias("n"))
        children = runs.agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), "digest")))["digest"].alias("children"))
        nodes = scratch.put(children.select("tree", "rank", _digest(F.col("children")).alias("digest"), "n", "children"), name)
        records.append(nodes.select("digest", "children"))
        tops = tops.union(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // FANOUT)
    return records, tops


def height_of(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    out, reach = F.lit(0), 1
    for _ in range(21):  # 8^21 leaves are as many as a bigint can count
        out = out + (n > reach).cast("int")
        reach *= FANOUT
    return out


def proofs(manifest: Manifest, requests: DataFrame, scratch: Scratch) -> DataFrame:
    """``ask``, ``subroot`` and ``path`` for each row of ``requests`` (tree, rank,
    ask): the segments of siblings from the leaf up to the root, each the digests
    before and after the node on the way.

    Requests descend from the root: the digits of a rank say which child of the
    record of the digest reached comes next, and its siblings make the next
    segment of the path. Requests below one node descend together, and only
    children that some request wants are followed. In the last step each request
    is joined with its leaf's parent; then the segments are reversed. A leaf may be
    asked for any number of times; a rank without a leaf has no row."""
    if manifest.root is None:
        return requests.select("ask", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(f"array<{SEGMENT}>").alias("path")).limit(0)
    wanted = [scratch.put(requests.select("tree", F.floor(F.col("rank") / FANOUT).alias("rank")).distinct(), "wanted")]
    for _ in manifest.records[1:]:
        wanted.append(scratch.put(wanted[-1].select("tree", F.floor(F.col("rank") / FANOUT).alias("rank")).distinct(), "wanted"))

    # Over the tree of the subroots, down to every subroot.
    start = requests.sparkSession.createDataFrame([(0, 0, manifest.root)], "tree long, rank long, digest string")
    at = start.withColumn("path", F.array().cast(f"array<{SEGMENT}>"))
    for records in reversed(manifest.upper):
        at = scratch.put(_descended(at, records), "descent")
    sizes = manifest.trees.select(F.col("tree").alias("rank"), "n")
    starts = at.join(sizes, "rank").select(
        F.col("rank").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "path", F.col("digest").alias("subroot"), height_of(F.col("n")).alias("height")
    )
    starts = scratch.put(starts, "starts")

    # Down the trees of the documents; a tree joins in at its height.
    at = starts.limit(0).drop("height")
    for k in range(len(manifest.records), 0, -1):
        at = at.union(starts.where(F.col("height") == k).drop("height"))
        if k > 1:
            below = _descended(at, manifest.records[k - 1])
            at = scratch.put(below.join(wanted[k - 2], ["tree", "rank"], "left_semi"), "descent")
    asked = requests.select("tree", F.floor(F.col("rank") / FANOUT).alias("parent"), (F.col("rank") % FANOUT).cast("int").alias("digit"), "ask")
    last = []
    if manifest.records:
        parents = at.join(manifest.records[0], "digest").select("tree", F.col("rank").alias("parent"), "children", "path", "subroot")
        segment = _segment(F.col("children"), F.col("digit"))
        below = asked.join(parents, ["tree", "parent"]).where("digit < size(children)")
        last.append(below.select("ask", "subroot", F.concat("path", F.array(segment)).alias("path")))
    alone = starts.where("height = 0").select("tree", "subroot", "path")
    last.append(asked.where("parent = 0 and digit = 0").join(alone, "tree").select("ask", "subroot", "path"))
    out = last[0] if len(last) == 1 else last[0].union(last[1])
    return out.select("ask", "subroot", F.reverse("path").alias("path"))


def _segment(children: Column, digit: Column) -> Column:
    """The children before and after the selected one, as text."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def _descended(at: DataFrame, records: DataFrame) -> DataFrame:
    """One step down: the children of each node (tree, rank, digest, path, ...), by its record."""
    own = [c for c in at.columns if c not in ("tree", "rank", "digest", "path")]
    nodes = at.join(records, "digest").select("tree", "rank", "path", "children", *own, F.posexplode("children").alias("digit", "child"))
    path = F.concat("path", F.array(_segment(F.col("children"), F.col("digit"))))
    return nodes.select("tree", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), F.col("child").alias("digest"), path.alias("path"), *own)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def verify(manifest: Manifest, shown: DataFrame, scratch: Scratch) -> DataFrame:
    """``shown`` (tree, rank, ask, leaf): leaves as someone shows them. Their ``ask``,
    ``subroot``, ``proof_sha256``, ``folded_root`` and whether that is the root (``verified``)."""
    paths = proofs(manifest, shown.select("tree", "rank", F.struct("ask", "leaf").alias("ask")), scratch)
    out = paths.select("ask.ask", "subroot", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("ask.leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.lit(manifest.root))
