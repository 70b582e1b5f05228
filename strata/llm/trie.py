"""Prefix trie of conversations, subtree totals by parallel tree contraction."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import Scratch, quoted, ranked

GROUP = 100  # conversations that share the start of their group's first one
MOST_SHARED = 5
DEPTHS = 1024  # turns of a conversation whose prefixes are added up in one window
IDS = 4096  # ids of an end that are joined as one text
WIDE = "decimal(38,0)"


def rebuilt_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, depth, turn, chars, last`` of every rebuilt conversation: a depth-0
    row, then its turns (``turn``: SHA-256 of role and text). The turns of a
    conversation c are put in order (by turn, null first, then role, then text);
    the first crc32(c) % 6 of conversation c - c % GROUP come first, then c's own
    turns after as many. Rows without a conv_id belong to no conversation.

    Turns are numbered in ranges of (conv, turn), so a conversation with a third
    of all turns lies in many tasks; it is joined by conversation and range."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("nr"), role.alias("role"), text.alias("text"),
        marked.alias("turn"), F.char_length(text).cast("long").alias("chars"),
    )
    order = [F.col("nr").asc_nulls_first(), F.col("role"), F.col("text")]
    placed, parts = ranked(rows, "conv", order, scratch, "turns")
    convs = parts.select("conv", "n").distinct()
    base = F.col("conv") - F.col("conv") % GROUP
    shared = (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("shared")
    asked = convs.select("conv", "n", base.alias("base"), shared)
    found = asked.join(convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
    # Of its base a conversation takes ``head`` turns; so many of its own go.
    head = F.least("shared", F.coalesce("n_base", F.lit(0)))
    convs = scratch.put(found.select("conv", "n", "base", "shared", head.alias("head")), "convs")

    length = (F.col("head") + F.greatest(F.col("n") - F.col("shared"), F.lit(0))).alias("length")
    spans = parts.select("conv", "part", "shift").join(convs.select("conv", "shared", "head", length), "conv")
    place = F.col("pos") + F.col("shift")  # from 0
    numbered = placed.select("conv", "part", "pos", "turn", "chars").join(spans, ["conv", "part"]).withColumn("place", place)
    own = numbered.where("place >= shared").select("conv", (F.col("head") + F.col("place") - F.col("shared") + 1).alias("depth"), "turn", "chars", "length")
    starts = numbered.where(F.col("place") < MOST_SHARED).select(F.col("conv").alias("base"), "place", "turn", "chars")
    lent = starts.join(convs.select("conv", "base", "head", length), "base").where("place < head")
    lent = lent.select("conv", (F.col("place") + 1).alias("depth"), "turn", "chars", "length")
    none = F.lit(None).cast("string").alias("turn")
    roots = convs.select("conv", F.lit(0).cast("long").alias("depth"), none, F.lit(0).cast("long").alias("chars"), length)
    every = own.union(lent).union(roots)
    out = scratch.put(every.select("conv", "depth", "turn", "chars", (F.col("depth") == F.col("length")).alias("last")), "rebuilt")
    scratch.drop(placed)
    return out


def prefixes(rebuilt: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, depth, chars, last``, and ``key`` and ``up``: names of the prefix up
    to this turn and of the one before, equal just for equal prefixes. A name is
    the depth and two sums over its turns of 64-bit hashes of (depth, turn); the
    sums are taken in blocks of DEPTHS turns, then over the blocks."""
    block = F.floor(F.col("depth") / DEPTHS).alias("block")
    value = [F.when(F.col("turn").isNull(), F.lit(0)).otherwise(F.xxhash64(*c)).cast(WIDE).alias(x) for x, c in (("a", ["depth", "turn"]), ("b", ["turn", "depth"]))]
    rows = rebuilt.select("*", block, *value)
    blocks = rows.groupBy("conv", "block").agg(F.sum("a").cast(WIDE).alias("a"), F.sum("b").cast(WIDE).alias("b"))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select("conv", "block", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).cast(WIDE).alias(f"{x}0") for x in "ab"])
    so_far = W.partitionBy("conv", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    sums = rows.select("*", *[F.sum(x).over(so_far).cast(WIDE).alias(f"{x}1") for x in "ab"]).join(before, ["conv", "block"])
    total = {x: (F.col(f"{x}0") + F.col(f"{x}1")).cast(WIDE) for x in "ab"}
    key = F.concat_ws(":", "depth", total["a"], total["b"])
    up = F.concat_ws(":", F.col("depth") - 1, (total["a"] - F.col("a")).cast(WIDE), (total["b"] - F.col("b")).cast(WIDE))
    return scratch.put(sums.select("conv", "depth", "chars", "last", key.alias("key"), F.when(F.col("depth") > 0, up).alias("up")), "prefixes")


def subtree_sums(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, depth, leaves, saved``: of each node of a tree the number of leaves in
    its subtree, and the sum of ``saved`` over it. ``nodes`` (conv, depth, up, saved): a node is
    named by conv and depth, its parent by up and depth - 1; the root's up is null.

    Rounds of contraction. Rake: every leaf is finished; its sums are added
    to its parent. Compress: of a chain of nodes with one child each, those of an
    independent set are spliced out; such a node's sums are its own and those
    of its child, which is handed over to its parent. Once the root is a leaf, the
    spliced nodes are expanded again, the last round first, from the sums of
    the child, which are known by then.

    A round is one partial aggregate by parent and two joins of one row a side, over
    nodes that are still there: a parent with any number of children, and a chain
    of any length, take rounds in the logarithm of the nodes."""
    # ``extra``: what nodes spliced out above a node add to what it gives its parent.
    now = scratch.put(nodes.select(
        "conv", "depth", F.col("up").alias("up"), (F.col("depth") - 1).alias("up_depth"),
        F.lit(0).cast("long").alias("leaves"), F.col("saved").alias("saved"),
        F.lit(0).cast("long").alias("extra_leaves"), F.lit(0).cast("long").alias("extra"),
    ), "tree")
    kids = now.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(F.count("*").alias("kids"))
    counted = now.join(kids, ["conv", "depth"], "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    first = counted.withColumn("leaves", (F.col("kids") == 0).cast("long"))
    now, finished, spliced, turn = scratch.put(first, "tree"), [], [], 0
    while True:
        finished.append(now.where("kids = 0").select("conv", "depth", "leaves", "saved"))
        if now.where("kids > 0").isEmpty():
            break
        # What each parent gets from its leaves, and its only other child, if it is one.
        leaf = F.col("kids") == 0
        other = {x: F.max(F.when(~leaf, F.col(x))).alias(f"only_{x}") for x in ("conv", "depth", "extra_leaves", "extra")}
        given = now.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(
            F.sum(F.when(leaf, F.col("leaves") + F.col("extra_leaves")).otherwise(0)).alias("got_leaves"),
            F.sum(F.when(leaf, F.col("saved") + F.col("extra")).otherwise(0)).alias("got"),
            F.count_if(~leaf).alias("left"),
            *other.values(),
        )
        inner = now.where("kids > 0").join(given, ["conv", "depth"]).select(
            "conv", "depth", "up", "up_depth", (F.col("leaves") + F.col("got_leaves")).alias("leaves"), (F.col("saved") + F.col("got")).alias("saved"),
            "extra_leaves", "extra", F.col("left").alias("kids"), *[f"only_{x}" for x in other],
        )
        goes = F.col("up").isNotNull() & (F.col("kids") == 1) & _coin("conv", "depth", turn) & ~_coin("only_conv", "only_depth", turn)
        inner = scratch.put(inner.withColumn("goes", goes), "raked")
        gone = inner.where("goes")
        spliced.append(gone.select(
            "conv", "depth", "only_conv", "only_depth",
            (F.col("leaves") + F.col("only_extra_leaves")).alias("add_leaves"), (F.col("saved") + F.col("only_extra")).alias("add"),
        ))
        handed = gone.select(
            F.col("only_conv").alias("conv"), F.col("only_depth").alias("depth"), F.col("up").alias("new_up"), F.col("up_depth").alias("new_up_depth"),
            (F.col("leaves") + F.col("extra_leaves")).alias("more_leaves"), (F.col("saved") + F.col("extra")).alias("more"),
        )
        stay = inner.where("not goes").join(handed, ["conv", "depth"], "left").select(
            "conv", "depth", F.coalesce("new_up", "up").alias("up"), F.coalesce("new_up_depth", "up_depth").alias("up_depth"), "leaves", "saved",
            (F.col("extra_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("extra_leaves"), (F.col("extra") + F.coalesce("more", F.lit(0))).alias("extra"), "kids",
        )
        now = scratch.put(stay, "tree")
        turn += 1
    # Expand: the child of a node spliced in a round was finished or spliced in a later one.
    known = finished[-1]
    for k in range(len(spliced) - 1, -1, -1):
        below = known.select(F.col("conv").alias("only_conv"), F.col("depth").alias("only_depth"), F.col("leaves"), F.col("saved"))
        back = spliced[k].join(below, ["only_conv", "only_depth"]).select(
            "conv", "depth", (F.col("add_leaves") + F.col("leaves")).alias("leaves"), (F.col("add") + F.col("saved")).alias("saved")
        )
        known = known.union(scratch.put(back, "expanded")).union(finished[k])
    return known


def _coin(conv: str, depth: str, turn: int) -> Column:
    """Heads or tails of a node in a round. In even rounds a bit of the depth, which
    takes every other node of an untouched chain; in odd ones a hash, which takes
    a quarter of any chain's nodes on average."""
    bit = F.shiftright(F.col(depth), turn // 2) if turn % 2 == 0 else F.xxhash64(conv, depth, F.lit(turn))
    return bit.bitwiseAND(F.lit(1).cast("long")) == 1


def end_digests(prefixed: DataFrame) -> DataFrame:
    """``key, ends``: of each prefix at which conversations end, the SHA-256 of
    their ids, ascending and comma-joined. Up to IDS neighbouring ids are joined
    in one group; the texts of a prefix follow each other in one task, which holds
    one batch of them at a time, as the digest of a sequence is a sequence itself."""
    block = F.floor(F.col("conv") / IDS).alias("block")
    texts = prefixed.where("last").groupBy("key", block).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    dealt = texts.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")

    def batches(it: Iterator[pa.RecordBatch]):
        at, digest = None, None
        for batch in it:
            keys, ends = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != at:
                    if at is not None:
                        keys.append(at)
                        ends.append(digest.hexdigest())
                    at, digest = key, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], names=["key", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends"])

    return dealt.mapInArrow(batches, "key string, ends string")


NO_ENDS = sha256(b"").hexdigest()


def prefix_trie(
    conversations: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations
    (``rebuilt_turns``): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (over the subtree: members but one, times code points of the
    node's text) and ``ends_sha256`` (digest of the ids of members that
    end here; of nothing, if none does).

    Null roles and texts count as empty; rows that repeat a turn are turns each; rows
    without a conv_id are left out. Conversations without turns left are members
    of the root. Other columns are ignored; an empty table gives no rows."""
    names = ((conv_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))
    turns = conversations.select(*[quoted(c).alias(n) for c, n in names])
    prefixed = prefixes(rebuilt_turns(turns, scratch), scratch)
    found = prefixed.groupBy("key").agg(
        F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), F.first("up").alias("up_key")
    )
    named = scratch.put(found, "named")
    parents = named.select(F.col("key").alias("up_key"), F.col("conv").alias("up"))
    children = named.where("up_key is not null").groupBy(F.col("up_key").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = named.join(parents, "up_key", "left").join(children, "key", "left").join(end_digests(prefixed), "key", "left")
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    nodes = scratch.put(nodes.select(
        "conv", "depth", "up", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), saved,
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
    ), "nodes")
    scratch.drop(named, prefixed)
    sums = subtree_sums(nodes.select("conv", "depth", "up", "saved"), scratch)
    return nodes.drop("saved").join(sums, ["conv", "depth"]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
