"""SimHash near-duplicates with covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, bounded, quoted
from strata.llm.components import connected_components

BITS = 64
# Buckets of up to so many fingerprints are compared inside one row of 32 KB at
# most; the fingerprints of larger buckets are linked by masked keys (see
# link_edges). Keys cost about 300 rows per fingerprint and table, a
# comparison about a nanosecond, so rows are the cheaper way up to here.
ROW_BUCKET = 4096


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of A-Z-lower-cased UTF-8 bytes: words are split at ASCII
    white space, each run of ``shingle`` words (all words, where there are
    fewer) is hashed with XXH64, seed 42; a bit is set if it is set in over
    half of the hashes. No words, or null: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")
    # One histogram per byte of the hashes, then the bits of each byte value.
    cells = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_AT
    counts = np.bincount(cells.ravel(), minlength=8 * 256).reshape(8, 256) @ _BYTE_BITS
    set_bits = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


_BYTE_AT = np.arange(8, dtype=np.int64) * 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: its id and ``fp``, the fingerprint as a
    signed long."""
    schema = docs.select(quoted(id_col).alias("doc_id")).schema.add("fp", "long")

    def prints(batch):
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("binary").alias("t")).mapInArrow(
        bounded(prints), schema
    )


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1)-1 masks of covering LSH: bit i has a nonzero vector of
    radius+1 bits, and mask v keeps the bits whose vector is odd against v.
    Up to ``radius`` differing bits span fewer than radius+1 dimensions, so
    some v is orthogonal to all of them: in that mask none of them is kept and
    the pair agrees. Vectors are dealt in turn, so each mask keeps about the
    same number of bits."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if (v & (i % n + 1)).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_edges(distinct: DataFrame, scratch: Scratch, radius: int = 2, row_bucket: int = ROW_BUCKET) -> DataFrame:
    """``distinct`` (fp, once each) -> edges (a, b) whose components are those
    of "at most ``radius`` (1 or 2) bits differ".

    Every fingerprint enters one bucket per mask. A bucket of one is dropped.
    A bucket of up to ``row_bucket`` fingerprints becomes one row, is linked
    there and yields one edge per member to the smallest it is linked with,
    directly or not. The fingerprints of a larger bucket are keyed again by
    themselves with two (for radius 1, one) of the bits cleared that the
    mask leaves out; each set of bits belongs to the first mask that leaves
    out all of it, so no set is keyed twice. Fingerprints that share such a
    key differ in those bits alone, hence are links, and each is tied to
    the smallest of its key: no pairs are formed, whatever the size.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)
    ])
    probes = distinct.select("fp", F.inline(tables).alias("t", "key"))
    counts = scratch.put(probes.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = scratch.put(probes.join(counts, ["t", "key"]).select("t", "key", "n", "fp"), "shared")

    rows = shared.where(F.col("n") <= row_bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    small = rows.select("fps").mapInArrow(lambda it: _bucket_stars(it, radius), "a long, b long")

    large = shared.where(F.col("n") > row_bucket)
    keyed = large.select("fp", F.explode(_cleared(masks, radius)).alias("bits")).select(
        "fp", "bits", F.col("fp").bitwiseAND(F.bitwise_not("bits")).alias("key")
    )
    hubs = scratch.put(keyed.groupBy("bits", "key").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top"), "hubs")
    tied = keyed.join(hubs, ["bits", "key"]).where("fp > b").select(F.col("fp").alias("a"), "b")
    edges = scratch.put(small.union(tied).distinct(), "links")
    scratch.drop(counts, shared, hubs)
    return edges


def _bucket_stars(it, radius: int):
    for batch in it:
        a, b = [], []
        for fps in batch.column(0):
            x = np.sort(np.asarray(fps.values))
            bits, open_ = x.view(np.uint64), np.ones(len(x), bool)
            for first in range(len(x)):
                reached = [first] if open_[first] else []
                open_[first] = False
                for i in reached:  # grows while it is walked
                    near = np.nonzero(open_ & (np.bitwise_count(bits ^ bits[i]) <= radius))[0]
                    open_[near] = False
                    reached.extend(near.tolist())
                a.extend(x[reached[1:]].tolist())
                b.extend([int(x[first])] * (len(reached) - 1))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _cleared(masks: list[int], radius: int):
    """By mask number t: the bit sets that mask t handles for large buckets."""
    own: dict[int, list[int]] = {t: [] for t in range(len(masks))}
    sets = [1 << i for i in range(BITS)] if radius == 1 else [
        (1 << i) | (1 << j) for i in range(BITS) for j in range(i)
    ]
    for s in sets:
        own[next(t for t, m in enumerate(masks) if not m & s)].append(s)
    case = None
    for t, bit_sets in own.items():
        values = F.array(*[F.lit(_signed(s)) for s in bit_sets]).cast("array<bigint>")
        case = F.when(F.col("t") == t, values) if case is None else case.when(F.col("t") == t, values)
    return case


def simhash_components(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``docs``: component_id is the
    smallest id reachable over links of at most ``radius`` differing bits.

    Null and wordless texts have fingerprint 0 and link like any other;
    repeated rows and ids keep their rows; an empty table gives no rows; other
    columns of any name are ignored. Documents are reduced to distinct
    fingerprints before linking, so a group of copies is one node.
    """
    fps = scratch.put(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = scratch.put(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    edges = link_edges(classes.select("fp"), scratch, radius)
    labels = connected_components(edges, scratch)
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    named = scratch.put(named, "labels")
    least = scratch.put(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    by_fp = scratch.put(named.join(least, "component").select("fp", "component_id"), "by_fp")
    scratch.drop(classes, edges, named, least)
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
