"""Repeated word sequences by De Bruijn compaction over sampled k-mers."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import Scratch, bounded, quoted, released

WINDOW, K = 20, 6
SEGMENT = 4_000_000  # bytes of a text that are split into words at a time
BLOCK = 1 << 18  # windows of a text that are handled at a time
DIGESTS = 20_000  # digests of spans and windows that are sent at a time

_U = np.uint64
_STEP, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, base, _U)]))


def segments(text: bytes) -> Iterator[bytes]:
    """A text in stretches of about SEGMENT bytes, cut where a word ends."""
    a = 0
    while a < len(text):
        b = min(len(text), a + SEGMENT)
        while b < len(text) and text[b] not in b" \t\n\r\x0b\x0c":
            b += 1
        yield text[a:b]
        a = b


def word_hashes(text: bytes) -> np.ndarray:
    """XXH3 of each word; bytes.split() splits at just the ASCII white space."""
    parts = [np.array(list(map(xxhash.xxh3_64_intdigest, s.split())), dtype=_U) for s in segments(text)]
    return np.concatenate(parts) if parts else np.zeros(0, _U)


def anchors(words: np.ndarray, ends: np.ndarray, window: int = WINDOW, k: int = K):
    """Sampled k-mers of a batch of documents, whose words stand one after the
    other in ``words`` and end at ``ends``. The sample of a window is its k-mer
    of least hash, the leftmost of equals: equal windows have equal samples at
    equal places. Consecutive windows of a document with one sample make an
    anchor. Returns per anchor: first window (index into ``words``), number of
    windows, hash of the k-mer, hash of all words that the windows cover (with
    the place of the k-mer among them)."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, _U),) * 2
    kmers = np.zeros(len(words) - k + 1, _U)
    for j in range(k):
        kmers = kmers * _U(_STEP) + words[j : j + len(kmers)]
    kmers = _mix(kmers)
    width = window - k + 1
    # Leftmost minimum of each run of `width`, by doubling.
    at, span = np.arange(len(kmers)), 1
    while span < width:
        shift = min(span, width - span)
        left, right = at[: len(at) - shift], at[shift:]
        at = np.where(kmers[left] <= kmers[right], left, right)
        span += shift
    starts = np.concatenate([[0], ends[:-1]])
    doc = np.repeat(np.arange(len(ends)), ends - starts)
    first = np.arange(n)
    inside = doc[first] == doc[first + window - 1]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1] | (doc[1:n] != doc[: n - 1])
    lead = np.nonzero(new & inside)[0]
    # A run ends at the next lead or at the next window that leaves its document.
    breaks = np.append(np.nonzero(new | ~inside)[0], n)
    count = breaks[np.searchsorted(breaks, lead, side="right")] - lead
    up, down = _powers(_STEP, len(words)), _powers(_BACK, len(words))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mix(words) * up[:-1])])
    covered = (sums[lead + count + window - 1] - sums[lead]) * down[lead]
    place = (at[lead] - lead).astype(_U) * _U(window) + count.astype(_U)
    return lead, count, kmers[at[lead]], _mix(covered + _mix(place + _U(1)))


def tag_of(text: bytes) -> int:
    """XXH64 as ``F.xxhash64`` has it."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >> 63 else h


def _document_anchors(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, tag, anchors``: tag is the XXH64 of the text, so
    that rows which share an id, or have none, but not their text stay apart."""
    fields = [("start", pa.int32()), ("windows", pa.int32()), ("kmer", pa.int64()), ("chunk", pa.int64())]

    def batches(batch):
        rows, tags = [], []
        pending: list[np.ndarray] = []
        results: list[tuple[np.ndarray, ...]] = []

        def flush():
            sizes = np.array([len(w) for w in pending])
            ends = np.cumsum(sizes)
            lead, *rest = anchors(np.concatenate(pending), ends)
            cut = np.searchsorted(lead, ends)
            for i, (a, b) in enumerate(zip(np.concatenate([[0], cut[:-1]]), cut, strict=True)):
                results.append((lead[a:b] - (ends[i] - sizes[i]), *(r[a:b] for r in rest)))
            pending.clear()

        for i, text in enumerate(batch.column(1).to_pylist()):
            words = word_hashes(text)
            if len(words) < WINDOW:
                continue
            rows.append(i)
            tags.append(tag_of(text))
            if len(words) <= BLOCK:
                pending.append(words)
                if sum(map(len, pending)) > BLOCK:
                    flush()
                continue
            if pending:
                flush()
            parts = []
            for a in range(0, len(words) - WINDOW + 1, BLOCK):
                part = words[a : a + BLOCK + WINDOW - 1]
                lead, *rest = anchors(part, np.array([len(part)]))
                parts.append((lead + a, *rest))
            results.append(tuple(np.concatenate(x) for x in zip(*parts, strict=True)))
        if pending:
            flush()
        offsets = np.concatenate([[0], np.cumsum([len(r[0]) for r in results])]).astype(np.int32)
        columns = [np.concatenate([r[c] for r in results]) if results else np.zeros(0) for c in range(4)]
        values = [pa.array(columns[c].astype(np.int32)) for c in (0, 1)] + [pa.array(columns[c].astype(_U).view(np.int64)) for c in (2, 3)]
        found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, names=[f[0] for f in fields]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(tags, pa.int64()), found], names=["doc_id", "tag", "anchors"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, tag long, anchors array<struct<start: int, windows: int, kmer: long, chunk: long>>"
    return docs.mapInArrow(bounded(batches), schema)


def removed_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, tag, start, length`` (in words): stretches of ``docs`` (doc_id,
    text as bytes) of which every window of WINDOW words starts earlier too.

    Edges of the graph are the anchors of sampled k-mers: an occurrence has a
    class, k-mer and covered words (two independent 64-bit hashes). K-mers that
    occur once are dropped, as no window can repeat without its k-mer. Edge A
    leads to edge B without branching if A and B occur equally often and B
    always follows A; such runs are paths, and a path's occurrences are long
    repeated spans. Where a k-mer has several classes the graph branches: the
    windows of each class's first occurrence are compared one by one. Both the
    spans and these windows are verified at their source coordinates: digests
    of the words themselves decide which of them are equal.
    """
    by_doc = scratch.put(_document_anchors(docs), "anchors")
    every = by_doc.select("doc_id", "tag", F.posexplode("anchors").alias("nr", "a")).select("doc_id", "tag", "nr", "a.*")
    twice = scratch.put(every.groupBy("kmer").agg(F.count("*").alias("n")).where("n > 1").select("kmer"), "twice")
    seen = scratch.put(every.join(twice, "kmer"), "repeated")
    scratch.drop(by_doc, twice)

    here = F.struct("doc_id", "tag", "start", "nr", "windows")
    classes = scratch.put(seen.groupBy("kmer", "chunk").agg(F.count("*").alias("n"), F.min(here).alias("first")), "classes")
    order = W.partitionBy("doc_id", "tag").orderBy("start")
    follows = seen.select(
        "kmer", "chunk", "nr", *[F.lead(c).over(order).alias(f"{c}_b") for c in ("kmer", "chunk", "nr")]
    ).where("nr_b = nr + 1")
    pairs = scratch.put(follows.groupBy("kmer", "chunk", "kmer_b", "chunk_b").agg(F.count("*").alias("together")), "pairs")
    size = classes.select("kmer", "chunk", "n")
    links = (
        pairs.join(size, ["kmer", "chunk"]).where("n = together")
        .select(F.col("kmer_b").alias("kmer"), F.col("chunk_b").alias("chunk"), "together")
        .join(size, ["kmer", "chunk"]).where("n = together").select("kmer", "chunk", F.lit(True).alias("linked"))
    )
    linked = scratch.put(links, "links")
    firsts = classes.where("n > 1").select("kmer", "chunk", "first.*").join(linked, ["kmer", "chunk"], "left")
    # The classes of a path first occur one after the other in one document.
    ahead = W.partitionBy("doc_id", "tag").orderBy("start")
    numbered = firsts.select("*", F.count(F.when(F.col("linked").isNull(), 1)).over(ahead).alias("path"))
    paths = scratch.put(
        numbered.groupBy("doc_id", "tag", "path")
        .agg(F.min_by(F.struct("kmer", "chunk"), "start").alias("head"), F.sum("windows").alias("path_windows"))
        .select("head.kmer", "head.chunk", "path_windows"),
        "paths",
    )
    length = (F.col("path_windows") + WINDOW - 1).cast("int").alias("length")
    spans = seen.join(paths, ["kmer", "chunk"]).select("doc_id", "tag", "start", length, F.lit(False).alias("singly"), "kmer", "chunk")

    branching = scratch.put(classes.groupBy("kmer").agg(F.count("*").alias("classes")).where("classes > 1").select("kmer"), "branching")
    singles = classes.join(branching, "kmer").select(
        "first.doc_id", "first.tag", "first.start", (F.col("first.windows") + WINDOW - 1).alias("length"),
        F.lit(True).alias("singly"), F.lit(0).cast("long").alias("kmer"), F.lit(0).cast("long").alias("chunk"),
    )
    removed = None
    asked = scratch.put(spans.union(singles), "asked")
    while True:
        checked = scratch.put(_digests(docs, asked), "checked")
        key = ["kmer", "chunk", "length", "digest"]
        first = scratch.put(checked.groupBy(*key).agg(F.min(F.struct("doc_id", "tag", "start")).alias("first"), F.count("*").alias("n")), "first")
        again = checked.join(first.where("n > 1"), key).where(F.struct("doc_id", "tag", "start") != F.col("first"))
        again = scratch.put(again.select("doc_id", "tag", "start", "length"), "again")
        removed = again if removed is None else removed.union(again)
        # Spans whose words differ although both hashes agree: window by window.
        differ = first.where("not (kmer = 0 and chunk = 0)").groupBy("kmer", "chunk", "length").agg(F.count("*").alias("n"))
        differ = scratch.put(differ.where("n > 1").drop("n"), "differ")
        scratch.drop(asked, first)
        if differ.isEmpty():
            scratch.drop(seen, classes, pairs, linked, paths, branching, checked, differ)
            return removed
        zero = F.lit(0).cast("long")
        asked = scratch.put(
            checked.join(differ, ["kmer", "chunk", "length"]).select(
                "doc_id", "tag", "start", "length", F.lit(True).alias("singly"), zero.alias("kmer"), zero.alias("chunk")
            ).union(singles),
            "asked",
        )


def _digests(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """128-bit digests of the words of each asked span, or, where asked
    ``singly``, of each window in it, read from the documents themselves. Rows
    that repeat an id and its text ask for the same spans: these are listed once."""
    per_doc = asked.groupBy("doc_id", "tag").agg(
        F.collect_set(F.struct("start", "length", "singly", "kmer", "chunk")).alias("asked")
    ).withColumnsRenamed({"doc_id": "asked_id", "tag": "asked_tag"})
    tagged = docs.withColumn("tag", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("tag") == F.col("asked_tag"))
    joined = tagged.join(per_doc, same).select("doc_id", "text", "tag", "asked")
    names = ["doc_id", "tag", "start", "length", "kmer", "chunk", "digest"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def digests(batch):
        columns = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        for i, (text, tag, spans) in enumerate(columns):
            words = text.split()
            for s in spans:
                size = WINDOW if s["singly"] else s["length"]
                for a in range(s["start"], s["start"] + s["length"] - size + 1):
                    digest = hashlib.blake2b(b" ".join(words[a : a + size]), digest_size=16).digest()
                    yield i, tag, a, size, s["kmer"], s["chunk"], digest

    def batches(batch):
        found = digests(batch)
        while out := list(itertools.islice(found, DIGESTS)):
            row, *rest = (pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), *rest], names=names)

    return joined.mapInArrow(bounded(batches), f"doc_id {kind}, tag long, start int, length int, kmer long, chunk long, digest binary")


def remove_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names),
    ``n_words``, ``n_removed`` and ``kept``: the words that are left, joined by
    one space (bytes).

    A word is a run of bytes other than ASCII white space, unchanged. A word
    goes if a window of WINDOW words that covers it starts earlier too, in a
    smaller id or at an earlier place of the same document; windows are judged
    on the input. A null text has no words. A null id sorts first. Rows that
    repeat an id and its text are one document and get one result each; rows
    with one id, or none, and different texts are told apart, the order being that
    of the texts' XXH64. An empty table gives no rows.
    """
    texts = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col).cast("binary"), F.lit(b"")).alias("text"))
    spans = removed_spans(texts, scratch)
    per_doc = scratch.put(
        spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "length")).alias("spans")), "spans"
    ).withColumnsRenamed({"doc_id": "removed_id", "tag": "removed_tag"})
    text = quoted(text_col).cast("binary")
    rows = docs.select(
        F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(text, F.lit(b""))).alias("tag"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("removed_id")) & (F.col("tag") == F.col("removed_tag"))
    # The text travels once, inside its row; tasks take it from there.
    joined = rows.join(per_doc, same, "left").select("row", "spans")
    place = docs.columns.index(text_col)
    schema = rows.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept", "binary")

    def batches(it):
        for batch in it:
            n_words, n_removed, kept = [], [], []
            texts = batch.column(0).field(place).cast(pa.binary())
            for text, spans in zip(texts.to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if spans:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["start"] for s in spans], 1)
                    np.add.at(change, [s["start"] + s["length"] for s in spans], -1)
                    words = [words[i] for i in np.nonzero(np.cumsum(change[:-1]) == 0)[0].tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], names=schema.names
            )

    return joined.mapInArrow(released(batches), schema)
