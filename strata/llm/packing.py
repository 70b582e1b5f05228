"""Sequence packing by patterns of few documents, fitted with non-negative
least squares (NNLS) to the histogram of lengths."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, bounded, quoted

MAX_TOKENS = 2048
END_OF_TEXT = 0  # the id that closes every document


class Tokenizer:
    """Byte-level BPE ids of whole texts.

    ``tokenizers`` with the vocabulary file is the definition; ``tiktoken`` with
    the same vocabulary as ranks gives the same ids about six times faster and
    is used where both certainly split alike: for texts of code points below
    U+0250 and of at most a million characters."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer as Whole

        self._whole = Whole.from_file(vocabulary)
        self._whole.encode_special_tokens = True
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= 1_000_000 and (text.isascii() or max(text) < "ɐ"):
            return np.array(self._fast.encode_ordinary(text), dtype="<u4")
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4")


def public_tokenizer() -> Tokenizer:
    import public_tokenizers as p

    return Tokenizer(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def cut(n: int, limit: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: whole up to
    ``limit``; else pieces of ``limit``, of which the first may be shorter."""
    first = (n - 1) % limit + 1
    return [(0, first), *((s, limit) for s in range(first, n, limit))]


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = MAX_TOKENS,
    make_tokenizer=public_tokenizer,
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every row's whole text (null: empty) and its end id:
    ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    schema = docs.select(quoted(id_col).alias("doc_id")).schema
    schema = schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    made: list = []  # the tokenizer, once in a task

    def pieces(batch: pa.RecordBatch):
        if not made:
            made.append(make_tokenizer())
        tokenizer = made[0]
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            doc = np.append(tokenizer.ids(text or ""), np.uint32(END_OF_TEXT)).astype("<u4")
            for k, (a, n) in enumerate(cut(len(doc), limit)):
                row.append(i)
                piece.append(k)
                start.append(a)
                length.append(n)
                crc.append(zlib.crc32(doc[a : a + n].tobytes()))
                if keep_ids:
                    ids.append(doc[a : a + n].astype(np.int32))
        columns = [
            batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
        ]
        if keep_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("t")).mapInArrow(bounded(pieces), schema)


def full_patterns(lengths: np.ndarray, limit: int) -> np.ndarray:
    """All patterns of up to three occurring lengths that fill ``limit``
    exactly: rows (a, b, c), a >= b >= c, 0 for no document."""
    has = np.zeros(limit + 1, bool)
    has[lengths] = True
    rows = [np.array([[limit, 0, 0]])] if has[limit] else []
    for a in lengths[(lengths < limit)][::-1]:
        rest = limit - a
        b = lengths[(lengths <= a) & (lengths < rest) & (2 * lengths >= rest)]
        b = b[has[rest - b]]
        rows.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
        if rest <= a and has[rest]:
            rows.append(np.array([[a, rest, 0]]))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def nnls_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2, A being the
    number of documents of each length in each pattern, by accelerated
    projected gradient steps. The work depends on the sequence length only,
    not on the number of documents."""
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0

    def times(x):  # A x
        out = sum(np.bincount(patterns[:, k], x, size) for k in range(3))
        out[0] = 0
        return out

    def back(r):  # A' r
        r = r.copy()
        r[0] = 0
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    v = np.ones(len(patterns))
    bound = 1.0
    for _ in range(30):
        v = back(times(v))
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        after = np.maximum(0, y - back(times(y) - target) / (1.02 * bound))
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


class Layout:
    """Where the documents of each length go. A slot says: the documents of
    ``length`` numbered from ``rank`` on go to the sequences numbered from
    ``sequence`` on, one each, at ``offset``. Slots are as many as there are
    patterns in use, whatever the number of documents."""

    def __init__(self, histogram: np.ndarray, limit: int):
        self.limit = limit
        self.left = histogram.astype(np.int64).copy()
        self.left[0] = 0
        self.used = np.zeros(limit + 1, np.int64)
        self.sequences = 0
        self.slots: list[tuple[int, int, int, int]] = []

    def _place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.slots.append((length, int(self.used[length]), sequence, offset))
        self.used[length] += count
        self.left[length] -= count

    def add_patterns(self, patterns: np.ndarray, x: np.ndarray) -> None:
        """Round the fitted counts, keeping running sums, and use each pattern
        as often as the documents that are left allow."""
        rounded = np.diff(np.floor(np.concatenate([[0], np.cumsum(x)]) + 0.5)).astype(np.int64)
        for i in np.nonzero(rounded)[0]:
            pattern = [int(v) for v in patterns[i] if v]
            times = int(min(rounded[i], *(self.left[v] // pattern.count(v) for v in pattern)))
            if times:
                at = 0
                for v in pattern:
                    self._place(v, times, self.sequences, at)
                    at += v
                self.sequences += times

    def add_rest(self) -> None:
        """Best fit, longest first, of what no pattern took: all documents of
        one length at a time into groups of sequences with equal room."""
        rooms: list[int] = []  # sorted, without repeats
        groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number)

        def put(room: int, first: int, number: int) -> None:
            if room and number:
                if room not in groups:
                    bisect.insort(rooms, room)
                    groups[room] = []
                groups[room].append((first, number))

        for length in range(self.limit, 0, -1):
            while (count := int(self.left[length])) > 0:
                i = bisect.bisect_left(rooms, length)
                if i < len(rooms):
                    room = rooms[i]
                    first, number = groups[room].pop()
                    if not groups[room]:
                        del groups[room]
                        rooms.pop(i)
                    n = min(count, number)
                    self._place(length, n, first, self.limit - room)
                    put(room - length, first, n)
                    put(room, first + n, number - n)
                else:  # new sequences: full of this length, and one with what remains
                    each = self.limit // length
                    number, fill = (count // each, each) if count >= each else (1, count)
                    first = self.sequences
                    self.sequences += number
                    for k in range(fill):
                        self._place(length, number, first, k * length)
                    put(self.limit - fill * length, first, number)

    def table(self) -> tuple[np.ndarray, ...]:
        """Slots by length and rank; the first array finds them by bisection."""
        s = np.array(sorted(self.slots), dtype=np.int64).reshape(-1, 4)
        return s[:, 0] << np.int64(48) | s[:, 1], s[:, 1], s[:, 2], s[:, 3]


def fit_layout(histogram: np.ndarray, limit: int = MAX_TOKENS) -> Layout:
    """The layout for ``histogram[length]`` documents of each length."""
    layout = Layout(histogram, limit)
    patterns = full_patterns(np.nonzero(layout.left)[0], limit)
    if len(patterns):
        layout.add_patterns(patterns, nnls_counts(patterns, layout.left))
    layout.add_rest()
    return layout


def pack(pieces: DataFrame, scratch: Scratch, limit: int = MAX_TOKENS, salts: int = 512) -> DataFrame:
    """``pieces`` (a table with ``length``, 1 to ``limit``, and any other
    columns) with ``sequence_id`` and ``offset``: every piece in one sequence,
    gapless from 0, at most ``limit`` tokens each. No pieces, no rows.

    Only the histogram (``limit`` numbers) reaches the driver; there the
    layout is fitted. The pieces of one length are then numbered: by salt
    within the length, so that a length with a third of all pieces is spread
    over ``salts`` windows, plus the sum of the salts before. The number finds
    the slot. The layout table has at most a few slots per pattern, of which
    there are fewer than limit^2/12 + limit, so what is broadcast is bounded
    by the sequence length."""
    spark = pieces.sparkSession
    landed = scratch.put(pieces, "pieces")
    salt = F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(salts)).alias("salt")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    rows = landed.select(F.struct(*[quoted(c).alias(c) for c in landed.columns]).alias("row"), quoted("length").alias("len"), salt, *place)
    counts = scratch.put(rows.groupBy("len", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("len").agg(F.sum("n").alias("n")).collect():
        histogram[r["len"]] = r["n"]
    shared = spark.sparkContext.broadcast(fit_layout(histogram, limit).table())

    before = W.partitionBy("len").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("len", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(W.partitionBy("len", "salt").orderBy("file", "at"))
    ranked = rows.withColumn("within", within).join(base, ["len", "salt"]).select(
        "row", "len", (F.col("base") + F.col("within") - 1).alias("rank")
    )
    schema = T.StructType(landed.schema.fields[:]).add("sequence_id", "long").add("offset", "long")

    def batches(it):
        keys, first, sequence, offset = shared.value
        for batch in it:
            length, rank = (np.asarray(batch.column(k)) for k in (1, 2))
            slot = np.searchsorted(keys, length.astype(np.int64) << np.int64(48) | rank, side="right") - 1
            row = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [*row.flatten(), pa.array(sequence[slot] + rank - first[slot]), pa.array(offset[slot])], names=schema.names
            )

    return ranked.mapInArrow(batches, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of each sequence, from packed pieces
    that kept their ids. A group is at most one sequence's tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(ordered.getField("ids")).alias("ids"))
