"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one
in-process database per Spark partition."""

from __future__ import annotations

import base64
import functools
import heapq
import re
import tempfile
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import quoted

# Words and bytes of words that one recursive query takes, tokens that are
# decoded at a time: with DuckDB's own limit, what bounds the memory.
QUERY_WORDS, QUERY_BYTES, QUERY_TOKENS = 60_000, 1_000_000, 500_000
DATABASE = {"threads": 1, "memory_limit": "200MB"}
# Encoded words, and stretches of text, that a worker remembers; when full, the
# memory keeps those just met. Characters of text that it works on at a time.
CACHE_WORDS = 300_000
SLICE_CHARS = 2_000_000
# The rows of the recursion grow with the square of a word's length. Longer
# words (none in ordinary text) are merged by a heap in the same order.
LONG_WORD = 256

_TABLES = """
    CREATE TABLE vocabulary AS SELECT id, token FROM ranks;
    -- Every way in which two tokens make a third.
    CREATE TABLE merges AS
        WITH cut AS (
            SELECT id, from_hex(left(hex(token), 2 * k)) AS l, from_hex(substr(hex(token), 2 * k + 1)) AS r
            FROM vocabulary, generate_series(1, octet_length(token) - 1) AS s(k)
        )
        SELECT a.id << 32 | b.id AS pair, cut.id AS merged
        FROM cut JOIN vocabulary a ON a.token = cut.l JOIN vocabulary b ON b.token = cut.r;
"""

# ``bytes`` has one row per byte of every word: its place, which is the word's
# number times 2^24 plus the position in the word, and its token. Each step
# finds the pairs of neighbours that the merge table has, takes the word's
# leftmost pair of least rank (a rank is the merged token's id) and contracts
# it: the right one's row goes, the left one's token changes. A word without
# such a pair is finished: it has no rows in the next step, and its rows of the
# last step stand.
_ENCODE = """
    WITH RECURSIVE
    state AS (
        SELECT place, token, 0 AS step FROM bytes
        UNION ALL
        SELECT s.place, CASE WHEN s.place & 16777215 = best.pick >> 16 & 16777215 THEN best.pick >> 40 ELSE s.token END, s.step + 1
        FROM state s JOIN (
            SELECT n.place >> 24 AS word, min((m.merged << 40) + ((n.place & 16777215) << 16) + (n.next_place - n.place)) AS pick
            FROM (
                SELECT place, token, lead(token) OVER near AS next_token, lead(place) OVER near AS next_place
                FROM state WINDOW near AS (ORDER BY place)
            ) n JOIN merges m ON m.pair = (n.token << 32 | n.next_token)
            WHERE n.place >> 24 = n.next_place >> 24
            GROUP BY 1
        ) best ON best.word = s.place >> 24 AND s.place & 16777215 <> (best.pick >> 16 & 16777215) + (best.pick & 65535)
    ),
    last AS (SELECT place >> 24 AS word, max(step) AS step FROM state GROUP BY 1)
    SELECT place, token FROM state JOIN last ON last.word = place >> 24 AND last.step = state.step ORDER BY place
"""

_DECODE = "SELECT id, token FROM wanted JOIN vocabulary USING (id)"


_OTHER_BLANKS = re.compile(r" \s|\s ")


def _stretches(text: str) -> list[str]:
    """The text cut before blanks, in order. Before a single blank between two
    characters that are no white space the pattern always begins a new match,
    so the parts can be split into words, and remembered, on their own. A text
    with any other blank is one part."""
    if _OTHER_BLANKS.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + s for s in rest]]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_CHARS characters."""
    a = size = 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size > SLICE_CHARS or b == len(texts):
            yield a, b
            a, size = b, 0


class DuckBpe:
    """Encoder and decoder over one DuckDB database in memory."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.split = regex.compile(pattern).findall
        self.db = duckdb.connect(config={**DATABASE, "temp_directory": tempfile.gettempdir()})
        self.db.register("ranks", pa.table({"id": pa.array(self.ranks.values(), pa.int64()), "token": pa.array(self.ranks, pa.binary())}))
        self.db.execute(_TABLES)
        self.db.unregister("ranks")
        self.known: dict[str, bytes] = {}  # ids of words (matches of the pattern)
        self.stretches: dict[str, bytes] = {}  # ids of stretches between blanks
        self.bodies: dict[int, bytes] = {}  # bytes of ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        cut = [_stretches(t) for t in texts]
        met = set().union(*cut)
        if len(self.stretches) > CACHE_WORDS:
            self.stretches = {s: self.stretches[s] for s in met if s in self.stretches}
        new = self._words(met.difference(self.stretches))
        words = {w for ws in new.values() for w in ws}
        if len(self.known) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in words if w in self.known}
        self._learn(words.difference(self.known))
        for s, ws in new.items():
            self.stretches[s] = self.known[ws[0]] if len(ws) == 1 else b"".join([self.known[w] for w in ws])
        return [b"".join(map(self.stretches.__getitem__, ss)) for ss in cut]

    def _words(self, stretches: set[str]) -> dict[str, list[str]]:
        """The words of each stretch. Those that begin with their only blank,
        between characters that are no white space, are split in one go: where
        one follows another, a new match begins, and no other has a blank."""
        plain, out = [], {}
        for s in stretches:
            if s.rfind(" ") == 0 and len(s) > 1 and not s[1].isspace() and not s[-1].isspace():
                plain.append(s)
            else:
                out[s] = self.split(s)
        found: list[list[str]] = []
        for w in self.split("".join(plain)):
            if w[0] == " ":
                found.append([w])
            else:
                found[-1].append(w)
        out.update(zip(plain, found, strict=True))
        return out

    def _learn(self, words: set[str]) -> None:
        block: list[tuple[str, bytes]] = []
        size = 0
        for word in words:
            body = word.encode()
            if body in self.ranks:
                self.known[word] = self.ranks[body].to_bytes(4, "little")
                continue
            if len(body) > LONG_WORD:
                self.known[word] = np.array(self._merge_long(body), "<u4").tobytes()
                continue
            block.append((word, body))
            size += len(body)
            if len(block) == QUERY_WORDS or size > QUERY_BYTES:
                self._encode_block(block)
                block, size = [], 0
        self._encode_block(block)

    def _encode_block(self, block: list[tuple[str, bytes]]) -> None:
        if not block:
            return
        sizes = np.array([len(body) for _, body in block])
        word = np.repeat(np.arange(len(block)), sizes)
        position = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        token = self.of_byte[np.frombuffer(b"".join(body for _, body in block), np.uint8)]
        self.db.register("bytes", pa.table({"place": word << 24 | position, "token": token}))
        found = self.db.sql(_ENCODE).to_arrow_table()
        ids = np.asarray(found["token"]).astype("<u4").tobytes()
        ends = np.searchsorted(np.asarray(found["place"]) >> 24, np.arange(len(block) + 1)) * 4
        for k, (text, _) in enumerate(block):
            self.known[text] = ids[ends[k] : ends[k + 1]]

    def _merge_long(self, body: bytes) -> list[int]:
        """The same contraction for one word, pairs in a heap by (rank, place)."""
        n = len(body)
        after, before, alive = list(range(1, n + 2)), list(range(-1, n)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                end = after[after[i]]
                rank = self.ranks.get(body[i:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue  # one of the two has been merged since
            alive[after[i]] = False
            after[i] = end
            if end < n:
                before[end] = i
            offer(before[i])
            offer(i)
        return [self.ranks[body[i : after[i]]] for i in range(n) if alive[i]]

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """The bytes of ids as ``encode`` gives them."""
        whole = b"".join(texts)
        for a in range(0, len(whole), 4 * QUERY_TOKENS):
            ids = np.unique(np.frombuffer(whole[a : a + 4 * QUERY_TOKENS], "<u4"))
            self._look_up(set(ids.tolist()).difference(self.bodies))
        return [b"".join(map(self.bodies.__getitem__, np.frombuffer(t, "<u4").tolist())) for t in texts]

    def _look_up(self, ids: set[int]) -> None:
        """The bytes of ids, once each; none for an id that the vocabulary lacks."""
        if not ids:
            return
        self.db.register("wanted", pa.table({"id": pa.array(ids, pa.int64())}))
        found = self.db.sql(_DECODE).to_arrow_table()
        self.bodies.update(dict.fromkeys(ids, b""))
        self.bodies.update(zip(found["id"].to_pylist(), found["token"].to_pylist(), strict=True))


@functools.lru_cache(maxsize=1)
def _worker(ranks_path: str, pattern: str) -> DuckBpe:
    """One database per Python worker; Spark gives a worker one partition at a time."""
    return DuckBpe(ranks_path, pattern)


def public_ranks() -> tuple[str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.tiktoken"), p.PATTERN


def encode(docs: DataFrame, text_col: str = "text", vocabulary: Callable[[], tuple[str, str]] = public_ranks) -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names) and
    ``ids``: the ids of the whole text as little-endian unsigned 32-bit
    integers. Null counts as empty; an empty text has no ids."""
    return _encoded(docs, text_col, vocabulary, and_decode=False)


def round_trip(docs: DataFrame, text_col: str = "text", vocabulary: Callable[[], tuple[str, str]] = public_ranks) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows, with one database a
    worker for both: ``row``, ``ids``, ``decoded``."""
    return _encoded(docs, text_col, vocabulary, and_decode=True)


def _encoded(docs: DataFrame, text_col: str, vocabulary: Callable[[], tuple[str, str]], and_decode: bool) -> DataFrame:
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(text_col).alias("text"))
    schema = rows.select("row").schema.add("ids", "binary")
    if and_decode:
        schema = schema.add("decoded", "binary")

    def batches(it: Iterator[pa.RecordBatch]):
        bpe = _worker(*vocabulary())
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                ids = bpe.encode(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())]
                if and_decode:
                    columns.append(pa.array(bpe.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(batches, schema)


def decode(encoded: DataFrame, vocabulary: Callable[[], tuple[str, str]] = public_ranks) -> DataFrame:
    """``encoded`` (any columns and ``ids``) with ``decoded``, the bytes of the
    ids. Null ids have null bytes."""
    schema = T.StructType(encoded.schema.fields[:]).add("decoded", "binary")
    at = encoded.columns.index("ids")

    def batches(it: Iterator[pa.RecordBatch]):
        bpe = _worker(*vocabulary())
        for batch in it:
            ids = batch.column(at).to_pylist()
            decoded = bpe.decode([x or b"" for x in ids])
            bodies = [None if x is None else body for x, body in zip(ids, decoded, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.binary())], names=schema.names)

    return encoded.mapInArrow(batches, schema)
