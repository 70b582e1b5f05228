"""Language identification by prediction by partial matching (PPM) over bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded, quoted

UNKNOWN = "und"
FOLDS, HELD_OUT_FOLD = 4, 2
ORDER = 3
CHUNK = 1 << 18  # bytes of texts that are worked on together, fewer with many languages:
GROUP_BYTES = 24 << 20  # memory for their code lengths
STRETCHES = 4  # of a long text, in the sample
LEAST_BYTES = 64  # of a text in the sample, however many languages there are
CELLS = 1 << 25  # numbers of the table of code lengths, (slots, languages)
_MOST_SLOT_BITS = 20


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Of each byte from position ``ORDER`` on: its last ``order`` bytes and itself, as one number."""
    n = len(data) - ORDER
    code = np.zeros(max(n, 0), np.uint32)
    for k in range(ORDER - order, ORDER + 1):
        code = (code << np.uint32(8)) | data[k : k + n]
    return code


def padded(text: bytes) -> bytes:
    """A text begins in a context of zero bytes."""
    return b"\0" * ORDER + text


class ContextTree:
    """Frozen byte statistics of one language, contexts of 0 to ORDER bytes.

    In a context with T symbols seen, D of them distinct, a seen symbol of
    count c has probability c/(T+D) and the escape to the next shorter
    context D/(T+D); a context never seen passes on at no cost; below order 0
    all 256 bytes are equally likely."""

    def __init__(self, texts: list[bytes]):
        self.orders = []
        for order in range(ORDER + 1):
            parts = [np.unique(grams(np.frombuffer(padded(t), np.uint8), order), return_counts=True) for t in texts]
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes))
            contexts, first = np.unique(codes >> np.uint32(8), return_index=True)
            total, distinct = np.add.reduceat(counts, first), np.diff(np.append(first, len(codes)))
            of = np.repeat(np.arange(len(contexts)), distinct)
            seen = -np.log2(counts / (total + distinct)[of])
            escape = -np.log2(distinct / (total + distinct))
            self.orders.append((codes, seen, contexts, escape))

    def bits(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Exact code length of each gram's last byte after the bytes before it."""
        if order < 0:
            return np.full(len(codes), 8.0)
        own, seen, contexts, escape = self.orders[order]
        out = np.zeros(len(codes))
        hit, at = _find(own, codes)
        out[hit] = seen[at[hit]]
        miss = ~hit
        if miss.any():
            rest = codes[miss]
            known, at = _find(contexts, rest >> np.uint32(8))
            shorter = rest & np.uint32((1 << (8 * order)) - 1)
            out[miss] = np.where(known, escape[at], 0.0) + self.bits(shorter, order - 1)
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


class PpmModel:
    """One context tree per language, and the code lengths of every gram that
    any of them has seen at full order in a table addressed by hash."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.langs = sorted(samples)
        self.trees = [ContextTree(samples[x]) for x in self.langs]
        if not self.langs:
            return
        counted = [np.unique(grams(np.frombuffer(padded(t), np.uint8), ORDER), return_counts=True) for x in self.langs for t in samples[x]]
        codes, where = np.unique(np.concatenate([c[0] for c in counted]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([c[1] for c in counted]), len(codes))
        codes = codes[np.argsort(counts, kind="stable")]  # of grams in one slot the most frequent stays
        self.slot_bits = max(8, min(_MOST_SLOT_BITS, (CELLS // len(self.langs)).bit_length() - 1))
        self.slots = np.zeros(1 << self.slot_bits, np.uint32)
        self.lengths = np.zeros((1 << self.slot_bits, len(self.langs)), np.float32)
        self.used = np.zeros(1 << self.slot_bits, bool)
        slot = self._slot(codes)
        self.slots[slot], self.used[slot] = codes, True
        kept = np.nonzero(self.used)[0]
        for k, tree in enumerate(self.trees):
            self.lengths[kept, k] = tree.bits(self.slots[kept])

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language, (texts, languages)."""
        out = np.zeros((len(texts), len(self.langs)))
        group: list[int] = []
        size = 0
        # Of a byte: its code lengths, those of its gram if it is rare, and some indices.
        chunk = min(CHUNK, max(1 << 10, GROUP_BYTES // (16 * len(self.langs) + 64)))
        for i, t in enumerate(texts):
            if not t:
                continue
            if len(t) > chunk:  # a very long text, piece by piece with its context
                data = padded(t)
                for a in range(0, len(t), chunk):
                    out[i] += self._gram_bits(np.frombuffer(data[a : a + chunk + ORDER], np.uint8)).sum(0, dtype=np.float64)
                continue
            group.append(i)
            size += len(t)
            if size > chunk:
                self._add(texts, group, out)
                group, size = [], 0
        self._add(texts, group, out)
        return out

    def _add(self, texts: list[bytes], group: list[int], out: np.ndarray) -> None:
        if not group:
            return
        data = np.frombuffer(b"".join([*(padded(texts[i]) for i in group), b"\0"]), np.uint8)
        ends = np.cumsum([len(texts[i]) + ORDER for i in group])
        starts = ends - [len(texts[i]) + ORDER for i in group]
        bits = self._gram_bits(data)
        # Rows at starts .. ends-ORDER belong to a text; those between two texts mix them and are left out.
        cuts = np.empty(2 * len(group), np.int64)
        cuts[0::2], cuts[1::2] = starts, ends - ORDER
        out[group] = np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)[0::2]

    def _gram_bits(self, data: np.ndarray) -> np.ndarray:
        codes = grams(data, ORDER)
        slot = self._slot(codes)
        bits = self.lengths[slot]
        miss = np.nonzero((self.slots[slot] != codes) | ~self.used[slot])[0]
        if len(miss):
            rare, where = np.unique(codes[miss], return_inverse=True)
            exact = np.stack([tree.bits(rare) for tree in self.trees], axis=1)
            bits[miss] = exact[where]
        return bits

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435761)) >> np.uint32(32 - self.slot_bits)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language of the shortest code and its posterior under equal priors;
        ``und`` and 0 without text, letters or a learned language."""
        known = [bool(t and self.langs and any(c.isalpha() for c in t)) for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bits = self.code_lengths([t.encode("utf-8", "replace") if k else b"" for t, k in zip(texts, known, strict=True)])
        best = bits.argmin(1)
        score = 1 / np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1)
        langs = [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
        return langs, np.where(known, score, 0.0)


def held_out(id_col):
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 400,
    sample_bytes: int = 16_384,
    total_bytes: int = 32 * 400 * 16_384,
) -> PpmModel:
    """Fit the model on a bounded, deterministic sample of the training folds:
    about ``sample_docs`` texts per language (by a hash of the id, so the bound
    is on average; at least the text of the least hash). Every language is
    learned: if all of them at ``sample_docs`` times ``sample_bytes`` exceed
    ``total_bytes`` (more than 32 languages), each has an equal part of these,
    in fewer texts, and once that is one text, in fewer bytes (``LEAST_BYTES``
    at the least). Texts of any length take part: of one over ``sample_bytes``
    bytes, ``STRETCHES`` evenly spaced stretches of that many bytes together are
    learned, the first from its start, the last up to its end. Only text and
    non-null lang are read; a null id is in no training fold."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id"))
    )
    sized = rows.where(F.octet_length("text") >= 1)
    least = F.min(F.xxhash64("id", "text")).alias("least")
    counts = sized.groupBy("lang").agg(F.count("*").alias("n"), least).collect()
    if not counts:
        return PpmModel({})
    each = total_bytes // len(counts)
    n_docs = max(1, min(sample_docs, each // sample_bytes))
    n_bytes = max(LEAST_BYTES, min(sample_bytes, each // n_docs))
    buckets = 1 << 24
    # As many rows as the model has languages.
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(buckets, -(-n_docs * buckets // r["n"])), r["least"]) for r in counts], "lang string, share long, least long"
    )
    code = F.xxhash64("id", "text")
    sample = sized.join(F.broadcast(shares), "lang").where((F.pmod(code, F.lit(buckets)) < F.col("share")) | (code == F.col("least")))
    texts: dict[str, list[bytes]] = {}
    once = sample.withColumn("code", code).dropDuplicates(["lang", "code"])
    for r in once.select("lang", F.explode(_stretches(F.col("text"), F.lit(n_bytes))).alias("part")).toLocalIterator():
        texts.setdefault(r["lang"], []).append(_whole_characters(bytes(r["part"])))
    return PpmModel({k: sorted(v) for k, v in texts.items()})


def _stretches(text: Column, limit: Column) -> Column:
    """The bytes of a text, or ``STRETCHES`` evenly spaced parts of a longer one
    that have ``limit`` bytes together."""
    data, n = F.encode(text, "UTF-8"), F.octet_length(text)
    size = F.greatest(F.floor(limit / STRETCHES), F.lit(1)).cast("int")
    starts = [F.floor((n - size).cast("long") * k / (STRETCHES - 1)).cast("int") + 1 for k in range(STRETCHES)]
    return F.when(n <= limit, F.array(data)).otherwise(F.array(*[F.substring(data, at, size) for at in starts]))


def _whole_characters(part: bytes) -> bytes:
    """Without the pieces of characters that a cut left at its ends."""
    return part.decode("utf-8", "ignore").encode()


def predict(docs: DataFrame, model: PpmModel, text_col: str = "text") -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names),
    ``lang_pred``, ``score``. Null texts and texts
    without letters are ``und`` with score 0; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(text_col).alias("text"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")

    def found(batch):
        langs, score = shared.value.predict(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score)], names=schema.names)

    return rows.mapInArrow(bounded(found), schema)
