"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies by a
score-ordered agenda of adjacent symbol pairs, checked against the library."""

from __future__ import annotations

import codecs
import functools
import heapq
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import quoted

SPACE = "▁"
# Encoded words that a worker remembers (emptied when full), characters of a word
# that is worth remembering, characters of text worked on at a time.
CACHE_WORDS, CACHE_CHARS, SLICE_CHARS = 600_000, 64, 1_000_000
# Characters of a short word, and such words whose agendas make one matrix.
SHORT, BLOCK = 24, 4096
NONE = 1 << 30  # place of a pair that is no piece
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_POSITION = (1 << 32) - 1

# An undecodable byte of a run of byte pieces becomes one replacement character.
codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


class PieceBpe:
    """Encoder and decoder of one vocabulary.

    The text is normalised by the vocabulary's own rules, blanks becoming
    ``SPACE``. Its characters are the first symbols. The agenda holds every pair
    of neighbours whose join is a piece, the best score first, the leftmost of
    equals; the best pair is joined and its new neighbours enter the agenda
    until it is empty. A symbol that is no piece falls back to bytes, or to the
    unknown id. Long words have an agenda each, a heap (``merge``); the agendas of
    many short ones are the rows of a matrix, from which each step takes every
    word's best pair (``merge_block``).

    Joins never reach over a place whose two characters stand side by side in no
    piece, so a text is cut there and words are encoded once each."""

    def __init__(self, model_path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        every = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in every):
            raise ValueError(f"{model_path}: vocabularies with unused pieces are not supported")
        plain = [i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        places = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        # Of every piece of two characters or more: its place in the order of scores.
        self.places = {p: places[sp.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.neighbours = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.by_words = not any(b[0] != SPACE and b[1] == SPACE for b in self.neighbours)
        # Where no piece holds a line break, lines are cut there too.
        self.by_lines = self.by_words and not any("\n" in p for p in self.ids) and " " not in sp.normalize("a b")
        self.unknown = sp.unk_id()
        bytes_ = {int(m[1], 16): i for i in every if sp.is_byte(i) and (m := _BYTE.fullmatch(sp.id_to_piece(i)))}
        self.of_byte = [bytes_[b] for b in range(256)] if len(bytes_) == 256 else None
        self.bodies = [self._body(i) for i in every]
        # Decoding drops the blank that encoding puts before a text: that of the first
        # piece, whatever control pieces stand before it.
        self.silent = {i for i in every if sp.is_control(i)}
        self.blanked = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.prefixed = sp.normalize("a").startswith(SPACE)
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []  # known words too long to be worth remembering
        self._pairs()

    def _pairs(self) -> None:
        """Numbers of the symbols (pieces, and the characters they are made of), and
        the pairs of numbers that join: key, place in the order of scores, symbol."""
        symbols = sorted({*self.ids, *(c for p in self.ids for c in p)})
        number = {x: k for k, x in enumerate(symbols)}
        # Characters of no piece join nothing: their numbers follow those of the symbols.
        self.of_char = (len(symbols) + np.arange(0x110000)).astype(np.int32)
        for x, k in number.items():
            if len(x) == 1:
                self.of_char[ord(x)] = k
        self.symbols, self.n_symbols = symbols, len(symbols)
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for p, at in self.places.items():
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    rows.setdefault(number[p[:k]], []).append((number[p[k:]], at, number[p]))
        # All rows (one for each left symbol) lie in one table, each shifted by a number
        # of its own so that no two use one place: a pair is found by one look.
        rng, spread = np.random.default_rng(0), 16 * sum(map(len, rows.values())) + 1
        size = spread + self.n_symbols + 2
        self.shift = np.ones(self.n_symbols + 1, np.int32)
        self.owner, self.pair_place, self.pair_symbol = np.full(size, -1, np.int32), np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        for left, row in sorted(rows.items(), key=lambda r: -len(r[1])):
            right, place, symbol = np.array(row, np.int32).T
            at = right + 1
            while (self.owner[at] >= 0).any():
                at = right + rng.integers(1, spread + 1)
            self.shift[left] = at[0] - right[0]
            self.owner[at], self.pair_place[at], self.pair_symbol[at] = left, place, symbol
        self.id_of = np.array([self.ids.get(x, -1) for x in symbols], np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of pairs of symbols (-1: past the end): where they lie in the table, 0 if
        they do not join."""
        at = self.shift[np.minimum(left, self.n_symbols)] + np.minimum(right, self.n_symbols)
        at[self.owner[at] != left] = 0
        at[left < 0] = 0
        return at

    def merge_block(self, words: list[str]) -> np.ndarray:
        """``merge`` of words of about one length: a row of numbers of symbols for
        each, -1 after the last."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        table = np.full((len(words), width + 2), -1, np.int32)
        table[:, :width][np.arange(width) < sizes[:, None]] = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        place = self.pair_place[self._look(table[:, :-1], table[:, 1:])]
        out = np.empty_like(table)
        row = np.arange(len(words))
        columns = np.arange(width + 2)
        while len(row):
            best = place.argmin(1)
            going = place[np.arange(len(row)), best] < NONE
            if not going.all():
                out[row[~going]] = table[~going]
                row, table, place, best = row[going], table[going], place[going], best[going]
            every = np.arange(len(row))
            symbol = self.pair_symbol[self._look(table[every, best], table[every, best + 1])]
            # The right symbol's column goes, the left one's changes; so do the pairs on both sides.
            after = np.minimum(columns + (columns > best[:, None]), width + 1)
            table = np.take_along_axis(table, after, 1)
            table[every, best] = symbol
            place = np.take_along_axis(place, np.minimum(columns[:-1] + (columns[:-1] >= best[:, None]), width), 1)
            place[every, best] = self.pair_place[self._look(symbol, table[every, best + 1])]
            inner = np.nonzero(best)[0]
            left = best[inner] - 1
            place[inner, left] = self.pair_place[self._look(table[inner, left], symbol[inner])]
        return out

    def _body(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        if self.library.is_byte(i):
            return bytes([int(_BYTE.fullmatch(piece)[1], 16)])
        if self.library.is_control(i):
            return b""
        return (self.library.decode([i]) if self.library.is_unknown(i) else piece.replace(SPACE, " ")).encode()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, without begin and end."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._words(self.library.normalize(t)) for t in texts]
        self._learn(set().union(*cut).difference(self.known))
        out = []
        for words in cut:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4")
            if self.of_byte is None and len(ids):  # neighbouring unknown symbols are one id
                again = (ids == self.unknown) & np.append(False, ids[:-1] == self.unknown)
                ids = ids[~again]
            out.append(ids)
        return out

    def _words(self, normal: str) -> list[str]:
        if not self.by_words:
            return [normal]
        if SPACE + SPACE in normal or not normal.startswith(SPACE):
            return _WORD.findall(normal)
        if self.by_lines and "\n" in normal:
            return normal.replace("\n", " \n ").replace(SPACE, " " + SPACE)[1:].split(" ")
        return [SPACE + w for w in normal[1:].split(SPACE)]

    def _learn(self, words: set[str]) -> None:
        short = sorted((w for w in words if 0 < len(w) <= SHORT), key=len)
        for a in range(0, len(short), BLOCK):
            block = short[a : a + BLOCK]
            symbols = self.merge_block(block)
            there = symbols >= 0
            ids = np.where(symbols < self.n_symbols, self.id_of[np.minimum(symbols, self.n_symbols - 1)], -1)
            plain = ~((ids < 0) & there).any(1)
            body = ids[there].astype("<i4").tobytes()
            ends = (4 * np.cumsum(there.sum(1))).tolist()
            self.known.update(zip(block, [body[start:end] for start, end in zip([0, *ends], ends)]))
            for k in np.nonzero(~plain)[0].tolist():  # words with symbols that are no pieces
                row = zip(symbols[k][there[k]].tolist(), ids[k][there[k]].tolist(), strict=True)
                spare = [[i] if i >= 0 else self._spare(self.symbols[x] if x < self.n_symbols else chr(x - self.n_symbols)) for x, i in row]
                self.known[block[k]] = array("i", [i for part in spare for i in part]).tobytes()
        for word in words:
            if not 0 < len(word) <= SHORT:
                self.known[word] = self._long(word)
                if len(word) > CACHE_CHARS:
                    self.passing.append(word)

    def _long(self, word: str) -> bytes:
        out, a = [], 0
        for b in range(1, len(word) + 1):
            if b == len(word) or word[b - 1 : b + 1] not in self.neighbours:
                out.append(self._bytes(word[a:b]))
                a = b
        return b"".join(out)

    def _bytes(self, word: str) -> bytes:
        ids: list[int | None] = list(map(self.ids.get, symbols := self.merge(word)))
        if None in ids:
            spare = [[i] if i is not None else self._spare(s) for i, s in zip(ids, symbols, strict=True)]
            ids = [i for part in spare for i in part]
        return array("i", ids).tobytes()

    def _spare(self, symbol: str) -> list[int]:
        return [self.of_byte[b] for b in symbol.encode()] if self.of_byte else [self.unknown]

    def merge(self, word: str) -> list[str]:
        """The symbols that are left when the agenda is empty. An entry is a
        place in the order of scores and the position of the left symbol; it is
        out of date when the pair at that position has another place by now."""
        n = len(word)
        place = self.places.get
        agenda = [p << 32 | i for i in range(n - 1) if (p := place(word[i : i + 2])) is not None]
        if not agenda:
            return list(word)
        # Of a symbol's first character: where the next symbol starts (-1: joined
        # to its left) and where the one before starts.
        table = list if n <= CACHE_CHARS else functools.partial(array, "i")
        after, before = table(range(1, n + 1)), table(range(-1, n - 1))
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            entry = pop(agenda)
            i = entry & _POSITION
            middle = after[i]
            if not 0 < middle < n:
                continue
            end = after[middle]
            if place(word[i:end]) != entry >> 32:
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                p = place(word[i : after[end]])
                if p is not None:
                    push(agenda, p << 32 | i)
            if i:
                left = before[i]
                p = place(word[left:end])
                if p is not None:
                    push(agenda, p << 32 | left)
        out, i = [], 0
        while i < n:
            out.append(word[i : after[i]])
            i = after[i]
        return out

    def forget(self) -> None:
        """Empty the memory of words when it is full, or of long ones."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for word in self.passing:
            self.known.pop(word, None)
        self.passing.clear()

    def decode(self, ids: list[int]) -> str:
        body = b"".join(map(self.bodies.__getitem__, ids))
        if self.prefixed and next((i in self.blanked for i in ids if i not in self.silent), False):
            body = body[1:]
        return body.decode("utf-8", "one-by-one")


@functools.lru_cache(maxsize=1)
def _worker(model_path: str) -> PieceBpe:
    return PieceBpe(model_path)


def public_pieces() -> str:
    import public_tokenizers as p

    return p.path("piece_bpe_32k.model")


def round_trip(docs: DataFrame, text_col: str = "text", vocabulary: Callable[[], str] = public_pieces) -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names),
    ``ids`` (array of int, without begin and end ids), ``decoded`` (their text)
    and ``agrees``: whether the sentencepiece library, run on the same whole
    text in the same Arrow batch, gives the same ids and decodes them to the same
    text. Null counts as empty; an empty text has no ids; an empty table gives
    no rows. ``vocabulary`` names the model file where the task runs."""
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(text_col).alias("text"))
    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string").add("agrees", "boolean")

    def batches(it: Iterator[pa.RecordBatch]):
        bpe = _worker(vocabulary())
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                bpe.forget()
                ids = bpe.encode_all(texts[a:b])
                decoded, agrees = [], []
                for text, own in zip(texts[a:b], map(np.ndarray.tolist, ids), strict=True):
                    theirs = bpe.library.encode(text)
                    back = bpe.decode(own)
                    decoded.append(back)
                    agrees.append(own == theirs and back == bpe.library.decode(theirs))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                columns = [batch.column(0).slice(a, b - a), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(batches, schema)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_CHARS characters, one text at least."""
    a = size = 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size > SLICE_CHARS or b == len(texts):
            yield a, b
            a, size = b, 0
