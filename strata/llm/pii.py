"""Personal data: exact base rules, and candidate spans that gradient-boosted
trees accept by format and context."""

from __future__ import annotations

import bisect
import math
import random
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, bounded, quoted

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind; code points, end exclusive

# --- Base rules ---------------------------------------------------------------
# Possessive quantifiers where giving characters back could never help, so that
# no text makes the search quadratic.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


_DOUBLED = bytes.maketrans(b"0123456789", b"0246813579")
_DIGITS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    """The card number check: every second digit from the right doubled."""
    d = digits.encode()
    return (sum(d[-2::-2].translate(_DOUBLED)) + sum(d[-1::-2]) - 48 * len(d)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def emails(text: str) -> Iterator[Span]:
    """A match begins where the run of local characters before its @ begins
    (not before the end of the last match), so it is found from its @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass their kind's check,
    by start, then kind; matches that fail are dropped and not searched again."""
    out = list(emails(text))
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- Candidates ---------------------------------------------------------------
# High recall: each generator proposes its kind, spans overlap freely. All
# repeats are bounded or possessive.
_GENERATORS = {
    "phone": [
        re.compile(r"(?<![\w+.@-])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![\w@])"),
        re.compile(r"\+[0-9](?:[ ().-]{0,3}[0-9]){7,14}(?![0-9])"),
    ],
    "card": [re.compile(r"(?<![\w+.])[0-9]{4}(?:[ .\-_/]{0,2}[0-9]{3,6}){2,4}(?![\w])")],
    "ip": [
        re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?\. ?| dot )[0-9]{1,3}){3}(?![\w])"),
        re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    ],
    "email": [
        re.compile(
            r"(?<![\w.])[\w.%+-]{1,64}(?: ?[\[({] ?at ?[\])}] ?| at |@| @ )[\w-]{1,63}"
            r"(?:(?: ?[\[({] ?dot ?[\])}] ?| dot |\.| \. )[\w-]{1,63}){1,4}(?!\w)"
        )
    ],
}
# Without any of these no generator can match.
_HINT = re.compile(r"[0-9@]| at |at[\])}]")
# Each address has one of these.
_MAIL_HINTS = ("@", " at ", "at]", "at)", "at}", "at ]", "at )", "at }")
_CUES = {
    "phone": ("phone", "tel", "call", "fax", "mobile", "contact"),
    "card": ("card", "visa", "credit", "payment", "account"),
    "ip": ("ip", "host", "server", "address", "from"),
    "email": ("mail", "contact", "write", "send", "reach"),
}
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ](?:19|20)[0-9]{2}")
FEATURES = 26
SCORE_BINS = 1000


def candidates(text: str) -> list[Span]:
    if not _HINT.search(text):
        return []
    digit = _DIGITS.search(text) is not None
    may = {"phone": digit, "card": digit, "ip": digit or ":" in text, "email": any(h in text for h in _MAIL_HINTS)}
    return sorted({(m.start(), m.end(), k) for k, found in _GENERATORS.items() if may[k] for g in found for m in g.finditer(text)})


_AT, _DOT = re.compile(r"\bat\b"), re.compile(r"\bdot\b")


def features(text: str, span: Span) -> list[int]:
    """Format of the span and what stands around it: whole numbers."""
    a, b, kind = span
    s = text[a:b]
    groups = _DIGITS.findall(s)
    digits, sizes = "".join(groups), [len(g) for g in groups] or [0]
    before, after = text[max(0, a - 24) : a].lower(), text[b : b + 1]
    cued = False
    for c in _CUES[kind]:
        if c in before:
            cued = True
    return [
        kind == "email", kind == "ip", kind == "card", kind == "phone",
        len(s), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        s.startswith("+"), s.startswith("00"), "(" in s,
        s.count(" "), s.count("."), s.count("-") + s.count("/"), s.count(":"),
        digits != "" and luhn(digits),
        len(groups) == 4 and max(sizes) <= 4 and max(map(int, groups)) <= 255,
        "@" in s, "at" in s and bool(_AT.search(s)), "dot" in s and bool(_DOT.search(s)),
        cued,
        len(digits) >= 6 and bool(_DATE.search(s)),
        after.isalnum() or before[-1:].isalnum(),
    ]


# --- Training -----------------------------------------------------------------
def _generated(rng: random.Random) -> list[tuple[str, str, int]]:
    """One positive and some near misses per kind: (text of the span, kind, label)."""
    d = lambda n: f"{int(rng.random() * 10**n):0{n}d}"
    w = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=3 + int(rng.random() * 6)))
    card = rng.choice("3456") + d(14)
    card += next(c for c in "0123456789" if luhn(card + c))
    bad = card[:-1] + rng.choice([c for c in "0123456789" if c != card[-1]])
    sep = rng.choice([".", "  ", "_", "/", " "])
    by4 = lambda x: sep.join(x[i : i + 4] for i in range(0, 16, 4))
    ip = [str(rng.randint(1, 255)) for _ in range(4)]
    area, mid, last = d(3), d(3), d(4)
    phone = rng.choice([f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"+1 ({area}) {mid}-{last}", f"+{d(2)} {area} {mid} {last}", f"00{d(2)} {area} {mid}{d(2)}"])
    at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" @ ", ".")])
    date = rng.choice([f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", f"1{d(1)}.0{rng.randint(1, 9)}.20{d(2)}", f"1{d(1)}/0{rng.randint(1, 9)}/19{d(2)}"])
    return [
        (by4(card), "card", 1), (by4(bad), "card", 0), (f"{d(4)} {d(4)} {d(4)}", "card", 0), (by4(bad), "phone", 0),
        (rng.choice(["[.]", "(.)", " dot "]).join(ip), "ip", 1),
        (":".join(f"{rng.randrange(65536):x}" for _ in range(8)), "ip", 1),
        ("[.]".join([*ip[:3], str(rng.randint(256, 999))]), "ip", 0), (f"{d(2)}:{d(2)}:{d(2)}:{d(2)}", "ip", 0),
        (" . ".join(d(1) for _ in range(4)), "ip", 0),
        (phone, "phone", 1), (date, "phone", 0), (f"{d(2)} {d(2)}", "phone", 0), (f"{d(1)}.{d(2)}.{d(2)}", "phone", 0),
        (f"{d(4)}-{d(4)}", "phone", 0), (f"{d(3)}.{d(3)}.{d(3)}", "phone", 0), (f"{d(2)}/{d(3)}", "phone", 0),
        (f"{w()}{at}{w()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}", "email", 1),
        (f"{w()} at {w()}. {w()}", "email", 0), (f"{w()} at {w()} . {w()}", "email", 0), (f"{w()} at {w()}.{w()}", "email", 0),
    ]


def surely_false(span: str, kind: str) -> bool:
    """Whether a rule excludes that a candidate is what its kind says: a phone
    number of under 7 or over 15 digits, or a date; a card number without 14 to
    19 digits or with a wrong check digit; an address with an octet over 255, or
    without the eight groups; a mail domain that ends in no name of two letters
    or more. Everything else may be personal data."""
    digits, groups = _digits(span), re.findall(r"[0-9]+", span)
    if kind == "phone":
        return not 7 <= len(digits) <= 15 or bool(_DATE.fullmatch(span))
    if kind == "card":
        return not 14 <= len(digits) <= 19 or not luhn(digits)
    if kind == "ip":
        return span.count(":") != 7 if ":" in span else any(int(g) > 255 for g in groups)
    last = re.split(r"\W+", span)[-1]
    return len(last) < 2 or not (last.isalpha() or "xn--" in span.lower())


def _examples(text: str) -> Iterator[tuple[list[int], int]]:
    """Labelled candidates of one text. Its own: those that are base spans are
    positive, those that overlap none and that a rule excludes negative; the
    others may be true and are left out. Generated ones stand between two of
    its words and are labelled as made, where a generator proposes them."""
    base = base_spans(text)
    own, cover = set(base), Cover(base)
    for c in candidates(text):
        if c in own:
            yield features(text, c), 1
        elif not cover.meets(c) and surely_false(text[c[0] : c[1]], c[2]):
            yield features(text, c), 0
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    words = text.split()
    for s, kind, label in _generated(rng):
        i = rng.randint(0, len(words))
        cue = rng.choice(["", "", rng.choice(_CUES[kind]) + " "])
        left = " ".join(words[max(0, i - 6) : i]) + " " + cue
        made = f"{left}{s} {' '.join(words[i : i + 6])}"
        made_span = (len(left), len(left) + len(s), kind)
        if any((m.start(), m.end()) == made_span[:2] for g in _GENERATORS[kind] for m in g.finditer(made)):
            yield features(made, made_span), label


class Scorer:
    """Boosted trees as nested tuples (feature, threshold, left, right) or leaf
    values, with a threshold per kind."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, x: list[int]) -> float:
        total = 0.0
        for node, weight in zip(self.trees, self.weights, strict=True):
            while isinstance(node, tuple):
                node = node[2] if x[node[0]] <= node[1] else node[3]
            total += weight * node
        return total

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Accepted candidates, the best first where they overlap; none that
        overlaps a base span."""
        cover, scored = Cover(base), []
        for c in candidates(text):
            if not cover.meets(c):
                s = self.score(features(text, c))
                if s >= self.thresholds[c[2]]:
                    scored.append((-s, c))
        taken, out = Cover([]), []
        for _, c in sorted(scored):
            if not taken.meets(c):
                taken.add(c)
                out.append(c)
        return out


class Cover:
    """The stretches that spans cover, apart from each other and in order, so that
    a span is held against its neighbours only."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, c: Span) -> bool:
        i = bisect.bisect_right(self.ends, c[0])
        return i < len(self.ends) and self.starts[i] < c[1]

    def add(self, c: Span) -> None:
        """A span that meets none."""
        i = bisect.bisect_right(self.ends, c[0])
        self.starts.insert(i, c[0])
        self.ends.insert(i, c[1])


def _tree(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


# An example: its features, and whether it is true.
_EXAMPLE = f"<{FEATURES + 1}H"


def fit(
    docs: DataFrame,
    scratch: Scratch,
    text_col: str = "text",
    sample_chars: int | None = None,
    trees: int = 20,
    depth: int = 4,
    precision: float = 0.98,
) -> Scorer | None:
    """Train on the candidates of every text, whole; copies count once, as their
    hash has it. (A caller may have but a stretch of ``sample_chars`` characters
    read of longer texts, at a place that the hash gives.) Two thirds of the texts,
    by another hash, train the trees; on the rest each kind's threshold is set: the
    lowest score (to 1/``SCORE_BINS``) from which on ``precision`` of the candidates
    are true (none reaching it: no candidate of the kind is taken). Examples that
    are alike are one row, weighted by their number. No examples: None."""
    texts = docs.select(quoted(text_col).alias("text")).where(F.char_length("text") >= 1).select(F.xxhash64("text").alias("code"), "text")
    if sample_chars:
        at = F.pmod("code", F.greatest(F.char_length("text") - sample_chars, F.lit(0)).cast("long") + 1).cast("int") + 1
        texts = texts.select("code", F.substring(F.col("text"), at, F.lit(sample_chars)).alias("text"))

    def examples(batch):
        held, made = [], []
        for text in batch.column(1).to_pylist():
            held.append(zlib.crc32(text.encode("utf-8", "replace")) % 3 == 0)
            made.append([struct.pack(_EXAMPLE, *x, y) for x, y in _examples(text)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(made, pa.list_(pa.binary()))], names=["code", "calibrate", "made"])

    def unpacked(it):
        for batch in it:
            table = np.array(list(struct.iter_unpack(_EXAMPLE, b"".join(batch.column(0).to_pylist()))), np.float64).reshape(-1, FEATURES + 1)
            x = pa.array(list(table[:, :FEATURES]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, pa.array(table[:, FEATURES]), *batch.columns[1:]], names=["x", "label", "calibrate", "n"])

    of_text = texts.mapInArrow(bounded(examples), "code long, calibrate boolean, made array<binary>").dropDuplicates(["code"])
    alike = of_text.select("calibrate", F.explode("made").alias("made")).groupBy("made", "calibrate").agg(F.count("*").cast("double").alias("n"))
    labelled = scratch.put(alike.mapInArrow(unpacked, "x array<double>, label double, calibrate boolean, n double"), "labelled")
    sizes = {r["label"]: r["m"] for r in labelled.where("not calibrate").groupBy("label").agg(F.count("*").alias("m")).collect()}
    if len(sizes) < 2:
        return None
    # Unlike examples are few, and the trees pass over them many times: a few tasks do.
    rows = sum(sizes.values())
    train = labelled.where("not calibrate").coalesce(max(4, rows // 50_000)).select("label", "n", array_to_vector("x").alias("features"))
    # With this many bins every value of a feature may split, and none is drawn for.
    bins = max(32, math.isqrt(rows) + 1)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=0.3, seed=7, weightCol="n").fit(train)
    scorer = Scorer([_tree(t._call_java("rootNode")) for t in model.trees], list(model.treeWeights), {})

    def scores(it):
        for batch in it:
            rows = batch.column(0).to_pylist()
            kinds = [x.index(1.0) for x in rows]
            bins = [math.floor(scorer.score(x) * SCORE_BINS) for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(bins, pa.int32()), *batch.columns[1:]], names=["kind", "bin", "label", "n"])

    # One row for each kind and score that occurs: boosted scores have a small range.
    binned = labelled.where("calibrate").select("x", "label", "n").mapInArrow(scores, "kind int, bin int, label double, n double")
    found = binned.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("true")).collect()
    for k, kind in enumerate(KINDS):
        scorer.thresholds[kind], all_, true = float("inf"), 0.0, 0.0
        for r in sorted((r for r in found if r["kind"] == k), key=lambda r: -r["bin"]):
            all_, true = all_ + r["n"], true + r["true"]
            if r["bin"] >= 0 and true >= precision * all_:
                scorer.thresholds[kind] = r["bin"] / SCORE_BINS
    scratch.drop(labelled)
    return scorer


# --- Application --------------------------------------------------------------
SPAN_TYPE = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


def find(docs: DataFrame, scorer: Scorer | None, text_col: str = "text") -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names),
    ``base`` and ``spans`` (base and added spans by start, then kind),
    ``redacted`` (the text with every covered stretch replaced by its first
    span's kind in angle brackets, like <email>; null for a null text). Null and
    empty texts have no spans; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(text_col).alias("text"))
    schema = rows.select("row").schema.add("base", SPAN_TYPE).add("spans", SPAN_TYPE).add("redacted", "string")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def spans_of(batch):
        model = shared.value
        base, spans, redacted = [], [], []
        for text in batch.column(1).to_pylist():
            own = base_spans(text or "")
            both = in_order(own + (model.added(text or "", own) if model else []))
            base.append([{"kind": k, "start": a, "end": b} for a, b, k in own])
            spans.append([{"kind": k, "start": a, "end": b} for a, b, k in both])
            redacted.append(redact(text, both) if text else text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(spans, kind), pa.array(redacted, pa.string())], names=schema.names)

    return rows.mapInArrow(bounded(spans_of), schema)


def redact(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
