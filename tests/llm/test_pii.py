import random
import re
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import pii
from strata.llm.common import Scratch


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_base(text):
    """The four rules as written."""
    out, only = [], lambda s: re.sub("[^0-9]", "", s)
    out += [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(only(m[0])) <= 19 and luhn(only(m[0])):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(only(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_match_the_rules():
    rng = random.Random(4)
    parts = ["a@b.c", "@", "x.y@z", ".com", "1.2.3.4", "256", ".", "4539 1488 0343 6467", "4111-1111-1111-1111", "0" * 16, "+1 (269) 555-3296", "+", " ", "-", "é", "@b.c@d.e", "12", "+4930(123)45.67", "007.1.1.1"]
    texts = ["", "@a.b@c.d", "a@b.c.", "1.2.3.4.5.6.7.8", "1.2.3.256.1.2.3.4", "+1 " + "2" * 14, "a@b..c"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t), t


def test_long_runs_take_linear_time():
    began = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "1 " * 150_000, "(1" * 100_000, "x at " * 60_000):
        pii.base_spans(t)
        pii.candidates(t)
    assert time.time() - began < 30


def test_redaction_and_overlaps():
    text = "mail a@b.cc or call +1 (269) 555-3296 now"
    spans = pii.base_spans(text)
    assert pii.redact(text, spans) == "mail <email> or call <phone> now"
    assert pii.redact("abcdef", [(1, 4, "ip"), (2, 5, "card")]) == "a<ip>f"
    assert pii.redact("abc", []) == "abc"


def test_trees_add_what_the_rules_miss_and_leave_the_rest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scorer = pii.fit(docs, Scratch(spark, "t9"))
    text = "please call (269) 555-3296 or write jon at mailbox dot com about 4539.1488.0343.6467 today"
    found = {(k, text[a:b]) for a, b, k in scorer.added(text, pii.base_spans(text))}
    assert ("email", "jon at mailbox dot com") in found and ("card", "4539.1488.0343.6467") in found
    for clean in ("on 2024-05-17 we met at noon. all fine", "version 1.2.3 of 10 items", "room 12, page 345", "met at home.we left", "password=531ccd051a92ebcb68"):
        assert scorer.added(clean, pii.base_spans(clean)) == [], clean
    # Base spans stay whatever the trees say.
    rows = [(1, "x a@b.cc y", 1, "k"), (1, "x a@b.cc y", 1, "k"), (None, None, 2, None), (3, "", 3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base int, spans string")
    out = pii.find(df, scorer).collect()
    got = sorted((r.row.base, r.redacted, len(r.base), len(r.spans)) for r in out if r.redacted is not None)
    assert got == [(1, "x <email> y", 1, 1), (1, "x <email> y", 1, 1), (3, "", 0, 0)] and len(out) == 4
    assert pii.find(df.where("false"), scorer).collect() == [] and pii.fit(df.where("false"), Scratch(spark, "t9")) is None
    assert pii.find(df.where("base = 1"), None).count() == 2


def test_unlabelled_looser_forms_are_not_taught_as_clean(spark):
    for text, kind in (("(269) 555-3296", "phone"), ("jon at mailbox dot com", "email"), ("4539.1488.0343.6467", "card"), ("10[.]0[.]0[.]1", "ip")):
        assert not pii.surely_false(text, kind)
    for text, kind in (("2024-05-17", "phone"), ("12 34", "phone"), ("4539.1488.0343.6468", "card"), ("1[.]2[.]3[.]256", "ip"), ("12:34:56:78", "ip"), ("a at b. 3", "email")):
        assert pii.surely_false(text, kind)
    # A corpus in which every text holds a looser form teaches to find it.
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    say = lambda: " ".join(rng.choices(words, k=8))
    rows = [(f"{say()} reach {rng.choice(words)} at {rng.choice(words)} dot com or ({num(3)}) {num(3)}-{num(4)} {say()}",) for _ in range(400)]
    scorer = pii.fit(spark.createDataFrame(rows, "text string"), Scratch(spark, "t9"))
    text = "alpha beta call (269) 555-3296 or reach jon at mailbox dot com gamma"
    assert {(k, text[a:b]) for a, b, k in scorer.added(text, [])} == {("phone", "(269) 555-3296"), ("email", "jon at mailbox dot com")}


def test_long_texts_take_time_by_their_length(spark):
    """Spans of a text are held against their neighbours, not against all."""
    rng = random.Random(5)
    text = " ".join(f"{rng.randrange(256)}.{rng.randrange(256)}.1.2 call (269) 555-{rng.randrange(1000, 9999)} a{rng.randrange(99)}@b.com" for _ in range(20_000))
    scorer = pii.Scorer([1.0], [1.0], dict.fromkeys(pii.KINDS, 0.5))
    begin = time.monotonic()
    base = pii.base_spans(text)
    added = scorer.added(text, base)
    assert time.monotonic() - begin < 20 and len(base) >= 40_000 and len(added) >= 15_000
    taken = sorted([s[:2] for s in base if s[2] == "email"] + [s[:2] for s in added])
    assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=12), st.integers(0, 60), st.integers(1, 9))
def test_cover_meets_just_what_overlaps(spans, a, n):
    spans = [(x, x + k, "ip") for x, k in spans]
    assert pii.Cover(spans).meets((a, a + n, "ip")) == any(x < a + n and a < y for x, y, _ in spans)


def test_longer_texts_than_the_sample_takes_are_learned_from(spark):
    """Only long texts, and a third of all rows one text: the sample is neither empty nor all copies."""
    words = "the quick brown fox call 10.2.3.4 or mail a@b.com for +1 555 123 4567 now "
    rows = [(i, f"{i} " + words * 40) for i in range(60)] + [(100 + i, "copy " + words * 40) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scorer = pii.fit(docs, Scratch(spark, "p"), sample_chars=300, trees=3, depth=2)
    assert scorer is not None and set(scorer.thresholds) == set(pii.KINDS)


def test_every_text_is_learned_from_whole(spark):
    """The examples are those of all different texts, long ones to their end, copies once."""
    seen = []

    class Kept(Scratch):
        def put(self, df, name):
            out = super().put(df, name)
            seen.extend(out.collect())
            return out

    filler = "alpha beta gamma delta 12.34 omega " * 1500
    texts = [filler + f"mail a{i}@b.com or +1 555 123 45{i:02}" for i in range(3)] + [f"call {i} on 2024-05-17" for i in range(40)]
    rows = [(t,) for t in texts] + [(texts[0],)] * 30 + [(None,), ("",)]
    pii.fit(spark.createDataFrame(rows, "text string").repartition(5), Kept(spark, "t9"), trees=1, depth=1)
    want = {}
    for t in texts:
        for x, y in pii._examples(t):
            key = (zlib.crc32(t.encode()) % 3 == 0, tuple(map(float, x)), float(y))
            want[key] = want.get(key, 0) + 1
    assert {(r.calibrate, tuple(r.x), r.label): r.n for r in seen} == want and len(seen) == len(want)
    assert sum(n for (_, x, y), n in want.items() if x[0] and y and x[20] and x[14] == 0) >= 3
