import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm.common import Scratch
from strata.llm.spotsigs import COMMON_WORDS, SPARE, edited_fingerprints, fingerprint, near_pairs, signatures


def plain(text, spare):
    """Signatures as word tuples; ``spare`` holds the words that begin chains of their own."""
    low = (text or "").lower()
    bare = re.sub(r"[^\w \t\n\x0b\f\r]|_", "", low)
    words = (bare if bare.split() else low).split()
    content = [w for w in words if w not in COMMON_WORDS]
    if words and not content:
        return {tuple(words)}
    found, seen = set(), 0
    for w in words:
        begins = w in COMMON_WORDS or seen == 0 or w in spare
        seen += w not in COMMON_WORDS
        if begins and (w not in COMMON_WORDS or content[seen:]):
            found.add((w, *content[seen : seen + 2]))
    return found


def begin_chains(spark, rows):
    """The words of texts whose hash is divisible by SPARE."""
    words = sorted({w for t in rows for w in re.sub(r"[^\w\s]", "", t.lower()).split()}) or [""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    return {r.w for r in df.where(F.xxhash64("w") % SPARE == 0).collect()}


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "and", "der", "fox", "Dog", "Été", "run", "sky,", "a"]
    return ["".join(rng.choice(words) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randint(0, 30))).strip() for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 90])
def test_edited_and_next_match_brute_force(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-50, 10**15), n)
    rows = list(zip(ids, texts(n, n), strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in edited_fingerprints(df).collect()}
    ordered = sorted(rows)
    spare = begin_chains(spark, [t for _, t in rows] + [r.edited for r in got.values()])
    assert len(got) == n
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % n][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(t), edited)
        assert r.near_edited == pytest.approx(jaccard(plain(t, spare), plain(edited, spare)))
        assert r.near_next == pytest.approx(jaccard(plain(t, spare), plain(nxt, spare)))


def test_equal_texts_have_equal_fingerprints_and_empty_ones_none(spark):
    df = spark.createDataFrame([("The  fox\nran",), ("the fox ran",), (None,), ("",), ("no anchors",)], "text string")
    got = [r[0] for r in df.select(fingerprint(signatures(F.col("text")))).collect()]
    assert got[0] == got[1] and len(got[0]) == 32 and got[2] == got[3] == "" and got[4]
    assert hashlib.sha256(got[0].encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    rows = [(4, None, 1, "x"), (4, "the fox", 2, "y"), (4, "the fox", 2, "y"), (None, "of it", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, b int, next_text string")
    got = sorted((r.doc_id or -1, r.edited) for r in edited_fingerprints(df).collect())
    assert [g[0] for g in got] == [-1, 4, 4, 4] and len(got) == 4
    assert edited_fingerprints(df.where("false")).collect() == []


def test_pairs_match_all_pairs(spark):
    rng = random.Random(4)
    base = [set(rng.sample(range(3000), rng.randint(1, 60))) for _ in range(25)]
    sets = [sorted(s ^ set(rng.sample(range(3000), rng.randint(0, 6)))) for s in base for _ in range(6)] + [[]] * 3 + [sorted(base[0])] * 4
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "doc_id long, sigs array<long>")
    members, pairs = near_pairs(df, Scratch(spark, "t6"), 0.8)
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(tuple(s), i)
    assert {(r.doc_id, r.set_id) for r in members.collect()} == {(i, first[tuple(s)]) for i, s in enumerate(sets) if s}
    distinct = sorted((i, set(s)) for s, i in first.items() if s)
    want = {(i, j) for i, a in distinct for j, b in distinct if i < j and jaccard(a, b) >= 0.8}
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(want) and want


def test_punctuation_does_not_count(spark):
    rows = [("of%%% fox ran AT!! home", "of fox ran at home"), ("(the) fox, «un%%%» chat", "the fox un chat"), ("fox the, of. dog", "fox the of dog")]
    df = spark.createDataFrame(rows, "a string, b string")
    sigs = df.select(signatures(F.col("a")).alias("a"), signatures(F.col("b")).alias("b")).collect()
    assert all(r.a == r.b for r in sigs)


def test_chains_skip_common_words(spark):
    df = spark.createDataFrame([("the house of a dog",)], "t string")
    chains = [("the", "house", "dog"), ("of", "dog"), ("a", "dog"), ("house", "dog")]
    want = [F.xxhash64(*[F.lit(w) for w in c]) for c in chains]
    r = df.select(signatures(F.col("t")).alias("sigs"), F.array(*want).alias("want")).first()
    assert set(r.want) <= set(r.sigs) and len(r.sigs) <= 5


def test_texts_without_common_words_are_near_their_edited_text(spark):
    bare = " ".join(f"wort{i}" for i in range(60))
    full = " ".join(f"the thing{i} of" for i in range(40))
    rows = [(i, t) for i, t in enumerate([bare, full, "!!! ???", "...", "the of a", "of the a", ""])]
    got = {r.doc_id: r for r in edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].near_edited > 0.2 and got[1].near_edited > 0.5
    assert len(got[2].sigs) == len(got[3].sigs) == 1 and got[4].sigs != got[5].sigs and got[6].sigs == []


def test_one_very_long_text(spark):
    text = " ".join(f"{w} w{i % 9973}" for i in range(400_000) for w in ("the",))
    rows = [(1, text), (2, "the fox ran")]
    start = time.time()
    got = {r.doc_id: r for r in edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_chars", F.size("sigs").alias("n")).collect()}
    assert got[1].n_chars == len(text) and got[1].n >= 9973 and time.time() - start < 60
