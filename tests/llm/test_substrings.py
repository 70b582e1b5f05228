import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from strata.llm import substrings
from strata.llm.common import Scratch
from strata.llm.substrings import anchors, remove_repeats, word_hashes


def brute(rows, window=20):
    docs = sorted({(i, t) for i, t in rows})
    first = {}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", d[1] or "") for d in docs}
    for d in docs:
        for s in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][s : s + window]), (d, s))
    out = []
    for d in rows:
        w, gone = words[d], set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (d, s):
                gone.update(range(s, s + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df, spark):
    rows = remove_repeats(df, Scratch(spark, "t4")).collect()
    return sorted((r.row.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in rows)


def corpus(seed, vocabulary, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(vocabulary)
    passages = [[word() for _ in range(rng.randint(5, 90))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            a = rng.randint(0, len(part) // 3)
            words += part[a : len(part) - rng.randint(0, 3)] if rng.random() < 0.6 else [word() for _ in range(rng.randint(0, 60))]
        rows.append((i * 3, rng.choice([" ", "  ", "\n", "\t\x0b"]).join(words)))
    rows += [(1000 + j, rows[rng.randrange(n)][1]) for j in range(15)]
    return rows


@pytest.mark.parametrize("seed,size", [(1, 500), (2, 6), (3, 2)])
def test_matches_brute_force(spark, seed, size):
    rows = corpus(seed, [f"w{i}é" for i in range(size)])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df, spark) == brute(rows)


def test_periodic_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 50)
    monkeypatch.setattr(substrings, "SEGMENT", 64)
    rows = [(1, "a b c " * 100), (2, "a b c " * 30), (3, "x " + "a b c " * 40 + "y " * 25), (4, "y " * 300), (5, " ".join(map(str, range(400))) * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, spark) == brute(rows)


def test_hash_collisions_are_resolved_by_the_words(spark, monkeypatch):
    """With anchors that confuse all covered words, digests still decide."""
    honest = anchors

    def confused(words, ends, *a):
        lead, count, kmers, chunks = honest(words, ends, *a)
        return lead, count, kmers * np.uint64(0), chunks * np.uint64(0) + count.astype(np.uint64)

    monkeypatch.setattr(substrings, "anchors", confused)
    rows = corpus(4, [f"w{i}" for i in range(50)], n=12)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert result(df, spark) == brute(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    long = " ".join(f"t{i}" for i in range(30))
    rows = [(2, long, 1, "k"), (2, long, 1, "k"), (None, long, 2, None), (7, None, 3, ""), (8, "", 4, ""), (2, long + " end", 5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag int, kept string")
    out = remove_repeats(df, Scratch(spark, "t4")).collect()
    got = sorted((r.row.tag, r.n_words, r.n_removed) for r in out)
    assert got == [(1, 30, 30), (1, 30, 30), (2, 30, 0), (3, 0, 0), (4, 0, 0), (5, 31, 30)]
    assert remove_repeats(df.where("false"), Scratch(spark, "t4")).collect() == []


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(500)) + b"\x0b\x0c\r\n\tz"
    whole = word_hashes(text)
    monkeypatch.setattr(substrings, "SEGMENT", 7)
    assert (word_hashes(text) == whole).all() and len(whole) == 501


def test_many_rows_without_id(spark):
    """Rows without an id meet only rows of their own text, whatever their number."""
    rng = random.Random(9)
    shared = " ".join(f"s{rng.randrange(10**6)}" for _ in range(30))
    rows = [(None, f"{shared} " + " ".join(f"w{rng.randrange(10**12)}" for _ in range(25))) for _ in range(400)]
    rows += [rows[0]] * 200  # repeated rows are one document
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()
    removed = [r.n_removed for r in out if r.row.text != rows[0][1]]
    assert len(out) == 600 and len({r.n_removed for r in out if r.row.text == rows[0][1]}) == 1
    assert sorted(set(removed)) in ([0, 30], [30]) and removed.count(0) <= 1


def test_anchors_take_texts_by_their_bytes():
    """One batch of long texts is worked on, and sent on, a few MB at a time."""
    import pyarrow as pa

    class Docs:
        schema = T.StructType().add("doc_id", "long").add("text", "binary")

        def mapInArrow(self, work, schema):
            return work

    texts = [b"w%d " % i * 200_000 for i in range(12)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(12), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "text"])
    parts = list(substrings._document_anchors(Docs())(iter([batch])))
    assert len(parts) >= 2 and [i for p in parts for i in p.column(0).to_pylist()] == list(range(12))
