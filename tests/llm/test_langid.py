import math
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.langid import PpmModel, padded


def code_length(texts, text):
    """The definition: escape from order 3 down, symbol by symbol."""
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(4)]
    for t in map(padded, texts):
        for i in range(3, len(t)):
            for o in range(4):
                counts[o][t[i - o : i]][t[i]] += 1
    bits, t = 0.0, padded(text)
    for i in range(3, len(t)):
        for o in (3, 2, 1, 0):
            seen = counts[o].get(t[i - o : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if t[i] in seen:
                bits -= math.log2(seen[t[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


SAMPLES = {"en": [b"the cat sat on the mat", b"a theory of that"], "fr": ["le chat été".encode(), b"la table de la mer"], "xx": [b"zzzz"]}


def test_code_lengths_match_the_definition(monkeypatch):
    rng = random.Random(1)
    texts = [b"", b"t", b"the", "été\x00".encode(), bytes(range(256))] + [bytes(rng.choices(b"the cat\xc3\xa9lz", k=rng.randint(1, 90))) for _ in range(20)]
    model = PpmModel(SAMPLES)
    want = [[code_length(SAMPLES[k], t) for k in model.langs] for t in texts]
    assert np.allclose(model.code_lengths(texts), want, rtol=1e-5, atol=1e-3)
    monkeypatch.setattr(langid, "CHUNK", 7)  # long texts in pieces, small groups
    assert np.allclose(model.code_lengths(texts), want, rtol=1e-5, atol=1e-3)


def test_predictions_unknowns_and_no_model():
    model = PpmModel(SAMPLES)
    langs, score = model.predict(["the mat", "la mer", None, "", "123 !?", "zz"])
    assert langs == ["en", "fr", "und", "und", "und", "xx"]
    assert score[2:5].tolist() == [0, 0, 0] and all(0 <= s <= 1 for s in score) and score[0] > 0.5
    assert PpmModel({}).predict(["abc", None])[0] == ["und", "und"]


def test_fold_and_fit_use_only_training_rows(spark):
    rows = [(i, "aaaa" if zlib.crc32(str(i).encode()) % 4 != 2 else "bbbb", "l1") for i in range(60)]
    rows += [(100 + i, "cccc", None) for i in range(9)] + [(None, "dddd", "l2"), (500, None, "l3"), (501, "", "l4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.langs == ["l1"]
    assert set(model.trees[0].orders[0][0].tolist()) == {ord("a")}
    got = {r.doc_id: r.h for r in df.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got.items())
    assert langid.fit(df.where("false")).langs == []


def test_frames_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "the mat", "x", 1.0), (1, "the mat", "x", 1.0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    out = langid.predict(df, PpmModel(SAMPLES))
    assert sorted((r.row.doc_id or 0, r.row.lang_pred or "", r.lang_pred) for r in out.collect()) == [(0, "", "und"), (1, "x", "en"), (1, "x", "en")]
    assert langid.predict(df.where("false"), PpmModel(SAMPLES)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predict(docs, langid.fit(docs)).where(langid.held_out(F.col("row.doc_id")))
    total, right = out.agg(F.count("*"), F.count_if(F.col("row.lang") == F.col("lang_pred"))).first()
    assert total > 200 and right / total > 0.97


def test_long_texts_are_learned_from_bounded_stretches(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "aé" * 3000, "long") if i % 2 else (i, "bb", "short") for i in ids] + [(ids[0] + 1000, "cccc", "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, sample_bytes=100)
    assert model.langs == ["long", "short"] and model.predict(["aéaéaé", "bbbb"])[0] == ["long", "short"]
    n_long = sum(r[2] == "long" for r in rows)
    parts = langid._stretches(F.col("text"), F.lit(100))
    assert df.where("lang = 'long'").select(F.sum(F.aggregate(parts, F.lit(0), lambda s, p: s + F.octet_length(p)))).first()[0] == 100 * n_long
    assert langid.fit(df.where("lang = 'long'"), sample_bytes=100).langs == ["long"]
    cut = spark.createDataFrame([("0123456789" * 2,)], "text string").select(langid._stretches(F.col("text"), F.lit(8)).alias("s")).first().s
    assert [bytes(p) for p in cut] == [b"01", b"67", b"23", b"89"]


def test_every_language_is_learned(spark):
    # 45 languages of which the last one is rare; one letter tells them apart.
    langs = [chr(0x4E00 + k) for k in range(45)]
    ids = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"{langs[k % 44]} {langs[k % 44]}", f"l{k % 44}") for k, i in enumerate(ids)] + [(ids[-1] + 1 + 4 * j, langs[44] * 2, "rare") for j in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.langs) == 45 and model.predict([langs[44] * 3, langs[7] * 3])[0] == ["rare", "l7"]
    small = langid.fit(df, total_bytes=45 * 20, sample_bytes=20)  # one text each
    assert small.langs == model.langs
    assert all(1 <= t.orders[0][0].size <= 5 for t in small.trees)


def test_numbers_that_are_no_letters_are_no_language(spark):
    model = langid.PpmModel({"en": [b"the cat and the dog"], "fr": [b"le chat et le chien"]})
    langs, score = model.predict(["½", "² ①", "Ⅷ", "123 !", "a", "中"])
    assert langs[:4] == ["und"] * 4 and not score[:4].any() and "und" not in langs[4:]


def test_repeated_rows_enter_the_sample_once(spark):
    rows = [(1, "the cat and the dog", "en")] * 300 + [(2, "le chat et le chien", "fr"), (1, "another text of one id", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == ["en", "fr"]
    # The frozen counts of a context are those of one copy.
    assert np.isclose(model.trees[0].orders[0][1].min(), langid.ContextTree(sorted([b"the cat and the dog", b"another text of one id"])).orders[0][1].min())
