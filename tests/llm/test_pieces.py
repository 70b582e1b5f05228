import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import pieces


@pytest.fixture(scope="module")
def bpe():
    return pieces.PieceBpe(pieces.public_pieces())


def same(bpe, text):
    ids = bpe.encode(text).tolist()
    assert ids == bpe.library.encode(text), text[:100]
    assert bpe.decode(ids) == bpe.library.decode(ids), text[:100]


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_any_text(text):
    same(pieces._worker(pieces.public_pieces()), text)


def test_odd_texts(bpe):
    rng = random.Random(1)
    alphabet = "ab cdeé▁  \n\t\0ıßЖ中🙂<s>0x41<0x41>.,!?the ing er​�½"
    for _ in range(4000):
        same(bpe, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))))


@pytest.mark.parametrize("text", ["", " ", "   ", "▁", "a" * 5000, "ab" * 3000, " " * 3001, "▁ " * 2000, "the" * 2000, "中" * 2000, "x\n" * 3000, "qz▁" * 2000, "<unk></s>"])
def test_long_runs(bpe, text):
    same(bpe, text)


def test_a_million_characters_without_blank(bpe):
    same(bpe, "abcdefghij" * 100_000)


def test_decoding_ids_that_are_no_encoding(bpe):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randint(0, 20))]
        assert bpe.decode(ids) == bpe.library.decode(ids), ids


def test_agenda_against_plain_search(bpe):
    """The definition: join the pair of best score, leftmost of equals, until none is a piece."""
    rng = random.Random(4)
    for _ in range(400):
        symbols = list("".join(rng.choice("▁theinrasdo") for _ in range(rng.randint(1, 25))))
        word = "".join(symbols)
        while pairs := [(bpe.places[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in bpe.places]:
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert bpe.merge(word) == symbols
        block = bpe.merge_block([word, word[:1]])[0]
        assert bpe.id_of[block[block >= 0]].tolist() == [bpe.ids[x] for x in symbols]


def test_without_cuts_at_blanks(bpe):
    whole = pieces.PieceBpe(pieces.public_pieces())
    whole.by_words = False
    for text in ("some words  of a text\nand a line", "", "a" * 100 + " b" * 100):
        assert whole.encode(text).tolist() == bpe.library.encode(text)


def test_round_trip_of_rows(spark, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_CHARS", 40)
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "héllo wörld " * 20), (4, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("ids"), F.lit(2).alias("row"), F.lit(3).alias("a.b"))
    got = pieces.round_trip(docs).collect()
    assert sorted((str(r["row"]["doc_id"]), r["row"]["text"] or "") for r in got) == sorted((str(a), b or "") for a, b in rows)
    assert all(r["agrees"] for r in got)
    assert all(r["decoded"] == (r["row"]["text"] or "") for r in got)
    assert [len(r["ids"]) for r in got if not r["row"]["text"]] == [0, 0]


def test_empty_table(spark):
    assert pieces.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []
