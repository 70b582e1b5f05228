import random

import public_tokenizers as p
import tiktoken

from strata.llm.bpe import DuckBpe, decode, encode, public_ranks, round_trip


def library():
    ranks = DuckBpe(*public_ranks()).ranks
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    chars = "aAbZz019 \t\n\r'.,-_éßñ漢字🙂́  \x1c\x85ﷺ"
    texts = ["", " ", "  \n ", "<|endoftext|>", "don't we'll I'm", "x" * 700, " " * 900, "ab" * 400, "🙂" * 90, "the cat" * 50, "a b  c d", " lead", "trail ", "a\n b", "a \nb", "x\u00a0 y", "one two,three four"]
    return texts + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 120))) for _ in range(150)]


def test_ids_match_the_library_and_come_back():
    own, lib = DuckBpe(*public_ranks()), library()
    texts = odd_texts()
    ids = own.encode(texts)
    for t, x in zip(texts, ids, strict=True):
        want = lib.encode_ordinary(t)
        assert [int.from_bytes(x[i : i + 4], "little") for i in range(0, len(x), 4)] == want, t
    assert own.decode(ids) == [t.encode() for t in texts]


def test_long_words_by_heap_equal_the_recursion():
    own = DuckBpe(*public_ranks())
    rng = random.Random(2)
    for n in (2, 3, 17, 90, 200):
        for letters in ("ab", "the ing", "abcdefghijklmnopqrstuvwxyz"):
            word = "".join(rng.choice(letters.replace(" ", "")) for _ in range(n))
            own.known.clear()
            own._learn({word})
            ids = own.known[word]
            assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == own._merge_long(word.encode())


def test_small_blocks_and_an_emptied_memory_change_nothing(monkeypatch):
    import strata.llm.bpe as m

    texts = odd_texts()[:60]
    want = DuckBpe(*public_ranks()).encode(texts)
    monkeypatch.setattr(m, "QUERY_WORDS", 7)
    monkeypatch.setattr(m, "CACHE_WORDS", 5)
    monkeypatch.setattr(m, "QUERY_TOKENS", 11)
    own = DuckBpe(*public_ranks())
    assert [own.encode([t])[0] for t in texts] == want
    assert own.decode(want) == [t.encode() for t in texts]


def test_frames_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b", 7, "x"), (1, "a b", 7, "x"), (2, None, None, None), (None, "", 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    out = decode(encode(df)).collect()
    key = lambda r: (r.row.ids or 0, bytes(r.ids), bytes(r.decoded))
    assert sorted(map(key, round_trip(df).collect())) == sorted(map(key, out))
    assert sorted((r.row.ids or 0, bytes(r.decoded)) for r in out) == [(0, b""), (1, b""), (7, b"a b"), (7, b"a b")]
    assert decode(encode(df.where("false"))).collect() == []


def test_words_and_ids_just_met_are_not_asked_for_again(monkeypatch):
    """A full memory keeps what the texts at hand hold; decoding asks for an id once."""
    import strata.llm.bpe as m

    monkeypatch.setattr(m, "CACHE_WORDS", 5)
    own, lib, asked = DuckBpe(*public_ranks()), library(), []
    honest = own.db

    class Counted:
        def __getattr__(self, name):
            asked.append(name)
            return getattr(honest, name)

    own.db = Counted()
    text = "zqxv kjwpz vvqza, mmxzq'd wqpzx.\nqqzzk Éxqz " * 3 + "qzv" + " bzzq"
    ids = own.encode([text])
    own.decode(ids)
    asked.clear()
    assert own.encode([text]) == ids and own.decode(ids) == [text.encode()] and not asked
    assert [int.from_bytes(ids[0][i : i + 4], "little") for i in range(0, len(ids[0]), 4)] == lib.encode_ordinary(text)


def test_stretches_split_in_one_go_equal_the_pattern():
    own = DuckBpe(*public_ranks())
    stretches = {s for t in odd_texts() for s in (t, *t.split(" "), *(" " + x for x in t.split(" ")))} | {" 's", " \x1cx", " x\x85", " ​é", " a\nb"}
    assert own._words(stretches) == {s: own.split(s) for s in stretches}
