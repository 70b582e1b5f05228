import random
import zlib

import numpy as np
import pytest
import public_tokenizers as p
from tokenizers import Tokenizer as Whole

from strata.llm.common import Scratch
from strata.llm.packing import cut, fit_layout, full_patterns, nnls_counts, pack, public_tokenizer, sequences, token_pieces


def test_pieces_of_a_document():
    assert cut(1) == [(0, 1)] and cut(2048) == [(0, 2048)]
    assert cut(2049) == [(0, 1), (1, 2048)]
    assert cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    for n in range(1, 60):
        pieces = cut(n, 7)
        assert sum(x for _, x in pieces) == n and all(x == 7 for _, x in pieces[1:]) and pieces[0][1] <= 7


def test_patterns_are_all_ways_to_fill_a_sequence():
    for seed in range(5):
        rng = random.Random(seed)
        limit = rng.randint(5, 30)
        lengths = sorted(rng.sample(range(1, limit + 1), rng.randint(1, limit)))
        want = {(a, b, c) for a in lengths for b in [0, *lengths] for c in [0, *lengths] if a + b + c == limit and a >= b >= c}
        assert {tuple(x) for x in full_patterns(np.array(lengths), limit).tolist()} == want


def test_counts_fit_a_histogram_that_patterns_explain():
    patterns = np.array([[6, 4, 0], [5, 5, 0], [4, 3, 3]])
    histogram = np.bincount([6, 4] * 30 + [5, 5] * 20 + [4, 3, 3] * 10, minlength=11)
    assert nnls_counts(patterns, histogram).round().tolist() == [30, 20, 10]


def play(layout, histogram):
    """Every document of every length, placed by the table as the tasks do it."""
    keys, first, sequence, offset = layout.table()
    placed = {}
    for n in np.nonzero(histogram)[0]:
        for rank in range(histogram[n]):
            slot = np.searchsorted(keys, (int(n) << 48) | rank, side="right") - 1
            placed.setdefault(int(sequence[slot] + rank - first[slot]), []).append((int(offset[slot]), int(n)))
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_layouts_are_gapless_and_tight(seed):
    rng = np.random.default_rng(seed)
    limit = int(rng.integers(3, 80))
    lengths = rng.integers(1, limit + 1, int(rng.integers(0, 400)))
    if seed % 2:
        lengths = np.concatenate([lengths, np.full(300, lengths[0] if len(lengths) else 1)])  # one hot length
    histogram = np.bincount(lengths, minlength=limit + 1)
    layout = fit_layout(histogram, limit)
    placed = play(layout, histogram)
    assert sorted(placed) == list(range(layout.sequences))
    for parts in placed.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= limit
    assert layout.sequences <= -(-lengths.sum() // limit) * 1.25 + 1


def test_fewer_sequences_than_best_fit_alone_need_not_be_but_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(np.exp(rng.normal(6, 1, 20_000)).astype(int), 1, 2048)
    layout = fit_layout(np.bincount(lengths, minlength=2049))
    assert layout.sequences <= -(-lengths.sum() // 2048) + 10


def test_tokens_are_those_of_the_library():
    whole = Whole.from_file(p.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    own = public_tokenizer()
    rng = random.Random(3)
    chars = "aAbZz019 \t\n\r'.,-_éßñɏ"
    texts = ["", "  ", "<|endoftext|>", "漢字 and 🙂", "ɐ"] + ["".join(rng.choice(chars) for _ in range(200)) for _ in range(80)]
    texts += [chr(c) + "a " + chr(c) for c in range(0x250)]
    for t in texts:
        assert own.ids(t).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_frames(spark):
    rng = random.Random(5)
    texts = ["word " * rng.randint(0, 90) for _ in range(120)] + [None, "", "x y z " * 400]
    rows = [(i, t, i, "k") for i, t in enumerate(texts)] + [(7, texts[7], 0, "k"), (None, "a", 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string").repartition(4)
    pieces = token_pieces(df, limit=64, keep_ids=True)
    out = pack(pieces, Scratch(spark, "t2"), limit=64, salts=3).collect()
    own = public_tokenizer()
    want = []
    for i, t, _, _ in rows:
        ids = [*own.ids(t or "").tolist(), 0]
        want += [(i, k, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for k, (a, n) in enumerate(cut(len(ids), 64))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    for parts in by.values():
        at = 0
        for o, ids in sorted(parts):
            assert o == at
            at += len(ids)
        assert at <= 64
    joined = {r.sequence_id: r.ids for r in sequences(spark.createDataFrame(out)).collect()}
    assert joined == {k: [x for _, ids in sorted(v) for x in ids] for k, v in by.items()}
    assert pack(token_pieces(df.where("false")), Scratch(spark, "t2")).collect() == []
