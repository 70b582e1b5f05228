import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm.common import Scratch
from strata.llm.components import connected_components
from strata.llm.simhash import covering_masks, fingerprint, link_edges, simhash_components


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_the_definition():
    rng = random.Random(1)
    texts = [None, "", "  \t\n", "One", "Two Words", "A b\x0bc\x0cd", "É É É", "a b c d", "x " * 5000]
    texts += [" ".join(rng.choice("aAbcé") for _ in range(rng.randint(1, 40))) for _ in range(100)]
    for t in texts:
        assert fingerprint(None if t is None else t.encode()) == plain_fingerprint(t), t


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for i in range(64):
            for j in range(64) if radius == 2 else [i]:
                diff = (1 << i) | (1 << j)
                assert any(not m & diff for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_linking_matches_all_pairs_for_small_and_large_buckets(spark):
    rng = random.Random(7)
    fps = set()
    for size, spread in [(60, 2), (200, 4), (10, 8), (1, 0)] * 3:
        centre = rng.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(rng.randint(0, spread)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(signed(x) for x in fps)
    arr = np.array(fps, dtype=np.int64).view(np.uint64)
    links = [
        (fps[i], fps[j])
        for i in range(len(fps))
        for j in range(i)
        if int(np.bitwise_count(arr[i] ^ arr[j])) <= 2
    ]
    want = components(fps, links)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for row_bucket in (2, 16, 10_000):
        scratch = Scratch(spark, "t7")
        got = components(fps, [tuple(r) for r in link_edges(df, scratch, 2, row_bucket).collect()])
        assert got == want


def test_components_of_paths_hubs_and_repeats(spark):
    path = [(i, i + 1) for i in range(200, 330)]
    hub = [(7, i) for i in range(1000, 3000)]
    odd = [(5, 5), (7, 1000), (1000, 7), (None, 4), (4, None)]
    df = spark.createDataFrame(path + hub + odd, "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(df, Scratch(spark, "cc")).collect()}
    links = [x for x in path + hub if None not in x]
    assert got == components({x for e in links for x in e}, links)


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert connected_components(df, Scratch(spark, "cc")).collect() == []


def test_documents_nulls_repeats_and_clashing_columns(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until it rains"
    rows = [(3, base, 1, "x"), (1, base.upper(), 2, "y"), (3, base, 1, "x"), (8, None, 3, "z"), (6, "", 4, None), (9, "quite other words here", 5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string")
    got = sorted((r.doc_id, r.component_id) for r in simhash_components(df, Scratch(spark, "t7")).collect())
    assert got == [(1, 1), (3, 1), (3, 1), (6, 6), (8, 6), (9, 9)]
    empty = df.where(F.lit(False))
    assert simhash_components(empty, Scratch(spark, "t7")).collect() == []
