import hashlib
from collections import Counter

import pytest

from strata.llm.sharding import SLOTS, lookup_table, place, production_shards, write_shards


def plain_table(shards, slots):
    orders = []
    for name in shards:
        h = hashlib.sha256(name.encode()).digest()
        offset, skip = int.from_bytes(h[:8]) % slots, int.from_bytes(h[8:16]) % (slots - 1) + 1
        orders.append(iter([(offset + j * skip) % slots for j in range(slots)]))
    table = {}
    while len(table) < slots:
        for k, order in enumerate(orders):
            slot = next((s for s in order if s not in table), None)
            if slot is not None:
                table[slot] = k
    return [table[s] for s in range(slots)]


def test_table_matches_turn_taking_and_is_even():
    for n, slots in ((1, 7), (3, 7), (7, 7), (5, 101)):
        names = [f"s{i}" for i in range(n)]
        assert lookup_table(names, slots) == plain_table(names, slots)
    counts = Counter(lookup_table(production_shards()))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_slots_move_when_a_shard_goes():
    names = production_shards()
    before, after = lookup_table(names), lookup_table(names[:-1])
    moved = sum(names[a] != names[b] for a, b in zip(before, after, strict=True))
    assert moved / SLOTS < 0.06


def test_bad_tables():
    for names, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            lookup_table(names, slots)


def test_placement_matches_brute_force(spark, tmp_path):
    names = [f"s{i}" for i in range(5)]
    rows = [(i, f"t{i}", i, "z") for i in range(300)] + [(7, "again", 0, "z"), (None, None, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int, shard string").repartition(3)
    table = lookup_table(names, 101)

    def shard(i):
        return names[table[int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) % 101]]

    got = sorted(((r.row.doc_id, r.row.text, r.shard) for r in place(df, names, slots=101).collect()), key=repr)
    assert got == sorted(((i, t, shard(i)) for i, t, _, _ in rows), key=repr)
    assert place(df.where("false"), names, slots=101).collect() == []
    out = str(tmp_path / "out")
    write_shards(df.select("doc_id", "text"), out, names, files_per_shard=2, slots=101)
    back = spark.read.parquet(out)
    assert sorted(((r.doc_id, r.text, r.shard) for r in back.collect()), key=repr) == got
