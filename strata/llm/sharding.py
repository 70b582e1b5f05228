"""Shard placement by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import quoted

SHARDS, SLOTS = 64, 65_537  # a prime at least a hundred times the shards keeps shares within 1 %


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Shard number of each slot. Every shard prefers the slots in an order of
    its own, offset + j * skip modulo the prime number of slots, both from a
    hash of its name; shards take turns, each claiming the next slot of its
    order that is free, until all are claimed."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime and at least that of the shards")
    seeds = [hashlib.sha256(name.encode()).digest() for name in shards]
    place = [int.from_bytes(s[:8]) % slots for s in seeds]
    skip = [int.from_bytes(s[8:16]) % (slots - 1) + 1 for s in seeds]
    table, free = [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            table[place[k]] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 60 bits of the key text's MD5 modulo the number of slots; null counts as empty."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``slot, shard``: at most a few MB for 65,537 slots, whatever the data."""
    return spark.createDataFrame(list(enumerate(shards[k] for k in lookup_table(shards, slots))), "slot int, shard string")


def place(docs: DataFrame, shards: list[str], id_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``row`` (each row of ``docs`` as a struct, whatever its column names),
    ``slot`` and ``shard``. One narrow pass: the table is broadcast, its size is
    that of ``slots``, and each key is looked up once. Rows with one id go to
    one shard; a null id counts as empty text; an empty table gives no rows."""
    table = table_frame(docs.sparkSession, shards, slots)
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), slot_of(quoted(id_col), slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: list[str], id_col: str = "doc_id", files_per_shard: int = 1, slots: int = SLOTS) -> None:
    """Write ``docs`` as Parquet, one folder per shard with ``files_per_shard``
    files at most: rows are spread over them by slot, so shards stay equal
    whatever the keys."""
    placed = place(docs, shards, id_col, slots)
    placed.repartition(len(shards) * files_per_shard, "shard", F.col("slot") % files_per_shard).select("row.*", "shard").write.partitionBy("shard").parquet(path)


def production_shards() -> list[str]:
    return [f"shard-{k:05d}" for k in range(SHARDS)]
