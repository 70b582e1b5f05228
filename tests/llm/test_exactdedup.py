import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch
from strata.llm.exactdedup import dedup_rows, normalised, read_state, run_stream, sha256_hex

A_Z = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(A_Z)].append(i)
    out = []
    for i, t in rows:
        key = (t or "").translate(A_Z)
        out.append((i, max(groups[key]), len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((r.row.doc_id, r.keep_id, r.group_size, r.digest) for r in df.collect())


def fixture_rows():
    rng = random.Random(3)
    texts = ["Same Text", "same text", "SAME TEXT ", "", None, "Éa", "éa", "ÉA", "İx", "x" * 200_000, "X" * 200_000, "a\n", "a"]
    return [(i, rng.choice(texts)) for i in range(400)]


def test_groups_match_brute_force(spark):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = dedup_rows(df, Scratch(spark, "t3")).cache()
    assert rows_of(out) == brute(rows)
    assert {r.row.doc_id for r in out.where("kept").collect()} == {k for _, k, _, _ in brute(rows)}


def test_colliding_digests_are_told_apart_by_full_bytes(spark):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weak = dedup_rows(df, Scratch(spark, "t3"), digest=lambda t: F.length(t).cast("string"))
    got = sorted((r.row.doc_id, r.keep_id, r.group_size) for r in weak.collect())
    assert got == [x[:3] for x in brute(rows)]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(5, "a", "x", 1), (5, "a", "x", 1), (None, "a", "y", 2), (7, "b", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, keep_id int")
    out = dedup_rows(df, Scratch(spark, "t3")).collect()
    assert sorted((r.row.digest or "", r.group_size, r.keep_id) for r in out) == [("", 1, 7), ("x", 3, 5), ("x", 3, 5), ("y", 3, 5)]
    assert sum(r.kept for r in out) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert dedup_rows(df, Scratch(spark, "t3")).collect() == []


def test_state_goes_on_without_expiry(spark, tmp_path):
    """A second run on the same checkpoint adds new files to the old state."""
    folder, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    schema = T.StructType().add("id", "long").add("text", "string")

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("locator")
        run_stream(stream.select("id", sha256_hex(normalised(F.col("text"))).alias("digest"), where), ck)
        return {(r.keep.id, r.n) for r in read_state(spark, ck).collect()}

    assert feed([(1, "a"), (2, "A"), (3, "b")]) == {(2, 2), (3, 1)}
    assert feed([(9, "a"), (0, "b"), (4, "c")]) == {(9, 3), (3, 2), (4, 1)}


@pytest.mark.parametrize("n", [2])
def test_one_large_group(spark, n):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"))
    out = dedup_rows(df, Scratch(spark, "t3"))
    assert out.groupBy("keep_id", "group_size").count().collect() == [(2999, 3000, 3000)]
