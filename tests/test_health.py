"""Health checks: the reference's cases plus the boundaries it leaves untested."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.model import Column, Contract
from strata.operators.health import (
    aggregate_status,
    check_freshness,
    check_null_ratio,
    check_schema_hash,
    check_volume,
    volume_backfill,
)
from strata.operators.registry import RECORD_SCHEMA, latest_ingestion

NOW = dt.datetime(2024, 6, 1, 12, 0, 0)


def records(spark, counts, dataset="prices", step_days=1, end=NOW):
    """Newest first, one record per step back from ``end``."""
    rows = []
    for i, c in enumerate(counts):
        at = end - dt.timedelta(days=i * step_days)
        rows.append((f"run{i:03d}", dataset, "1.0", at, c, "chk", "src", "part", "h1"))
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def regs(spark, freq="daily", h="h1", name="prices"):
    return spark.createDataFrame([(name, freq, h)], "name string, expected_frequency string, schema_hash string")


def fresh_one(spark, freq, ingested_at, now=NOW):
    recs = spark.createDataFrame([], RECORD_SCHEMA) if ingested_at is None else records(spark, [1], end=ingested_at)
    return check_freshness(regs(spark, freq), latest_ingestion(recs), now).first()


def test_freshness_on_demand_without_record(spark):
    r = fresh_one(spark, "on_demand", None)
    assert r["freshness_ok"] and r["freshness_reason"] == "on_demand_no_sla"


def test_freshness_no_record(spark):
    r = fresh_one(spark, "daily", None)
    assert not r["freshness_ok"] and r["freshness_reason"] == "no_ingestion_record_found"


@pytest.mark.parametrize(
    "freq,age,ok",
    [("daily", dt.timedelta(hours=1), True), ("daily", dt.timedelta(hours=30), False),
     ("daily", dt.timedelta(hours=26), True), ("daily", dt.timedelta(hours=26, microseconds=1), False),
     ("intraday", dt.timedelta(hours=4), True), ("weekly", dt.timedelta(days=8, seconds=1), False),
     ("monthly", dt.timedelta(days=33), True), ("daily", -dt.timedelta(hours=5), True)],
)
def test_freshness_age(spark, freq, age, ok):
    r = fresh_one(spark, freq, NOW - age)
    assert r["freshness_ok"] is ok
    assert r["max_age_seconds"] == {"daily": 93600, "intraday": 14400, "weekly": 691200, "monthly": 2851200}[freq]


def vol(spark, counts):
    if not counts:
        return None
    return check_volume(records(spark, counts)).first()


def test_volume_cases(spark):
    assert vol(spark, []) is None  # no row: the report marks no_ingestion_history
    r = vol(spark, [100, 105])
    assert r["volume_ok"] and r["volume_reason"] == "insufficient_history" and r["records_available"] == 2
    assert vol(spark, [100, 101, 102])["volume_reason"] == "insufficient_history"
    assert vol(spark, [100, 101, 102, 103])["volume_reason"] is None
    assert vol(spark, [100, 100, 102, 98, 101, 99, 103, 97, 100, 101])["volume_ok"]
    base = [100, 102, 98, 101, 99, 103, 97, 100, 101]
    mean = sum(base) / len(base)
    std = (sum((x - mean) ** 2 for x in base) / len(base)) ** 0.5
    assert not vol(spark, [int(mean + 10 * std + 1000)] + base)["volume_ok"]
    assert vol(spark, [100, 100, 100, 100, 100])["volume_ok"]
    assert not vol(spark, [200, 100, 100, 100, 100])["volume_ok"]


def test_volume_exact_boundary(spark):
    # baseline 0, 6 (mean 3, sigma 3): bounds are exactly -6 and 12, inclusive.
    assert vol(spark, [12, 0, 6, 0, 6])["volume_ok"]
    assert not vol(spark, [13, 0, 6, 0, 6])["volume_ok"]


def test_volume_uses_newest_31(spark):
    # Baseline = 30 x 100 (sigma 0), so 101 fails; the 32nd record (102) would
    # give sigma > 0 and let 101 pass if it were wrongly included.
    r = vol(spark, [101] + [100] * 30 + [102])
    assert r["records_available"] == 31 and r["baseline_n"] == 30 and not r["volume_ok"]
    assert not vol(spark, [10_000] + [100] * 30)["volume_ok"]


def test_volume_backfill_matches_latest(spark):
    counts = [100, 100, 102, 98, 101, 99, 103, 97, 100, 101, 250]
    bf = volume_backfill(records(spark, counts)).orderBy(F.col("ingested_at").desc()).collect()
    assert bf[0]["volume_ok"] == vol(spark, counts)["volume_ok"]
    assert bf[-1]["volume_reason"] == "insufficient_history"


C = Contract("prices", "1.0", (Column("date", "string"), Column("close", "float"), Column("volume", "int", True)))


def nulls(spark, rows, schema="date string, close double, volume bigint", threshold=0.10):
    df = spark.createDataFrame(rows, schema).withColumn("dataset_name", F.lit("prices"))
    return check_null_ratio(df, C, ["dataset_name"], threshold).first()


def test_null_ratio_cases(spark):
    clean = [(f"d{i}", 100.0 + i, 1000 * i) for i in range(20)]
    assert nulls(spark, []) is None  # no group: the report marks empty_dataframe
    assert nulls(spark, clean)["null_ratio_ok"]
    assert not nulls(spark, [("d", None, 1)] + clean)["null_ratio_ok"]
    assert not nulls(spark, [("d", float("nan"), 1)] + clean)["null_ratio_ok"]
    five = [(f"d{i}", 1.0, None if i < 5 else i) for i in range(100)]
    fifteen = [(f"d{i}", 1.0, None if i < 15 else i) for i in range(100)]
    ten = [(f"d{i}", 1.0, None if i < 10 else i) for i in range(100)]
    assert nulls(spark, five)["null_ratio_ok"]
    assert not nulls(spark, fifteen)["null_ratio_ok"]
    assert nulls(spark, ten)["null_ratio_ok"]  # exactly the threshold passes


def test_null_ratio_missing_column(spark):
    r = nulls(spark, [("d", 1.0)], schema="date string, close double")
    assert not r["null_ratio_ok"]
    missing = [c for c in r["columns"] if c["column_name"] == "volume"][0]
    assert missing["reason"] == "column_missing_from_dataframe" and missing["null_ratio"] is None


def test_schema_hash(spark):
    recs = latest_ingestion(records(spark, [1]))
    assert check_schema_hash(regs(spark, h="h1"), recs).first()["schema_hash_ok"]
    assert not check_schema_hash(regs(spark, h="h2"), recs).first()["schema_hash_ok"]
    empty = latest_ingestion(spark.createDataFrame([], RECORD_SCHEMA))
    r = check_schema_hash(regs(spark), empty).first()
    assert not r["schema_hash_ok"] and r["schema_hash_reason"] == "no_ingestion_record_found"


@pytest.mark.parametrize(
    "flags,status",
    [((True, True, True, True), "healthy"), ((False, True, True, True), "degraded"), ((False, False, True, True), "degraded"),
     ((False, False, False, True), "failing"), ((True, True, True, False), "failing")],
)
def test_status(spark, flags, status):
    df = spark.createDataFrame([flags], "f boolean, v boolean, n boolean, s boolean")
    assert df.select(aggregate_status(F.col("f"), F.col("v"), F.col("n"), F.col("s"))).first()[0] == status


def test_volume_backfill_bucketed_equals_plain_window_with_a_hot_dataset(spark):
    import random

    from pyspark.sql.window import Window

    rnd = random.Random(11)
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for i in range(600):
        ds = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b"])
        gap_days = rnd.choice([0, 0, 0, 1, 3, 20])  # dense stretches and long gaps
        t0 = t0 + dt.timedelta(days=gap_days, minutes=rnd.randrange(1, 300))
        rows.append((f"r{i:04d}", ds, "1", t0, rnd.randrange(50, 150), "c", "s", "p", "h"))
    recs = spark.createDataFrame(rows, RECORD_SCHEMA)
    got = {r["run_id"]: (r["baseline_n"], r["volume_ok"]) for r in volume_backfill(recs, bucket_days=3).collect()}
    w = Window.partitionBy("dataset_name").orderBy("ingested_at", "run_id").rowsBetween(-30, -1)
    plain = recs.select("run_id", F.count(F.lit(1)).over(w).alias("n"), F.sum("row_count").over(w).alias("s"),
                        F.sum(F.col("row_count") * F.col("row_count")).over(w).alias("q"), "row_count").collect()
    want = {}
    for r in plain:
        n, s_, q, c = r["n"], r["s"] or 0, r["q"] or 0, r["row_count"]
        ok = True if n + 1 < 4 else (n * c - s_) ** 2 <= 9 * (n * q - s_ * s_)
        want[r["run_id"]] = (n, ok)
    assert got == want
