import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.point_in_time import BadRequest, NotFound, asof_runs, point_in_time
from strata.operators.registry import RECORD_SCHEMA


def rec(run_id, ds, at, n=1):
    return (run_id, ds, "1.0", at, n, "c", "s", "p", "h")


@pytest.fixture
def store(spark):
    # Two runs of 'prices': the later one revises history and adds a future row.
    rows = [("r1", "AAPL", "2026-01-02", 1.0), ("r1", "MSFT", "2026-01-02", 2.0), ("r1", "AAPL", "2026-01-05", 3.0),
            ("r2", "AAPL", "2026-01-02", 1.5), ("r2", "AAPL", "2026-01-05", 3.5), ("r2", "AAPL", "2026-01-09", 9.0)]
    return spark.createDataFrame(rows, "run_id string, symbol string, date string, close double")


@pytest.fixture
def recs(spark):
    return spark.createDataFrame(
        [rec("r1", "prices", dt.datetime(2026, 1, 5, 18)), rec("r2", "prices", dt.datetime(2026, 1, 8, 23, 59, 59))], RECORD_SCHEMA)


def test_no_look_ahead(spark, store, recs):
    out = point_in_time(store, recs, "prices", "2026-01-07")
    assert sorted((r["symbol"], r["date"], r["close"]) for r in out.collect()) == [
        ("AAPL", "2026-01-02", 1.0), ("AAPL", "2026-01-05", 3.0), ("MSFT", "2026-01-02", 2.0)]
    assert {r["ingestion_run_id"] for r in out.collect()} == {"r1"}
    # The run at exactly 23:59:59 is visible that day; its future row is not.
    out = point_in_time(store, recs, "prices", "2026-01-08", symbol="AAPL")
    assert sorted(r["close"] for r in out.collect()) == [1.5, 3.5]


def test_errors(spark, store, recs):
    with pytest.raises(NotFound):
        point_in_time(store, recs, "prices", "2026-01-04")
    with pytest.raises(ValueError):
        point_in_time(store, recs, "prices", "20260107")  # compact form would compare wrongly as text
    with pytest.raises(BadRequest):
        point_in_time(store.drop("symbol"), recs, "prices", "2026-01-07", symbol="AAPL")


def test_timestamp_date_column_compares_by_day(spark, recs):
    s = spark.createDataFrame([("r1", dt.datetime(2026, 1, 5, 12)), ("r1", dt.datetime(2026, 1, 6, 0))],
                              "run_id string, date timestamp_ntz")
    assert point_in_time(s, recs, "prices", "2026-01-05").count() == 1


def brute(requests, runs):
    out = {}
    for ds, day in requests:
        cut = dt.datetime.combine(day, dt.time(23, 59, 59))
        cands = [r for r in runs if r[1] == ds and r[3] <= cut]
        best = max(cands, key=lambda r: (r[3], r[0])) if cands else None
        out[(ds, day)] = best[0] if best else None
    return out


@pytest.mark.parametrize("bucket_days", [1, 3, 7, 30])
def test_asof_runs_matches_brute_force_with_a_hot_dataset(spark, bucket_days):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    runs = []
    for i in range(300):
        ds = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c"])
        at = t0 + dt.timedelta(seconds=rnd.randrange(0, 60 * 86400))
        if i % 25 == 0:
            at = at.replace(hour=23, minute=59, second=59, microsecond=0)
        runs.append(rec(f"run{i:04d}", ds, at, i))
    runs.append(rec("tieB", "a", t0 + dt.timedelta(days=5), 1))
    runs.append(rec("tieA", "a", t0 + dt.timedelta(days=5), 2))
    requests = [("hot", (t0 + dt.timedelta(days=rnd.randrange(-3, 65))).date()) for _ in range(400)]
    requests += [(ds, (t0 + dt.timedelta(days=d)).date()) for ds in ["a", "b", "c", "zz"] for d in range(-2, 63)]
    rdf = spark.createDataFrame(runs, RECORD_SCHEMA)
    qdf = spark.createDataFrame(requests, "dataset_name string, as_of date")
    got = {(r["dataset_name"], r["as_of"]): r["run_id"] for r in asof_runs(qdf, rdf, bucket_days).collect()}
    assert got == brute(set(requests), runs)


def test_asof_rows_over_a_snapshot_store(spark, tmp_path):
    from strata.operators.point_in_time import asof_rows
    from strata.sources.snapshots import read_store, run_path

    schema = "symbol string, date date, close double"
    runs = {
        "r1": (dt.datetime(2026, 1, 2, 18), [("A", dt.date(2026, 1, 1), 1.0), ("A", dt.date(2026, 1, 2), 2.0)]),
        "r2": (dt.datetime(2026, 1, 5, 9), [("A", dt.date(2026, 1, 2), 2.5), ("A", dt.date(2026, 1, 5), 5.0), ("B", dt.date(2026, 1, 6), 6.0)]),
    }
    for rid, (at, rows) in runs.items():
        spark.createDataFrame(rows, schema).write.parquet(run_path(str(tmp_path), "px", at.date(), rid))
    store = read_store(spark, str(tmp_path), "px", spark.createDataFrame([], schema).schema).withColumn("dataset_name", F.lit("px"))
    recs = spark.createDataFrame([rec(rid, "px", at, len(rows)) for rid, (at, rows) in runs.items()], RECORD_SCHEMA)
    reqs = spark.createDataFrame([("px", dt.date(2026, 1, d)) for d in (1, 2, 4, 5, 6)], "dataset_name string, as_of date")
    out = asof_rows(store, reqs, recs, run_keys=("dataset_name", "run_id"))
    got = sorted((r["as_of"].day, r["ingestion_run_id"], r["close"]) for r in out.collect())
    assert got == [(2, "r1", 1.0), (2, "r1", 2.0), (4, "r1", 1.0), (4, "r1", 2.0),
                   (5, "r2", 2.5), (5, "r2", 5.0), (6, "r2", 2.5), (6, "r2", 5.0), (6, "r2", 6.0)]


@pytest.mark.parametrize("name", ["pit_events", "pit_orders_symbol", "asof_rows_events", "pit_store"])
def test_without_the_date_filter_the_oracle_fails(spark, name, monkeypatch):
    """Each point-in-time query has rows that only ``date <= as_of`` hides, rows
    without a date among them; the three types of date column are covered."""
    import sys

    from strata.plans.catalog import QUERIES

    module = sys.modules["strata.operators.point_in_time"]
    sf = "/root/testdata/sf0.001"
    kept = QUERIES[name](spark, sf).count()
    monkeypatch.setattr(module, "date_visible", lambda *a, **k: None)
    monkeypatch.setattr(module, "_request_visible", lambda joined, *a: joined)
    assert QUERIES[name](spark, sf).count() > kept


def test_invalid_requests_fail_nothing_else(spark):
    requests = spark.createDataFrame([("a", "2026-01-05"), ("a", "20260105"), ("a", "2026-02-30"), ("a", None)], "dataset_name string, as_of string")
    records = spark.createDataFrame([("r", "a", dt.datetime(2026, 1, 1), 3)], "run_id string, dataset_name string, ingested_at timestamp_ntz, row_count long")
    assert [(r["as_of"], r["run_id"]) for r in asof_runs(requests, records).collect()] == [(dt.date(2026, 1, 5), "r")]
