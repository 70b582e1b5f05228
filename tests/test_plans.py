"""The physical plans keep the properties the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.plans.catalog import QUERIES
from strata.model import Column, Contract
from strata.operators.normalize import gate_summary
from strata.operators.registry import RECORD_SCHEMA, ingestion_history

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def pushed(p: str) -> str:
    return " ".join(line for line in p.split("\n") if "PushedFilters" in line)


def test_point_in_time_pushes_filters_into_the_scan(spark):
    p = plan(E.queries()["pit_events"](spark, SF))
    assert "EqualTo(event_type,click)" in pushed(p)
    assert "Exchange" not in p  # a single filtered scan, no shuffle


def test_symbol_filter_reaches_parquet(spark):
    p = plan(E.queries()["pit_orders_symbol"](spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in pushed(p)


def test_a_stored_run_is_read_by_folder_and_date(spark):
    p = plan(E.queries()["pit_store"](spark, SF))
    assert "LessThanOrEqual(date,2024-01-15)" in pushed(p) and "PartitionFilters: [isnotnull(run_id" in p


def test_latest_run_nulls_prune_the_store(spark, tmp_path):
    from strata.operators.health import latest_run_nulls

    rows = [("a", dt.date(2026, 1, d), d, None if d == 2 else 1.0) for d in (1, 2, 3)]
    spark.createDataFrame(rows, "dataset_name string, day date, k int, v double").write.partitionBy("dataset_name", "day").parquet(str(tmp_path / "s"))
    store = spark.read.schema("k int, v double, dataset_name string, day date").parquet(str(tmp_path / "s"))
    keys = spark.createDataFrame([("a", dt.date(2026, 1, 2))], "dataset_name string, day date")
    out = latest_run_nulls(store, keys, Contract("a", "1", (Column("k", "int"), Column("v", "float", True))), ["dataset_name", "day"])
    assert "dynamicpruning" in plan(out).lower()
    assert [(r["total_rows"], r["null_ratio_ok"]) for r in out.collect()] == [(1, False)]


def test_store_read_prunes_partitions(spark, tmp_path):
    from strata.operators.point_in_time import point_in_time
    from strata.sources.snapshots import read_store, run_path

    data = spark.createDataFrame([("A", "2026-01-02", 1.0)], "symbol string, date string, close double")
    for rid, day in [("r1", dt.date(2026, 1, 2)), ("r2", dt.date(2026, 1, 3))]:
        data.write.parquet(run_path(str(tmp_path), "prices", day, rid))
    recs = spark.createDataFrame(
        [("r1", "prices", "1", dt.datetime(2026, 1, 2, 9), 1, "c", "s", "p", "h"),
         ("r2", "prices", "1", dt.datetime(2026, 1, 3, 9), 1, "c", "s", "p", "h")], RECORD_SCHEMA)
    store = read_store(spark, str(tmp_path), "prices", data.schema)
    out = point_in_time(store, recs, "prices", "2026-01-02", symbol="A")
    p = plan(out)
    assert "PartitionFilters: [isnotnull(run_id" in p and "(run_id" in p and "= r1)" in p
    assert "EqualTo(symbol,A)" in pushed(p)
    assert [r["ingestion_run_id"] for r in out.collect()] == ["r1"]


def test_gate_shuffles_only_partial_counters(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b\n1,x\n2,y\n")
    from strata.sources.csv import csv_scan

    c = Contract("t", "1.0", (Column("a", "int"), Column("b", "float", True)))
    plan_text = plan(gate_summary(csv_scan(spark, str(p), ["a", "b"]), c))
    assert "partial_count_if" in plan_text or "partial_count" in plan_text
    before_exchange = plan_text.split("Exchange")[1]
    assert "Generate" not in before_exchange  # rows are never exploded before the shuffle


def test_history_top_k_uses_window_group_limit(spark):
    rows = [(f"r{i}", "d", "1", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i, "c", "s", "p", "h") for i in range(50)]
    df = ingestion_history(spark.createDataFrame(rows, RECORD_SCHEMA), 10)
    assert "WindowGroupLimit" in plan(df)
    assert df.count() == 10


def test_asof_join_forms_no_pairs(spark):
    p = plan(E.queries()["asof_bulk"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_python_udfs_in_registered_queries(spark):
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
