import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.model import Column, Contract
from strata.sources.manifest import verify_manifest
from strata.sources.registry_store import Registry
from strata.streaming.daily_volume import daily_volume_batch_via_stream, run_daily_volume
from strata.streaming.file_ingest import StreamIngestConfig, make_batch_handler, refused_files, run_stream_ingest

C = Contract("ticks", "1.0", (Column("symbol", "string"), Column("ts", "timestamp"), Column("price", "float", True)))


def _files(folder, contents):
    os.makedirs(folder, exist_ok=True)
    for i, text in enumerate(contents):
        with open(os.path.join(folder, f"part{i}.csv"), "w") as f:
            f.write(text)


def test_stream_ingest_is_idempotent_and_quarantines(spark, tmp_path):
    src = str(tmp_path / "in")
    _files(src, [
        "symbol,ts,price\nA,2026-01-02 10:00:00,1.5\nB,2026-01-02 10:00:01,2.5\n",
        "symbol,ts,price\nA,2026-01-03 10:00:00,N/A\n,2026-01-03 10:00:01,3.0\nC,2026-01-03 11:00:00,\n",
        "symbol,ts,price\nD,2026-01-04,4.0\n",
    ])
    clock = lambda: dt.datetime(2026, 1, 5, 8, 0, 0)
    cfg = StreamIngestConfig("ticks", "1.0", "me", "daily", C, src, str(tmp_path / "reg"), str(tmp_path / "store"),
                             str(tmp_path / "quarantine"), str(tmp_path / "ckpt"), max_files_per_trigger=1)
    run_stream_ingest(spark, cfg, clock=clock)
    reg = Registry(spark, cfg.registry_base)
    recs = reg.records()
    assert recs.count() == 3
    assert recs.agg(F.sum("row_count")).first()[0] == 4  # 2 + 1 + 1 clean rows
    bad = spark.read.parquet(str(tmp_path / "quarantine"))
    assert bad.count() == 2
    # Same checkpoint: nothing new.
    run_stream_ingest(spark, cfg, clock=clock)
    assert reg.records().count() == 3 and verify_manifest(spark, reg.manifest()).count() == 0


def _cfg(tmp_path, src, **kw):
    return StreamIngestConfig("ticks", "1.0", "me", "daily", C, src, str(tmp_path / "reg"), str(tmp_path / "store"),
                              str(tmp_path / "quarantine"), **{"checkpoint": str(tmp_path / "ckpt"), **kw})


def test_a_new_checkpoint_on_the_same_day_is_a_new_stream(spark, tmp_path):
    clock = lambda: dt.datetime(2026, 1, 5, 8)
    for k in (1, 2):  # two folders, each its own stream, batch 0 both times
        _files(str(tmp_path / f"in{k}"), [f"symbol,ts,price\nS{k},2026-01-02 10:00:00,{k}\n"])
    src = str(tmp_path / "in1")
    run_stream_ingest(spark, _cfg(tmp_path, src), clock=clock)
    _files(src, [f"symbol,ts,price\nS{k},2026-01-02 10:00:00,{k}\n" for k in (1, 2)])
    run_stream_ingest(spark, _cfg(tmp_path, src, checkpoint=str(tmp_path / "other")), clock=clock)
    reg = Registry(spark, str(tmp_path / "reg"))
    assert reg.records().count() == 2
    stored = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "store"))
    assert sorted(r["symbol"] for r in stored.collect()) == ["S1", "S1", "S2"]  # nothing of the second stream is lost


def test_a_replay_past_midnight_is_the_same_run(spark, tmp_path):
    """The handler is called again for batch 0 on the next day: before its record
    exists (crash) it replaces the first attempt, afterwards it does nothing."""
    src = str(tmp_path / "in")
    _files(src, ["symbol,ts,price\nA,2026-01-02 10:00:00,1.5\nB,2026-01-02 10:00:01,x\n"])
    cfg = _cfg(tmp_path, src)
    days = iter([dt.datetime(2026, 1, 5, 23, 59), dt.datetime(2026, 1, 6, 0, 1), dt.datetime(2026, 1, 7)])
    handle = make_batch_handler(spark, cfg, clock=lambda: next(days))
    os.makedirs(cfg.checkpoint)
    with open(os.path.join(cfg.checkpoint, "metadata"), "w") as f:
        f.write('{"id":"stream-1"}')
    batch = spark.createDataFrame([("A", "2026-01-02 10:00:00", "1.5", False), ("B", "2026-01-02", "x", False)],
                                  "symbol string, ts string, price string, _malformed boolean")
    recorded, Registry.record_ingestion = Registry.record_ingestion, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            handle(batch, 0)
    finally:
        Registry.record_ingestion = recorded
    handle(batch, 0)
    handle(batch, 0)
    reg = Registry(spark, cfg.registry_base)
    record = reg.records().collect()
    assert len(record) == 1 and "ingest_date=2026-01-05" in record[0]["partition_path"]
    for base in (cfg.store_base, cfg.quarantine_base):
        assert spark.read.option("recursiveFileLookup", "true").parquet(base).count() == 1
    assert verify_manifest(spark, reg.manifest()).count() == 0


def test_files_of_a_stream_are_read_by_their_own_header(spark, tmp_path):
    """Two column orders, a quoted line break, an empty file, a missing and an extra
    column: the bad files are kept whole, the others are not held up by them."""
    src = str(tmp_path / "in")
    _files(src, [
        'symbol,ts,price\nA,2026-01-02 10:00:00,1.5\n"B\nb",2026-01-02 10:00:01,\n',
        "price,symbol,ts\n2.5,C,2026-01-02 10:00:02\nx,D,2026-01-02 10:00:03\n",
        "symbol,ts\nE,2026-01-02 10:00:04\n",
        "symbol,ts,price,colour\nF,2026-01-02 10:00:05,1,red\n",
        "",
    ])
    cfg = _cfg(tmp_path, src, nullable_threshold=0.5)
    run_stream_ingest(spark, cfg, clock=lambda: dt.datetime(2026, 1, 5, 8))
    reg = Registry(spark, cfg.registry_base)
    record = reg.records().first()
    stored = spark.read.parquet(record["partition_path"]).select("symbol", "price").collect()
    assert sorted(map(tuple, stored), key=str) == [("A", 1.5), ("B\nb", None), ("C", 2.5)] and record["row_count"] == 3
    assert [r["symbol"] for r in spark.read.parquet(cfg.quarantine_base).collect()] == ["D"]
    refused = refused_files(spark, cfg.quarantine_base, "ticks").collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["column"], r["error_type"]) for r in refused) == [
        ("part2.csv", "price", "missing_column"), ("part3.csv", "colour", "unexpected_column")]
    assert {r["run_id"] for r in refused} == {record["run_id"]}
    lines = spark.read.parquet(f"{cfg.quarantine_base}/_files/dataset=ticks/run_id={record['run_id']}/lines")
    assert sorted(r["line"] for r in lines.collect()) == ["E,2026-01-02 10:00:04", "F,2026-01-02 10:00:05,1,red", "symbol,ts", "symbol,ts,price,colour"]
    report = reg.latest_health("ticks").first()
    assert report["status"] == "healthy" and report["null_ratio_ok"]
    assert verify_manifest(spark, reg.manifest()).count() == 0


def test_a_batch_of_bad_files_only_is_an_empty_run(spark, tmp_path):
    src = str(tmp_path / "in")
    _files(src, ["symbol,ts\nE,2026-01-02 10:00:04\n"])
    cfg = _cfg(tmp_path, src)
    run_stream_ingest(spark, cfg, clock=lambda: dt.datetime(2026, 1, 5, 8))
    reg = Registry(spark, cfg.registry_base)
    assert reg.records().first()["row_count"] == 0
    assert refused_files(spark, cfg.quarantine_base, "ticks").count() == 1
    assert refused_files(spark, cfg.quarantine_base, "other").count() == 0
    assert not reg.latest_health("ticks").first()["null_ratio_ok"]  # no rows: nothing to vouch for


def test_columns_beyond_the_contract_may_be_allowed(spark, tmp_path):
    src = str(tmp_path / "in")
    _files(src, ["colour,symbol,ts,price\nred,F,2026-01-02 10:00:05,1\n"])
    cfg = _cfg(tmp_path, src, strict_columns=False)
    run_stream_ingest(spark, cfg, clock=lambda: dt.datetime(2026, 1, 5, 8))
    assert Registry(spark, cfg.registry_base).records().first()["row_count"] == 1


def test_daily_volume_stream_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    got = daily_volume_batch_via_stream(spark, sf, glob="events.parquet")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    want = ev.groupBy(F.col("event_type").alias("dataset_name"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    newest = ev.agg(F.max("ts")).first()[0]
    final = [r for r in want.collect() if dt.datetime.combine(r["day"], dt.time()) + dt.timedelta(days=2) <= newest]
    assert sorted(got.collect()) == sorted(final) and final


def test_append_mode_drops_late_rows(spark, tmp_path):
    src = tmp_path / "ev"
    os.makedirs(src)
    # A row is judged late against the watermark of the previous batch, so the
    # late day-2 row comes two batches after the watermark passed day 2.
    rows = [
        [("a", dt.datetime(2026, 1, 1, 1)), ("a", dt.datetime(2026, 1, 2, 1)), ("a", dt.datetime(2026, 1, 3, 1))],
        [("a", dt.datetime(2026, 1, 10, 1))],
        [("a", dt.datetime(2026, 1, 11, 1))],
        [("a", dt.datetime(2026, 1, 2, 5)), ("a", dt.datetime(2026, 1, 12, 1))],  # first row is far too late
        [("a", dt.datetime(2026, 1, 20, 1))],
    ]
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, "event_type string, ts timestamp_ntz").coalesce(1).write.parquet(str(src / f"b{i}"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    flat = tmp_path / "flat"
    os.makedirs(flat)
    for i in range(len(rows)):
        for f in os.listdir(src / f"b{i}"):
            if f.endswith(".parquet"):
                os.link(src / f"b{i}" / f, flat / f"b{i}-{f}")
                t = 1_700_000_000 + 60 * i  # the stream takes files in modification-time order
                os.utime(flat / f"b{i}-{f}", (t, t))
    run_daily_volume(spark, str(flat), out, ck, mode="append", max_files_per_trigger=1)
    got = {(r["day"], r["row_count"]) for r in spark.read.parquet(out).collect()}
    # Day 2 counts only its on-time row; days up to the watermark are final and emitted.
    assert (dt.date(2026, 1, 2), 1) in got
    assert (dt.date(2026, 1, 20), 1) not in got  # still open when the input ended
    # A replayed batch writes the folder of its number again, whatever the mode.
    folders = sorted(f for f in os.listdir(out) if f.startswith("batch_id="))
    assert len(folders) == len(set(folders)) >= 2
