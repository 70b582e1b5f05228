"""End-to-end ingestion: determinism, idempotence, failure demos, drift, manifests."""

import csv
import datetime as dt
import gzip
import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.api import get_data, get_data_response
from strata.model import Column, Contract
from strata.operators.registry import RECORD_SCHEMA
from strata.plans.ingest import IngestionConfig, compute_run_id, ingest, run_health
from strata.sources.manifest import manifest_checksum, verify_manifest
from strata.session import ensure_checkpoint_dir
from strata.sources.registry_store import Registry

NOW = dt.datetime(2026, 3, 11, 9, 0, 0)


def cfg(tmp_path, contract, source, **kw):
    return IngestionConfig(
        dataset_name="prices", version="1.0", owner="test", expected_frequency="daily", contract=contract,
        source_path=source, registry_base=str(tmp_path / "registry"), store_base=str(tmp_path / "store"), **kw)


def test_happy_path_and_rerun(spark, tmp_path, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv)
    r1 = ingest(spark, c, now=NOW)
    assert r1.success and r1.row_count == 10 and r1.status == "healthy" and not r1.rerun
    assert r1.run_id == compute_run_id("prices", prices_csv, prices_contract.schema_hash(), NOW.date())
    assert f"run_id={r1.run_id}" in r1.partition_path
    data = spark.read.parquet(r1.partition_path)
    assert data.columns == ["date", "close", "volume"] and data.count() == 10
    assert dict(data.dtypes) == {"date": "string", "close": "double", "volume": "bigint"}

    r2 = ingest(spark, c, now=NOW + dt.timedelta(hours=1))
    assert r2.success and r2.rerun and r2.run_id == r1.run_id and r2.row_count == 10
    assert r2.source_changed is False
    reg = Registry(spark, c.registry_base)
    assert reg.records().count() == 1
    assert reg.table("health_reports").count() == 2
    latest = reg.latest_health("prices").first()
    assert latest["status"] == "healthy" and latest["checked_at"] == NOW + dt.timedelta(hours=1)
    rec = reg.ingestion_as_of("prices", dt.datetime(2026, 3, 11, 23, 59, 59))
    assert rec["run_id"] == r1.run_id and len(rec["checksum"]) == 64
    assert reg.ingestion_as_of("prices", dt.datetime(2026, 3, 10, 23, 59, 59)) is None


def _csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


@pytest.mark.parametrize(
    "text,column,etype",
    [("date,close\n2026-01-02,1.0\n2026-01-03,2.0\n", "volume", "missing_column"),
     ("date,close,volume\n2026-01-02,1.0,1\n2026-01-03,,2\n2026-01-04,3.0,3\n", "close", "unexpected_null"),
     ("date,close,volume\n2026-01-02,1.0,1\n2026-01-03,N/A,2\n2026-01-04,3.0,3\n", "close", "type_mismatch")],
)
def test_failure_demos_write_nothing(spark, tmp_path, prices_contract, text, column, etype):
    c = cfg(tmp_path, prices_contract, _csv(tmp_path, "bad.csv", text))
    r = ingest(spark, c, now=NOW)
    assert not r.success and r.row_count == 0
    assert [(e[0], e[1]) for e in r.errors] == [(column, etype)]
    assert f"[{etype}] {column}" in r.error
    assert not os.path.exists(r.partition_path)
    reg = Registry(spark, c.registry_base)
    assert reg.records().count() == 0 and reg.registrations().count() == 0
    assert not os.path.exists(c.store_base) or os.listdir(c.store_base) == []


def test_extra_columns_strict_and_lenient(spark, tmp_path, prices_contract):
    src = _csv(tmp_path, "extra.csv", "date,close,volume,note\n2026-01-02,1.0,1,x\n")
    strict = ingest(spark, cfg(tmp_path, prices_contract, src), now=NOW)
    assert not strict.success and strict.errors[0][:2] == ("note", "unexpected_column")
    lenient = ingest(spark, cfg(tmp_path, prices_contract, src, strict_columns=False), now=NOW)
    assert lenient.success and spark.read.parquet(lenient.partition_path).columns == ["date", "close", "volume"]


def test_missing_source_is_reported(spark, tmp_path, prices_contract):
    r = ingest(spark, cfg(tmp_path, prices_contract, str(tmp_path / "nope.csv")), now=NOW)
    assert not r.success and "cannot be read as CSV: FileNotFoundError" in r.error


def test_rerun_reports_a_changed_source(spark, tmp_path, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv)
    ingest(spark, c, now=NOW)
    with open(prices_csv, "a") as f:
        f.write("2026-03-11,111.0,11000\n")
    r = ingest(spark, c, now=NOW + dt.timedelta(hours=2))
    assert r.rerun and r.source_changed is True and r.row_count == 10  # recorded run kept, change reported


def test_drift_sequence_a_b_a(spark, tmp_path, prices_contract, prices_csv):
    b = Contract("prices", "1.0", (Column("date", "string"), Column("close", "float"), Column("volume", "int", nullable=False)))
    ra = ingest(spark, cfg(tmp_path, prices_contract, prices_csv), now=NOW)
    rb = ingest(spark, cfg(tmp_path, b, prices_csv), now=NOW + dt.timedelta(minutes=1))
    ra2 = ingest(spark, cfg(tmp_path, prices_contract, prices_csv), now=NOW + dt.timedelta(minutes=2))
    assert ra.status == "healthy" and rb.status == "healthy"
    assert ra2.rerun and ra2.status == "failing"  # latest record is B's hash, registration is A's


def test_unregistered_health_raises(spark, tmp_path, prices_contract, prices_csv):
    reg = Registry(spark, str(tmp_path / "registry"))
    with pytest.raises(ValueError):
        run_health(spark, reg, "prices", prices_csv, prices_contract, NOW)


def test_manifest_verification(spark, tmp_path, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv)
    r = ingest(spark, c, now=NOW)
    reg = Registry(spark, c.registry_base)
    m = reg.manifest(r.run_id)
    assert m.count() >= 1 and verify_manifest(spark, m).count() == 0
    victim = m.first()["path"].replace("file:", "")
    with open(victim, "r+b") as f:
        f.seek(10)
        f.write(b"\x00\x01\x02")
    # The local file system's own checksum refuses the file: reported, no crash.
    assert [b["status"] for b in verify_manifest(spark, m).collect()] == ["missing"]
    crc = os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc")
    os.unlink(crc)  # a store without its own checksums (object stores): our digest catches it
    assert [b["status"] for b in verify_manifest(spark, m).collect()] == ["changed"]
    assert [b["status"] for b in verify_manifest(spark, m, root=c.store_base).collect()] == ["changed"]


def test_registry_upsert_and_listing(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    reg.register_dataset("a", "1.0", "me", "daily", "h1", at=dt.datetime(2026, 1, 1))
    reg.register_dataset("a", "1.1", "me", "weekly", "h2", "desc", at=dt.datetime(2026, 2, 1))
    reg.register_dataset("b", "1.0", "me", "on_demand", "h3", at=dt.datetime(2026, 1, 5))
    a = reg.get_dataset("a")
    assert (a["version"], a["expected_frequency"], a["schema_hash"], a["description"]) == ("1.1", "weekly", "h2", "desc")
    assert a["registered_at"] == dt.datetime(2026, 1, 1)
    assert reg.get_dataset("zz") is None and reg.list_datasets().count() == 2
    assert {r["dataset_name"]: r["status"] for r in reg.health_listing().collect()} == {"a": "unknown", "b": "unknown"}
    with pytest.raises(ValueError):
        reg.register_dataset("c", "1.0", "me", "hourly", "h")


def test_record_first_writer_wins_and_history(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    base = dict(dataset_name="a", version="1.0", row_count=1, checksum="c", source_path="s", partition_path="p", schema_hash="h")
    for i in range(12):
        reg.record_ingestion(dict(base, run_id=f"r{i:02d}", ingested_at=dt.datetime(2026, 1, 1) + dt.timedelta(days=i)))
    reg.record_ingestion(dict(base, run_id="r00", ingested_at=dt.datetime(2030, 1, 1), row_count=99))
    assert reg.records().count() == 12
    assert reg.records().where(F.col("run_id") == "r00").first()["row_count"] == 1
    hist = reg.ingestion_history("a", 10).orderBy("rank").collect()
    assert [h["run_id"] for h in hist] == [f"r{i:02d}" for i in range(11, 1, -1)]
    # Equal ingested_at: the larger run_id wins, deterministically.
    reg.record_ingestion(dict(base, run_id="zz", ingested_at=dt.datetime(2026, 1, 12)))
    assert reg.ingestion_as_of("a", dt.datetime(2026, 1, 12, 23, 59, 59))["run_id"] == "zz"


def test_class_entry_points(spark, tmp_path, prices_contract, prices_csv):
    from strata.operators.validate import SchemaValidator
    from strata.plans.ingest import HealthReporter, IngestionPipeline

    c = cfg(tmp_path, prices_contract, prices_csv)
    res = IngestionPipeline(spark, c).run(now=NOW)
    assert res.success
    reg = Registry(spark, c.registry_base)
    df = spark.read.parquet(res.partition_path)
    assert SchemaValidator(strict_columns=True).validate(df, prices_contract).valid
    report = HealthReporter(reg, nullable_threshold=0.10).run("prices", df, prices_contract, now=NOW)
    assert report["status"] == "healthy" and report["details"]["null_ratio"]["total_rows"] == 10
    with pytest.raises(ValueError):
        HealthReporter(reg).run("unknown", df, prices_contract, now=NOW)


def test_registry_logs_are_partitioned_by_dataset(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    base = dict(version="1.0", row_count=1, checksum="c", source_path="s", partition_path="p", schema_hash="h",
                ingested_at=dt.datetime(2026, 1, 1))
    reg.record_ingestion(dict(base, run_id="r1", dataset_name="2024"))  # a name that looks like a number
    reg.record_ingestion(dict(base, run_id="r2", dataset_name="b"))
    parts = sorted(d for d in os.listdir(reg.path("ingestion_records")) if d.startswith("dataset_name="))
    assert parts == ["dataset_name=2024", "dataset_name=b"]
    recs = reg.records("2024")
    assert recs.columns == [f.name for f in __import__("strata.operators.registry", fromlist=["x"]).RECORD_SCHEMA.fields]
    assert [r["dataset_name"] for r in recs.collect()] == ["2024"]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(recs._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(dataset_name" in plan
    assert reg.has_run("r2", "b") and not reg.has_run("r2", "2024")


# --- CSV dialect and headers -------------------------------------------------------

NOTES = Contract("notes", "1.0", (Column("bid", "float"), Column("ask", "float"), Column("note", "string", nullable=True)))


def test_standard_quoting(spark, tmp_path):
    """What Python's csv module writes is read back as it was."""
    notes = ['He said "hi"', "a, b", '{"a": 1, "b": 2}', '"C:\\"', "back\\slash", "two\nlines", "plain"]
    path = tmp_path / "q.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["bid", "ask", "note"])
        w.writerows([i, i + 1, n] for i, n in enumerate(notes))
    r = ingest(spark, cfg(tmp_path, NOTES, str(path)), now=NOW)
    assert r.success, r.error
    assert [x["note"] for x in spark.read.parquet(r.partition_path).orderBy("bid").collect()] == notes


def test_each_file_of_a_folder_has_its_own_header(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    (src / "a.csv").write_text("bid,ask,note\n1,2,x\n")
    (src / "b.csv").write_text("\n\nask,note,bid\n20,y,10\n")  # empty lines first, other order
    (src / "c.csv").write_text("")
    with gzip.open(src / "d.csv.gz", "wt") as f:
        f.write("note, bid ,ask\nz,100,200\n")
    r = ingest(spark, cfg(tmp_path, NOTES, str(src)), now=NOW)
    assert r.success and r.row_count == 3, r.error
    assert sorted(tuple(x) for x in spark.read.parquet(r.partition_path).collect()) == [(1, 2, "x"), (10, 20, "y"), (100, 200, "z")]
    (src / "e.csv").write_text("bid,asked,note\n1,2,x\n")
    r = ingest(spark, cfg(tmp_path, NOTES, str(src)), now=NOW + dt.timedelta(days=1))
    assert [(e[0], e[1]) for e in r.errors] == [("ask", "missing_column"), ("asked", "unexpected_column")]


def test_signed_nan_is_a_float(spark, tmp_path):
    r = ingest(spark, cfg(tmp_path, NOTES, _csv(tmp_path, "n.csv", "bid,ask,note\n-nan,+NaN,\n")), now=NOW)
    assert not r.errors and r.row_count == 1 and r.health_report["details"]["null_ratio"]["columns"][0]["null_count"] == 1


# --- names that look like ours ---------------------------------------------------------

def test_user_columns_of_any_name_survive(spark, tmp_path):
    names = ["run_id", "dataset_name", "ingested_at", "px.close", "ingestion_run_id"]
    c = Contract("own", "1.0", tuple(Column(n, "string", nullable=n == "dataset_name") for n in names))
    src = _csv(tmp_path, "own.csv", ",".join(names) + "\n" + "".join(f"r{i},,t{i},{i},u{i}\n" for i in range(4)))
    conf = IngestionConfig("own", "1.0", "me", "daily", c, src, str(tmp_path / "reg"), str(tmp_path / "store"))
    r = ingest(spark, conf, now=NOW)
    assert r.success and r.status == "degraded"  # dataset_name is null in every row
    columns = {x["column_name"]: x["null_count"] for x in r.health_report["details"]["null_ratio"]["columns"]}
    assert columns == {"run_id": 0, "dataset_name": 4, "ingested_at": 0, "px.close": 0, "ingestion_run_id": 0}
    reg = Registry(spark, conf.registry_base)
    data = get_data(spark, reg, "own", NOW.date().isoformat())
    assert data.columns == [*names, "_ingestion_run_id", "_ingested_at"]
    assert sorted(x["run_id"] for x in data.collect()) == ["r0", "r1", "r2", "r3"]
    response = get_data_response(spark, reg, "own", NOW.date().isoformat())
    assert (response["row_count"], response["ingestion_run_id"], response["symbol"]) == (4, r.run_id, None)
    assert response["rows"].columns == names


# --- crashes, files, logs -----------------------------------------------------------------

def test_a_crash_before_the_record_leaves_no_false_alarm(spark, tmp_path, prices_contract, prices_csv, monkeypatch):
    c = cfg(tmp_path, prices_contract, prices_csv)
    monkeypatch.setattr(Registry, "record_ingestion", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest(spark, c, now=NOW)
    monkeypatch.undo()
    r = ingest(spark, c, now=NOW)
    assert r.success and not r.rerun
    reg = Registry(spark, c.registry_base)
    assert reg.table("file_manifest").count() == 2 * reg.manifest(r.run_id).count()
    assert verify_manifest(spark, reg.manifest()).count() == 0
    assert not os.path.exists(os.path.join(c.store_base, "_staging"))


def test_files_are_bounded_and_the_source_is_read_once(spark, tmp_path, prices_contract, prices_csv):
    r = ingest(spark, cfg(tmp_path, prices_contract, prices_csv, max_records_per_file=3), now=NOW)
    files = [f for f in os.listdir(r.partition_path) if f.endswith(".parquet")]
    assert len(files) >= 4 and r.row_count == 10
    assert set(r.timings) == {"lookup", "write", "manifest", "registry", "health"}  # no gate pass, no second read


def test_checksum_of_many_files_in_two_levels(spark):
    rows = spark.range(100_000).selectExpr("'r' AS run_id", "concat('p/f', id) AS path", "id AS length", "sha2(cast(id AS string), 256) AS sha256")
    one = manifest_checksum(rows).first()
    assert one["n_files"] == 100_000 and one["checksum"] == manifest_checksum(rows.repartition(7)).first()["checksum"]
    assert manifest_checksum(rows.where("length <> 5")).first()["checksum"] != one["checksum"]


def test_compaction_keeps_the_views_and_concurrent_appends(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    base = dict(dataset_name="a", version="1.0", row_count=1, checksum="c", source_path="s", partition_path="p", schema_hash="h")
    for i in range(6):
        reg.register_dataset("a", f"1.{i}", "me", "daily", "h", at=dt.datetime(2026, 1, 1) + dt.timedelta(days=i))
        reg.record_ingestion(dict(base, run_id=f"r{i}", ingested_at=dt.datetime(2026, 1, 1) + dt.timedelta(days=i)))
    before = reg.records().collect(), reg.list_datasets().collect()
    append = reg.append

    def racing(table, df):  # another writer appends while the compaction writes
        append(table, df)
        if table == "ingestion_records":
            other = dict(base, run_id="late", ingested_at=dt.datetime(2026, 3, 1))
            append(table, spark.createDataFrame([tuple(other[f] for f in RECORD_SCHEMA.fieldNames())], RECORD_SCHEMA))

    reg.append = racing
    assert reg.compact("dataset_registry") == 6 and reg.compact("ingestion_records") == 6 and reg.compact("file_manifest") == 0
    assert reg.list_datasets().collect() == before[1]
    assert sorted(r["run_id"] for r in reg.records().collect()) == sorted([r["run_id"] for r in before[0]] + ["late"])
    files = [f for _, _, fs in os.walk(reg.path("ingestion_records")) for f in fs if f.endswith(".parquet")]
    assert len(files) == 2


def test_no_shared_folder_is_an_error(monkeypatch):
    class Bare:
        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Bare)


def _hashes(folder):
    return {str(p): (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in Path(folder).rglob("*.parquet")}


def _found(rows):
    return {x.path.removeprefix("file:"): (x.length, x.sha256) for x in rows.collect()}


def test_files_of_any_size_are_hashed_by_tasks_in_small_pieces(spark, tmp_path, monkeypatch):
    """Several files, empty lines, a newline byte at the end, odd names; no file is read as one value."""
    from strata.sources import manifest

    monkeypatch.setattr(manifest, "BATCH_LINES", 3)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1")
    try:
        store = tmp_path / "store"
        spark.range(30_000).selectExpr("id", "sha2(cast(id AS string), 256) AS h").repartition(5).write.parquet(str(store / "a b=x%20y"))
        bodies = [b"\n", b"\n\n", b"x", b"x\n", b"\r\n\r", b"\x00\xff\n\xfe", b"\n" * 1000, b"z" * 100_000]
        for i, body in enumerate(bodies):
            (store / f"part-{i}.parquet").write_bytes(body)
        rows = manifest.file_manifest(spark, str(store), "r")
        found, want = _found(rows), _hashes(store)
        assert {k: (v, found.get(k)) for k, v in want.items() if found.get(k) != v} == {}
        assert len(found) == len(want) == 13
        assert manifest.verify_manifest(spark, rows.checkpoint()).collect() == []
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)


def test_verification_tells_changed_resized_missing_and_unreadable(spark, tmp_path):
    from strata.sources.manifest import file_manifest

    for k in range(5):
        (tmp_path / f"f{k}.parquet").write_bytes(b"a\nb\n" * 1000)
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "checked"))
    rows = file_manifest(spark, str(tmp_path), "r").checkpoint()
    (tmp_path / "f0.parquet").write_bytes(b"a\nc\n" * 1000)
    (tmp_path / "f1.parquet").write_bytes(b"a\nb\n" * 5000)
    (tmp_path / "f2.parquet").unlink()
    (tmp_path / "f3.parquet").write_bytes(b"")
    part = next((tmp_path / "checked").glob("*.parquet"))  # has a checksum file of the file system
    body = bytearray(part.read_bytes())
    body[100] ^= 1
    part.write_bytes(body)
    got = {r["path"].rsplit("/", 1)[1]: (r["status"], r["reason"]) for r in verify_manifest(spark, rows).collect()}
    assert got == {
        "f0.parquet": ("changed", "digest"), "f1.parquet": ("changed", "length"), "f2.parquet": ("missing", "gone"),
        "f3.parquet": ("missing", "gone"), part.name: ("missing", "unreadable"),
    }


@pytest.mark.parametrize("rebalance", [False, True])
def test_files_are_bounded_in_bytes_whatever_the_rows_take(spark, tmp_path, rebalance):
    from strata.sources.snapshots import data_files, write_run

    # Rows of 10 KB that do not compress, after as many short ones, in one task.
    wide = "array_join(transform(sequence(1, 160), i -> sha2(concat(id, '-', i), 256)), '')"
    rows = spark.range(0, 3000, 1, 1).selectExpr("id", f"CASE WHEN id >= 1500 THEN {wide} ELSE '' END AS body")
    write_run(rows, str(tmp_path / "run"), max_file_bytes=1_000_000, rebalance=rebalance)
    sizes = [n for _, n in data_files(spark, str(tmp_path / "run"))]
    assert max(sizes) <= 1_000_000 and sum(sizes) > 5_000_000
    assert spark.read.parquet(str(tmp_path / "run")).selectExpr("count(*)", "sum(id)", "sum(length(body))").first() == (3000, 3000 * 2999 // 2, 1500 * 160 * 64)


def test_one_row_may_be_larger_than_a_file(spark, tmp_path):
    from strata.sources.snapshots import data_files, write_run

    rows = spark.range(0, 3, 1, 1).selectExpr("id", "repeat(sha2(cast(id AS string), 256), 1) AS body")
    write_run(rows, str(tmp_path / "run"), max_file_bytes=10)
    assert len(data_files(spark, str(tmp_path / "run"))) == 3
    assert spark.read.parquet(str(tmp_path / "run")).count() == 3


def test_a_run_of_wide_rows_is_ingested_in_bounded_files(spark, tmp_path, prices_contract):
    lines = ["date,close,volume"] + [f"{hashlib.sha256(str(i).encode()).hexdigest() * 40},{i}.5,{i}" for i in range(400)]
    (tmp_path / "wide.csv").write_text("\n".join(lines) + "\n")
    c = cfg(tmp_path, prices_contract, str(tmp_path / "wide.csv"), max_file_bytes=10_000)
    r = ingest(spark, c, now=NOW)
    assert r.success and r.row_count == 400
    sizes = [n for n, _ in _hashes(r.partition_path).values()]
    assert len(sizes) > 2 and max(sizes) <= 10_000
    assert spark.read.parquet(r.partition_path).count() == 400
    assert verify_manifest(spark, Registry(spark, c.registry_base).manifest()).count() == 0
