"""Two writers of one run: one record, one data folder, one manifest."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import strata.plans.ingest as plans_ingest
from strata.plans.ingest import IngestionConfig, compute_run_id, ingest
from strata.sources import claims
from strata.sources.manifest import verify_manifest
from strata.sources.registry_store import Registry

NOW = dt.datetime(2026, 3, 11, 9, 0, 0)


def cfg(tmp_path, contract, source, **kw):
    return IngestionConfig(
        dataset_name="prices", version="1.0", owner="test", expected_frequency="daily", contract=contract,
        source_path=source, registry_base=str(tmp_path / "registry"), store_base=str(tmp_path / "store"), **kw)


def test_one_of_many_gets_the_claim(spark, tmp_path):
    folder = str(tmp_path / "claims")
    with ThreadPoolExecutor(8) as pool:
        got = [m for m in pool.map(lambda _: claims.claim(spark, folder), range(8)) if m]
    assert got == [f"{folder}/1"] and claims.holds(spark, got[0])
    assert claims.claim(spark, folder) is None
    claims.release(spark, got[0])
    assert not claims.holds(spark, got[0]) and claims.claim(spark, folder) == f"{folder}/1"


def test_a_dead_writers_claim_is_outlived_once(spark, tmp_path):
    folder = str(tmp_path / "claims")
    dead = claims.claim(spark, folder)
    os.utime(dead, (1, 1))
    with ThreadPoolExecutor(8) as pool:
        got = [m for m in pool.map(lambda _: claims.claim(spark, folder, 60), range(8)) if m]
    assert got == [f"{folder}/2"]
    assert claims.holds(spark, got[0]) and not claims.holds(spark, dead)
    claims.release(spark, dead)  # the dead writer wakes up: it removes its own marker only
    assert claims.holds(spark, got[0])


def test_done_is_asked_again_under_the_claim(spark, tmp_path):
    folder, answers = str(tmp_path / "claims"), [False, True]
    assert claims.claim_unless(lambda: answers.pop(0), spark, folder) is None
    assert claims.claim(spark, folder) == f"{folder}/1"  # given back


def test_two_ingests_of_one_run_leave_one(spark, tmp_path, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv, key_columns=("date",))
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda _: ingest(spark, c, now=NOW), range(2)))
    assert all(r.success and r.row_count == 10 for r in results)
    assert sorted(r.rerun for r in results) == [False, True]
    reg, path = Registry(spark, c.registry_base), results[0].partition_path
    assert reg.table("ingestion_records").count() == 1
    assert spark.read.parquet(path).count() == 10 and len(os.listdir(os.path.dirname(path))) == 1
    assert verify_manifest(spark, reg.manifest(), path).count() == 0
    assert not os.path.exists(f"{c.store_base}/_staging")
    rerun = next(r for r in results if r.rerun)
    assert rerun.source_changed is False and rerun.source_changes == {"added": 0, "removed": 0, "changed": 0}


def test_a_failed_writer_gives_its_claim_back(spark, tmp_path, monkeypatch, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv)

    def fails(*_):
        raise OSError("no manifest")

    with monkeypatch.context() as m:
        m.setattr(plans_ingest, "log_manifest", fails)
        with pytest.raises(OSError):
            ingest(spark, c, now=NOW)
    r = ingest(spark, c, now=NOW)
    assert r.success and not r.rerun and Registry(spark, c.registry_base).table("ingestion_records").count() == 1


def test_a_writer_that_was_outlived_does_not_record(spark, tmp_path, monkeypatch, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv, claim_seconds=60)
    run_id = compute_run_id("prices", prices_csv, prices_contract.schema_hash(), NOW.date())
    folder, log = f"{c.registry_base}/run_claims/{run_id}", plans_ingest.log_manifest

    def slow(*args):
        os.utime(f"{folder}/1", (1, 1))
        assert claims.claim(spark, folder, 60) == f"{folder}/2"
        return log(*args)

    monkeypatch.setattr(plans_ingest, "log_manifest", slow)
    with pytest.raises(RuntimeError, match="taken over"):
        ingest(spark, c, now=NOW)
    assert Registry(spark, c.registry_base).table("ingestion_records").count() == 0


def test_rerun_names_added_removed_and_changed_rows(spark, tmp_path, prices_contract, prices_csv):
    c = cfg(tmp_path, prices_contract, prices_csv, key_columns=("date",))
    ingest(spark, c, now=NOW)
    lines = open(prices_csv).read().splitlines()
    day = lines[3].split(",")[0]
    with open(prices_csv, "w") as f:
        f.write("\n".join([*lines[:2], *lines[3:4], f"{day},1.5,7", *lines[4:], "2027-01-01,1.0,1"]) + "\n")
    r = ingest(spark, c, now=NOW + dt.timedelta(hours=1))
    assert r.rerun and r.source_changed and r.source_changes == {"added": 2, "removed": 1, "changed": 0}
