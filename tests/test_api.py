import datetime as dt

import pytest

from strata.api import BadRequest, NotFound, get_data, get_health, get_metadata, list_datasets
from strata.model import Column, Contract
from strata.plans.ingest import IngestionConfig, ingest
from strata.sources.registry_store import Registry

C2 = Contract("prices", "2.0", (Column("symbol", "string"), Column("date", "string"), Column("close", "float"),
                                Column("volume", "int", True)))


def _src(tmp_path, name, rows):
    p = tmp_path / name
    p.write_text("symbol,date,close,volume\n" + "".join(f"{s},{d},{c},{v}\n" for s, d, c, v in rows))
    return str(p)


@pytest.fixture
def world(spark, tmp_path):
    cfg = dict(dataset_name="prices", version="1.0", owner="me", expected_frequency="daily", contract=C2,
               registry_base=str(tmp_path / "reg"), store_base=str(tmp_path / "store"))
    first = _src(tmp_path, "a.csv", [("AAPL", "2026-01-02", 1.0, 10), ("MSFT", "2026-01-02", 2.0, 20), ("AAPL", "2026-01-05", 3.0, 30)])
    revised = _src(tmp_path, "b.csv", [("AAPL", "2026-01-02", 1.5, 10), ("AAPL", "2026-01-05", 3.5, 30), ("AAPL", "2026-01-09", 9.0, 90)])
    ingest(spark, IngestionConfig(source_path=first, **cfg), now=dt.datetime(2026, 1, 5, 18))
    ingest(spark, IngestionConfig(source_path=revised, **cfg), now=dt.datetime(2026, 1, 8, 18))
    return Registry(spark, cfg["registry_base"])


def test_reads(spark, world):
    assert [r["name"] for r in list_datasets(world).collect()] == ["prices"]
    h = get_health(world, "prices")
    assert h["status"] in ("healthy", "degraded") and h["details"]["volume"]["reason"] == "insufficient_history"
    m = get_metadata(world, "prices")
    assert m["registration"]["version"] == "1.0" and m["latest_ingestion"]["ingested_at"] == dt.datetime(2026, 1, 8, 18)
    rows = get_data(spark, world, "prices", "2026-01-07").collect()
    assert sorted((r["symbol"], r["close"]) for r in rows) == [("AAPL", 1.0), ("AAPL", 3.0), ("MSFT", 2.0)]
    rows = get_data(spark, world, "prices", "2026-01-09", symbol="AAPL").collect()
    assert sorted(r["close"] for r in rows) == [1.5, 3.5, 9.0]
    assert {r["ingested_at"] for r in rows} == {dt.datetime(2026, 1, 8, 18)}


def test_read_errors(spark, world, tmp_path, prices_contract, prices_csv):
    with pytest.raises(NotFound):
        get_health(world, "nope")
    with pytest.raises(NotFound):
        get_metadata(world, "nope")
    with pytest.raises(NotFound):
        get_data(spark, world, "prices", "2026-01-04")
    with pytest.raises(ValueError):
        get_data(spark, world, "prices", "2026/01/07")
    with pytest.raises(ValueError):
        get_data(spark, world, "prices", "20260107")  # compact dates are refused, not compared as text
    cfg = IngestionConfig("nosym", "1.0", "me", "daily", prices_contract, prices_csv, world.base, str(tmp_path / "store"))
    ingest(spark, cfg, now=dt.datetime(2026, 3, 11, 9))
    assert get_data(spark, world, "nosym", "2026-03-11").count() == 10
    with pytest.raises(BadRequest):
        get_data(spark, world, "nosym", "2026-03-11", symbol="AAPL")
