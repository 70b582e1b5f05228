import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.model import Column, Contract  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", app="strata-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture
def prices_contract():
    return Contract(
        "prices",
        "1.0",
        (
            Column("date", "string", description="Trading date"),
            Column("close", "float"),
            Column("volume", "int", nullable=True),
        ),
    )


@pytest.fixture
def prices_csv(tmp_path):
    p = tmp_path / "prices.csv"
    lines = ["date,close,volume"] + [f"2026-03-{d:02d},{100.0 + d},{1000 * d}" for d in range(1, 11)]
    p.write_text("\n".join(lines) + "\n")
    return str(p)
