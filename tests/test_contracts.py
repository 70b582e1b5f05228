import json

from pyspark.sql import functions as F

from strata.functions.jsontext import json_quote
from strata.model import Column, Contract
from strata.operators.fingerprint import contracts_frame, schema_fingerprint

KNOWN = "79b31173edf23ffa365fc393b57e71a91638274f1ea73d3cfe88cc20abd50f22"


def test_known_hash(prices_contract):
    assert prices_contract.schema_hash() == KNOWN


def test_set_based_hash_equals_driver_hash(spark, prices_contract):
    other = Contract("weird \"name\" é", "2.0", (Column("a\tb", "int"), Column("ü", "boolean", True), Column("😀", "date")))
    rows = schema_fingerprint(contracts_frame(spark, [prices_contract, other])).collect()
    got = {(r["dataset_name"], r["version"]): r["schema_hash"] for r in rows}
    assert got[("prices", "1.0")] == KNOWN
    assert got[(other.name, "2.0")] == other.schema_hash()


def test_hash_ignores_order_and_description(prices_contract):
    shuffled = Contract("prices", "1.0", tuple(reversed([Column(c.name, c.dtype, c.nullable) for c in prices_contract.columns])))
    assert shuffled.schema_hash() == KNOWN


def test_hash_changes_on_type_nullability_version(prices_contract):
    cols = list(prices_contract.columns)
    t = Contract("prices", "1.0", (cols[0], Column("close", "int"), cols[2]))
    n = Contract("prices", "1.0", (cols[0], cols[1], Column("volume", "int", nullable=False)))
    v = Contract("prices", "1.1", tuple(cols))
    assert len({t.schema_hash(), n.schema_hash(), v.schema_hash(), KNOWN}) == 4


def test_json_quote_matches_python(spark):
    texts = ["plain", 'q"uote', "back\\slash", "tab\there", "new\nline", "é ü", "😀x", "", "\x01ctl", "del\x7f", "~"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(json_quote("t")).collect()]
    assert got == [json.dumps(t) for t in texts]


def test_contract_json_roundtrip(prices_contract):
    assert Contract.from_json(prices_contract.to_json()) == prices_contract


def test_contracts_from_json_files(spark, tmp_path, prices_contract):
    from strata.operators.fingerprint import contracts_from_json

    other = Contract("ticks", "3.1", (Column("sym", "string"), Column("ts", "timestamp", True)))
    for i, c in enumerate([prices_contract, other]):
        (tmp_path / f"c{i}.json").write_text(c.to_json())
    table = contracts_from_json(spark, str(tmp_path))
    assert table.count() == 5
    got = {(r["dataset_name"], r["version"]): r["schema_hash"] for r in schema_fingerprint(table).collect()}
    assert got == {("prices", "1.0"): KNOWN, ("ticks", "3.1"): other.schema_hash()}
