import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.casts import guarded_cast, guarded_cast_sql
from strata.functions.text import clean_cell, clean_cell_sql
from strata.model import Column, Contract
from strata.operators.normalize import error_summary, normalize_types, quarantine_split
from strata.sources.csv import csv_scan, header_errors, read_headers

CASES = {
    "int": [("42", 42), ("+7", 7), ("-3", -3), ("1.0", None), ("1e3", None), ("12a", None), ("99999999999999999999", None)],
    "float": [("1.5", 1.5), ("-2", -2.0), (".5", 0.5), ("1e3", 1000.0), ("inf", float("inf")), ("-Infinity", float("-inf")),
              ("1d", None), ("1f", None), ("N/A", None), ("0x10", None)],
    "boolean": [("true", True), ("YES", True), ("1", True), ("No", False), ("0", False), ("t", None), ("maybe", None)],
    "timestamp": [("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
                  ("2024-01-02", dt.datetime(2024, 1, 2)), ("2024-1-2 3:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
                  ("2024-01-02 03:04:05.123", None), ("2024-01-02T03:04:05Z", None), ("2024-01-02 03:04", None), ("2024/01/02", None)],
    "date": [("2024-01-02", dt.date(2024, 1, 2)), ("2024-1-2", None), ("2024-02-30", None), ("20240102", None)],
}


@pytest.mark.parametrize("dtype", list(CASES))
def test_guarded_casts(spark, dtype):
    df = spark.createDataFrame([(t,) for t, _ in CASES[dtype]], "v string")
    got = [r[0] for r in df.select(guarded_cast(F.col("v"), dtype)).collect()]
    assert got == [e for _, e in CASES[dtype]]
    via_sql = [r[0] for r in df.selectExpr(guarded_cast_sql("v", dtype)).collect()]
    assert via_sql == got


def test_nan_text_is_a_float(spark):
    df = spark.createDataFrame([("nan",), ("NaN",)], "v string")
    got = [r[0] for r in df.select(guarded_cast(F.col("v"), "float")).collect()]
    assert all(g != g for g in got)


def test_clean_cell_trims_unicode_space(spark):
    texts = [" \t a b  ", "   ", "", None, "\u3000\u00a0x\u2003\n", "\u200bz", "\u0085y "]
    # Zero-width space (U+200B) is not White_Space, so it stays.
    expected = ["a b", None, None, None, "x", "\u200bz", "y"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(clean_cell(F.col("v"))).collect()] == expected
    assert [r[0] for r in df.selectExpr(clean_cell_sql("v")).collect()] == expected


CONTRACT = Contract("t", "1.0", (Column("id", "int"), Column("x", "float", True), Column("flag", "boolean", True)))


def test_normalize_collects_all_errors(spark):
    raw = spark.createDataFrame([("1", "2.5", "yes"), (None, "abc", "maybe"), ("3", None, None)], "id string, x string, flag string")
    rows = normalize_types(raw, CONTRACT).collect()
    assert rows[0]["id"] == 1 and rows[0]["x"] == 2.5 and rows[0]["flag"] is True and rows[0]["_errors"] == []
    assert [(e["column"], e["error_type"]) for e in rows[1]["_errors"]] == [
        ("id", "unexpected_null"), ("x", "type_mismatch"), ("flag", "type_mismatch")]
    assert rows[2]["_errors"] == []
    good, bad = quarantine_split(normalize_types(raw, CONTRACT))
    assert good.count() == 2 and bad.count() == 1


def _write(tmp_path, text, name="in.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_csv_scan_by_name_and_ragged_rows(spark, tmp_path):
    path = _write(tmp_path, "x,id,extra\n 1.5 ,1,a\n2.5,2\n3.5,3,c,d\n")
    header, = read_headers(spark, path)
    assert header == ("x", "id", "extra")
    assert header_errors([header], CONTRACT, strict_columns=True)[0][:2] == ("flag", "missing_column")
    contract = Contract("t", "1.0", (Column("id", "int"), Column("x", "float", True)))
    assert [e[:2] for e in header_errors([header, header], contract, strict_columns=True)] == [("extra", "unexpected_column")]
    assert [e[:2] for e in header_errors([("id", "x", "x")], contract, strict_columns=False)] == [("x", "unexpected_column")]
    n = normalize_types(csv_scan(spark, path, header), contract)
    rows = n.select("id", "x", F.size("_errors").alias("k")).collect()
    assert [(r["id"], r["x"]) for r in rows] == [(1, 1.5), (2, 2.5), (3, 3.5)]
    assert [r["k"] for r in rows] == [0, 1, 1]  # short and long records are flagged
    kinds = {(r["column"], r["error_type"]) for r in error_summary(n).collect()}
    assert kinds == {("_record", "malformed_record")}


def test_header_only_csv(spark, tmp_path):
    path = _write(tmp_path, "id,x,flag\n")
    n = normalize_types(csv_scan(spark, path, next(iter(read_headers(spark, path)))), CONTRACT)
    assert n.count() == 0 and error_summary(n).count() == 0
