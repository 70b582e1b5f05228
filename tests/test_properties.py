"""Property tests: set-based Spark forms equal their one-at-a-time definitions."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.jsontext import json_quote
from strata.model import CONTRACT_TYPES, Column, Contract
from strata.operators.fingerprint import contracts_frame, schema_fingerprint

names = st.text(min_size=1, max_size=12)
column = st.builds(Column, name=names, dtype=st.sampled_from(CONTRACT_TYPES), nullable=st.booleans())
contract = st.builds(
    Contract, name=names, version=st.text(min_size=1, max_size=5),
    columns=st.lists(column, min_size=1, max_size=6, unique_by=lambda c: c.name).map(tuple),
)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(contract, min_size=1, max_size=4, unique_by=lambda c: (c.name, c.version)))
def test_set_fingerprint_equals_single(spark, contracts):
    rows = schema_fingerprint(contracts_frame(spark, contracts)).collect()
    got = {(r["dataset_name"], r["version"]): r["schema_hash"] for r in rows}
    assert got == {(c.name, c.version): c.schema_hash() for c in contracts}


@SETTINGS
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_json_quote_equals_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(json_quote("t")).collect()] == [json.dumps(t) for t in texts]


def _py_float(text: str):
    import math
    import re

    from strata.functions.casts import FLOAT_PATTERN

    if not re.fullmatch(FLOAT_PATTERN, text.lower()):
        return None
    v = float(text)
    return "nan" if math.isnan(v) else v


def _py_int(text: str):
    import re

    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return v if -(2**63) <= v < 2**63 else None


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789+-.eE", min_size=1, max_size=8), min_size=1, max_size=60))
def test_float_fast_path_equals_grammar(spark, texts):
    """For text of digits, signs, dots and exponent letters the regex is skipped;
    the cast must then accept exactly what the grammar accepts."""
    import math

    from pyspark.sql import functions as F

    from strata.functions.casts import guarded_cast

    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(guarded_cast(F.col("v"), "float")).collect()]
    got = ["nan" if isinstance(g, float) and math.isnan(g) else g for g in got]
    assert got == [_py_float(t) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789+-", min_size=1, max_size=21), min_size=1, max_size=60))
def test_int_fast_path_equals_grammar(spark, texts):
    from pyspark.sql import functions as F

    from strata.functions.casts import guarded_cast

    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(guarded_cast(F.col("v"), "int")).collect()] == [_py_int(t) for t in texts]
