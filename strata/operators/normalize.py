"""Raw text rows -> typed rows under a contract, with per-row errors.

Rules follow the strict CSV path: every cell is trimmed and an empty cell is
null; a null in a non-nullable column is ``unexpected_null``; a present text
that does not parse as the declared type is ``type_mismatch``. All errors are
kept (nothing stops at the first), one array per row, so the gate can count
them in one aggregate and quarantine can split on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.casts import guarded_cast_sql, sql_quote
from strata.functions.text import clean_cell_sql
from strata.model import SPARK_TYPE, Contract, ErrorType

ERRORS = "_errors"
ROW_ERROR = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)
# Name of the flag column a CSV scan adds for records whose field count is wrong.
MALFORMED = "_malformed"
MALFORMED_RECORD = "malformed_record"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stages(raw: DataFrame, contract: Contract, keep: list[str]):
    """Cleaned and typed columns side by side, and the row-error rules.

    Two stacked projections: clean each cell once, then cast each once.
    Catalyst does not merge projections when that would repeat a costly
    expression, so every cell is trimmed and parsed exactly once. The
    expressions are SQL text (one JVM call per column to build).
    Returns (frame, rules, value names) with rules = [(column, error_type,
    flag SQL, raw-text SQL)].
    """
    cols = contract.columns
    pass_through = [_q(k) for k in keep] + ([MALFORMED] if MALFORMED in raw.columns else [])
    cleaned = raw.selectExpr(*pass_through, *[f"{clean_cell_sql(_q(c.name))} AS _t{i}" for i, c in enumerate(cols)])
    typed = cleaned.selectExpr(
        *pass_through,
        *[f"_t{i}" for i in range(len(cols))],
        *[f"CAST({guarded_cast_sql(f'_t{i}', c.dtype)} AS {SPARK_TYPE[c.dtype].simpleString()}) AS _v{i}" for i, c in enumerate(cols)],
    )
    rules = []
    for i, c in enumerate(cols):
        if not c.nullable:
            rules.append((c.name, ErrorType.UNEXPECTED_NULL.value, f"_t{i} IS NULL", "CAST(NULL AS STRING)"))
        if c.dtype != "string":
            rules.append((c.name, ErrorType.TYPE_MISMATCH.value, f"_t{i} IS NOT NULL AND _v{i} IS NULL", f"_t{i}"))
    if MALFORMED in raw.columns:
        rules.append(("_record", MALFORMED_RECORD, MALFORMED, "CAST(NULL AS STRING)"))
    return typed, rules, [f"_v{i}" for i in range(len(cols))]


def _outputs(contract: Contract, keep: list[str], values: list[str]) -> list[str]:
    return [_q(k) for k in keep] + [f"{v} AS {_q(c.name)}" for v, c in zip(values, contract.columns)]


def typed_rows(raw: DataFrame, contract: Contract, keep: list[str] | None = None) -> DataFrame:
    """Only the typed contract columns (what gets written once the gate passed)."""
    keep = list(keep or [])
    typed, _, values = _stages(raw, contract, keep)
    return typed.selectExpr(*_outputs(contract, keep, values))


def normalize_types(raw: DataFrame, contract: Contract, keep: list[str] | None = None) -> DataFrame:
    """Typed contract columns (contract order) + ``_errors`` array.

    ``raw`` holds text columns named as in the contract; columns of ``raw``
    outside the contract are dropped unless listed in ``keep`` (pass-through
    keys such as a dataset or run column). A missing contract column must be
    caught before (header_errors); here it would be an analysis error.
    """
    keep = list(keep or [])
    typed, rules, values = _stages(raw, contract, keep)
    if rules:
        entries = ", ".join(
            f"CASE WHEN {flag} THEN named_struct('column', {sql_quote(col)}, 'error_type', '{etype}', 'raw', {text}) END"
            for col, etype, flag, text in rules
        )
        errors = f"filter(array({entries}), e -> e IS NOT NULL) AS {ERRORS}"
    else:
        errors = f"CAST(array() AS array<struct<column:string,error_type:string,raw:string>>) AS {ERRORS}"
    return typed.selectExpr(*_outputs(contract, keep, values), errors)


def gate_summary(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per-rule error counts and one example, from a single aggregate.

    Each task keeps one counter and one minimum per rule (map-side partial
    aggregate); only those few values are shuffled, never error rows. The
    result has one row per violated (column, error_type).
    """
    typed, rules, _ = _stages(raw, contract, [])
    if not rules:
        return raw.sparkSession.createDataFrame([], "column string, error_type string, n_rows bigint, example string")
    aggs = []
    for k, (_, _, flag, text) in enumerate(rules):
        aggs += [F.expr(f"count_if({flag}) AS _n{k}"), F.expr(f"min(CASE WHEN {flag} THEN {text} END) AS _x{k}")]
    wide = typed.agg(*aggs)
    entries = ", ".join(
        f"named_struct('column', {sql_quote(col)}, 'error_type', '{etype}', 'n_rows', _n{k}, 'example', _x{k})"
        for k, (col, etype, _, _) in enumerate(rules)
    )
    return wide.selectExpr(f"inline(array({entries}))").where("n_rows > 0")


def observed_rows(raw: DataFrame, contract: Contract, observation: Observation) -> DataFrame:
    """The typed contract columns, while ``observation`` counts, in the same pass:
    rows, violations of each rule with an example, nulls (and NaN) of each
    column. Read them with ``observed_gate`` and ``observed_nulls``."""
    typed, rules, values = _stages(raw, contract, [])
    counts = [F.expr("count(1) AS n_rows")]
    for k, (_, _, flag, text) in enumerate(rules):
        counts += [F.expr(f"count_if({flag}) AS n{k}"), F.expr(f"min(CASE WHEN {flag} THEN {text} END) AS x{k}")]
    for i, c in enumerate(contract.columns):
        nan = f" OR isnan({values[i]})" if c.dtype == "float" else ""
        counts.append(F.expr(f"count_if({values[i]} IS NULL{nan}) AS null{i}"))
    return typed.observe(observation, *counts).selectExpr(*_outputs(contract, [], values))


def observed_gate(raw: DataFrame, contract: Contract, seen: dict) -> list[tuple[str, str, int, str | None]]:
    """(column, error_type, rows, example) of the violated rules, by column and type."""
    _, rules, _ = _stages(raw, contract, [])
    return sorted((col, etype, seen[f"n{k}"], seen[f"x{k}"]) for k, (col, etype, _, _) in enumerate(rules) if seen[f"n{k}"])


def observed_nulls(contract: Contract, seen: dict) -> list[int]:
    """Null counts in contract order."""
    return [seen[f"null{i}"] for i in range(len(contract.columns))]


def error_summary(normalized: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Counts per (group..., column, error_type) with one example raw text.

    Runs as one partial+final aggregate; its output is bounded by
    groups x columns x rules, so it is safe to collect for the gate.
    """
    group_cols = list(group_cols or [])
    exploded = normalized.select(*group_cols, F.explode(ERRORS).alias("e"))
    return exploded.groupBy(*group_cols, F.col("e.column").alias("column"), F.col("e.error_type").alias("error_type")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("e.raw").alias("example")
    )


def with_quarantine_flag(normalized: DataFrame) -> DataFrame:
    """Adds ``quarantined``: the row has at least one error."""
    return normalized.withColumn("quarantined", F.size(ERRORS) > 0)


def quarantine_split(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, bad rows with their errors).

    Both sides read the same input; persist ``normalized`` first when both
    are written, so the source is scanned once.
    """
    flagged = with_quarantine_flag(normalized)
    good = flagged.where(~F.col("quarantined")).drop(ERRORS, "quarantined")
    bad = flagged.where(F.col("quarantined")).drop("quarantined")
    return good, bad
