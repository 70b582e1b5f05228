"""Guarded text-to-type casts.

Spark's own casts accept more text than the contract allows (``1d`` as a
double, ``t`` as a boolean, fractional seconds and zones in timestamps), so
each cast is preceded by a regular-expression guard. A present text that fails
its guard or its cast is a parse error (type_mismatch), never a silent null.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.model import BOOL_FALSE, BOOL_TRUE

# Fixed patterns: accepted text per contract type (applied after trimming).
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|inf|infinity|nan)$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _guard(c: Column, pattern: str) -> Column:
    return F.regexp_like(c, F.lit(pattern))


def _only(c: Column, chars: str) -> Column:
    """True when every character of ``c`` is in ``chars`` (a char map, no regex)."""
    return F.length(F.translate(c, chars, "")) == 0


def guarded_cast(c: Column, dtype: str) -> Column:
    """Typed value of a cleaned text cell; null when absent or unparseable.

    For text made only of digits, sign, dot and exponent letters, Spark's
    ANSI cast accepts exactly the guarded grammar, so the regular expression
    runs only on the rest (words such as inf/nan, suffixes like 1d, hex).
    """
    if dtype == "string":
        return c
    if dtype == "int":
        return F.when(_only(c, "0123456789+-"), c.try_cast("bigint"))
    if dtype == "float":
        plain = _only(c, "0123456789+-.eE")
        # The cast itself knows no signed nan.
        signed_nan = F.lower(c).isin("+nan", "-nan")
        return F.when(signed_nan, F.lit(float("nan"))).when(plain | _guard(F.lower(c), FLOAT_PATTERN), c.try_cast("double"))
    if dtype == "boolean":
        low = F.lower(c)
        return F.when(low.isin(*BOOL_TRUE), F.lit(True)).when(low.isin(*BOOL_FALSE), F.lit(False))
    if dtype == "timestamp":
        # 'T' separator is rewritten to a blank so that one cast covers the three formats.
        return F.when(_guard(c, TIMESTAMP_PATTERN), F.regexp_replace(c, "T", " ").try_cast("timestamp_ntz"))
    if dtype == "date":
        return F.when(_guard(c, DATE_PATTERN), c.try_cast("date"))
    raise ValueError(f"unknown contract type {dtype!r}")


def sql_quote(text: str) -> str:
    """A SQL string literal (the patterns here hold no backslashes)."""
    assert "\\" not in text
    return "'" + text.replace("'", "''") + "'"


def guarded_cast_sql(x: str, dtype: str) -> str:
    """The same guarded cast as SQL text over the expression ``x``.

    Used where many columns are typed at once: one JVM call per column to
    build instead of one per sub-expression. Tests check it against
    ``guarded_cast``.
    """
    if dtype == "string":
        return x
    if dtype == "int":
        return f"CASE WHEN length(translate({x}, '0123456789+-', '')) = 0 THEN try_cast({x} AS BIGINT) END"
    if dtype == "float":
        return (f"CASE WHEN length(translate({x}, '0123456789+-.eE', '')) = 0 THEN try_cast({x} AS DOUBLE) "
                f"WHEN lower({x}) IN ('+nan', '-nan') THEN double('NaN') "
                f"WHEN regexp_like(lower({x}), {sql_quote(FLOAT_PATTERN)}) THEN try_cast({x} AS DOUBLE) END")
    if dtype == "boolean":
        t = ", ".join(sql_quote(v) for v in BOOL_TRUE)
        f = ", ".join(sql_quote(v) for v in BOOL_FALSE)
        return f"CASE WHEN lower({x}) IN ({t}) THEN true WHEN lower({x}) IN ({f}) THEN false END"
    if dtype == "timestamp":
        return f"CASE WHEN regexp_like({x}, {sql_quote(TIMESTAMP_PATTERN)}) THEN try_cast(replace({x}, 'T', ' ') AS TIMESTAMP_NTZ) END"
    if dtype == "date":
        return f"CASE WHEN regexp_like({x}, {sql_quote(DATE_PATTERN)}) THEN try_cast({x} AS DATE) END"
    raise ValueError(f"unknown contract type {dtype!r}")
