"""JSON string quoting that reproduces Python's json.dumps (ASCII-only output).

Built as one SQL expression (a single call to the JVM to construct, instead
of one call per sub-expression); Catalyst sees the same plan either way.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two-character escapes Python's json encoder writes, as
# (character code, escape letter): '"', backslash, newline, carriage return,
# tab, backspace, form feed.
_SHORT_ESCAPES = [(34, '"'), (92, None), (10, "n"), (13, "r"), (9, "t"), (8, "b"), (12, "f")]

_U4 = "concat(chr(92), 'u', lower(lpad(hex({v}), 4, '0')))"


def _template() -> str:
    cases = []
    for code, letter in _SHORT_ESCAPES:
        out = "concat(chr(92), chr(92))" if letter is None else f"concat(chr(92), '{letter}')"
        cases.append(f"WHEN ascii(ch) = {code} THEN {out}")
    hi = "55296 + CAST(floor((ascii(ch) - 65536) / 1024) AS INT)"
    lo = "56320 + ((ascii(ch) - 65536) % 1024)"
    body = (
        "CASE " + " ".join(cases)
        + f" WHEN ascii(ch) < 32 THEN {_U4.format(v='ascii(ch)')}"
        + " WHEN ascii(ch) < 127 THEN ch"
        + f" WHEN ascii(ch) <= 65535 THEN {_U4.format(v='ascii(ch)')}"
        + f" ELSE concat({_U4.format(v=hi)}, {_U4.format(v=lo)}) END"
    )
    return "concat('\"', array_join(transform(regexp_extract_all({x}, '(?s).', 0), ch -> " + body + "), ''), '\"')"


_TEMPLATE = _template()


def json_quote(column_name: str) -> Column:
    """'"' + escaped text + '"' for the named column; every non-ASCII code point
    becomes \\uXXXX and characters above U+FFFF a surrogate pair, as Python writes them."""
    return F.expr(_TEMPLATE.format(x=f"`{column_name}`"))
