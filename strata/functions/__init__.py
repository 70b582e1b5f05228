"""Column-level building blocks (all Catalyst built-ins, no Python UDFs)."""

from strata.functions.text import blank_to_null, clean_cell, trim_unicode
from strata.functions.casts import guarded_cast
from strata.functions.digest import cell_encoding, hex_to_decimal, run_id_col, sha256_hex
from strata.functions.timefn import end_of_day, parse_as_of

__all__ = [
    "blank_to_null",
    "clean_cell",
    "trim_unicode",
    "guarded_cast",
    "cell_encoding",
    "hex_to_decimal",
    "run_id_col",
    "sha256_hex",
    "end_of_day",
    "parse_as_of",
]
