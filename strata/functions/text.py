"""Text cleanup applied to raw CSV cells."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters a Unicode-aware trim removes
# (tab, LF, VT, FF, CR, space, NEL, NBSP, ogham space, U+2000..U+200A,
# line and paragraph separators, narrow NBSP, medium math space, ideographic space).
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_unicode(c: Column) -> Column:
    """Strip White_Space from both ends (a character-set trim, no regex)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_cell(c: Column) -> Column:
    """Trim, then an empty cell becomes null."""
    return blank_to_null(trim_unicode(c))


def clean_cell_sql(x: str) -> str:
    """``clean_cell`` as SQL text over the expression ``x``."""
    return f"nullif(btrim(CAST({x} AS STRING), '{WHITE_SPACE}'), '')"
