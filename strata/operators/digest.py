"""Order-free content digests of DataFrames.

Each row is encoded cell by cell (length-prefixed text, a marker for null)
and hashed with SHA-256; a group's digest is the exact sum of the first 60
bits of its row hashes. Addition commutes, so the digest does not depend on
row order, partitioning or file layout, and it is computed as a partial
aggregate (no rows move before the map-side combine).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.digest import hex_to_decimal, row_hash


def content_digest(df: DataFrame, columns: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """(group..., n_rows, digest) with digest as decimal text."""
    group_cols = list(group_cols or [])
    h = hex_to_decimal(row_hash([F.col(c) for c in columns]))
    agg = [F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("decimal(38,0)").cast("string").alias("digest")]
    grouped = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return grouped.agg(*agg)
