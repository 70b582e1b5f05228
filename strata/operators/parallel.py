"""Spread per-row CPU work when an input arrives in fewer pieces than cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than the
    session's default parallelism (one unsplittable file: a gzip CSV, a
    single-row-group Parquet file). A large input with many splits is
    returned unchanged, so no shuffle is added where the scan is already
    parallel. Call it on a freshly read frame (before any exchange): counting
    partitions then only lists files and plans splits.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
