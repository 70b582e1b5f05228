"""Registry operators over append-only logs.

The registry is three logs (registrations, ingestion records, health
reports) that are only ever appended to. Every "current" view is an
aggregate (max_by per key), which Spark computes with a map-side partial
aggregate, so a dataset that owns most of the log does not overload a task.
"""

from __future__ import annotations

from strata.functions.timefn import ntz
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

REGISTRATION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("owner", T.StringType(), False),
        T.StructField("expected_frequency", T.StringType(), False),
        T.StructField("schema_hash", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("event_at", T.TimestampNTZType(), False),
        T.StructField("event_seq", T.LongType(), False),
    ]
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("checksum", T.StringType(), False),
        T.StructField("source_path", T.StringType(), False),
        T.StructField("partition_path", T.StringType(), False),
        T.StructField("schema_hash", T.StringType(), False),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("checked_at", T.TimestampNTZType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("freshness_ok", T.BooleanType(), False),
        T.StructField("volume_ok", T.BooleanType(), False),
        T.StructField("null_ratio_ok", T.BooleanType(), False),
        T.StructField("schema_hash_ok", T.BooleanType(), False),
        T.StructField("details", T.StringType(), False),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("sha256", T.StringType(), False),
        T.StructField("checksum", T.StringType(), False),  # of the attempt that wrote the files
    ]
)


def _latest_by(df: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """Newest row per key by the ``order`` columns (descending), as an aggregate."""
    packed = F.struct(*[F.col(c) for c in keep])
    rank = F.struct(*[F.col(c) for c in order])
    return df.groupBy(key).agg(F.max_by(packed, rank).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in keep])


def latest_registrations(events: DataFrame) -> DataFrame:
    """Upsert semantics on an event log: latest values per name, first registered_at kept."""
    keep = ["version", "owner", "expected_frequency", "schema_hash", "description", "event_at"]
    packed = F.struct(*[F.col(c) for c in keep])
    return (
        events.groupBy("name")
        .agg(
            F.max_by(packed, F.struct("event_at", "event_seq")).alias("_r"),
            F.min("event_at").alias("registered_at"),
        )
        .select(
            "name",
            F.col("_r.version").alias("version"),
            F.col("_r.owner").alias("owner"),
            F.col("_r.expected_frequency").alias("expected_frequency"),
            F.col("_r.schema_hash").alias("schema_hash"),
            F.coalesce(F.col("_r.description"), F.lit("")).alias("description"),
            "registered_at",
            F.col("_r.event_at").alias("updated_at"),
        )
    )


def first_writer_wins(records: DataFrame) -> DataFrame:
    """One record per run_id: that with the earliest ingestion time wins (ties: the
    larger checksum). A replay carries the later time, so this is the first
    writer unless writers' clocks disagree."""
    cols = records.columns
    return _latest_by(
        records.withColumn("_neg", -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ingested_at"))),
        "run_id",
        ["_neg", "checksum"],
        [c for c in cols if c != "run_id"],
    ).select(*cols)


def records_to_append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-if-absent on run_id: incoming records whose run_id is not yet logged.

    The log is probed with the incoming ids (broadcast after a size check),
    so appending a batch scans the log's run_id column without shuffling it;
    only when the batch itself is huge does this fall back to a shuffle join.
    """
    from strata.operators.joins import checked_broadcast

    fresh = first_writer_wins(incoming)
    ids = checked_broadcast(fresh.select("run_id"))
    seen = existing.select("run_id").join(ids, "run_id", "left_semi").distinct()
    return fresh.join(seen, "run_id", "left_anti").select(*incoming.columns)


def latest_ingestion(records: DataFrame, cutoff=None) -> DataFrame:
    """Latest record per dataset at or before ``cutoff`` (a literal or a Column).

    Ties on ingested_at are broken by run_id, descending, so the answer is
    deterministic.
    """
    if cutoff is None:
        src = records
    else:
        cut = ntz(cutoff)
        src = records.where(F.col("ingested_at") <= cut)
    keep = [c for c in records.columns if c != "dataset_name"]
    return _latest_by(src, "dataset_name", ["ingested_at", "run_id"], keep).select(*records.columns)


def ingestion_history(records: DataFrame, limit: int = 10) -> DataFrame:
    """Newest ``limit`` records per dataset with their rank (1 = newest).

    ``row_number() <= k`` is planned as a WindowGroupLimit that keeps at most
    k rows per dataset in every map task before the shuffle.
    """
    w = Window.partitionBy("dataset_name").orderBy(F.col("ingested_at").desc(), F.col("run_id").desc())
    return records.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def latest_health(reports: DataFrame) -> DataFrame:
    keep = [c for c in reports.columns if c != "dataset_name"]
    return _latest_by(reports, "dataset_name", ["checked_at", "id"], keep).select(*reports.columns)
