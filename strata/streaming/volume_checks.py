"""The volume check of every run as it arrives, against keyed state.

The state of a dataset is its last 30 runs (time, id, row count), whatever the
length of its history; it never expires, as a dataset may pause for any time.
Every arriving run is held against the runs before it and then joins them, so
the results are those of ``volume_backfill`` over the same runs. A micro-batch
sorts the runs of a dataset in one task: one line for each of its files, which
``max_files_per_trigger`` bounds.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.model import VOLUME_HISTORY
from strata.operators.health import volume_decision

RUN_SCHEMA = "dataset_name string, run_id string, ingested_at timestamp_ntz, row_count long"
STATE_SCHEMA = "at array<long>, run_id array<string>, row_count array<long>"
STATS_SCHEMA = (
    "dataset_name string, run_id string, at long, records_available long, current_row_count long, "
    "baseline_n long, baseline_sum decimal(38,0), baseline_sumsq decimal(38,0)"
)
CHECK_SCHEMA = (
    "dataset_name string, run_id string, ingested_at timestamp_ntz, records_available long, current_row_count long, baseline_n long, "
    "baseline_mean double, baseline_std double, lower_bound double, upper_bound double, volume_ok boolean, volume_reason string"
)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _arrived(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Baselines of the arriving runs of one dataset, oldest first.

    A run whose id the state holds is a repetition and gives no row. A late run
    is held against those of the state's runs that are older than itself; what
    was said about newer runs stays."""
    keep = VOLUME_HISTORY - 1
    held = list(zip(*state.get, strict=True)) if state.exists else []
    known = {run_id for _, run_id, _ in held}
    out = []
    for at, run_id, count in sorted({r for f in frames for r in zip(f["at"].tolist(), f["run_id"].tolist(), f["row_count"].tolist(), strict=True)}):
        if run_id in known:
            continue
        known.add(run_id)
        place = bisect.bisect_left(held, (at, run_id, count))
        counts = [c for _, _, c in held[max(0, place - keep) : place]]
        out.append((key[0], run_id, at, len(counts) + 1, count, len(counts), Decimal(sum(counts)), Decimal(sum(c * c for c in counts))))
        held.insert(place, (at, run_id, count))
        del held[: max(0, len(held) - keep)]
    if out:
        state.update(tuple(list(column) for column in zip(*held, strict=True)))
    names = [c.split()[0] for c in STATS_SCHEMA.split(", ")]
    yield pd.DataFrame(out, columns=names)


def volume_checks(runs: DataFrame) -> DataFrame:
    """The volume decision of every run of a stream (dataset_name, run_id,
    ingested_at, row_count; other columns are ignored). Rows without one of these
    are no finished runs and are left out."""
    at = F.timestamp_diff("MICROSECOND", _epoch(), F.col("ingested_at"))
    known = runs.select("dataset_name", "run_id", at.alias("at"), F.col("row_count").cast("long")).dropna()
    stats = known.groupBy("dataset_name").applyInPandasWithState(_arrived, STATS_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    timed = stats.withColumn("ingested_at", F.timestamp_add("MICROSECOND", F.col("at"), _epoch()))
    return volume_decision(timed, ["dataset_name", "run_id", "ingested_at"])


def run_volume_checks(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Check all runs that arrived in ``source_dir`` (Parquet) since the last call
    with this checkpoint. A micro-batch writes to a folder of its own, so a
    replayed one overwrites its own rows."""
    reader = spark.readStream.schema(RUN_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    query = (
        volume_checks(reader.parquet(source_dir)).writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_checks(spark: SparkSession, out_dir: str) -> DataFrame:
    """What all micro-batches wrote."""
    return spark.read.schema(CHECK_SCHEMA).option("recursiveFileLookup", "true").parquet(out_dir)
