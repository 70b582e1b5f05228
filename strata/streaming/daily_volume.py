"""Watermarked daily row counts per dataset from a stream of event files.

``withWatermark`` bounds the state: a day's window is final once the
watermark (max event time minus the allowed lateness) passes its end, and
rows older than that are dropped as late. Spark judges lateness against the
watermark of the previous micro-batch, so a row is certainly dropped once
it is older than that; rows just behind the newest watermark may still be
counted. In append mode only final windows are emitted; complete mode keeps
every window, which the watermark does not bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, shared_dir


def utc_instant(ntz):
    """timestamp_ntz (UTC wall clock) -> timestamp instant, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, ntz))


def utc_day(instant):
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int"))


def daily_volume(stream: DataFrame, lateness: str = "1 day", time_col: str = "ts", key: str = "event_type") -> DataFrame:
    """(dataset_name, day, row_count) with day windows aligned to UTC midnight."""
    return (
        stream.withColumn("_et", utc_instant(F.col(time_col)))
        .withWatermark("_et", lateness)
        .groupBy(F.window("_et", "1 day").alias("w"), F.col(key).alias("dataset_name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("dataset_name", utc_day(F.col("w.start")).alias("day"), "row_count")
    )


def run_daily_volume(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, mode: str = "append",
                     glob: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Run the stream to the end of the available input (availableNow).

    Append mode emits each window once, when the watermark has passed it, and
    drops its state; what a micro-batch emits is written to the folder of that
    batch (``batch_id=``), so a replayed batch overwrites its own rows. In
    complete mode, for a bounded set of days only, all windows stay in the
    state and every batch overwrites the output with the whole table. The
    checkpoint makes a restart resume from the last committed batch.
    """
    batch_reader = spark.read
    reader = spark.readStream
    if glob:
        batch_reader = batch_reader.option("pathGlobFilter", glob)
        reader = reader.option("pathGlobFilter", glob)
    reader = reader.schema(batch_reader.parquet(source_dir).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = daily_volume(reader.parquet(source_dir))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir if mode == "complete" else f"{out_dir}/batch_id={batch_id}")

    query = (
        counts.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def daily_volume_batch_via_stream(spark: SparkSession, source_dir: str, glob: str | None = None) -> DataFrame:
    """The days that are final after one run over the files in ``source_dir``: those
    that ended a day (the allowed lateness) before the newest event, or earlier."""
    base = shared_dir(spark, "daily-volume")
    delete_path(spark, base)
    run_daily_volume(spark, source_dir, f"{base}/out", f"{base}/checkpoint", glob=glob)
    schema = "dataset_name string, day date, row_count long"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/out")
