"""Exact deduplication as a stateful stream, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import STEP_CONF, Scratch, lower_ascii, quoted, settings

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The state is read back from its snapshots and change logs, all of which
    # lie in the stream's checkpoint folder.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store is closed when its task has committed: else each of them keeps 4 MB
    # of preallocated files open on its executor for as long as that lives.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normalised(text: Column) -> Column:
    """Null as empty; A-Z lower-cased."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def run_stream(arrivals: DataFrame, checkpoint: str) -> None:
    """Feed what lies in the arrivals folder through the keyed state.

    ``arrivals``: a streaming frame (id, digest, locator). The state has one
    entry per digest, in RocksDB, and nothing ever expires (no watermark):
    the largest id so far with its content locator, and the number of rows.
    Rows are combined by digest in each task before they are shuffled, so a
    digest with a third of all rows costs one row a task. Running again on the
    same checkpoint takes in only arrivals that are new.
    """
    spark = arrivals.sparkSession
    state = arrivals.groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count("*").alias("n"))
    with settings(spark, STATE_CONF | STEP_CONF):
        query = (
            state.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The retained state: ``digest, keep (id, locator), n``."""
    state = spark.read.format("statestore").load(checkpoint)
    keep, n = (F.col("value").getField(f.name) for f in state.schema["value"].dataType.fields)
    return state.select(F.col("key.digest").alias("digest"), keep.alias("keep"), n.alias("n"))


def dedup_rows(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """Every row of ``docs`` with its group: ``row`` (the original columns as a
    struct, whatever their names), ``digest``, ``keep_id``, ``group_size`` and
    ``kept``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. The row with the largest id of a group is kept; of repeated rows
    with that id, one (the one whose locator sorts last). A null id sorts below all
    others. An empty table gives no rows.

    The documents are landed in the shared folder, digest beside each row; a
    row's content locator is the landed file and its row number there. The
    stream keeps the state by digest. A row whose digest has more than one
    arrival is a hit: its full text is compared with the text found at the
    retained locator. Should the bytes differ under one digest, the rows of
    that digest are grouped by their full text instead.
    """
    spark = docs.sparkSession
    text = normalised(quoted(text_col))
    landed = scratch.put(
        docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), digest(text).alias("digest")), "landed"
    )
    locator = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("locator")
    id_of = F.col("row").getField(id_col).alias("id")
    arrivals = spark.readStream.schema(landed.schema).parquet(landed._scratch_path).select(id_of, "digest", locator)
    checkpoint = scratch.path("state")
    run_stream(arrivals, checkpoint)
    state = scratch.put(read_state(spark, checkpoint), "groups")

    located = landed.select("row", "digest", locator)
    rep = F.struct("keep.locator").getField("locator")
    hits = located.select(normalised(F.col("row").getField(text_col)).alias("content"), "digest", "locator").join(
        state.where("n > 1").select("digest", rep.alias("rep")), "digest"
    )
    hits = scratch.put(hits, "hits")
    kept_text = hits.where("locator = rep").select("digest", F.col("content").alias("kept_content"))
    # Written before it is made distinct: so the join's rows of one digest, which
    # may be a third of all, can be split over tasks.
    other = scratch.put(hits.join(kept_text, "digest").where("content <> kept_content").select("digest"), "other")
    differing = scratch.put(other.distinct(), "differing")
    groups = state.select("digest", F.col("keep.id").alias("keep_id"), rep.alias("rep"), F.col("n").alias("group_size"))
    if differing.isEmpty():
        scratch.drop(hits, other, differing)
        out = located.join(groups, "digest")
    else:
        out = _split_by_text(located, groups, hits, differing, id_col, scratch)
    return out.select("row", "digest", "keep_id", "group_size", (F.col("locator") == F.col("rep")).alias("kept"))


def _split_by_text(located, groups, hits, differing, id_col, scratch) -> DataFrame:
    """The rows of colliding digests grouped by full text, all others by digest."""
    ids = located.select("locator", F.col("row").getField(id_col).alias("id"))
    apart = hits.join(differing, "digest").select("digest", "content", "locator").join(ids, "locator")
    exact = apart.groupBy("digest", "content").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count("*").alias("group_size"))
    exact = scratch.put(exact, "exact")
    split = apart.join(exact, ["digest", "content"]).select(
        "locator", F.col("keep.id").alias("keep_id"), F.col("keep.locator").alias("rep"), "group_size"
    )
    columns = ["row", "digest", "locator", "keep_id", "rep", "group_size"]
    plain = located.join(groups.join(differing, "digest", "left_anti"), "digest").select(*columns)
    return plain.union(located.join(scratch.put(split, "split"), "locator").select(*columns))
