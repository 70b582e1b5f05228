"""Shared plumbing of the training-data operators: scratch tables in the
cluster's shared folder, session settings held for one step, input reading."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Held while an intermediate table is written: the step's shuffle files go
# when it ends, and Python workers get batches of a few MB.
STEP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def shared_base(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local master without
    that setting gets a temporary folder (tests); elsewhere it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the duration of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Scratch:
    """Tables of one operator run, in a folder of their own under the shared
    base. ``put`` writes a frame and reads it back (lineage ends there, so a
    lost executor costs no recomputation); ``drop`` deletes a table that no
    later step reads. What the returned frame still reads stays."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = self.path(f"{self._n:03d}-{name}")
        with settings(self.spark, STEP_CONF):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, t._scratch_path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that its path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged. ``lower`` does just that on
    pure ASCII and is far faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, A_Z, a_z))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns of a frame (all unless given), whatever their names, as one struct ``row``."""
    return F.struct(*[quoted(c).alias(c) for c in columns or df.columns]).alias("row")


def ranked(rows: DataFrame, group: str, order: list[Column], scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """The places of rows in their groups, without a window over a group.

    All rows are dealt by ranges of (group, order) and sorted, so that a group of
    any size lies in several tasks; rows that are equal in these are dealt by
    their place in the input. Returns the written rows with ``part`` and ``pos``
    (place within the part), and the ``parts``, one row for each group and part
    that it lies in: ``group``, ``part``, ``shift`` and ``n``. A row's place in
    its group, from 0, is its pos plus the shift; n is the size of the group."""
    dealt = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_salt")]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *rows.columns, F.spark_partition_id().alias("part"), inside.alias("pos")
    )
    placed = scratch.put(placed, name)
    sizes = placed.groupBy(group, "part").agg(F.min("pos").alias("first"), F.count("*").alias("m"))
    before = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")
    parts = sizes.select(group, "part", shift.alias("shift"), F.sum("m").over(W.partitionBy(group)).alias("n"))
    return placed, scratch.put(parts, f"{name}-parts")


# Bytes of text that a Python worker works on at a time (one row at least).
BATCH_BYTES = 4 << 20


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts have about ``limit`` bytes together."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def bounded(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], column: int = 1):
    """A function for ``mapInArrow``: ``work`` on slices of each batch bounded by
    the bytes of a text column; see ``released``."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in by_bytes(batch, column):
                yield from work(part)

    return released(batches)


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow``. When its partition ends, the worker gives what
    it no longer uses back to the system: idle workers wait for the next stage beside
    an executor that needs the memory."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(it)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = _trim()
            if trim:
                trim(0)

    return batches


@functools.cache
def _trim():
    """The C library's malloc_trim, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)
