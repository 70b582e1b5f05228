"""File manifests: SHA-256 and length of every file of a run, and verification.

Files are hashed where they lie, by tasks that stream them: Spark's text source
cuts a file at its newline bytes, unchanged otherwise, and the pieces go through
one running digest. So a file of any size takes the memory of a batch of pieces,
the files of a run are shared out over the cores, and only paths and digests
come out. A run's checksum is a digest of its ``name:sha256`` lines, independent
of listing order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_LINES = 4000  # pieces of a file in the memory of a task at a time


def file_manifest(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """``run_id, path, length, sha256`` of every file of a run, whatever its size."""
    return hashed_files(spark, [path]).select(F.lit(run_id).cast("string").alias("run_id"), "path", "length", "sha256")


def listed_files(spark: SparkSession, roots: list[str], skip_unreadable: bool = False) -> DataFrame:
    """``path, length, uri`` of the Parquet files below some folders; no content is read. Spark
    lists no empty files: no Parquet file is, so one without bytes counts as gone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    if skip_unreadable:
        files = files.option("ignoreMissingFiles", "true")
    return files.load(roots).select("path", "length", F.col("_metadata.file_path").alias("uri"))


def hashed_files(spark: SparkSession, roots: list[str], skip_unreadable: bool = False) -> DataFrame:
    """``path, length, sha256`` of the Parquet files below some folders. With
    ``skip_unreadable`` a file that the file system refuses to read to its end
    has a null digest; otherwise it is an error."""
    listed = listed_files(spark, roots, skip_unreadable)
    largest = listed.agg(F.max("length")).first()[0]
    if largest is None:
        return listed.select("path", "length", F.lit(None).cast("string").alias("sha256"))
    # A session of its own, as how files are shared out over tasks is a session
    # setting: none is split, and each task gets some of them, one after the other.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    own.conf.set("spark.sql.files.openCostInBytes", str(largest + 1))
    lines = own.read.option("lineSep", "\n").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    if skip_unreadable:
        lines = lines.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    # The path as a value of the row: a task may get several files.
    read = lines.text(roots).select("_metadata.file_path", "_metadata.file_size", F.col("value").cast("binary").alias("line"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_LINES))
    digests = read.mapInArrow(_digests(skip_unreadable), "uri string, sha256 string")
    return listed.join(digests, "uri", "left").select("path", "length", "sha256")


def _digests(skip_unreadable: bool):
    """Lines of files, each file's in order and together -> path, SHA-256."""

    def close(path: str, size: int, done: int, digest) -> str | None:
        if done == size - 1:  # the file ends with a newline byte
            digest.update(b"\n")
        elif done != size:
            if not skip_unreadable:
                raise OSError(f"{path}: {done} of {size} bytes could be read")
            return None
        return digest.hexdigest()

    def batches(it: Iterator[pa.RecordBatch]):
        path, size, done, digest = None, 0, 0, None
        for batch in it:
            out = []
            paths = batch.column(0)
            at = 0
            lines = batch.column(2).to_pylist()
            while at < len(lines):
                here = paths[at].as_py()
                # The rows of one file stand together: the last of this batch is found by bisection.
                end = _last(paths, at, here)
                if here != path:
                    if path is not None:
                        out.append((path, close(path, size, done, digest)))
                    path, size, digest = here, batch.column(1)[at].as_py(), hashlib.sha256()
                    body = b"\n".join(lines[at:end])
                    done = len(body)
                else:
                    body = b"\n" + b"\n".join(lines[at:end])
                    done += len(body)
                digest.update(body)
                at = end
            yield pa.RecordBatch.from_pylist([{"uri": p, "sha256": h} for p, h in out], schema=_OUT)
        if path is not None:
            yield pa.RecordBatch.from_pylist([{"uri": path, "sha256": close(path, size, done, digest)}], schema=_OUT)

    return batches


_OUT = pa.schema([("uri", pa.string()), ("sha256", pa.string())])


def _last(paths, at: int, here: str) -> int:
    """The end of the rows from ``at`` on with this path."""
    low, high = at + 1, len(paths)
    if paths[high - 1].as_py() == here:
        return high
    while low < high:
        middle = (low + high) // 2
        if paths[middle].as_py() == here:
            low = middle + 1
        else:
            high = middle
    return low


def manifest_checksum(manifest: DataFrame, buckets: int = 1024) -> DataFrame:
    """One row per run_id: a digest of its (file name, sha256) lines, in two
    levels: the sorted lines of each bucket (by a hash of the line), then the
    sorted digests of the buckets. A run's million files are never in one row.
    """
    line = F.concat(F.element_at(F.split("path", "/"), -1), F.lit(":"), F.col("sha256"))
    lines = manifest.select("run_id", "length", line.alias("line"))
    parts = lines.groupBy("run_id", F.pmod(F.crc32("line"), F.lit(buckets)).alias("bucket")).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "\n"), 256).alias("part"),
        F.count(F.lit(1)).alias("n"),
        F.sum("length").alias("bytes"),
    )
    return parts.groupBy("run_id").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("part")), "\n"), 256).alias("checksum"),
        F.sum("n").alias("n_files"),
        F.sum("bytes").alias("bytes"),
    )


def verify_manifest(spark: SparkSession, manifest: DataFrame, root: str | None = None) -> DataFrame:
    """Files whose current bytes differ from the manifest, or that are gone:
    ``run_id, path, status, reason``. Status is 'changed', by 'length' (the content is
    not compared then) or 'digest'; or 'missing': 'gone', or 'unreadable', as the
    file system refuses to read it (its own checksum fails)."""
    # With ``root`` (the store), files are listed once under it and matched by
    # path, so verifying many runs sends no per-run list through the driver.
    roots = [root] if root else _roots(manifest)
    if not roots:
        return manifest.select("run_id", "path", F.lit("").alias("status"), F.lit("").alias("reason")).limit(0)
    current = hashed_files(spark, roots, skip_unreadable=True).select("path", F.col("length").alias("now_length"), F.col("sha256").alias("now_sha"))
    reason = (
        F.when(F.col("now_length").isNull(), "gone")
        .when(F.col("now_length") != F.col("length"), "length")
        .when(F.col("now_sha").isNull(), "unreadable")
        .when(F.col("now_sha") != F.col("sha256"), "digest")
    )
    found = manifest.join(current, "path", "left").select("run_id", "path", reason.alias("reason")).where("reason is not null")
    status = F.when(F.col("reason").isin("gone", "unreadable"), "missing").otherwise("changed")
    return found.select("run_id", "path", status.alias("status"), "reason")


def _roots(manifest: DataFrame) -> list[str]:
    # Directories of the runs in the manifest (one per run): for a few runs;
    # pass the store root to verify many.
    dirs = manifest.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("d")).distinct().collect()
    return [r["d"] for r in dirs]
