"""Immutable run snapshots: ``base/dataset=<d>/ingest_date=<yyyy-mm-dd>/run_id=<id>/``.

A run is written once to its own directory (the run id is part of the path,
so a later run on the same day never overwrites an earlier one that a
registry record still points to). Reads name the partition columns in the
schema, so values are never type-inferred from directory names.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.session import hadoop_path

PARTITION_FIELDS = [
    T.StructField("dataset", T.StringType(), True),
    T.StructField("ingest_date", T.DateType(), True),
    T.StructField("run_id", T.StringType(), True),
]


def run_path(base: str, dataset: str, ingest_date: dt.date, run_id: str) -> str:
    return f"{base.rstrip('/')}/dataset={dataset}/ingest_date={ingest_date.isoformat()}/run_id={run_id}"


# Bounds of a file: rows, and bytes. A file that many long rows took over the
# bytes is written again (``split_large_files``).
MAX_RECORDS_PER_FILE = 2_000_000
MAX_FILE_BYTES = 512 * 1024 * 1024


def write_run(df: DataFrame, path: str, max_records_per_file: int = MAX_RECORDS_PER_FILE, max_file_bytes: int = MAX_FILE_BYTES,
              rebalance: bool = False, partition_by: str | None = None) -> None:
    """Write the files of a run, none over ``max_file_bytes`` unless a single row
    takes that much. ``rebalance`` lets Spark deal the rows anew by their bytes
    first, at the price of a shuffle: for sources of very many small or few very
    large pieces."""
    rows = df.hint("rebalance") if rebalance else df
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    split_large_files(df.sparkSession, path, max_file_bytes)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, length) of the Parquet files below a folder."""
    fs, root = hadoop_path(spark, path)
    listed, out = fs.listFiles(root, True), []
    while listed.hasNext():
        status = listed.next()
        if status.getPath().getName().endswith(".parquet"):
            out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def split_large_files(spark: SparkSession, path: str, max_file_bytes: int) -> int:
    """Write every file below ``path`` that is larger than ``max_file_bytes`` again,
    as files of so many rows as fit by the file's own mean width, and return how
    many were replaced. Rows of very uneven width may need it again: it goes on
    until no file is too large or holds one row. Several splits read a large
    file, so this has as many tasks as the data; nothing passes through the driver
    but names and row counts of the large files."""
    replaced, single = 0, set()
    while large := [(f, n) for f, n in data_files(spark, path) if n > max_file_bytes and f not in single]:
        fs, _ = hadoop_path(spark, path)
        for file, length in large:
            folder = file.rsplit("/", 1)[0]
            # Only the file's own columns: partition values stay in the folder's name.
            rows = spark.read.option("basePath", folder).parquet(file)
            count = rows.count()
            if count < 2:
                single.add(file)
                continue
            fit = max(1, min(count // 2, int(count * 0.8 * max_file_bytes / length)))
            rows.write.mode("append").option("maxRecordsPerFile", fit).parquet(folder)
            fs.delete(hadoop_path(spark, file)[1], False)
            replaced += 1
    return replaced


def staging_path(base: str, run_id: str) -> str:
    """A folder for one attempt at a run; readers of the store never look there."""
    return f"{base.rstrip('/')}/_staging/{run_id}-{uuid.uuid4().hex}"


def read_store(spark: SparkSession, base: str, dataset: str, data_schema: T.StructType) -> DataFrame:
    """All runs of one dataset; filters on run_id / ingest_date prune directories."""
    schema = T.StructType(list(data_schema.fields) + PARTITION_FIELDS)
    return spark.read.schema(schema).option("basePath", base).parquet(f"{base.rstrip('/')}/dataset={dataset}")
