"""The registry: append-only Parquet logs with "latest" views.

Tables live under one base directory: ``dataset_registry``,
``ingestion_records``, ``health_reports`` and ``file_manifest``. Writers
only append new files (no row is updated in place), so concurrent writers
never clobber each other; writers of one run take turns by a claim
(``claim_run``), readers resolve duplicates (first writer wins on run_id) and
take the latest row per key with aggregates.
"""

from __future__ import annotations

import datetime as dt
import time

from strata.functions.timefn import ntz
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from strata.model import FRESHNESS_MAX_AGE, HealthStatus
from strata.session import hadoop_path
from strata.sources.claims import STALE_AFTER, claim_unless
from strata.operators.registry import (
    MANIFEST_SCHEMA,
    RECORD_SCHEMA,
    REGISTRATION_SCHEMA,
    REPORT_SCHEMA,
    first_writer_wins,
    ingestion_history,
    latest_health,
    latest_ingestion,
    latest_registrations,
    records_to_append,
)

TABLES = {
    "dataset_registry": REGISTRATION_SCHEMA,
    "ingestion_records": RECORD_SCHEMA,
    "health_reports": REPORT_SCHEMA,
    "file_manifest": MANIFEST_SCHEMA,
}

# Logs that grow with every run are partitioned by dataset, so a lookup for
# one dataset lists and scans only that dataset's files.
PARTITION_COLUMN = {"ingestion_records": "dataset_name", "health_reports": "dataset_name"}


class Registry:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # -- storage -------------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def exists(self, table: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table(self, table: str) -> DataFrame:
        schema = TABLES[table]
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        try:
            # The declared schema types the partition column too (no inference
            # from directory names); columns are returned in declared order.
            return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.fieldNames())
        except AnalysisException:  # created by a concurrent writer but still empty
            return self.spark.createDataFrame([], schema)

    def append(self, table: str, df: DataFrame) -> None:
        w = df.select(*TABLES[table].fieldNames()).write.mode("append")
        if table in PARTITION_COLUMN:
            w = w.partitionBy(PARTITION_COLUMN[table])
        w.parquet(self.path(table))

    # -- registrations -------------------------------------------------------------
    def register_dataset(self, name: str, version: str, owner: str, expected_frequency: str, schema_hash: str,
                         description: str = "", at: dt.datetime | None = None) -> None:
        """Upsert as an event: the newest event per name is the registration."""
        if expected_frequency not in FRESHNESS_MAX_AGE:
            raise ValueError(f"unknown frequency {expected_frequency!r}")
        at = at or dt.datetime.utcnow()
        row = (name, version, owner, expected_frequency, schema_hash, description, at, time.time_ns())
        self.append("dataset_registry", self.spark.createDataFrame([row], REGISTRATION_SCHEMA).coalesce(1))

    def registrations(self) -> DataFrame:
        return latest_registrations(self.table("dataset_registry"))

    def list_datasets(self) -> DataFrame:
        return self.registrations()

    def get_dataset(self, name: str) -> dict | None:
        rows = self.registrations().where(F.col("name") == name).take(1)
        return rows[0].asDict() if rows else None

    # -- ingestion records ---------------------------------------------------------
    def records(self, dataset: str | None = None) -> DataFrame:
        """Deduplicated records; a dataset filter is applied before the
        de-duplication (duplicates of a run id share its dataset), so it
        reaches the Parquet scan."""
        log = self.table("ingestion_records")
        if dataset is not None:
            log = log.where(F.col("dataset_name") == dataset)
        return first_writer_wins(log)

    def has_run(self, run_id: str, dataset: str | None = None) -> bool:
        """Is the run recorded? With ``dataset`` only that dataset's partition is read."""
        if not self.exists("ingestion_records"):
            return False
        log = self.table("ingestion_records")
        if dataset is not None:
            log = log.where(F.col("dataset_name") == dataset)
        return bool(log.where(F.col("run_id") == run_id).select("run_id").take(1))

    def claim_run(self, run_id: str, dataset: str, stale_after: float = STALE_AFTER) -> str | None:
        """The marker that lets this writer put a run into place and record it, or
        None once the run is recorded. Waits while another writer holds it;
        ``claims.release`` gives it back."""
        return claim_unless(lambda: self.has_run(run_id, dataset), self.spark, f"{self.base}/run_claims/{run_id}", stale_after)

    def record_ingestions(self, incoming: DataFrame) -> None:
        """Insert-if-absent on run_id (anti join against the log, then append)."""
        self.append("ingestion_records", records_to_append(self.table("ingestion_records"), incoming))

    def record_ingestion(self, record: dict) -> None:
        """One record: a filtered scan of the run_id column decides, no join."""
        if self.has_run(record["run_id"], record["dataset_name"]):
            return
        row = tuple(record[f] for f in RECORD_SCHEMA.fieldNames())
        self.append("ingestion_records", self.spark.createDataFrame([row], RECORD_SCHEMA).coalesce(1))

    def ingestion_as_of(self, dataset: str, as_of: dt.datetime) -> dict | None:
        as_of = as_of.replace(tzinfo=None) if as_of.tzinfo else as_of
        rows = latest_ingestion(self.records(dataset), ntz(as_of)).take(1)
        return rows[0].asDict() if rows else None

    def ingestion_history(self, dataset: str | None = None, limit: int = 10) -> DataFrame:
        return ingestion_history(self.records(dataset), limit)

    def latest_records(self) -> DataFrame:
        return latest_ingestion(self.records())

    # -- health reports ------------------------------------------------------------
    def write_health_reports(self, reports: DataFrame) -> None:
        self.append("health_reports", reports)

    def reports(self) -> DataFrame:
        return self.table("health_reports")

    def latest_health(self, dataset: str | None = None) -> DataFrame:
        reps = self.reports()
        if dataset is not None:
            reps = reps.where(F.col("dataset_name") == dataset)
        return latest_health(reps)

    def health_listing(self) -> DataFrame:
        """Every registered dataset with its latest status; 'unknown' when never checked."""
        latest = self.latest_health().select("dataset_name", "status", "checked_at")
        return self.registrations().select(F.col("name").alias("dataset_name")).join(latest, "dataset_name", "left").select(
            "dataset_name", F.coalesce("status", F.lit(HealthStatus.UNKNOWN.value)).alias("status"), "checked_at"
        )

    # -- manifests -----------------------------------------------------------------
    def write_manifest(self, manifest: DataFrame, checksum: str) -> None:
        """Log the files of one attempt at a run under the attempt's checksum."""
        self.append("file_manifest", manifest.withColumn("checksum", F.lit(checksum)))

    def manifest(self, run_id: str | None = None) -> DataFrame:
        """The files of recorded runs. An attempt that crashed before its record
        was written left files of another checksum: those are not listed."""
        m = self.table("file_manifest")
        recorded = self.records().select("run_id", "checksum")
        if run_id is not None:
            m, recorded = m.where(F.col("run_id") == run_id), recorded.where(F.col("run_id") == run_id)
        return m.join(recorded, ["run_id", "checksum"], "left_semi").select(*MANIFEST_SCHEMA.fieldNames()).distinct()

    # -- maintenance ---------------------------------------------------------------
    def compact(self, table: str) -> int:
        """Rewrite the small files of a log into few and return how many went.

        The files present at the start are read, their rows written as new files
        of the log, then exactly these files are deleted: rows that another
        writer appends meanwhile lie in other files and stay. Until the deletion
        readers may see a row twice, which changes no view (records are unique
        by run id, reports by id, registrations by their newest event, manifest
        rows are distinct)."""
        if not self.exists(table):
            return 0
        fs, root = hadoop_path(self.spark, self.path(table))
        listed, files, size = fs.listFiles(root, True), [], 0
        while listed.hasNext():
            status = listed.next()
            if status.getPath().getName().endswith(".parquet"):
                files.append(status.getPath())
                size += status.getLen()
        if len(files) < 2:
            return 0
        schema = TABLES[table]
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        rows = reader.parquet(*[p.toString() for p in files]).select(*schema.fieldNames())
        # As many files (in each dataset's folder) as the log has times 128 MB.
        n = 1 + size // (128 * 1024 * 1024)
        part = F.pmod(F.xxhash64(*schema.fieldNames()), F.lit(n))
        by = [F.col(PARTITION_COLUMN[table])] if table in PARTITION_COLUMN else []
        self.append(table, rows.distinct().repartition(*by, part))
        for p in files:
            fs.delete(p, False)
        return len(files)
