"""Structured Streaming ingestion of CSV files arriving in a folder.

Every micro-batch becomes one ingestion run. The stream carries the names of the
files that arrived; each file is read by its own header, its columns matched by
name, so files of one stream may order them differently. A file whose header
breaks the contract is quarantined whole (its lines, and why); of the others
clean rows are written to the run's snapshot directory and bad rows to a
quarantine directory next to it, in one pass that also counts rows and nulls. Then
the run is registered and its health report written. A run is identified by its
stream (the id that Spark keeps in the checkpoint) and batch number: a batch
replayed after a failure, on whatever day, is the same run and its record a no-op,
while a new checkpoint is a new stream. Data is written to a staging folder,
moved into place, and recorded last; a replay of an unrecorded batch replaces
what the first attempt left, at that attempt's date.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.model import DEFAULT_NULLABLE_THRESHOLD, Contract
from strata.operators.health import null_summary_of_counts
from strata.operators.normalize import MALFORMED, normalize_types, observed_nulls, with_quarantine_flag
from strata.operators.validate import quoted
from strata.plans.ingest import discard_staging, log_manifest, report
from strata.sources.csv import Header, csv_source, header_errors, headers_of
from strata.sources.registry_store import Registry
from strata.sources.snapshots import run_path, staging_path, write_run
from strata.session import ensure_checkpoint_dir, hadoop_path, rename_path


@dataclass
class StreamIngestConfig:
    dataset_name: str
    version: str
    owner: str
    expected_frequency: str
    contract: Contract
    source_dir: str
    registry_base: str
    store_base: str
    quarantine_base: str
    checkpoint: str
    max_files_per_trigger: int | None = None
    strict_columns: bool = True
    multi_line: bool = True  # False: no field holds a line break, large files are split
    nullable_threshold: float = DEFAULT_NULLABLE_THRESHOLD


def stream_run_id(cfg: StreamIngestConfig, schema_hash: str, stream_id: str, batch_id: int) -> str:
    payload = f"{cfg.dataset_name}|{cfg.source_dir}|{schema_hash}|{stream_id}|{batch_id}"
    return hashlib.sha256(payload.encode()).hexdigest()


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream, which Spark writes when it first uses the checkpoint."""
    text = "".join(r["value"] for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def _run_date(spark: SparkSession, base: str, dataset: str, run_id: str, today: dt.date) -> dt.date:
    """The date under which an earlier attempt stored the run, else today."""
    fs, pattern = hadoop_path(spark, f"{base.rstrip('/')}/dataset={dataset}/ingest_date=*/run_id={run_id}")
    found = fs.globStatus(pattern)
    return dt.date.fromisoformat(found[0].getPath().getParent().getName().split("=", 1)[1]) if found else today


# What a stream of files carries; their content is not read here.
FILE_FIELDS = "path string, modificationTime timestamp, length long, content binary"


def _file_stream(spark: SparkSession, cfg: StreamIngestConfig) -> DataFrame:
    reader = spark.readStream.format("binaryFile").schema(FILE_FIELDS)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.load(cfg.source_dir).select("path")


def dispatch(headers: dict[Header, list[str]], contract: Contract, strict_columns: bool = True) -> tuple[dict[Header, list[str]], list[tuple]]:
    """The headers that the contract allows, with their files, and the findings of
    the others: (file, column, error_type, details)."""
    allowed, findings = {}, []
    for header, files in headers.items():
        errors = header_errors([header], contract, strict_columns)
        if errors:
            findings += [(file, *error) for file in files for error in errors]
        else:
            allowed[header] = files
    return allowed, findings


FINDING_FIELDS = "file string, column string, error_type string, details string"


def quarantine_files(spark: SparkSession, findings: list[tuple], base: str) -> None:
    """Keep files that were refused whole: ``lines`` (file, line) and ``findings``
    (file, column, error_type, details) below ``base``."""
    spark.createDataFrame(findings, FINDING_FIELDS).coalesce(1).write.mode("overwrite").parquet(f"{base}/findings")
    files = sorted({f[0] for f in findings})
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    write_run(lines, f"{base}/lines")


def make_batch_handler(spark: SparkSession, cfg: StreamIngestConfig, clock=None):
    """The handler of a micro-batch: a frame of file names (``path``), or of the
    contract's columns as text with the malformed flag."""
    registry = Registry(spark, cfg.registry_base)
    schema_hash = cfg.contract.schema_hash()
    ensure_checkpoint_dir(spark)

    def rows_of(batch: DataFrame) -> tuple[DataFrame | None, list[tuple]]:
        if batch.columns != ["path"]:
            return batch, []
        # As many names as a micro-batch has files; their headers are read here anyway.
        headers = headers_of(spark, sorted(r["path"] for r in batch.collect()))
        allowed, findings = dispatch(headers, cfg.contract, cfg.strict_columns)
        return (csv_source(spark, allowed, cfg.contract, cfg.multi_line) if allowed else None), findings

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = clock() if clock else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        run_id = stream_run_id(cfg, schema_hash, stream_id_of(spark, cfg.checkpoint), batch_id)
        if registry.has_run(run_id, cfg.dataset_name):
            return  # replayed batch: already recorded
        raw, findings = rows_of(batch)
        day = _run_date(spark, cfg.store_base, cfg.dataset_name, run_id, now.date())
        path = run_path(cfg.store_base, cfg.dataset_name, day, run_id)
        if raw is None:
            raw = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in cfg.contract.names])).withColumn(MALFORMED, F.lit(False))
        # One pass types, classifies, counts and writes the batch, good and bad rows apart.
        flagged = with_quarantine_flag(normalize_types(raw, cfg.contract))
        obs = Observation(f"batch{batch_id}")
        good = ~F.col("quarantined")
        counts = [F.count_if(good).alias("rows")]
        for i, c in enumerate(cfg.contract.columns):
            empty = quoted(c.name).isNull() | F.isnan(quoted(c.name)) if c.dtype == "float" else quoted(c.name).isNull()
            counts.append(F.count_if(good & empty).alias(f"null{i}"))
        staging = staging_path(cfg.store_base, run_id)
        refused = run_path(cfg.quarantine_base, cfg.dataset_name, day, run_id)
        try:
            write_run(flagged.observe(obs, *counts), f"{staging}/rows", partition_by="quarantined")
            seen = obs.get
            rows = int(seen["rows"])
            for name, target in (("false", path), ("true", refused)):
                part = f"{staging}/rows/quarantined={name}"
                fs, p = hadoop_path(spark, part)
                if not fs.exists(p):  # no such rows: an empty run, that readers find by its schema
                    write_run(flagged.drop("quarantined").limit(0), part)
                rename_path(spark, part, target)
            if findings:
                quarantine_files(spark, findings, f"{staging}/files")
                rename_path(spark, f"{staging}/files", f"{cfg.quarantine_base.rstrip('/')}/_files/dataset={cfg.dataset_name}/run_id={run_id}")
        finally:
            discard_staging(spark, cfg.store_base, staging)
        checksum = log_manifest(registry, path, run_id)
        registry.register_dataset(cfg.dataset_name, cfg.version, cfg.owner, cfg.expected_frequency, schema_hash, at=now)
        registry.record_ingestion({
            "run_id": run_id, "dataset_name": cfg.dataset_name, "version": cfg.version, "ingested_at": now,
            "row_count": rows, "checksum": checksum, "source_path": f"{cfg.source_dir}#batch={batch_id}",
            "partition_path": path, "schema_hash": schema_hash,
        })
        nulls = null_summary_of_counts(spark, cfg.dataset_name, cfg.contract, rows, observed_nulls(cfg.contract, seen), cfg.nullable_threshold)
        report(registry, cfg.dataset_name, nulls, now)

    return handle


def refused_files(spark: SparkSession, quarantine_base: str, dataset: str) -> DataFrame:
    """``run_id, file, column, error_type, details`` of all files quarantined whole."""
    base = f"{quarantine_base.rstrip('/')}/_files/dataset={dataset}"
    schema = T._parse_datatype_string(f"run_id string, {FINDING_FIELDS}")
    fs, p = hadoop_path(spark, base)
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(FINDING_FIELDS).parquet(f"{base}/run_id=*/findings")
    run_id = F.regexp_extract(F.col("_metadata.file_path"), "/run_id=([^/]*)/", 1).alias("run_id")
    return found.select(run_id, *[f.name for f in schema.fields[1:]])


def run_stream_ingest(spark: SparkSession, cfg: StreamIngestConfig, clock=None) -> None:
    """Ingest everything currently in ``source_dir`` (availableNow), then stop."""
    query = (
        _file_stream(spark, cfg).writeStream.foreachBatch(make_batch_handler(spark, cfg, clock))
        .option("checkpointLocation", cfg.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
