"""End-to-end ingestion of one source under a contract.

The source is read once: its typed rows are written to a staging folder while
an observation of the same pass counts rows, violations of every rule and
nulls of every column. If a rule is violated the staging folder is deleted
and nothing else has happened; otherwise it is moved to the run's place,
its files are hashed, and the registration, the record and the health report
(from the observed counts) are appended. The record comes after the data, so a
crash leaves at most an unreferenced folder, never a record of missing data.
Several writers may ingest one run at a time: each writes to its own staging
folder, one of them (``Registry.claim_run``) moves it into place and records it,
the others then report a re-run.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.model import DEFAULT_NULLABLE_THRESHOLD, Contract
from strata.operators.changes import change_counts
from strata.operators.health import check_null_ratio, health_reports, null_summary_of_counts
from strata.operators.normalize import observed_gate, observed_nulls, observed_rows, typed_rows
from strata.operators.parallel import spread
from strata.sources.claims import STALE_AFTER, holds, release
from strata.sources.csv import csv_source, header_errors, read_headers
from strata.sources.manifest import file_manifest, manifest_checksum
from strata.operators.registry import REPORT_SCHEMA
from strata.sources.registry_store import Registry
from strata.sources.snapshots import MAX_FILE_BYTES, MAX_RECORDS_PER_FILE, run_path, staging_path, write_run
from strata.session import delete_path, ensure_checkpoint_dir, hadoop_path, rename_path


@dataclass
class IngestionConfig:
    dataset_name: str
    version: str
    owner: str
    expected_frequency: str
    contract: Contract
    source_path: str
    registry_base: str
    store_base: str
    nullable_threshold: float = DEFAULT_NULLABLE_THRESHOLD
    strict_columns: bool = True
    multi_line: bool = True  # False: no field holds a line break, large files are split
    max_records_per_file: int = MAX_RECORDS_PER_FILE
    max_file_bytes: int = MAX_FILE_BYTES
    rebalance: bool = False  # True: deal the rows anew by their bytes before they are written
    key_columns: tuple[str, ...] = ()  # name a row across versions: re-runs tell changed rows from added and removed ones
    claim_seconds: float = STALE_AFTER  # a writer silent for longer while it records a run is taken as dead


@dataclass
class IngestionResult:
    success: bool
    run_id: str
    dataset_name: str
    row_count: int
    partition_path: str
    schema_hash: str
    status: str | None = None
    health_report: dict | None = None
    error: str | None = None
    errors: list[tuple] = field(default_factory=list)  # (column, error_type, n_rows, example)
    rerun: bool = False
    source_changed: bool | None = None  # re-runs only: the source differs from the recorded run
    source_changes: dict[str, int] | None = None  # re-runs of a readable source: rows added, removed, changed
    timings: dict[str, float] = field(default_factory=dict)  # seconds per step


def compute_run_id(dataset: str, source_path: str, schema_hash: str, day: dt.date) -> str:
    """sha256 of 'dataset|source|schema_hash|YYYY-MM-DD' (content is not part of it)."""
    return hashlib.sha256(f"{dataset}|{source_path}|{schema_hash}|{day.isoformat()}".encode()).hexdigest()


def _error_text(errors: list[tuple]) -> str:
    parts = []
    for column, etype, n, example in errors:
        eg = f", e.g. {example!r}" if example is not None else ""
        parts.append(f"[{etype}] {column}: {n} row(s){eg}" if n is not None else f"[{etype}] {column}: {example}")
    return f"{len(errors)} contract violation(s): " + "; ".join(parts)


def ingest(spark: SparkSession, cfg: IngestionConfig, now: dt.datetime | None = None) -> IngestionResult:
    if now is None:
        now = dt.datetime.now(dt.timezone.utc)
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    registry = Registry(spark, cfg.registry_base)
    schema_hash = cfg.contract.schema_hash()
    day = now.date()
    run_id = compute_run_id(cfg.dataset_name, cfg.source_path, schema_hash, day)
    path = run_path(cfg.store_base, cfg.dataset_name, day, run_id)
    result = IngestionResult(False, run_id, cfg.dataset_name, 0, path, schema_hash)

    clock = [time.perf_counter()]

    def step(name: str) -> None:
        now_t = time.perf_counter()
        result.timings[name] = round(now_t - clock[0], 3)
        clock[0] = now_t

    rerun = registry.has_run(run_id, cfg.dataset_name)
    step("lookup")
    claim = None
    if not rerun:
        try:
            headers = read_headers(spark, cfg.source_path)
        except Exception as exc:  # missing or unreadable source: reported, nothing written
            result.error = f"source '{cfg.source_path}' cannot be read as CSV: {type(exc).__name__}"
            return result
        file_errors = header_errors(headers, cfg.contract, cfg.strict_columns)
        if file_errors:
            result.errors = [(c, t, None, d) for c, t, d in file_errors]
            result.error = _error_text(result.errors)
            return result
        raw = spread(csv_source(spark, headers, cfg.contract, cfg.multi_line))
        staging = staging_path(cfg.store_base, run_id)
        try:
            obs = Observation("ingest")
            write_run(observed_rows(raw, cfg.contract, obs), staging, cfg.max_records_per_file, cfg.max_file_bytes, cfg.rebalance)
            seen = obs.get
            step("write")
            result.errors = observed_gate(raw, cfg.contract, seen)
            if result.errors:
                result.error = _error_text(result.errors)
                return result
            claim = registry.claim_run(run_id, cfg.dataset_name, cfg.claim_seconds)
            if claim:
                row_count = int(seen["n_rows"])
                _settle(registry, cfg, result, claim, staging, row_count, now)
                step("manifest")
        finally:
            if claim:
                release(spark, claim)
            discard_staging(spark, cfg.store_base, staging)
        rerun = claim is None  # another writer of this run has recorded it meanwhile
    if rerun:
        prior = registry.records(cfg.dataset_name).where(F.col("run_id") == run_id).first()
        row_count, path = int(prior["row_count"]), prior["partition_path"]
        result.partition_path = path
        result.source_changes = _source_changes(spark, cfg, path)
        result.source_changed = result.source_changes is None or any(result.source_changes.values())
        nulls = check_null_ratio(spark.read.parquet(path), cfg.contract, [], cfg.nullable_threshold)
        nulls = nulls.withColumn("dataset_name", F.lit(cfg.dataset_name))
        step("compare")
    else:
        nulls = null_summary_of_counts(spark, cfg.dataset_name, cfg.contract, row_count, observed_nulls(cfg.contract, seen),
                                       cfg.nullable_threshold)

    registry.register_dataset(cfg.dataset_name, cfg.version, cfg.owner, cfg.expected_frequency, schema_hash, at=now)
    step("registry")
    result.health_report = report(registry, cfg.dataset_name, nulls, now)
    step("health")
    result.success, result.row_count, result.status, result.rerun = True, row_count, result.health_report["status"], rerun
    return result


def _settle(registry: Registry, cfg: IngestionConfig, result: IngestionResult, claim: str, staging: str, row_count: int,
            now: dt.datetime) -> None:
    """Under the run's claim: move the staged files into place, log and record them.

    A writer that was taken for dead while it hashed its files stops here; the
    one that outlived its claim writes the record."""
    rename_path(registry.spark, staging, result.partition_path)
    checksum = log_manifest(registry, result.partition_path, result.run_id)
    if not holds(registry.spark, claim):
        raise RuntimeError(f"the claim on run {result.run_id} was taken over after {cfg.claim_seconds} s")
    registry.record_ingestion(
        {
            "run_id": result.run_id,
            "dataset_name": cfg.dataset_name,
            "version": cfg.version,
            "ingested_at": now,
            "row_count": row_count,
            "checksum": checksum,
            "source_path": cfg.source_path,
            "partition_path": result.partition_path,
            "schema_hash": result.schema_hash,
        }
    )


def log_manifest(registry: Registry, path: str, run_id: str) -> str:
    """Hash the files of a run where they lie, log them, return their checksum.

    The files are hashed once (the rows are checkpointed); the checksum comes
    from these rows, not from a scan of the ever-growing log."""
    ensure_checkpoint_dir(registry.spark)
    manifest = file_manifest(registry.spark, path, run_id).checkpoint(eager=True)
    checksum = manifest_checksum(manifest).first()["checksum"]
    registry.write_manifest(manifest, checksum)
    return checksum


def discard_staging(spark: SparkSession, base: str, staging: str) -> None:
    """Delete an attempt's folder, and the folder of attempts when it was the last."""
    delete_path(spark, staging)
    fs, parent = hadoop_path(spark, staging.rsplit("/", 1)[0])
    if fs.exists(parent) and not fs.listStatus(parent):
        fs.delete(parent, False)


def _source_changes(spark: SparkSession, cfg: IngestionConfig, path: str) -> dict[str, int] | None:
    """How many rows the source has more, less and changed against the recorded run.

    Compares the source typed under the contract with the stored rows by a hash
    tree (operators/changes.py), so a source that is equal costs one aggregate.
    None for a source that no longer reads, or has another header: all of it
    counts as changed.
    """
    try:
        headers = read_headers(spark, cfg.source_path)
    except Exception:  # noqa: BLE001 - an unreadable source is a changed source
        return None
    if header_errors(headers, cfg.contract, cfg.strict_columns):
        return None
    names = cfg.contract.names
    new = typed_rows(csv_source(spark, headers, cfg.contract, cfg.multi_line), cfg.contract)
    return change_counts(spark.read.parquet(path).select(*names), new, names, list(cfg.key_columns))


def run_health(spark: SparkSession, registry: Registry, dataset: str, data_path: str, contract: Contract,
               now: dt.datetime, threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> str:
    """Health report for one dataset over the rows at ``data_path``; appended to the registry."""
    if registry.get_dataset(dataset) is None:
        raise ValueError(_unregistered(dataset))
    return health_report_for(registry, dataset, spark.read.parquet(data_path), contract, now, threshold)["status"]


def _unregistered(dataset: str) -> str:
    return f"'{dataset}' has no registration; health is only checked for registered datasets"


def health_report_for(registry: Registry, dataset: str, data: DataFrame, contract: Contract,
                      now: dt.datetime | None = None, threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> dict:
    """The four checks for one registered dataset over ``data``; the report is
    appended to the registry and returned (one row). Raises ValueError when
    the dataset is not registered."""
    # One group of all rows: no column is added to the data, whatever its names.
    nulls = check_null_ratio(data, contract, [], threshold).withColumn("dataset_name", F.lit(dataset))
    return report(registry, dataset, nulls, now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def report(registry: Registry, dataset: str, nulls: DataFrame, now: dt.datetime) -> dict:
    """The health report of a registered dataset from its null summary; appended to the registry."""
    regs = registry.registrations().where(F.col("name") == dataset)
    # One row (one registered dataset): computed once, then appended as is;
    # no row means the dataset is not registered.
    rows = health_reports(regs, registry.records(dataset), nulls, now).collect()
    if not rows:
        raise ValueError(_unregistered(dataset))
    registry.write_health_reports(registry.spark.createDataFrame(rows, REPORT_SCHEMA).coalesce(1))
    report = rows[0].asDict()
    report["details"] = json.loads(report["details"])
    return report


class HealthReporter:
    """``HealthReporter(registry, nullable_threshold).run(dataset_name, df, contract)`` -> report dict."""

    def __init__(self, registry: Registry, nullable_threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> None:
        self.registry = registry
        self.nullable_threshold = nullable_threshold

    def run(self, dataset_name: str, df: DataFrame, contract: Contract, now: dt.datetime | None = None) -> dict:
        return health_report_for(self.registry, dataset_name, df, contract, now, self.nullable_threshold)


class IngestionPipeline:
    """``IngestionPipeline(spark, config).run()`` -> IngestionResult."""

    def __init__(self, spark: SparkSession, config: IngestionConfig) -> None:
        self.spark = spark
        self.config = config

    def run(self, now: dt.datetime | None = None) -> IngestionResult:
        return ingest(self.spark, self.config, now)
