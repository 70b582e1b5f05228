"""The registered queries: one per operator family, each over whole test tables.

Each function takes (spark, sf_dir) and returns a lazy DataFrame. The SQL
oracle for each lives in plans/oracle.py under the same key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.model import Column, Contract
from strata.operators.changes import row_changes
from strata.operators.digest import content_digest
from strata.operators.health import (
    DETAILS_JSON,
    DETAILS_SCHEMA,
    aggregate_status,
    check_freshness,
    check_schema_hash,
    check_volume,
    health_reports,
    latest_run_nulls,
    null_ratio_long,
    volume_backfill,
)
from strata.operators.parallel import spread
from strata.operators.fingerprint import contracts_from_json, schema_fingerprint
from strata.operators.normalize import gate_summary, normalize_types, quarantine_split, with_quarantine_flag
from strata.operators.point_in_time import asof_rows, asof_runs, point_in_time, rows_of_run
from strata.operators.registry import (
    ingestion_history,
    latest_health,
    latest_ingestion,
    records_to_append,
)
from strata.operators.validate import validation_errors
from strata.functions.timefn import end_of_day_literal, valid_as_of
from strata.plans import fixtures as fx
from strata.plans.ingest import IngestionConfig, ingest
from strata.session import delete_path, ensure_checkpoint_dir, hadoop_path, rename_path, shared_dir
from strata.sources.csv import csv_options
from strata.sources.manifest import file_manifest, verify_manifest
from strata.sources.registry_store import Registry
from strata.sources.snapshots import data_files, read_store, write_run
from strata.streaming.daily_volume import daily_volume_batch_via_stream
from strata.streaming.file_ingest import StreamIngestConfig, refused_files, run_stream_ingest
from strata.streaming.volume_checks import read_checks, run_volume_checks

MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
RECORD_COLS = ["run_id", "dataset_name", "version", "ingested_at", "row_count", "checksum", "source_path", "partition_path", "schema_hash"]


def _events(spark, sf):
    return fx.read(spark, sf, "events")


def _records(spark, sf):
    return fx.event_runs(_events(spark, sf)).select(*RECORD_COLS)


# --- contracts and identity -------------------------------------------------

def q_schema_fingerprint(spark, sf):
    return fx.event_fingerprints(_events(spark, sf))


def q_ingestion_records(spark, sf):
    return fx.event_runs(_events(spark, sf))


# --- normalisation, gate, quarantine ----------------------------------------

def _raw_events(spark, sf):
    """Dirty text rows; typing them is per-row CPU work, spread over the cores."""
    return fx.dirty_events(spread(_events(spark, sf)))


def _normalized(spark, sf):
    return normalize_types(_raw_events(spark, sf), fx.DIRTY_CONTRACT)


def q_normalize_events(spark, sf):
    n = _normalized(spark, sf)
    return n.select(*fx.DIRTY_CONTRACT.names, F.size("_errors").cast("int").alias("n_errors"),
                    F.array_join(F.transform("_errors", lambda e: F.concat(e["column"], F.lit(":"), e["error_type"])), ",").alias("error_list"))


def q_error_summary_events(spark, sf):
    return gate_summary(_raw_events(spark, sf), fx.DIRTY_CONTRACT)


def q_quarantine_events(spark, sf):
    flagged = with_quarantine_flag(_normalized(spark, sf))
    return flagged.groupBy(F.col("event_type").alias("dataset_name")).agg(
        F.count_if(~F.col("quarantined")).alias("good_rows"), F.count_if(F.col("quarantined")).alias("bad_rows")
    )


# --- typed-frame validation ---------------------------------------------------

VALIDATE_EVENTS_CONTRACT = Contract(
    "events",
    "1.0",
    (
        Column("event_id", "int"),
        Column("symbol", "string"),
        Column("ts", "timestamp"),
        Column("user_id", "int"),
        Column("value", "int", nullable=True),
    ),
)

EMBEDDINGS_CONTRACT = Contract(
    "embeddings", "1.0", (Column("vec_id", "int"), Column("embedding", "string"), Column("label", "int"))
)

ORDERS_TYPED_CONTRACT = Contract(
    "orders",
    "1.0",
    (
        Column("o_orderkey", "int"),
        Column("o_custkey", "int"),
        Column("o_orderstatus", "string"),
        Column("o_totalprice", "float"),
        Column("o_orderdate", "date"),
        Column("o_orderpriority", "string"),
    ),
)


def q_validate_events(spark, sf):
    return validation_errors(fx.events_with_nulls(_events(spark, sf)), VALIDATE_EVENTS_CONTRACT, strict_columns=True)


def q_validate_embeddings(spark, sf):
    return validation_errors(fx.read(spark, sf, "embeddings"), EMBEDDINGS_CONTRACT, strict_columns=True)


def _orders_with_nulls(spark, sf):
    o = fx.read(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def q_validate_orders(spark, sf):
    return validation_errors(_orders_with_nulls(spark, sf), ORDERS_TYPED_CONTRACT, strict_columns=False)


# --- health ------------------------------------------------------------------

def q_null_ratio_events(spark, sf):
    df = fx.events_with_nulls(_events(spark, sf)).withColumn("dataset_name", F.col("event_type"))
    return null_ratio_long(df, fx.events_contract("1.0"), ["dataset_name"])


LINEITEM_CONTRACT = Contract(
    "lineitem",
    "1.0",
    (
        Column("l_orderkey", "int"),
        Column("l_partkey", "int"),
        Column("l_suppkey", "int"),
        Column("l_quantity", "float"),
        Column("l_extendedprice", "float"),
        Column("l_discount", "float", nullable=True),
        Column("l_tax", "float", nullable=True),
        Column("l_shipdate", "timestamp"),
        Column("l_comment", "string", nullable=True),
    ),
)


def _lineitem_with_nulls(spark, sf):
    li = fx.read(spark, sf, "lineitem")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return li.select(
        "l_returnflag",
        "l_orderkey",
        "l_partkey",
        F.when(k % 1009 == 0, F.lit(None)).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        "l_quantity",
        "l_extendedprice",
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        "l_shipdate",
    )


def q_null_ratio_lineitem(spark, sf):
    return null_ratio_long(_lineitem_with_nulls(spark, sf), LINEITEM_CONTRACT, ["l_returnflag"])


def q_freshness(spark, sf):
    events = _events(spark, sf)
    runs = fx.event_runs(events)
    regs = fx.registrations(spark, sf, runs)
    return check_freshness(regs, latest_ingestion(runs.select(*RECORD_COLS)), fx.NOW)


def q_volume(spark, sf):
    return check_volume(fx.half_day_records(_events(spark, sf)))


def q_volume_backfill(spark, sf):
    return volume_backfill(fx.half_day_records(_events(spark, sf)))


def q_schema_hash_check(spark, sf):
    runs = fx.event_runs(_events(spark, sf))
    regs = fx.registrations(spark, sf, runs)
    return check_schema_hash(regs, latest_ingestion(runs.select(*RECORD_COLS)))


def health_frame(spark: SparkSession, sf: str, now=fx.NOW) -> DataFrame:
    """The set-based health report for every registered dataset."""
    events = _events(spark, sf)
    runs = fx.event_runs(events)
    records = runs.select(*RECORD_COLS)
    regs = fx.registrations(spark, sf, runs)
    latest = latest_ingestion(records)
    # Null ratios of each dataset's latest run only. The latest run keys are few
    # (one per dataset): a semi join with them, a broadcast after a check of
    # their size, drops the rows of older runs in the scan's own stage; over a
    # store partitioned by the keys it prunes their folders (latest_run_nulls).
    rows = fx.events_with_nulls(events).withColumn("dataset_name", F.col("event_type")).withColumn("ingest_date", F.to_date("ts"))
    keys = latest_ingestion(runs.select(*RECORD_COLS, "ingest_date")).select("dataset_name", "ingest_date")
    nulls = latest_run_nulls(rows, keys, fx.events_contract("1.0"), ["dataset_name", "ingest_date"])
    return health_reports(regs, records, nulls, now)


def q_health_report(spark, sf):
    """Reports with their details as typed columns."""
    reports = health_frame(spark, sf).withColumn("d", F.from_json("details", DETAILS_SCHEMA, DETAILS_JSON))
    columns = F.transform(F.filter("d.null_ratio.columns", lambda c: c["violated"]), lambda c: F.concat_ws(":", c["column_name"], c["null_ratio"].cast("decimal(9,6)").cast("string")))
    return reports.select(
        "id", "dataset_name", "checked_at", "status", "freshness_ok", "volume_ok", "null_ratio_ok", "schema_hash_ok",
        "d.freshness.freshness_reason", "d.freshness.ingested_at", "d.freshness.age_seconds", "d.freshness.max_age_seconds",
        F.col("d.volume.reason").alias("volume_reason"), "d.volume.records_available", "d.volume.current_row_count",
        "d.volume.baseline_mean", "d.volume.baseline_std", "d.volume.lower_bound", "d.volume.upper_bound",
        F.col("d.null_ratio.reason").alias("null_reason"), "d.null_ratio.total_rows", "d.null_ratio.nullable_threshold",
        F.array_join(columns, ",").alias("violations"),
        "d.schema_hash.schema_hash_reason", "d.schema_hash.expected_hash", "d.schema_hash.actual_hash",
    )


# --- registry reads ------------------------------------------------------------

def q_list_datasets(spark, sf):
    return fx.registrations(spark, sf)


def q_dataset_metadata(spark, sf):
    runs = fx.event_runs(_events(spark, sf))
    regs = fx.registrations(spark, sf, runs)
    latest = latest_ingestion(runs.select(*RECORD_COLS))
    return regs.join(
        latest.select(
            F.col("dataset_name").alias("name"),
            F.col("run_id").alias("latest_run_id"),
            F.col("ingested_at").alias("latest_ingested_at"),
            F.col("row_count").alias("latest_row_count"),
            F.col("schema_hash").alias("latest_schema_hash"),
        ),
        "name",
        "left",
    )


def q_ingestion_history(spark, sf):
    return ingestion_history(fx.half_day_records(_events(spark, sf)), 10).select("dataset_name", "rank", "run_id", "ingested_at", "row_count")


def q_ingestion_as_of(spark, sf):
    cutoff = end_of_day_literal(dt.date.fromisoformat(fx.AS_OF))
    return latest_ingestion(fx.half_day_records(_events(spark, sf)), cutoff).select("dataset_name", "run_id", "ingested_at", "row_count", "version")


def q_record_ingestion(spark, sf):
    runs = fx.event_runs(_events(spark, sf))
    existing = runs.where(F.col("ingest_date") <= F.lit(dt.date(2024, 1, 20))).select(*RECORD_COLS)
    incoming = runs.where(F.col("ingest_date") >= F.lit(dt.date(2024, 1, 10))).select(*RECORD_COLS)
    # A replayed batch: the same records arrive twice; first writer wins.
    incoming = incoming.unionByName(incoming)
    return existing.unionByName(records_to_append(existing, incoming)).select("run_id", "dataset_name", "ingested_at", "row_count")


def _reports_log(spark, sf):
    """A report per run from the volume backfill, checked 5 minutes after the run."""
    vb = volume_backfill(_records(spark, sf))
    checked = F.timestamp_add("MINUTE", F.lit(5), F.col("ingested_at"))
    return vb.select(
        F.sha2(F.concat_ws("|", F.col("dataset_name"), F.date_format(checked, MICROS_FORMAT)), 256).alias("id"),
        "dataset_name",
        checked.alias("checked_at"),
        aggregate_status(F.lit(True), F.col("volume_ok"), F.lit(True), F.lit(True)).alias("status"),
        F.lit(True).alias("freshness_ok"),
        "volume_ok",
        F.lit(True).alias("null_ratio_ok"),
        F.lit(True).alias("schema_hash_ok"),
    )


def q_latest_health(spark, sf):
    return latest_health(_reports_log(spark, sf)).select("dataset_name", "id", "checked_at", "status", "volume_ok")


# --- point in time ---------------------------------------------------------------

def q_pit_events(spark, sf):
    events = _events(spark, sf)
    runs = fx.event_runs(events)
    store = fx.events_store(events)
    out = point_in_time(store, runs, "click", fx.AS_OF, run_keys=("dataset_name", "ingest_date"))
    return out.drop("dataset_name", "ingest_date")


def q_pit_orders_symbol(spark, sf):
    orders = fx.read(spark, sf, "orders")
    store = fx.orders_store(orders)
    runs = fx.order_runs(orders)
    out = point_in_time(store, runs, "orders", fx.ORDERS_AS_OF, symbol=fx.ORDERS_SYMBOL, run_keys=("dataset_name", "ingest_month"))
    return out.drop("dataset_name", "ingest_month")


def asof_requests(events: DataFrame) -> DataFrame:
    """Every dataset asked for every day from the day before its first event
    to the day after its last one."""
    span = events.groupBy(F.col("event_type").alias("dataset_name")).agg(
        F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1")
    )
    return span.select("dataset_name", F.explode(F.sequence(F.date_sub("d0", 1), F.date_add("d1", 1))).alias("as_of"))


def q_asof_bulk(spark, sf):
    events = _events(spark, sf)
    return asof_runs(asof_requests(events), _records(spark, sf).select(*RECORD_COLS))


def q_asof_rows_events(spark, sf):
    """Bulk point-in-time rows: every as-of request of asof_bulk with its visible rows."""
    events = _events(spark, sf)
    records = fx.event_runs(events)
    out = asof_rows(fx.events_store(events, "timestamp"), asof_requests(events), records, run_keys=("dataset_name", "ingest_date"))
    return out.select("dataset_name", "as_of", "event_id", "ts", "user_id", "value", "ingestion_run_id", "ingested_at")


# --- content digests ------------------------------------------------------------

def q_digest_documents(spark, sf):
    d = fx.read(spark, sf, "documents")
    return content_digest(d, ["doc_id", "text", "lang", "source", "n_chars"], ["lang"])


def q_digest_conversations(spark, sf):
    c = fx.read(spark, sf, "conversations")
    return content_digest(c, ["conv_id", "turn", "role", "text"], ["role"])


def q_digest_pages(spark, sf):
    p = fx.read(spark, sf, "pages")
    return content_digest(p, ["page_id", "url", "html"])


def q_row_changes(spark, sf):
    """Two versions of events (some rows without a user): of the newer one some rows
    are gone, some have another value, some another user, some come twice. Rows
    added, removed and changed for each user with any."""
    old, e = fx.events_with_nulls(_events(spark, sf)), F.col("event_id")
    edited = old.where(e % 97 != 0).withColumns(
        {"value": F.when(e % 89 == 3, -F.col("value")).otherwise(F.col("value")),
         "user_id": F.when(e % 83 == 7, F.col("user_id") + 1).otherwise(F.col("user_id"))})
    return row_changes(old, edited.unionAll(edited.where(e % 101 == 5)), old.columns, ["user_id"])


# --- end-to-end CSV ingestion ------------------------------------------------------

def _workspace(spark, name: str) -> str:
    """A folder of this application for one query; what an earlier run left goes first."""
    base = shared_dir(spark, name)
    delete_path(spark, base)
    return base


def _write_csv(df: DataFrame, path: str) -> None:
    """RFC 4180 text in two column orders: half of the rows in files with the
    columns as they are, the other half in files with them reversed."""
    half = F.col("event_id").cast("string").try_cast("long") % 2 == 0
    for rows, columns in ((df.where(half), df.columns), (df.where(~F.coalesce(half, F.lit(False))), df.columns[::-1])):
        csv_options(rows.select(*columns).write.mode("append")).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def _ingest_config(base: str, contract: Contract) -> IngestionConfig:
    return IngestionConfig(contract.name, contract.version, "events", "daily", contract, f"{base}/raw", f"{base}/registry", f"{base}/store")


def q_csv_ingest_events(spark, sf):
    """events written as CSV (timestamps to the second, as the contract's text
    grammar has no fractions), ingested end to end (scan, typing, gate,
    write, manifest, registry, health), and the stored typed rows read back."""
    base = _workspace(spark, "csv-ingest")
    cfg = _ingest_config(base, fx.events_contract("1.0"))
    _write_csv(_events(spark, sf), cfg.source_path)
    res = ingest(spark, cfg, now=fx.NOW)
    if not res.success:
        raise RuntimeError(res.error)
    delete_path(spark, cfg.source_path)
    return spark.read.parquet(res.partition_path)


def q_ingest_two_writers(spark, sf):
    """events as CSV, ingested as the same run by two writers at once: the stored
    rows of each event type, and the logged records, data folders, manifests of
    stored files and re-runs that the two leave."""
    base = _workspace(spark, "two-writers")
    cfg = _ingest_config(base, fx.events_contract("1.0"))
    _write_csv(_events(spark, sf), cfg.source_path)
    with ThreadPoolExecutor(2) as writers:
        results = list(writers.map(lambda _: ingest(spark, cfg, now=fx.NOW), range(2)))
    failed = [r.error for r in results if not r.success]
    if failed:
        raise RuntimeError(failed[0])
    registry, path = Registry(spark, cfg.registry_base), results[0].partition_path
    fs, runs = hadoop_path(spark, path.rsplit("/", 1)[0])
    unlisted = verify_manifest(spark, registry.manifest(), path).count()
    left = [("records", "logged", registry.table("ingestion_records").count()), ("folders", "runs", len(fs.listStatus(runs))),
            ("files", "not as logged", unlisted), ("reruns", "unchanged", sum(r.rerun and not r.source_changed for r in results))]
    stored = spark.read.parquet(path).groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return stored.select(F.lit("rows").alias("kind"), "name", "n").unionByName(spark.createDataFrame(left, "kind string, name string, n long"))


def q_ingest_rejected(spark, sf):
    """Dirty events through the whole ingestion: the gate's findings, and how
    many files, records and registrations a rejected source leaves (none)."""
    base = _workspace(spark, "ingest-rejected")
    cfg = _ingest_config(base, fx.DIRTY_CONTRACT)
    _write_csv(fx.dirty_events(_events(spark, sf)), cfg.source_path)
    res = ingest(spark, cfg, now=fx.NOW)
    registry = Registry(spark, cfg.registry_base)
    fs, store = hadoop_path(spark, cfg.store_base)
    left = len(fs.listStatus(store)) if fs.exists(store) else 0
    left += registry.records().count() + registry.registrations().count() + int(res.success)
    delete_path(spark, base)
    return spark.createDataFrame([*res.errors, ("_store", "left_behind", left, None)], "column string, error_type string, n_rows long, example string")


def q_manifest_verify(spark, sf):
    """Events as one stored file per event type, in the order of their names the
    first then deleted, the second replaced by other rows, the third by its rows
    twice: every file's rows when it was logged, and what verification finds."""
    base = _workspace(spark, "manifest-verify")
    ensure_checkpoint_dir(spark)
    events, store = _events(spark, sf), f"{base}/store"
    write_run(events.withColumn("dataset", F.col("event_type")).repartition("dataset"), store, partition_by="dataset")
    dataset = F.regexp_extract(F.col("path"), "/dataset=([^/]*)/", 1)
    logged = file_manifest(spark, store).withColumn("run_id", dataset).checkpoint(eager=True)
    stored = spark.read.parquet(store)
    counts = stored.groupBy(F.col("dataset").cast("string").alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows")).checkpoint(eager=True)
    files = sorted(r["path"] for r in logged.select("path").collect())  # one for each event type
    fs, _ = hadoop_path(spark, store)
    for k, file in enumerate(files[:3]):
        rows = spark.read.parquet(file)
        other = rows.withColumn("user_id", -F.col("user_id")) if k == 1 else rows.unionAll(rows)
        if k:
            write_run(other.coalesce(1), f"{base}/other-{k}")
        fs.delete(hadoop_path(spark, file)[1], False)
        if k:
            rename_path(spark, data_files(spark, f"{base}/other-{k}")[0][0], file)
    found = verify_manifest(spark, logged, store).select(F.col("run_id").alias("dataset"), "status")
    return counts.join(found, "dataset", "left").select("dataset", "n_rows", F.coalesce("status", F.lit("ok")).alias("outcome"))


def q_quarantine_rows(spark, sf):
    """Both sides of the quarantine split, one row each."""
    good, bad = quarantine_split(_normalized(spark, sf))
    return good.select("event_id", "event_type", F.lit("good").alias("side"), F.lit(0).alias("n_errors")).unionByName(
        bad.select("event_id", "event_type", F.lit("bad").alias("side"), F.size("_errors").alias("n_errors"))
    )


def q_contracts_json(spark, sf):
    """Contracts stored as JSON documents, read back and fingerprinted."""
    base = _workspace(spark, "contracts-json")
    columns = fx.contract_columns(fx.event_datasets(_events(spark, sf)), ["1.0", "1.1", fx.DRIFT_VERSION])
    docs = columns.groupBy(F.col("dataset_name").alias("name"), "version").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "column_name", "dtype", "nullable"))),
            lambda c: F.struct(c["column_name"].alias("name"), c["dtype"].alias("dtype"), c["nullable"].alias("nullable"), F.lit("text").alias("description")),
        ).alias("columns")
    )
    docs.write.json(f"{base}/contracts")
    return schema_fingerprint(contracts_from_json(spark, f"{base}/contracts", multi_line=False))


DATES_CONTRACT = Contract("dates", "1.0", (Column("key", "int"), Column("date", "date")))


def q_typed_dates(spark, sf):
    """Order dates as text in several forms, typed as dates (strict ISO), and the
    same text taken as requested as_of days."""
    o, k = fx.read(spark, sf, "orders"), F.col("o_orderkey")
    text = (
        F.when(k % 11 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(k % 13 == 0, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30")))
        .when(k % 17 == 0, F.date_format("o_orderdate", "yyyy-M-d"))
        .when(k % 19 == 0, F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ")))
        .when(k % 23 == 0, F.lit(" "))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    raw = o.select(k.cast("string").alias("key"), text.alias("date"))
    typed = normalize_types(raw.withColumn("asked", F.trim("date")), DATES_CONTRACT, keep=["asked"])
    return typed.select("key", "date", valid_as_of(F.col("asked")).alias("as_of"),
                        F.array_join(F.transform("_errors", lambda e: e["error_type"]), ",").alias("errors"))


def q_registry_roundtrip(spark, sf):
    """Registrations and records through the registry's stored logs: appended
    twice (the second time a no-op for records), compacted, and read back."""
    registry = Registry(spark, _workspace(spark, "registry-roundtrip"))
    runs = fx.event_runs(_events(spark, sf))
    records = runs.select(*RECORD_COLS)
    registry.append("dataset_registry", fx.registration_events(spark, sf, runs))
    registry.record_ingestions(records)
    registry.record_ingestions(records.withColumn("row_count", F.lit(-1).cast("long")))
    for table in ("dataset_registry", "ingestion_records"):
        registry.compact(table)
    history = registry.ingestion_history(None, 3).select(
        F.col("dataset_name").alias("name"), "rank", "run_id", "ingested_at", "row_count", F.col("version").alias("run_version"))
    return registry.registrations().select("name", "version", "registered_at", "updated_at").join(history, "name", "left")


def q_pit_store(spark, sf):
    """Every dataset's rows as known on the as_of day, from a partitioned store
    (dataset, ingest_date, run_id) through the registry's stored records."""
    base = _workspace(spark, "pit-store")
    events = _events(spark, sf)
    runs = fx.event_runs(events)
    registry = Registry(spark, f"{base}/registry")
    registry.record_ingestions(runs.select(*RECORD_COLS))
    keyed = fx.events_store(events).join(runs.select("dataset_name", "ingest_date", "run_id"), ["dataset_name", "ingest_date"])
    keyed.withColumnRenamed("dataset_name", "dataset").write.partitionBy("dataset", "ingest_date", "run_id").parquet(f"{base}/store")
    schema = T.StructType([*events.schema.fields, T.StructField("date", T.DateType())])
    out = None
    for name in sorted(r["event_type"] for r in events.select("event_type").distinct().collect()):
        record = registry.ingestion_as_of(name, end_of_day_literal(dt.date.fromisoformat(fx.AS_OF)))
        if record is not None:
            rows = rows_of_run(read_store(spark, f"{base}/store", name, schema), record, fx.AS_OF).select(
                F.lit(name).alias("dataset_name"), "event_id", "ts", "date", "ingestion_run_id", "ingested_at")
            out = rows if out is None else out.unionByName(rows)
    return out


# --- streaming --------------------------------------------------------------------

def q_stream_daily_volume(spark, sf):
    return daily_volume_batch_via_stream(spark, sf, glob="events.parquet")


def q_stream_volume_checks(spark, sf):
    """The runs in time order, as four arriving files: each is checked on arrival
    against the last 30 runs that the stream's state holds of its dataset."""
    base = _workspace(spark, "stream-volume")
    runs = fx.half_day_records(_events(spark, sf)).select("dataset_name", "run_id", "ingested_at", "row_count").checkpoint()
    first, last = runs.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    cuts = [first + (last - first) * k / 4 for k in (1, 2, 3)]
    quarter = reduce(lambda c, cut: c + (F.col("ingested_at") > F.lit(cut.isoformat(" ")).cast("timestamp_ntz")).cast("int"), cuts, F.lit(0))
    for k in range(4):
        runs.where(quarter == k).repartition(1).write.mode("append").parquet(f"{base}/runs")
    run_volume_checks(spark, f"{base}/runs", f"{base}/out", f"{base}/checkpoint", max_files_per_trigger=1)
    return read_checks(spark, f"{base}/out")


def q_stream_ingest_events(spark, sf):
    """Dirty events as arriving CSV files, two per micro-batch: the stored and the
    quarantined rows, and one line for the records' row counts."""
    base = _workspace(spark, "stream-ingest")
    contract = fx.DIRTY_CONTRACT
    dirty = fx.dirty_events(_events(spark, sf)).repartition(4)
    csv_options(dirty.write).csv(f"{base}/raw")
    cfg = StreamIngestConfig(contract.name, "1.0", "events", "daily", contract, f"{base}/raw", f"{base}/registry", f"{base}/store",
                             f"{base}/quarantine", f"{base}/checkpoint", max_files_per_trigger=2)
    run_stream_ingest(spark, cfg)
    stored = spark.read.option("recursiveFileLookup", "true").schema("event_id long, event_type string").parquet(f"{base}/store")
    bad = spark.read.option("recursiveFileLookup", "true").schema(
        "event_id long, event_type string, _errors array<struct<column: string, error_type: string>>").parquet(f"{base}/quarantine")
    errors = F.array_join(F.transform("_errors", lambda e: F.concat(e["column"], F.lit(":"), e["error_type"])), ",")
    total = Registry(spark, cfg.registry_base).records().agg(F.sum("row_count").alias("event_id"))
    return stored.select("event_id", "event_type", F.lit("stored").alias("outcome")).unionByName(
        bad.select("event_id", "event_type", errors.alias("outcome"))
    ).unionByName(total.select("event_id", F.lit("#records").alias("event_type"), F.lit("row_count").alias("outcome")))


def q_stream_ingest_headers(spark, sf):
    """Dirty events as arriving files in two column orders, and one file whose
    header lacks a column and has another: what is stored, quarantined by row and
    refused whole, and what the stream's health report counted."""
    base = _workspace(spark, "stream-headers")
    contract, events = fx.DIRTY_CONTRACT, _events(spark, sf)
    other = F.col("user_id") % 5 == 0
    dirty = fx.dirty_events(events.where(~other)).coalesce(2)
    raw = f"{base}/raw"
    _write_csv(dirty, raw)
    csv_options(fx.dirty_events(events.where(other)).drop("flag").withColumn("colour", F.lit("red")).coalesce(1).write.mode("append")).csv(raw)
    cfg = StreamIngestConfig(contract.name, "1.0", "events", "daily", contract, raw, f"{base}/registry", f"{base}/store",
                             f"{base}/quarantine", f"{base}/checkpoint")
    run_stream_ingest(spark, cfg, clock=lambda: fx.NOW)
    run = T._parse_datatype_string("event_type string, _errors array<struct<column: string, error_type: string>>")
    stored = read_store(spark, cfg.store_base, contract.name, run)
    bad = read_store(spark, cfg.quarantine_base, contract.name, run)
    errors = F.array_join(F.transform("_errors", lambda e: F.concat(e["column"], F.lit(":"), e["error_type"])), ",")
    refused = refused_files(spark, cfg.quarantine_base, contract.name)
    lines = spark.read.schema("line string").parquet(f"{cfg.quarantine_base}/_files/dataset={contract.name}/run_id=*/lines")
    reports = Registry(spark, cfg.registry_base).reports().select("null_ratio_ok", F.from_json("details", DETAILS_SCHEMA, DETAILS_JSON)["null_ratio"].alias("d"))
    n = F.count(F.lit(1)).alias("n")
    kind = lambda x: F.lit(x).alias("kind")
    parts = [
        stored.groupBy(kind("stored"), F.col("event_type").alias("name")).agg(n),
        bad.groupBy(kind("quarantined"), errors.alias("name")).agg(n),
        refused.groupBy(kind("refused"), F.concat_ws(":", "column", "error_type").alias("name")).agg(n),
        lines.groupBy(kind("refused"), F.lit("lines").alias("name")).agg(n),
        reports.select(kind("report"), F.concat(F.lit("null_ratio_ok="), F.col("null_ratio_ok").cast("string")).alias("name"), F.col("d.total_rows").alias("n")),
        reports.select(F.explode("d.columns").alias("c")).select(kind("nulls"), F.col("c.column_name").alias("name"), F.col("c.null_count").alias("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "schema_fingerprint": q_schema_fingerprint,
    "ingestion_records": q_ingestion_records,
    "normalize_events": q_normalize_events,
    "error_summary_events": q_error_summary_events,
    "quarantine_events": q_quarantine_events,
    "validate_events": q_validate_events,
    "validate_embeddings": q_validate_embeddings,
    "validate_orders": q_validate_orders,
    "null_ratio_events": q_null_ratio_events,
    "null_ratio_lineitem": q_null_ratio_lineitem,
    "freshness": q_freshness,
    "volume": q_volume,
    "volume_backfill": q_volume_backfill,
    "schema_hash_check": q_schema_hash_check,
    "health_report": q_health_report,
    "list_datasets": q_list_datasets,
    "dataset_metadata": q_dataset_metadata,
    "ingestion_history": q_ingestion_history,
    "ingestion_as_of": q_ingestion_as_of,
    "record_ingestion": q_record_ingestion,
    "latest_health": q_latest_health,
    "pit_events": q_pit_events,
    "pit_orders_symbol": q_pit_orders_symbol,
    "asof_bulk": q_asof_bulk,
    "asof_rows_events": q_asof_rows_events,
    "digest_documents": q_digest_documents,
    "digest_conversations": q_digest_conversations,
    "digest_pages": q_digest_pages,
    "row_changes": q_row_changes,
    "csv_ingest_events": q_csv_ingest_events,
    "ingest_two_writers": q_ingest_two_writers,
    "ingest_rejected": q_ingest_rejected,
    "manifest_verify": q_manifest_verify,
    "quarantine_rows": q_quarantine_rows,
    "contracts_json": q_contracts_json,
    "typed_dates": q_typed_dates,
    "registry_roundtrip": q_registry_roundtrip,
    "pit_store": q_pit_store,
    "stream_daily_volume": q_stream_daily_volume,
    "stream_volume_checks": q_stream_volume_checks,
    "stream_ingest_events": q_stream_ingest_events,
    "stream_ingest_headers": q_stream_ingest_headers,
}
