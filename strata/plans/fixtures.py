"""Registry and store views derived from the driver's test tables.

The test tables carry no registry, so one is derived from them, the same
way in Spark (here) and in the SQL oracle (plans/oracle.py):

* every ``event_type`` of ``events`` is a dataset; every UTC day of ``ts``
  is one ingestion run of it (row_count = rows that day, ingested_at = the
  day's last ``ts``);
* runs on days 10, 20 and 30 were made under contract version 1.1 (``value``
  required), all others under 1.0;
* each run upserts the dataset registration first (as the pipeline does);
  datasets whose first letter has an even code point were re-registered
  at version 2.0 one hour after their last run, which no run has used yet
  (schema drift);
* every ``nation`` is a registered reference dataset that was never ingested;
* ``orders`` is one dataset ingested monthly, ``date`` = o_orderdate and
  ``symbol`` = o_orderpriority.
"""

from __future__ import annotations

import datetime as dt

from strata.functions.timefn import ntz
from strata.session import ensure_checkpoint_dir
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.digest import run_id_col
from strata.model import Column, Contract
from strata.operators.fingerprint import contract_hash_col, schema_fingerprint
from strata.operators.registry import latest_registrations

# Fixed scenario values (shared with the SQL oracle).
FREQUENCIES = ["intraday", "daily", "weekly", "monthly", "on_demand"]
NOW = dt.datetime(2024, 1, 31, 6, 0, 0)
AS_OF = "2024-01-15"
ORDERS_AS_OF = "1998-06-15"
ORDERS_SYMBOL = "1-URGENT"
DRIFT_VERSION = "2.0"
REFERENCE_REGISTERED_AT = dt.datetime(2024, 1, 1)


def events_contract(version: str = "1.0") -> Contract:
    value_nullable = version == "1.0" or version == DRIFT_VERSION
    return Contract(
        "events",
        version,
        (
            Column("event_id", "int"),
            Column("ts", "timestamp"),
            Column("user_id", "int"),
            Column("event_type", "string"),
            Column("value", "float", nullable=value_nullable),
            Column("props", "string", nullable=True),
        ),
    )


ORDERS_CONTRACT = Contract(
    "orders",
    "1.0",
    (
        Column("o_orderkey", "int"),
        Column("o_custkey", "int"),
        Column("o_orderstatus", "string"),
        Column("o_totalprice", "float"),
        Column("date", "date"),
        Column("symbol", "string"),
    ),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def run_version(day: SparkColumn) -> SparkColumn:
    return F.when(F.dayofmonth(day) % 10 == 0, F.lit("1.1")).otherwise(F.lit("1.0"))


def frequency_of(name: SparkColumn) -> SparkColumn:
    return F.element_at(F.array(*[F.lit(f) for f in FREQUENCIES]), (F.ascii(F.substring(name, -1, 1)) % 5 + 1).cast("int"))


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def contract_columns(datasets: DataFrame, versions: list[str]) -> DataFrame:
    """Long contract table (dataset_name, version, column_name, dtype, nullable, position)
    for every dataset name in ``datasets`` and each events contract version
    (a generator over a literal array: no join, one row in -> columns x versions out)."""
    entries = []
    for v in versions:
        for i, c in enumerate(events_contract(v).columns):
            entries.append(
                f"named_struct('version', {_sql_str(v)}, 'column_name', {_sql_str(c.name)}, 'dtype', {_sql_str(c.dtype)}, "
                f"'nullable', {str(c.nullable).lower()}, 'position', {i})"
            )
    return datasets.select("dataset_name", F.expr(f"inline(array({', '.join(entries)}))"))


def events_contract_hash(name_col: str, version_col: str) -> SparkColumn:
    return contract_hash_col(name_col, version_col, {v: events_contract(v).columns for v in ["1.0", "1.1", DRIFT_VERSION]})


def event_datasets(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("dataset_name")).distinct()


def event_fingerprints(events: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    ds = datasets if datasets is not None else event_datasets(events)
    return schema_fingerprint(contract_columns(ds, ["1.0", "1.1", DRIFT_VERSION]))


def event_runs(events: DataFrame) -> DataFrame:
    """The ingestion-record log: one record per (event_type, day).

    Materialised once (checkpoint into the shared checkpoint folder), as a
    stored registry table would be: one row per run, far smaller than the
    events it is derived from. Every later use reads it instead of
    re-aggregating the events, and no predicate on the computed run id can
    be pushed below the aggregate into a per-event evaluation.
    """
    ensure_checkpoint_dir(events.sparkSession)
    return _event_runs(events).checkpoint(eager=True)


def _event_runs(events: DataFrame) -> DataFrame:
    runs = events.groupBy(F.col("event_type").alias("dataset_name"), F.to_date("ts").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max("ts").alias("ingested_at"),
        F.sum("event_id").alias("_ids"),
    )
    runs = runs.withColumn("version", run_version(F.col("ingest_date")))
    # The contract's columns are declared; only the dataset name and version
    # vary per run, so the schema hash is a projection of the run row.
    runs = runs.withColumn("schema_hash", events_contract_hash("dataset_name", "version"))
    source = F.concat(F.lit("raw/"), F.col("dataset_name"), F.lit("/"), F.col("ingest_date").cast("string"), F.lit(".csv"))
    rid = run_id_col(F.col("dataset_name"), source, F.col("schema_hash"), F.col("ingest_date"))
    return runs.select(
        rid.alias("run_id"),
        "dataset_name",
        "version",
        "ingested_at",
        "row_count",
        F.sha2(F.concat(F.lit("rows:"), F.col("row_count").cast("string"), F.lit(":ids:"), F.col("_ids").cast("string")), 256).alias("checksum"),
        source.alias("source_path"),
        F.concat(
            F.lit("canonical/dataset="), F.col("dataset_name"), F.lit("/ingest_date="), F.col("ingest_date").cast("string"), F.lit("/run_id="), rid
        ).alias("partition_path"),
        "schema_hash",
        "ingest_date",
    )


def registration_events(spark: SparkSession, sf_dir: str, runs: DataFrame | None = None) -> DataFrame:
    """Registration event log (name, version, owner, expected_frequency, schema_hash,
    description, event_at, event_seq): one upsert per run, the 2.0 drift bumps,
    and one registration per nation that never gets ingested."""
    events = read(spark, sf_dir, "events")
    runs = runs if runs is not None else event_runs(events)
    per_run = runs.select(
        F.col("dataset_name").alias("name"),
        "version",
        F.lit("events").alias("owner"),
        frequency_of(F.col("dataset_name")).alias("expected_frequency"),
        "schema_hash",
        F.concat(F.lit("event stream "), F.col("dataset_name")).alias("description"),
        F.col("ingested_at").alias("event_at"),
        F.lit(0).cast("long").alias("event_seq"),
    )
    last = runs.groupBy(F.col("dataset_name").alias("name")).agg(F.max("ingested_at").alias("last_at"))
    drift = (
        last.where(F.ascii("name") % 2 == 0)
        .withColumn("version", F.lit(DRIFT_VERSION))
        .select(
            "name",
            "version",
            F.lit("events").alias("owner"),
            frequency_of(F.col("name")).alias("expected_frequency"),
            events_contract_hash("name", "version").alias("schema_hash"),
            F.concat(F.lit("event stream "), F.col("name")).alias("description"),
            F.timestamp_add("HOUR", F.lit(1), F.col("last_at")).alias("event_at"),
            F.lit(1).cast("long").alias("event_seq"),
        )
    )
    nations = read(spark, sf_dir, "nation").select(
        F.concat(F.lit("ref_"), F.lower("n_name")).alias("name"),
        F.lit("1.0").alias("version"),
        F.lit("reference").alias("owner"),
        frequency_of(F.concat(F.lit("ref_"), F.lower("n_name"))).alias("expected_frequency"),
        F.sha2(F.concat(F.lit("ref_"), F.lower("n_name"), F.lit("|1.0")), 256).alias("schema_hash"),
        F.lit(None).cast("string").alias("description"),
        ntz(REFERENCE_REGISTERED_AT).alias("event_at"),
        F.lit(0).cast("long").alias("event_seq"),
    )
    return per_run.unionByName(drift).unionByName(nations)


def registrations(spark: SparkSession, sf_dir: str, runs: DataFrame | None = None) -> DataFrame:
    return latest_registrations(registration_events(spark, sf_dir, runs))


# A run holds rows dated up to so many days (orders: months) after its own day,
# which only the point-in-time filter hides.
EVENTS_LOOK_AHEAD, ORDERS_LOOK_AHEAD = 3, 1
NO_DATE_EVENTS, NO_DATE_ORDERS = 41, 43


def events_store(events: DataFrame, date_type: str = "date") -> DataFrame:
    """events as a snapshot store: run keys (dataset_name, ingest_date) and the
    ``date`` column (a date, or a timestamp) the point-in-time filter applies to.

    The run of a day holds the rows of that day and of the three days after it;
    rows whose event_id is divisible by 41 have no date."""
    date = F.when(F.col("event_id") % NO_DATE_EVENTS != 0, F.to_date("ts") if date_type == "date" else F.col("ts"))
    ahead = F.explode(F.array(*[F.lit(k) for k in range(EVENTS_LOOK_AHEAD + 1)])).alias("ahead")
    return events.select("*", F.col("event_type").alias("dataset_name"), date.alias("date"), ahead).withColumn(
        "ingest_date", F.date_sub(F.to_date("ts"), F.col("ahead"))
    ).drop("ahead")


def half_day_records(events: DataFrame) -> DataFrame:
    """A finer log: one record per (event_type, half day), so that datasets have
    far over 31 runs. Both runs of a day carry one ingestion time (ties), and the
    runs of the last day of datasets with an odd first letter report ten times
    their rows (a failing volume)."""
    ensure_checkpoint_dir(events.sparkSession)
    day, half = F.to_date("ts"), F.when(F.hour("ts") < 12, F.lit("am")).otherwise(F.lit("pm"))
    runs = events.groupBy(F.col("event_type").alias("dataset_name"), day.alias("ingest_date"), half.alias("half")).agg(F.count(F.lit(1)).alias("n"))
    last = runs.groupBy("dataset_name").agg(F.max("ingest_date").alias("last"))
    swollen = (F.col("ingest_date") == F.col("last")) & (F.ascii("dataset_name") % 2 == 1)
    source = F.concat(F.lit("raw/"), F.col("dataset_name"), F.lit("/"), F.col("ingest_date").cast("string"), F.lit("-"), F.col("half"), F.lit(".csv"))
    out = runs.join(last, "dataset_name").select(
        run_id_col(F.col("dataset_name"), source, F.lit("half"), F.col("ingest_date")).alias("run_id"),
        "dataset_name",
        F.lit("1.0").alias("version"),
        F.timestamp_add("HOUR", F.lit(18), F.col("ingest_date").cast("timestamp_ntz")).alias("ingested_at"),
        F.when(swollen, F.col("n") * 10).otherwise(F.col("n")).alias("row_count"),
        F.lit("half").alias("schema_hash"),
    )
    return out.checkpoint(eager=True)


def dirty_events(events: DataFrame) -> DataFrame:
    """events as raw CSV text with injected faults (by event_id residue):
    padded cells, blanks, unparseable numbers and timestamps, and a
    yes/no flag column. Faults are deterministic so both engines agree."""
    e = F.col("event_id")
    ts_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    value_text = F.format_string("%.2f", F.col("value"))
    return events.select(
        F.when(e % 211 == 0, F.lit("#")).otherwise(e.cast("string")).alias("event_id"),
        F.when(e % 67 == 0, F.date_format("ts", "yyyy/MM/dd"))
        .when(e % 71 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(e % 73 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(ts_text)
        .alias("ts"),
        F.when(e % 79 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .when(e % 83 == 0, F.concat(F.lit(" \t"), F.col("user_id").cast("string"), F.lit("  ")))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(e % 59 == 0, F.lit("   ")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(e % 97 == 0, F.lit("N/A"))
        .when(e % 89 == 0, F.lit(""))
        .when(e % 61 == 0, F.lit("-Infinity"))
        .when(e % 53 == 0, F.lit("1e3"))
        .otherwise(value_text)
        .alias("value"),
        F.col("props"),
        F.element_at(F.array(*[F.lit(x) for x in ["true", "FALSE", "yes", "No", "1", "maybe", "0", " "]]), (e % 8 + 1).cast("int")).alias("flag"),
    )


DIRTY_CONTRACT = Contract(
    "events_raw",
    "1.0",
    (
        Column("event_id", "int"),
        Column("ts", "timestamp"),
        Column("user_id", "int"),
        Column("event_type", "string"),
        Column("value", "float", nullable=True),
        Column("props", "string", nullable=True),
        Column("flag", "boolean", nullable=True),
    ),
)


def events_with_nulls(events: DataFrame) -> DataFrame:
    """Typed events with nulls made by event_id residue (value ~10%, user_id rare)."""
    e = F.col("event_id")
    return events.select(
        "event_id",
        "ts",
        F.when(e % 997 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(e % 10 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(e % 12 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
    )


def orders_store(orders: DataFrame) -> DataFrame:
    """orders as a store with a text ``date``: the run of a month holds its orders
    and those of the month after; every 43rd order key has no date."""
    ahead = F.explode(F.array(*[F.lit(k) for k in range(ORDERS_LOOK_AHEAD + 1)])).alias("ahead")
    return orders.select("*", ahead).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.when(F.col("o_orderkey") % NO_DATE_ORDERS != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.col("o_orderpriority").alias("symbol"),
        F.lit("orders").alias("dataset_name"),
        F.date_format(F.add_months("o_orderdate", -F.col("ahead")), "yyyy-MM").alias("ingest_month"),
    )


def order_runs(orders: DataFrame) -> DataFrame:
    """Monthly runs of the orders dataset; ingested_at = the month's last order date."""
    dated = orders.select(F.lit("orders").alias("dataset_name"), F.to_date("o_orderdate").alias("date"),
                          F.date_format("o_orderdate", "yyyy-MM").alias("ingest_month"))
    h = ORDERS_CONTRACT.schema_hash()
    runs = dated.groupBy("dataset_name", "ingest_month").agg(F.count(F.lit(1)).alias("row_count"), F.max("date").alias("_last"))
    source = F.concat(F.lit("raw/orders/"), F.col("ingest_month"), F.lit(".csv"))
    return runs.select(
        run_id_col(F.col("dataset_name"), source, F.lit(h), F.col("_last")).alias("run_id"),
        "dataset_name",
        "ingest_month",
        F.col("_last").cast("timestamp_ntz").alias("ingested_at"),
        "row_count",
    )
