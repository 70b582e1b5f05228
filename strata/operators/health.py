"""Health checks for every dataset at once.

Each check is a DataFrame keyed by dataset_name; the report joins the four
on that key. Inputs are registry views (one row per dataset or per run) and
per-dataset null counts computed in one aggregate over the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.timefn import age_micros, ntz
from strata.model import (
    DEFAULT_NULLABLE_THRESHOLD,
    FRESHNESS_MAX_AGE,
    REASON_COLUMN_MISSING,
    REASON_EMPTY,
    REASON_INSUFFICIENT,
    REASON_NO_HISTORY,
    REASON_NO_RECORD,
    REASON_ON_DEMAND,
    VOLUME_HISTORY,
    VOLUME_MIN_RECORDS,
    VOLUME_SIGMAS,
    Contract,
    HealthStatus,
)
from strata.operators.registry import ingestion_history



# Declared schema of the JSON ``details`` of a health report (read back with from_json).
DETAILS_SCHEMA = (
    "freshness struct<freshness_reason:string,ingested_at:timestamp_ntz,age_seconds:bigint,max_age_seconds:bigint,"
    "expected_frequency:string>, "
    "volume struct<reason:string,records_available:bigint,current_row_count:bigint,baseline_mean:double,"
    "baseline_std:double,lower_bound:double,upper_bound:double>, "
    "null_ratio struct<reason:string,total_rows:bigint,nullable_threshold:double,columns:array<struct<column_name:string,"
    "null_count:bigint,null_ratio:double,threshold:double,nullable:boolean,violated:boolean,reason:string>>>, "
    "schema_hash struct<schema_hash_reason:string,expected_hash:string,actual_hash:string>"
)


# Written and read with microseconds (the default keeps milliseconds).
DETAILS_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _max_age_micros() -> Column:
    """Literal map frequency -> max age in microseconds (inlined, no join)."""
    pairs = []
    for freq, delta in FRESHNESS_MAX_AGE.items():
        if delta is not None:
            pairs += [F.lit(freq), F.lit(int(delta.total_seconds()) * 1_000_000)]
    return F.create_map(*pairs)


def freshness_columns(now_c: Column, latest_at: Column) -> list[Column]:
    """Freshness over a frame holding ``expected_frequency`` and the latest ingestion time.

    on_demand is always fresh; no record is stale; otherwise ok when
    now - ingested_at <= max age (inclusive; a future ingestion is fresh).
    """
    max_age = F.element_at(_max_age_micros(), F.col("expected_frequency"))
    age = age_micros(now_c, latest_at)
    on_demand = F.col("expected_frequency") == F.lit("on_demand")
    missing = latest_at.isNull()
    return [
        F.when(on_demand, F.lit(True)).when(missing, F.lit(False)).otherwise(F.coalesce(age <= max_age, F.lit(False))).alias("freshness_ok"),
        F.when(on_demand, F.lit(REASON_ON_DEMAND)).when(missing, F.lit(REASON_NO_RECORD)).alias("freshness_reason"),
        F.when(~on_demand, latest_at).alias("ingested_at"),
        F.when(~on_demand & ~missing, F.round(age / F.lit(1_000_000.0)).cast("long")).alias("age_seconds"),
        F.when(~on_demand & ~missing, (max_age / F.lit(1_000_000)).cast("long")).alias("max_age_seconds"),
    ]


def schema_columns(expected: Column, actual: Column) -> list[Column]:
    missing = actual.isNull()
    return [
        expected.alias("expected_hash"),
        actual.alias("actual_hash"),
        F.when(missing, F.lit(False)).otherwise(expected == actual).alias("schema_hash_ok"),
        F.when(missing, F.lit(REASON_NO_RECORD)).alias("schema_hash_reason"),
    ]


def check_freshness(registrations: DataFrame, latest: DataFrame, now) -> DataFrame:
    """registrations(name, expected_frequency) x latest record per dataset -> freshness."""
    now_c = ntz(now)
    joined = registrations.select(F.col("name").alias("dataset_name"), "expected_frequency").join(
        latest.select("dataset_name", F.col("ingested_at").alias("_latest_at")), "dataset_name", "left"
    )
    return joined.select("dataset_name", "expected_frequency", *freshness_columns(now_c, F.col("_latest_at")))


def volume_stats(history: DataFrame) -> DataFrame:
    """From ranked history (rank 1 = newest): current count and baseline n, S, Q.

    S and Q are exact decimal(38,0) sums so the decision never rounds.
    """
    rc = F.col("row_count").cast("decimal(38,0)")
    is_base = F.col("rank") > 1
    newest = F.col("rank") == 1
    return history.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("records_available"),
        F.max(F.when(newest, F.col("row_count"))).alias("current_row_count"),
        F.max(F.when(newest, F.col("ingested_at"))).alias("latest_ingested_at"),
        F.max(F.when(newest, F.col("schema_hash"))).alias("latest_schema_hash"),
        F.max(F.when(newest, F.col("run_id"))).alias("latest_run_id"),
        F.count_if(is_base).alias("baseline_n"),
        F.sum(F.when(is_base, rc)).cast("decimal(38,0)").alias("baseline_sum"),
        F.sum(F.when(is_base, rc * rc)).cast("decimal(38,0)").alias("baseline_sumsq"),
    )


def volume_decision(stats: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Within mean +- 3 sigma (population), tested exactly as
    (n*c - S)^2 <= 9 * (n*Q - S^2); sigma = 0 reduces to c == mean.

    Display values (mean, sigma, bounds) are doubles; the decision uses none of them.
    """
    keys = list(keys or ["dataset_name"])
    n = F.col("baseline_n").cast("decimal(38,0)")
    c = F.col("current_row_count").cast("decimal(38,0)")
    s = F.col("baseline_sum")
    q = F.col("baseline_sumsq")
    dev = n * c - s
    spread = n * q - s * s
    within = (dev * dev) <= F.lit(VOLUME_SIGMAS * VOLUME_SIGMAS).cast("decimal(38,0)") * spread
    enough = F.col("records_available") >= VOLUME_MIN_RECORDS
    mean = s.cast("double") / F.col("baseline_n").cast("double")
    std = F.sqrt(spread.cast("double")) / F.col("baseline_n").cast("double")
    return stats.select(
        *keys,
        "records_available",
        "current_row_count",
        "baseline_n",
        F.when(enough, mean).alias("baseline_mean"),
        F.when(enough, std).alias("baseline_std"),
        F.when(enough, mean - F.lit(float(VOLUME_SIGMAS)) * std).alias("lower_bound"),
        F.when(enough, mean + F.lit(float(VOLUME_SIGMAS)) * std).alias("upper_bound"),
        F.when(F.col("records_available") < 1, F.lit(False)).when(~enough, F.lit(True)).otherwise(within).alias("volume_ok"),
        F.when(F.col("records_available") < 1, F.lit(REASON_NO_HISTORY)).when(~enough, F.lit(REASON_INSUFFICIENT)).alias("volume_reason"),
    )


def check_volume(records: DataFrame) -> DataFrame:
    """Newest record vs the 30 before it, for every dataset."""
    return volume_decision(volume_stats(ingestion_history(records, VOLUME_HISTORY)))


def volume_backfill(records: DataFrame, bucket_days: int = 7) -> DataFrame:
    """The volume check as it would have read at every run (each run as 'current'):
    the run's row count against the 30 runs before it in its dataset.

    Skew-safe: no window spans a whole dataset. Runs are cut into time
    buckets; each (dataset, bucket) receives a halo of the 30 runs that
    precede the bucket, taken from the last-30 lists of the 30 previous
    non-empty buckets (each holds at least one run, so together they hold
    the 30 predecessors). The sliding frame then runs per (dataset, bucket).
    """
    keep = VOLUME_HISTORY - 1
    epoch = F.lit("1970-01-01").cast("date")
    runs = records.select(
        "dataset_name", "run_id", "ingested_at", "row_count",
        F.floor(F.datediff(F.to_date("ingested_at"), epoch) / F.lit(bucket_days)).cast("long").alias("_b"),
    )
    # Last `keep` runs of every (dataset, bucket), as one sorted array per bucket.
    w_tail = Window.partitionBy("dataset_name", "_b").orderBy(F.col("ingested_at").desc(), F.col("run_id").desc())
    tails = (
        runs.withColumn("_r", F.row_number().over(w_tail)).where(F.col("_r") <= keep)
        .groupBy("dataset_name", "_b")
        .agg(F.sort_array(F.collect_list(F.struct("ingested_at", "run_id", "row_count"))).alias("_tail"))
    )
    # Halo of bucket b: the last `keep` runs of the `keep` non-empty buckets before it.
    w_prev = Window.partitionBy("dataset_name").orderBy("_b").rowsBetween(-keep, -1)
    halo = tails.select(
        "dataset_name", "_b", F.flatten(F.collect_list("_tail").over(w_prev)).alias("_prev")
    ).select(
        # slice() with a negative start past the array's head returns nothing, so
        # the start index is computed: the last `keep` elements, or all of them.
        "dataset_name", "_b",
        F.slice("_prev", F.greatest(F.size("_prev") - F.lit(keep - 1), F.lit(1)), F.lit(keep)).alias("_halo"),
    )
    halo_rows = halo.select("dataset_name", "_b", F.explode("_halo").alias("h")).select(
        "dataset_name", "_b", F.col("h.run_id").alias("run_id"), F.col("h.ingested_at").alias("ingested_at"),
        F.col("h.row_count").alias("row_count"), F.lit(True).alias("_is_halo"),
    )
    both = runs.withColumn("_is_halo", F.lit(False)).unionByName(halo_rows)
    frame = Window.partitionBy("dataset_name", "_b").orderBy("ingested_at", "run_id").rowsBetween(-keep, -1)
    rc = F.col("row_count").cast("decimal(38,0)")
    stats = both.select(
        "dataset_name",
        "run_id",
        "ingested_at",
        "_is_halo",
        F.col("row_count").alias("current_row_count"),
        F.count(F.lit(1)).over(frame).alias("baseline_n"),
        F.coalesce(F.sum(rc).over(frame), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("baseline_sum"),
        F.coalesce(F.sum(rc * rc).over(frame), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("baseline_sumsq"),
    ).where(~F.col("_is_halo")).drop("_is_halo").withColumn("records_available", F.col("baseline_n") + F.lit(1))
    return volume_decision(stats, ["dataset_name", "run_id", "ingested_at"])


def _null_wide(df: DataFrame, contract: Contract, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """One aggregate: rows and null count (NaN included) per contract column present."""
    from strata.operators.validate import null_flag

    present = [c.name for c in contract.columns if c.name in df.columns]
    aggs = [F.count(F.lit(1)).alias("total_rows")] + [F.count_if(null_flag(df, n)).alias(f"_n{i}") for i, n in enumerate(present)]
    return df.groupBy(*group_cols).agg(*aggs).where("total_rows > 0"), present


def _column_entries(contract: Contract, present: list[str], threshold: float) -> Column:
    """Array of per-column structs over a wide row: counts, ratio, threshold, violation.

    Violation is any null on a required column and ``ratio > threshold``
    (strict) on a nullable one; a contract column absent from the frame is
    a violation with reason column_missing_from_dataframe and no ratio.
    """
    entries = []
    for c in contract.columns:
        limit = F.lit(float(threshold) if c.nullable else 0.0)
        if c.name in present:
            cnt = F.col(f"_n{present.index(c.name)}")
            ratio = cnt / F.col("total_rows")
            violated, reason = ratio > limit, F.lit(None).cast("string")
        else:
            cnt = F.lit(None).cast("long")
            ratio = F.lit(None).cast("double")
            violated, reason = F.lit(True), F.lit(REASON_COLUMN_MISSING)
        entries.append(
            F.struct(
                F.lit(c.name).alias("column_name"),
                cnt.alias("null_count"),
                ratio.alias("null_ratio"),
                limit.alias("threshold"),
                F.lit(c.nullable).alias("nullable"),
                violated.alias("violated"),
                reason.alias("reason"),
            )
        )
    return F.array(*entries)


def null_ratio_long(df: DataFrame, contract: Contract, group_cols: list[str], threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> DataFrame:
    """Per group and contract column: total_rows, null_count, null_ratio, threshold,
    nullable, violated, reason (long form, one aggregate + a generator)."""
    wide, present = _null_wide(df, contract, group_cols)
    return wide.select(*group_cols, "total_rows", F.inline(_column_entries(contract, present, threshold))).select(
        *group_cols, "column_name", "total_rows", "null_count", "null_ratio", "threshold", "nullable", "violated", "reason"
    )


def check_null_ratio(df: DataFrame, contract: Contract, group_cols: list[str], threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> DataFrame:
    """Per group: ok when no column violates; per-column detail kept as an array.

    A single partial/final aggregate (one shuffle of one row per group and
    map task); the per-column verdicts are array expressions on that row.
    """
    wide, present = _null_wide(df, contract, group_cols)
    return _null_verdicts(wide, present, contract, group_cols, threshold)


def latest_run_nulls(store: DataFrame, latest_keys: DataFrame, contract: Contract, run_keys: list[str],
                     threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> DataFrame:
    """Per dataset: the null check over the rows of its latest run. ``latest_keys``
    has the run keys (dataset_name among them) of one run per dataset. The span
    of the keys is a literal filter; where they are partition columns of the
    store, folders outside it are not listed, and of the rest Spark prunes at run
    time all that are no latest run."""
    from strata.operators.joins import checked_broadcast

    dated = [k for k in run_keys if k != "dataset_name"]
    keys = checked_broadcast(latest_keys.select(*run_keys))
    span = keys.agg(F.lit(1), *[f(k).alias(f"{f.__name__}_{k}") for k in dated for f in (F.min, F.max)]).first()
    inside = [F.col(k).between(F.lit(span[f"min_{k}"]), F.lit(span[f"max_{k}"])) for k in dated if span[f"min_{k}"] is not None]
    within = reduce(lambda a, b: a & b, inside, F.lit(True))
    rows = store.where(within).join(keys.where(within), run_keys, "left_semi")
    return check_null_ratio(rows, contract, ["dataset_name"], threshold)


def null_summary_of_counts(spark: SparkSession, dataset: str, contract: Contract, total_rows: int, null_counts: list[int],
                           threshold: float = DEFAULT_NULLABLE_THRESHOLD) -> DataFrame:
    """``check_null_ratio`` for one dataset whose nulls were counted while its rows
    were written. No row for a dataset without rows."""
    names = [f"_n{i}" for i in range(len(null_counts))]
    schema = ", ".join(["dataset_name string", "total_rows long", *[f"{n} long" for n in names]])
    rows = [(dataset, total_rows, *null_counts)] if total_rows else []
    return _null_verdicts(spark.createDataFrame(rows, schema), contract.names, contract, ["dataset_name"], threshold)


def _null_verdicts(wide: DataFrame, present: list[str], contract: Contract, group_cols: list[str], threshold: float) -> DataFrame:
    cols = _column_entries(contract, present, threshold)
    return wide.select(
        *group_cols,
        "total_rows",
        (~F.exists(cols, lambda c: c["violated"])).alias("null_ratio_ok"),
        F.size(F.filter(cols, lambda c: c["violated"])).alias("n_violations"),
        cols.alias("columns"),
        F.lit(float(threshold)).alias("nullable_threshold"),
    )


def check_schema_hash(registrations: DataFrame, latest: DataFrame) -> DataFrame:
    joined = registrations.select(F.col("name").alias("dataset_name"), F.col("schema_hash").alias("_expected")).join(
        latest.select("dataset_name", F.col("schema_hash").alias("_actual")), "dataset_name", "left"
    )
    return joined.select("dataset_name", *schema_columns(F.col("_expected"), F.col("_actual")))


def aggregate_status(freshness_ok: Column, volume_ok: Column, null_ratio_ok: Column, schema_hash_ok: Column) -> Column:
    """Schema drift is critical; otherwise 3 failures fail, 1-2 degrade."""
    failures = reduce(lambda a, b: a + b, [(~c).cast("int") for c in (freshness_ok, volume_ok, null_ratio_ok)])
    return (
        F.when(~schema_hash_ok, F.lit(HealthStatus.FAILING.value))
        .when(failures >= 3, F.lit(HealthStatus.FAILING.value))
        .when(failures >= 1, F.lit(HealthStatus.DEGRADED.value))
        .otherwise(F.lit(HealthStatus.HEALTHY.value))
    )


def health_reports(registrations: DataFrame, records: DataFrame, null_summary: DataFrame, now) -> DataFrame:
    """One report per registered dataset: the four checks, status and JSON details.

    ``null_summary`` has one row per dataset whose frame has rows
    (check_null_ratio output); a registered dataset without rows gets
    ``empty_dataframe``; one without runs gets ``no_ingestion_history``.
    The newest 31 records per dataset give, in one aggregate, both the
    latest record (freshness, schema hash) and the volume statistics; the
    checks are then columns of a single join of per-dataset rows.
    """
    now_c = ntz(now)
    vol = volume_decision(volume_stats(ingestion_history(records, VOLUME_HISTORY)), ["dataset_name", "latest_ingested_at", "latest_schema_hash"])
    base = registrations.select(F.col("name").alias("dataset_name"), "expected_frequency", F.col("schema_hash").alias("_expected"))
    j0 = base.join(vol, "dataset_name", "left").join(null_summary, "dataset_name", "left")
    j = j0.select(
        "*",
        *freshness_columns(now_c, F.col("latest_ingested_at")),
        *schema_columns(F.col("_expected"), F.col("latest_schema_hash")),
    )
    no_hist = F.col("records_available").isNull()
    no_rows = F.col("null_ratio_ok").isNull()
    freshness_ok = F.coalesce("freshness_ok", F.lit(False))
    volume_ok = F.coalesce("volume_ok", F.lit(False))
    null_ok = F.coalesce("null_ratio_ok", F.lit(False))
    schema_ok = F.coalesce("schema_hash_ok", F.lit(False))
    details = F.struct(
        F.struct("freshness_reason", "ingested_at", "age_seconds", "max_age_seconds", "expected_frequency").alias("freshness"),
        F.struct(
            F.when(no_hist, F.lit(REASON_NO_HISTORY)).otherwise(F.col("volume_reason")).alias("reason"),
            "records_available",
            "current_row_count",
            F.round("baseline_mean", 2).alias("baseline_mean"),
            F.round("baseline_std", 2).alias("baseline_std"),
            F.round("lower_bound", 2).alias("lower_bound"),
            F.round("upper_bound", 2).alias("upper_bound"),
        ).alias("volume"),
        F.struct(
            F.when(no_rows, F.lit(REASON_EMPTY)).alias("reason"),
            "total_rows",
            "nullable_threshold",
            F.transform(
                F.coalesce(F.col("columns"), F.array().cast("array<struct<column_name:string,null_count:bigint,null_ratio:double,threshold:double,nullable:boolean,violated:boolean,reason:string>>")),
                lambda c: c.withField("null_ratio", F.round(c["null_ratio"], 6)),
            ).alias("columns"),
        ).alias("null_ratio"),
        F.struct("schema_hash_reason", "expected_hash", "actual_hash").alias("schema_hash"),
    )
    id_text = F.concat_ws("|", F.col("dataset_name"), F.date_format(now_c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return j.select(
        F.sha2(id_text, 256).alias("id"),
        "dataset_name",
        now_c.alias("checked_at"),
        aggregate_status(freshness_ok, volume_ok, null_ok, schema_ok).alias("status"),
        freshness_ok.alias("freshness_ok"),
        volume_ok.alias("volume_ok"),
        null_ok.alias("null_ratio_ok"),
        schema_ok.alias("schema_hash_ok"),
        F.to_json(details, DETAILS_JSON).alias("details"),
    )
