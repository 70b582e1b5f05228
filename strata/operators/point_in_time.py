"""Point-in-time reads: only what was known at the end of the as_of day.

Two guarantees: (1) the run read is the latest ingestion at or before
as_of 23:59:59; (2) of that run, only rows whose ``date`` is on or before
as_of are returned. ``asof_runs`` answers many (dataset, as_of) requests
in one job without any per-request driver work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.functions.timefn import end_of_day, end_of_day_literal, ntz, parse_as_of, valid_as_of
from strata.operators.registry import latest_ingestion


class NotFound(LookupError):
    """No registered dataset / no ingestion at or before as_of."""


class BadRequest(ValueError):
    """A parameter the dataset cannot satisfy (e.g. symbol without a symbol column)."""


def date_visible(df: DataFrame, as_of: dt.date, date_col: str = "date") -> Column | None:
    """Row filter ``date <= as_of`` by the column's type; None when there is no such column.

    A date column compares as a date; a timestamp by its calendar day; a
    text column as ISO text against the normalised ``YYYY-MM-DD`` form.
    Null dates never pass.
    """
    if date_col not in df.columns:
        return None
    dtype = df.schema[date_col].dataType
    c = F.col(date_col)
    if isinstance(dtype, T.DateType):
        return c <= F.lit(as_of)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c) <= F.lit(as_of)
    return c.cast("string") <= F.lit(as_of.isoformat())


def resolve_run(records: DataFrame, dataset: str, as_of) -> DataFrame:
    """The single record a point-in-time read uses (0 or 1 row), lazily."""
    day = parse_as_of(as_of)
    cutoff = ntz(end_of_day_literal(day))
    return latest_ingestion(records.where(F.col("dataset_name") == F.lit(dataset)), cutoff)


def rows_of_run(store: DataFrame, record: dict, as_of, run_keys=("run_id",), symbol: str | None = None,
                date_col: str = "date", symbol_col: str = "symbol") -> DataFrame:
    """Rows of one resolved run with audit columns; filters are literals so they
    reach the scan (partition pruning on run keys, Parquet pushdown on the rest)."""
    day = parse_as_of(as_of)
    out = store
    for k in run_keys:
        out = out.where(F.col(k) == F.lit(record[k]))
    cond = date_visible(out, day, date_col)
    if cond is not None:
        out = out.where(cond)
    if symbol is not None:
        if symbol_col not in out.columns:
            raise BadRequest(f"'{record['dataset_name']}' cannot be filtered by symbol: no '{symbol_col}' column")
        out = out.where(F.col(symbol_col) == F.lit(symbol))
    run_id, at = audit_names(out.columns)
    return out.select("*", F.lit(record["run_id"]).alias(run_id), ntz(record["ingested_at"]).alias(at))


def audit_names(columns: list[str]) -> tuple[str, str]:
    """Names of the audit columns; a leading underscore where the data has a
    column of that name itself."""
    taken = {c.lower() for c in columns}
    return tuple(n if n not in taken else f"_{n}" for n in ("ingestion_run_id", "ingested_at"))


def point_in_time(store: DataFrame, records: DataFrame, dataset: str, as_of, symbol: str | None = None,
                  run_keys=("run_id",), date_col: str = "date", symbol_col: str = "symbol") -> DataFrame:
    """Rows of ``dataset`` as known at ``as_of``; raises NotFound / BadRequest / ValueError.

    The run lookup is one tiny aggregate (a single row reaches the driver);
    the data read is then a literal-filtered scan of that run only.
    """
    run = resolve_run(records, dataset, as_of).take(1)
    if not run:
        raise NotFound(f"'{dataset}' had not been ingested by {as_of}")
    return rows_of_run(store, run[0].asDict(), as_of, run_keys, symbol, date_col, symbol_col)


def asof_runs(requests: DataFrame, records: DataFrame, bucket_days: int = 7,
              record_cols: tuple[str, ...] = ("run_id", "ingested_at", "row_count")) -> DataFrame:
    """As-of join: for each (dataset_name, as_of) request, the latest record with
    ingested_at <= end of the as_of day (ties: larger run_id); null when none.

    Requests are first reduced to distinct (dataset_name, as_of) keys, so a
    dataset that owns most requests costs no more than its distinct days.
    Both sides are cut into time buckets of ``bucket_days``: inside a
    (dataset, bucket) a running last-value finds the latest run so far, and
    a second running last-value over the per-bucket maxima (one row per
    dataset and bucket) carries the latest run from earlier buckets. No
    pair of rows is ever formed, and no window spans a whole dataset's runs.
    Returned: the distinct keys with the matched record columns; join it
    back to the requests on (dataset_name, as_of). A request whose as_of is no
    valid YYYY-MM-DD has no key (``valid_as_of`` tells which); it fails nothing else.
    """
    epoch = F.lit(dt.date(1970, 1, 1))
    keys = requests.select("dataset_name", valid_as_of(F.col("as_of")).alias("as_of")).where("as_of is not null").distinct()
    keys = keys.select(
        "dataset_name", "as_of", end_of_day(F.col("as_of")).alias("_t"),
        F.floor(F.datediff(F.col("as_of"), epoch) / F.lit(bucket_days)).cast("long").alias("_b"),
    )
    rec = F.struct(*[F.col(c) for c in record_cols])
    runs = records.select(
        "dataset_name", F.col("ingested_at").alias("_t"),
        F.floor(F.datediff(F.to_date("ingested_at"), epoch) / F.lit(bucket_days)).cast("long").alias("_b"),
        F.col("run_id").alias("_tie"), rec.alias("_rec"),
    )
    rec_type = runs.schema["_rec"].dataType

    # 1. within the bucket: runs sort before requests at the same instant (<= is inclusive).
    both = runs.select("dataset_name", "_b", "_t", F.lit(0).alias("_kind"), "_tie", "_rec",
                       F.lit(None).cast("date").alias("as_of")).unionByName(
        keys.select("dataset_name", "_b", "_t", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("_tie"),
                    F.lit(None).cast(rec_type).alias("_rec"), "as_of"))
    w_in = Window.partitionBy("dataset_name", "_b").orderBy("_t", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.select("dataset_name", "_b", "_kind", "as_of", F.last("_rec", ignorenulls=True).over(w_in).alias("_in")).where(
        F.col("_kind") == 1)

    # 2. carry across buckets: latest run of every bucket, then a running last over buckets.
    per_bucket = runs.groupBy("dataset_name", "_b").agg(F.max_by("_rec", F.struct("_t", "_tie")).alias("_rec"))
    bucket_rows = per_bucket.select("dataset_name", "_b", F.lit(1).alias("_kind"), "_rec").unionByName(
        keys.select("dataset_name", "_b").distinct().select("dataset_name", "_b", F.lit(0).alias("_kind"),
                                                            F.lit(None).cast(rec_type).alias("_rec")))
    w_b = Window.partitionBy("dataset_name").orderBy("_b", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = bucket_rows.select("dataset_name", "_b", "_kind", F.last("_rec", ignorenulls=True).over(w_b).alias("_prev")).where(
        F.col("_kind") == 0).drop("_kind")

    matched = inside.join(carried, ["dataset_name", "_b"], "left").select(
        "dataset_name", "as_of", F.coalesce("_in", "_prev").alias("_m"))
    return matched.select("dataset_name", "as_of", *[F.col(f"_m.{c}").alias(c) for c in record_cols])


def asof_rows(store: DataFrame, requests: DataFrame, records: DataFrame, run_keys=("run_id",),
              date_col: str = "date", bucket_days: int = 7) -> DataFrame:
    """Bulk point-in-time read: for every (dataset_name, as_of) request, the rows
    of the run it resolves to (``asof_runs``) whose ``date`` is on or before as_of,
    tagged with the request's as_of and the run's audit columns.

    The matched table has one row per distinct request key; it is broadcast
    only after a check of its size (``checked_broadcast``), else Spark plans the
    join. A run matched by many requests contributes its rows to each, so the
    result has rows x requests of a run by definition; ``asof_runs`` is the
    answer per request, without rows, and the one to prefer where it will do.
    """
    from strata.operators.joins import checked_broadcast

    # Record columns to carry: the audit fields and every run key except the
    # dataset name, which asof_runs returns anyway.
    cols = tuple(dict.fromkeys(("run_id", "ingested_at", *[k for k in run_keys if k != "dataset_name"])))
    matched = asof_runs(requests, records, bucket_days, record_cols=cols).where(F.col("run_id").isNotNull())
    keyed = matched.select(
        *[F.col(k) for k in run_keys],
        F.col("run_id").alias("ingestion_run_id"),
        F.col("ingested_at").alias("_run_at"),
        F.col("as_of").alias("_as_of"),
    )
    joined = store.join(checked_broadcast(keyed), list(run_keys), "inner")
    dtype = store.schema[date_col].dataType if date_col in store.columns else None
    visible = _request_visible(joined, date_col, dtype)
    return visible.withColumnRenamed("_as_of", "as_of").withColumnRenamed("_run_at", "ingested_at")


def _request_visible(joined: DataFrame, date_col: str, dtype: T.DataType | None) -> DataFrame:
    """Rows dated on or before their request's ``_as_of``; all, without a date column."""
    if dtype is None:
        return joined
    day = F.col(date_col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        day = F.to_date(day)
    elif not isinstance(dtype, T.DateType):
        return joined.where(day.cast("string") <= F.date_format("_as_of", "yyyy-MM-dd"))
    return joined.where(day <= F.col("_as_of"))
