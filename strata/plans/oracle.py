"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: the same scenario (see
plans/fixtures.py) expressed in plain SQL over the driver's views. Only
declared constants (contract columns, the fixed `now`, as_of, symbol) are
shared; no SQL text is generated from Spark plans.
"""

from __future__ import annotations

from strata.plans.fixtures import ORDERS_CONTRACT

FREQ = """CASE ascii(right({x}, 1)) % 5 WHEN 0 THEN 'intraday' WHEN 1 THEN 'daily' WHEN 2 THEN 'weekly'
  WHEN 3 THEN 'monthly' ELSE 'on_demand' END"""

# Events contract versions: 1.0 and 2.0 have `value` nullable, 1.1 requires it.
CONTRACT_VALUES = """(VALUES
  ('1.0','event_id','int',false), ('1.0','ts','timestamp',false), ('1.0','user_id','int',false),
  ('1.0','event_type','string',false), ('1.0','value','float',true), ('1.0','props','string',true),
  ('1.1','event_id','int',false), ('1.1','ts','timestamp',false), ('1.1','user_id','int',false),
  ('1.1','event_type','string',false), ('1.1','value','float',false), ('1.1','props','string',true),
  ('2.0','event_id','int',false), ('2.0','ts','timestamp',false), ('2.0','user_id','int',false),
  ('2.0','event_type','string',false), ('2.0','value','float',true), ('2.0','props','string',true)
) AS c(version, column_name, dtype, nullable)"""

FINGERPRINTS = f"""
ev_datasets AS (SELECT DISTINCT event_type AS dataset_name FROM events),
contract_cols AS (SELECT d.dataset_name, c.* FROM ev_datasets d CROSS JOIN {CONTRACT_VALUES}),
fingerprints AS (
  SELECT dataset_name, version,
    sha256('{{"columns": [' || string_agg('{{"dtype": "' || dtype || '", "name": "' || column_name
      || '", "nullable": ' || CASE WHEN nullable THEN 'true' ELSE 'false' END || '}}', ', ' ORDER BY column_name)
      || '], "name": "' || dataset_name || '", "version": "' || version || '"}}') AS schema_hash,
    count(*) AS n_columns
  FROM contract_cols GROUP BY dataset_name, version)"""

RUNS = FINGERPRINTS + """,
runs0 AS (
  SELECT event_type AS dataset_name, CAST(ts AS DATE) AS ingest_date, count(*) AS row_count,
         max(ts) AS ingested_at, sum(event_id) AS ids
  FROM events GROUP BY 1, 2),
runs1 AS (
  SELECT *, CASE WHEN day(ingest_date) % 10 = 0 THEN '1.1' ELSE '1.0' END AS version,
         'raw/' || dataset_name || '/' || CAST(ingest_date AS VARCHAR) || '.csv' AS source_path
  FROM runs0),
runs2 AS (
  SELECT r.*, f.schema_hash,
         sha256(r.dataset_name || '|' || r.source_path || '|' || f.schema_hash || '|' || CAST(r.ingest_date AS VARCHAR)) AS run_id
  FROM runs1 r LEFT JOIN fingerprints f USING (dataset_name, version)),
runs AS (
  SELECT run_id, dataset_name, version, ingested_at, row_count,
         sha256('rows:' || CAST(row_count AS VARCHAR) || ':ids:' || CAST(ids AS VARCHAR)) AS checksum,
         source_path,
         'canonical/dataset=' || dataset_name || '/ingest_date=' || CAST(ingest_date AS VARCHAR) || '/run_id=' || run_id AS partition_path,
         schema_hash, ingest_date
  FROM runs2),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rn FROM runs)
  WHERE rn = 1)"""

HALF_RUNS = """
half0 AS (
  SELECT event_type AS dataset_name, CAST(ts AS DATE) AS ingest_date, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS half, count(*) AS n
  FROM events GROUP BY 1, 2, 3),
runs AS (
  SELECT sha256(dataset_name || '|raw/' || dataset_name || '/' || CAST(ingest_date AS VARCHAR) || '-' || half || '.csv|half|'
                || CAST(ingest_date AS VARCHAR)) AS run_id,
         dataset_name, '1.0' AS version, CAST(ingest_date AS TIMESTAMP) + INTERVAL 18 HOUR AS ingested_at,
         CASE WHEN ingest_date = max(ingest_date) OVER (PARTITION BY dataset_name) AND ascii(dataset_name) % 2 = 1 THEN n * 10 ELSE n END AS row_count
  FROM half0)"""

REGISTRATIONS = RUNS + f""",
reg_events AS (
  SELECT dataset_name AS name, version, 'events' AS owner, {FREQ.format(x='dataset_name')} AS expected_frequency,
         schema_hash, 'event stream ' || dataset_name AS description, ingested_at AS event_at, CAST(0 AS BIGINT) AS event_seq
  FROM runs
  UNION ALL
  SELECT l.name, '2.0', 'events', {FREQ.format(x='l.name')}, f.schema_hash, 'event stream ' || l.name,
         l.last_at + INTERVAL 1 HOUR, CAST(1 AS BIGINT)
  FROM (SELECT dataset_name AS name, max(ingested_at) AS last_at FROM runs GROUP BY 1) l
  JOIN fingerprints f ON f.dataset_name = l.name AND f.version = '2.0'
  WHERE ascii(l.name) % 2 = 0
  UNION ALL
  SELECT 'ref_' || lower(n_name), '1.0', 'reference', {FREQ.format(x="'ref_' || lower(n_name)")},
         sha256('ref_' || lower(n_name) || '|1.0'), NULL, TIMESTAMP '2024-01-01 00:00:00', CAST(0 AS BIGINT)
  FROM nation),
registrations AS (
  SELECT name, version, owner, expected_frequency, schema_hash, coalesce(description, '') AS description,
         registered_at, event_at AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY event_at DESC, event_seq DESC) AS rn,
               min(event_at) OVER (PARTITION BY name) AS registered_at FROM reg_events)
  WHERE rn = 1)"""

NOW = "TIMESTAMP '2024-01-31 06:00:00'"

FRESHNESS = """
fresh AS (
  SELECT r.name AS dataset_name, r.expected_frequency, l.ingested_at AS l_at,
         CASE r.expected_frequency WHEN 'intraday' THEN 4*3600 WHEN 'daily' THEN 26*3600 WHEN 'weekly' THEN 8*86400
              WHEN 'monthly' THEN 33*86400 END * CAST(1000000 AS BIGINT) AS max_us,
         epoch_us({now}) - epoch_us(l.ingested_at) AS age_us
  FROM registrations r LEFT JOIN latest l ON l.dataset_name = r.name),
freshness AS (
  SELECT dataset_name, expected_frequency,
    CASE WHEN expected_frequency = 'on_demand' THEN true WHEN l_at IS NULL THEN false
         ELSE coalesce(age_us <= max_us, false) END AS freshness_ok,
    CASE WHEN expected_frequency = 'on_demand' THEN 'on_demand_no_sla'
         WHEN l_at IS NULL THEN 'no_ingestion_record_found' END AS freshness_reason,
    CASE WHEN expected_frequency <> 'on_demand' THEN l_at END AS ingested_at,
    CASE WHEN expected_frequency <> 'on_demand' AND l_at IS NOT NULL THEN CAST(round(age_us / 1000000.0) AS BIGINT) END AS age_seconds,
    CASE WHEN expected_frequency <> 'on_demand' AND l_at IS NOT NULL THEN CAST(max_us // 1000000 AS BIGINT) END AS max_age_seconds
  FROM fresh)""".format(now=NOW)

VOLUME = """
hist AS (
  SELECT * FROM (SELECT dataset_name, run_id, ingested_at, row_count,
      row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rk FROM runs)
  WHERE rk <= 31),
vstats AS (
  SELECT dataset_name, count(*) AS records_available,
         max(CASE WHEN rk = 1 THEN row_count END) AS current_row_count,
         count(*) FILTER (WHERE rk > 1) AS baseline_n,
         CAST(sum(CASE WHEN rk > 1 THEN row_count END) AS HUGEINT) AS s,
         CAST(sum(CASE WHEN rk > 1 THEN CAST(row_count AS HUGEINT) * row_count END) AS HUGEINT) AS q
  FROM hist GROUP BY dataset_name),
volume AS (
  SELECT dataset_name, records_available, current_row_count, baseline_n,
    CASE WHEN records_available >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE) END AS baseline_mean,
    CASE WHEN records_available >= 4 THEN sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE) END AS baseline_std,
    CASE WHEN records_available >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE)
         - 3.0 * (sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE)) END AS lower_bound,
    CASE WHEN records_available >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE)
         + 3.0 * (sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE)) END AS upper_bound,
    CASE WHEN records_available < 1 THEN false WHEN records_available < 4 THEN true
         ELSE (baseline_n * current_row_count - s) * (baseline_n * current_row_count - s) <= 9 * (baseline_n * q - s * s) END AS volume_ok,
    CASE WHEN records_available < 1 THEN 'no_ingestion_history' WHEN records_available < 4 THEN 'insufficient_history' END AS volume_reason
  FROM vstats)"""

SCHEMA_CHECK = """
schema_check AS (
  SELECT r.name AS dataset_name, r.schema_hash AS expected_hash, l.schema_hash AS actual_hash,
         CASE WHEN l.schema_hash IS NULL THEN false ELSE r.schema_hash = l.schema_hash END AS schema_hash_ok,
         CASE WHEN l.schema_hash IS NULL THEN 'no_ingestion_record_found' END AS schema_hash_reason
  FROM registrations r LEFT JOIN latest l ON l.dataset_name = r.name)"""

EVENTS_NULLS = """
ev_nulls AS (
  SELECT event_id, ts, CASE WHEN event_id % 997 = 0 THEN NULL ELSE user_id END AS user_id, event_type,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 12 = 0 THEN NULL ELSE props END AS props
  FROM events)"""


def _null_long(src: str, group: str, cols: list[tuple[str, bool, bool]], threshold: float = 0.10) -> str:
    """Long-form null ratios; cols = (name, nullable, is_float); a name prefixed '!' is absent."""
    parts = []
    for name, nullable, is_float in cols:
        thr = f"CAST({threshold!r} AS DOUBLE)" if nullable else "CAST(0.0 AS DOUBLE)"
        if name.startswith("!"):
            n = name[1:]
            parts.append(
                f"SELECT {group}, '{n}' AS column_name, count(*) AS total_rows, CAST(NULL AS BIGINT) AS null_count, "
                f"CAST(NULL AS DOUBLE) AS null_ratio, {thr} AS threshold, {str(nullable).lower()} AS nullable, true AS violated, "
                f"'column_missing_from_dataframe' AS reason FROM {src} GROUP BY {group}"
            )
            continue
        test = f"({name} IS NULL OR isnan({name}))" if is_float else f"{name} IS NULL"
        parts.append(
            f"SELECT {group}, '{name}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {test}) AS null_count, "
            f"CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count(*) AS null_ratio, {thr} AS threshold, "
            f"{str(nullable).lower()} AS nullable, "
            f"CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count(*) > {thr} AS violated, CAST(NULL AS VARCHAR) AS reason "
            f"FROM {src} GROUP BY {group}"
        )
    return "\nUNION ALL\n".join(parts)


EVENT_NULL_COLS = [("event_id", False, False), ("ts", False, False), ("user_id", False, False),
                   ("event_type", False, False), ("value", True, True), ("props", True, False)]

TS_RE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"
INT_RE = "^[+-]?[0-9]+$"
FLOAT_RE = "^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|inf|infinity|nan)$"

DIRTY = f"""
raw AS (
  SELECT
    CASE WHEN event_id % 211 = 0 THEN '#' ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN event_id % 67 = 0 THEN strftime(ts, '%Y/%m/%d') WHEN event_id % 71 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN event_id % 73 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
    CASE WHEN event_id % 79 = 0 THEN CAST(user_id AS VARCHAR) || '.0'
         WHEN event_id % 83 = 0 THEN ' ' || chr(9) || CAST(user_id AS VARCHAR) || '  ' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 59 = 0 THEN '   ' ELSE event_type END AS event_type,
    CASE WHEN event_id % 97 = 0 THEN 'N/A' WHEN event_id % 89 = 0 THEN '' WHEN event_id % 61 = 0 THEN '-Infinity'
         WHEN event_id % 53 = 0 THEN '1e3' ELSE printf('%.2f', value) END AS value,
    props,
    ['true', 'FALSE', 'yes', 'No', '1', 'maybe', '0', ' '][event_id % 8 + 1] AS flag
  FROM events),
cleaned AS (
  SELECT {', '.join(f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '') AS {c}" for c in ['event_id', 'ts', 'user_id', 'event_type', 'value', 'props', 'flag'])}
  FROM raw),
typed AS (
  SELECT event_id AS r_event_id, ts AS r_ts, user_id AS r_user_id, event_type AS r_event_type, value AS r_value, props AS r_props, flag AS r_flag,
    CASE WHEN regexp_matches(event_id, '{INT_RE}') THEN TRY_CAST(event_id AS BIGINT) END AS event_id,
    CASE WHEN regexp_matches(ts, '{TS_RE}') THEN TRY_CAST(replace(ts, 'T', ' ') AS TIMESTAMP) END AS ts,
    CASE WHEN regexp_matches(user_id, '{INT_RE}') THEN TRY_CAST(user_id AS BIGINT) END AS user_id,
    event_type,
    CASE WHEN regexp_matches(lower(value), '{FLOAT_RE}') THEN TRY_CAST(value AS DOUBLE) END AS value,
    props,
    CASE WHEN lower(flag) IN ('true', '1', 'yes') THEN true WHEN lower(flag) IN ('false', '0', 'no') THEN false END AS flag
  FROM cleaned),
checked AS (
  SELECT *,
    r_event_id IS NULL AS e1, (r_event_id IS NOT NULL AND event_id IS NULL) AS e2,
    r_ts IS NULL AS e3, (r_ts IS NOT NULL AND ts IS NULL) AS e4,
    r_user_id IS NULL AS e5, (r_user_id IS NOT NULL AND user_id IS NULL) AS e6,
    r_event_type IS NULL AS e7,
    (r_value IS NOT NULL AND value IS NULL) AS e8,
    (r_flag IS NOT NULL AND flag IS NULL) AS e9
  FROM typed)"""

ERROR_LIST = """concat_ws(',',
  CASE WHEN e1 THEN 'event_id:unexpected_null' END, CASE WHEN e2 THEN 'event_id:type_mismatch' END,
  CASE WHEN e3 THEN 'ts:unexpected_null' END, CASE WHEN e4 THEN 'ts:type_mismatch' END,
  CASE WHEN e5 THEN 'user_id:unexpected_null' END, CASE WHEN e6 THEN 'user_id:type_mismatch' END,
  CASE WHEN e7 THEN 'event_type:unexpected_null' END, CASE WHEN e8 THEN 'value:type_mismatch' END,
  CASE WHEN e9 THEN 'flag:type_mismatch' END)"""

N_ERRORS = "CAST(e1::INT + e2::INT + e3::INT + e4::INT + e5::INT + e6::INT + e7::INT + e8::INT + e9::INT AS INTEGER)"

ERROR_RULES = [("event_id", "unexpected_null", "e1", None), ("event_id", "type_mismatch", "e2", "r_event_id"),
               ("ts", "unexpected_null", "e3", None), ("ts", "type_mismatch", "e4", "r_ts"),
               ("user_id", "unexpected_null", "e5", None), ("user_id", "type_mismatch", "e6", "r_user_id"),
               ("event_type", "unexpected_null", "e7", None), ("value", "type_mismatch", "e8", "r_value"),
               ("flag", "type_mismatch", "e9", "r_flag")]


def _null_detail(n: str, total: str) -> str:
    return (f"printf('%d null(s) in a required column (%.2f%% of %d rows).', {n}, "
            f"(CAST({n} AS DOUBLE) / {total}) * 100.0, {total})")


def _null_errors(src: str, required: list[tuple[int, str, bool]], first: int) -> str:
    parts = []
    for pos, name, is_float in required:
        test = f"({name} IS NULL OR isnan({name}))" if is_float else f"{name} IS NULL"
        parts.append(
            f"SELECT CAST({first + pos} AS INTEGER) AS seq, '{name}' AS \"column\", 'unexpected_null' AS error_type, "
            f"{_null_detail(f'count(*) FILTER (WHERE {test})', 'count(*)')} AS details FROM {src} "
            f"HAVING count(*) FILTER (WHERE {test}) > 0"
        )
    return "\nUNION ALL\n".join(parts)


ORDERS_HASH = ORDERS_CONTRACT.schema_hash()

ORDER_RUNS = f"""
ostore AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         CASE WHEN o_orderkey % 43 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
         o_orderpriority AS symbol, strftime(date_trunc('month', o_orderdate) - to_months(CAST(k AS INTEGER)), '%Y-%m') AS ingest_month
  FROM orders, range(2) AS ahead(k)),
oruns AS (
  SELECT sha256('orders|raw/orders/' || ingest_month || '.csv|{ORDERS_HASH}|' || CAST(max(d) AS VARCHAR)) AS run_id,
         ingest_month, CAST(max(d) AS TIMESTAMP) AS ingested_at, count(*) AS row_count
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%Y-%m') AS ingest_month FROM orders) GROUP BY ingest_month)"""

# Rows of a run: its own day and the three after it; every 41st row has no date.
EVENT_STORE = """
estore AS (
  SELECT e.*, event_type AS dataset_name, CASE WHEN event_id % 41 <> 0 THEN CAST(ts AS DATE) END AS date,
         CAST(CAST(ts AS DATE) - to_days(CAST(k AS INTEGER)) AS DATE) AS ingest_date
  FROM events e, range(4) AS ahead(k))"""


def _digest(table: str, cols: list[str], group: str | None) -> str:
    cells = ", ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')" for c in cols)
    h = f"CAST(('0x' || substr(sha256(concat_ws(',', {cells})), 1, 15)) AS BIGINT)"
    sel = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"SELECT {sel}count(*) AS n_rows, CAST(sum({h}) AS VARCHAR) AS digest FROM {table}{gb}"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


ORACLE_SQL: dict[str, str] = {
    "schema_fingerprint": _with(FINGERPRINTS) + "\nSELECT dataset_name, version, schema_hash, n_columns FROM fingerprints",
    "ingestion_records": _with(RUNS) + "\nSELECT run_id, dataset_name, version, ingested_at, row_count, checksum, source_path, "
    "partition_path, schema_hash, ingest_date FROM runs",
    "normalize_events": _with(DIRTY) + f"\nSELECT event_id, ts, user_id, event_type, value, props, flag, {N_ERRORS} AS n_errors, "
    f"{ERROR_LIST} AS error_list FROM checked",
    "error_summary_events": _with(DIRTY) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS error_type, count(*) AS n_rows, "
        f"{'min(' + raw + ')' if raw else 'CAST(NULL AS VARCHAR)'} AS example FROM checked WHERE {flag} HAVING count(*) > 0"
        for c, t, flag, raw in ERROR_RULES),
    "quarantine_events": _with(DIRTY) + f"\nSELECT event_type AS dataset_name, count(*) FILTER (WHERE {N_ERRORS} = 0) AS good_rows, "
    f"count(*) FILTER (WHERE {N_ERRORS} > 0) AS bad_rows FROM checked GROUP BY event_type",
    "validate_events": _with(EVENTS_NULLS) + """
SELECT * FROM (VALUES
  (CAST(0 AS INTEGER), 'symbol', 'missing_column', 'The contract declares ''symbol'', the data has no such column.'),
  (CAST(1 AS INTEGER), 'event_type', 'unexpected_column', 'The data has ''event_type'', the contract does not declare it.'),
  (CAST(2 AS INTEGER), 'props', 'unexpected_column', 'The data has ''props'', the contract does not declare it.'),
  (CAST(3 AS INTEGER), 'value', 'type_mismatch', 'Declared integer (byte/short/int/long), found ''double''.')
) AS s(seq, "column", error_type, details)
UNION ALL
""" + _null_errors("ev_nulls", [(0, "event_id", False), (1, "ts", False), (2, "user_id", False)], 4),
    "validate_embeddings": """
SELECT * FROM (VALUES (CAST(0 AS INTEGER), 'embedding', 'type_mismatch', 'Declared string, found ''array<float>''.'))
  AS s(seq, "column", error_type, details)
UNION ALL
""" + _null_errors("embeddings", [(0, "vec_id", False), (1, "embedding", False), (2, "label", False)], 1),
    "validate_orders": """WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority FROM orders)
""" + _null_errors("o", [(0, "o_orderkey", False), (1, "o_custkey", False), (2, "o_orderstatus", False),
                         (3, "o_totalprice", True), (4, "o_orderdate", False), (5, "o_orderpriority", False)], 0),
    "null_ratio_events": _with(EVENTS_NULLS, "evn AS (SELECT *, event_type AS dataset_name FROM ev_nulls)") + "\n"
    + _null_long("evn", "dataset_name", EVENT_NULL_COLS),
    "null_ratio_lineitem": """WITH li AS (
  SELECT l_returnflag, l_orderkey, l_partkey,
         CASE WHEN (l_orderkey + l_linenumber) % 1009 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey,
         l_quantity, l_extendedprice,
         CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax,
         l_shipdate FROM lineitem)
""" + _null_long("li", "l_returnflag", [("l_orderkey", False, False), ("l_partkey", False, False), ("l_suppkey", False, False),
                                        ("l_quantity", False, True), ("l_extendedprice", False, True), ("l_discount", True, True),
                                        ("l_tax", True, True), ("l_shipdate", False, False), ("!l_comment", True, False)]),
    "freshness": _with(REGISTRATIONS, FRESHNESS) + "\nSELECT * FROM freshness",
    "volume": _with(HALF_RUNS, VOLUME) + "\nSELECT * FROM volume",
    "volume_backfill": _with(HALF_RUNS) + """,
vb AS (
  SELECT dataset_name, run_id, ingested_at, row_count AS current_row_count,
    count(*) OVER w AS baseline_n,
    coalesce(CAST(sum(row_count) OVER w AS HUGEINT), 0) AS s,
    coalesce(CAST(sum(CAST(row_count AS HUGEINT) * row_count) OVER w AS HUGEINT), 0) AS q
  FROM runs
  WINDOW w AS (PARTITION BY dataset_name ORDER BY ingested_at, run_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT dataset_name, run_id, ingested_at, baseline_n + 1 AS records_available, current_row_count, baseline_n,
  CASE WHEN baseline_n + 1 >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE) END AS baseline_mean,
  CASE WHEN baseline_n + 1 >= 4 THEN sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE) END AS baseline_std,
  CASE WHEN baseline_n + 1 >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE)
       - 3.0 * (sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE)) END AS lower_bound,
  CASE WHEN baseline_n + 1 >= 4 THEN CAST(s AS DOUBLE) / CAST(baseline_n AS DOUBLE)
       + 3.0 * (sqrt(CAST(baseline_n * q - s * s AS DOUBLE)) / CAST(baseline_n AS DOUBLE)) END AS upper_bound,
  CASE WHEN baseline_n + 1 < 4 THEN true
       ELSE (baseline_n * current_row_count - s) * (baseline_n * current_row_count - s) <= 9 * (baseline_n * q - s * s) END AS volume_ok,
  CASE WHEN baseline_n + 1 < 4 THEN 'insufficient_history' END AS volume_reason
FROM vb""",
    "schema_hash_check": _with(REGISTRATIONS, SCHEMA_CHECK) + "\nSELECT * FROM schema_check",
    "health_report": _with(REGISTRATIONS, FRESHNESS, VOLUME, SCHEMA_CHECK, EVENTS_NULLS) + ",\n"
    + "lrows AS (SELECT n.*, n.event_type AS dataset_name FROM ev_nulls n JOIN latest l "
      "ON n.event_type = l.dataset_name AND CAST(n.ts AS DATE) = l.ingest_date),\n"
    + "ncols AS (" + _null_long("lrows", "dataset_name", EVENT_NULL_COLS) + "),\n"
    + """nr AS (SELECT dataset_name, NOT bool_or(violated) AS null_ratio_ok, any_value(total_rows) AS total_rows,
         coalesce(string_agg(column_name || ':' || printf('%.6f', null_ratio), ',' ORDER BY list_position(
           ['event_id', 'ts', 'user_id', 'event_type', 'value', 'props'], column_name)) FILTER (WHERE violated), '') AS violations
       FROM ncols GROUP BY dataset_name),
"""
    + f"""rep AS (
  SELECT r.name AS dataset_name, coalesce(f.freshness_ok, false) AS freshness_ok, coalesce(v.volume_ok, false) AS volume_ok,
         coalesce(nr.null_ratio_ok, false) AS null_ratio_ok, coalesce(s.schema_hash_ok, false) AS schema_hash_ok,
         f.freshness_reason, f.ingested_at, f.age_seconds, f.max_age_seconds,
         CASE WHEN v.records_available IS NULL THEN 'no_ingestion_history' ELSE v.volume_reason END AS volume_reason,
         v.records_available, v.current_row_count, round(v.baseline_mean, 2) AS baseline_mean, round(v.baseline_std, 2) AS baseline_std,
         round(v.lower_bound, 2) AS lower_bound, round(v.upper_bound, 2) AS upper_bound,
         CASE WHEN nr.dataset_name IS NULL THEN 'empty_dataframe' END AS null_reason, nr.total_rows,
         CASE WHEN nr.dataset_name IS NOT NULL THEN CAST(0.10 AS DOUBLE) END AS nullable_threshold, coalesce(nr.violations, '') AS violations,
         s.schema_hash_reason, s.expected_hash, s.actual_hash
  FROM registrations r LEFT JOIN freshness f ON f.dataset_name = r.name LEFT JOIN volume v ON v.dataset_name = r.name
  LEFT JOIN nr ON nr.dataset_name = r.name LEFT JOIN schema_check s ON s.dataset_name = r.name)
SELECT sha256(dataset_name || '|' || strftime({NOW}, '%Y-%m-%d %H:%M:%S.%f')) AS id, dataset_name, {NOW} AS checked_at,
  CASE WHEN NOT schema_hash_ok THEN 'failing'
       WHEN (NOT freshness_ok)::INT + (NOT volume_ok)::INT + (NOT null_ratio_ok)::INT >= 3 THEN 'failing'
       WHEN (NOT freshness_ok)::INT + (NOT volume_ok)::INT + (NOT null_ratio_ok)::INT >= 1 THEN 'degraded'
       ELSE 'healthy' END AS status,
  freshness_ok, volume_ok, null_ratio_ok, schema_hash_ok, freshness_reason, ingested_at, age_seconds, max_age_seconds,
  volume_reason, records_available, current_row_count, baseline_mean, baseline_std, lower_bound, upper_bound,
  null_reason, total_rows, nullable_threshold, violations, schema_hash_reason, expected_hash, actual_hash
FROM rep""",
    "list_datasets": _with(REGISTRATIONS) + "\nSELECT * FROM registrations",
    "dataset_metadata": _with(REGISTRATIONS) + """
SELECT r.*, l.run_id AS latest_run_id, l.ingested_at AS latest_ingested_at, l.row_count AS latest_row_count,
       l.schema_hash AS latest_schema_hash
FROM registrations r LEFT JOIN latest l ON l.dataset_name = r.name""",
    "ingestion_history": _with(HALF_RUNS) + """
SELECT dataset_name, CAST(rk AS INTEGER) AS rank, run_id, ingested_at, row_count FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rk FROM runs)
WHERE rk <= 10""",
    "ingestion_as_of": _with(HALF_RUNS) + """
SELECT dataset_name, run_id, ingested_at, row_count, version FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rk FROM runs
  WHERE ingested_at <= TIMESTAMP '2024-01-15 23:59:59')
WHERE rk = 1""",
    "record_ingestion": _with(RUNS) + """,
existing AS (SELECT * FROM runs WHERE ingest_date <= DATE '2024-01-20'),
incoming AS (SELECT * FROM runs WHERE ingest_date >= DATE '2024-01-10'
             UNION ALL SELECT * FROM runs WHERE ingest_date >= DATE '2024-01-10')
SELECT run_id, dataset_name, ingested_at, row_count FROM existing
UNION ALL
SELECT DISTINCT run_id, dataset_name, ingested_at, row_count FROM incoming
WHERE run_id NOT IN (SELECT run_id FROM existing)""",
    "pit_events": _with(RUNS, EVENT_STORE) + """,
sel AS (SELECT * FROM runs WHERE dataset_name = 'click' AND ingested_at <= TIMESTAMP '2024-01-15 23:59:59'
        ORDER BY ingested_at DESC, run_id DESC LIMIT 1)
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props, e.date, s.run_id AS ingestion_run_id, s.ingested_at
FROM estore e JOIN sel s USING (dataset_name, ingest_date) WHERE e.date <= DATE '2024-01-15'""",
    "pit_store": _with(RUNS, EVENT_STORE) + """,
sel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rk
        FROM runs WHERE ingested_at <= TIMESTAMP '2024-01-15 23:59:59') WHERE rk = 1)
SELECT e.dataset_name, e.event_id, e.ts, e.date, s.run_id AS ingestion_run_id, s.ingested_at
FROM estore e JOIN sel s USING (dataset_name, ingest_date) WHERE e.date <= DATE '2024-01-15'""",
    "pit_orders_symbol": _with(ORDER_RUNS) + """,
sel AS (SELECT * FROM oruns WHERE ingested_at <= TIMESTAMP '1998-06-15 23:59:59' ORDER BY ingested_at DESC, run_id DESC LIMIT 1)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.date, o.symbol,
       s.run_id AS ingestion_run_id, s.ingested_at
FROM ostore o JOIN sel s ON o.ingest_month = s.ingest_month
WHERE o.date <= '1998-06-15' AND o.symbol = '1-URGENT'""",
    "asof_bulk": _with(RUNS) + """,
span AS (SELECT event_type AS dataset_name, min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events GROUP BY 1),
req AS (SELECT dataset_name, CAST(unnest(generate_series(d0 - INTERVAL 1 DAY, d1 + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS as_of
        FROM span),
m AS (
  SELECT q.dataset_name, q.as_of, r.run_id, r.ingested_at, r.row_count,
         row_number() OVER (PARTITION BY q.dataset_name, q.as_of ORDER BY r.ingested_at DESC NULLS LAST, r.run_id DESC) AS rk
  FROM req q LEFT JOIN runs r
    ON r.dataset_name = q.dataset_name AND r.ingested_at <= CAST(q.as_of AS TIMESTAMP) + INTERVAL 86399 SECOND)
SELECT dataset_name, as_of, run_id, ingested_at, row_count FROM m WHERE rk = 1""",
    "asof_rows_events": _with(RUNS, EVENT_STORE) + """,
span AS (SELECT event_type AS dataset_name, min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events GROUP BY 1),
req AS (SELECT dataset_name, CAST(unnest(generate_series(d0 - INTERVAL 1 DAY, d1 + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS as_of
        FROM span),
m AS (
  SELECT q.dataset_name, q.as_of, r.run_id, r.ingested_at, r.ingest_date,
         row_number() OVER (PARTITION BY q.dataset_name, q.as_of ORDER BY r.ingested_at DESC, r.run_id DESC) AS rk
  FROM req q JOIN runs r
    ON r.dataset_name = q.dataset_name AND r.ingested_at <= CAST(q.as_of AS TIMESTAMP) + INTERVAL 86399 SECOND)
SELECT m.dataset_name, m.as_of, e.event_id, e.ts, e.user_id, e.value, m.run_id AS ingestion_run_id, m.ingested_at
FROM m JOIN estore e USING (dataset_name, ingest_date)
WHERE m.rk = 1 AND e.date <= m.as_of""",
    "digest_documents": _digest("documents", ["doc_id", "text", "lang", "source", "n_chars"], "lang"),
    "digest_conversations": _digest("conversations", ["conv_id", "turn", "role", "text"], "role"),
    "digest_pages": _digest("pages", ["page_id", "url", "html"], None),
    "row_changes": _with(EVENTS_NULLS) + """,
edited AS (
  SELECT event_id, ts, CASE WHEN event_id % 83 = 7 THEN user_id + 1 ELSE user_id END AS user_id, event_type,
         CASE WHEN event_id % 89 = 3 THEN -value ELSE value END AS value, props
  FROM ev_nulls WHERE event_id % 97 <> 0),
newer AS (SELECT * FROM edited UNION ALL SELECT * FROM edited WHERE event_id % 101 = 5),
came AS (SELECT user_id, count(*) AS n FROM (SELECT * FROM newer EXCEPT ALL SELECT * FROM ev_nulls) GROUP BY user_id),
went AS (SELECT user_id, count(*) AS n FROM (SELECT * FROM ev_nulls EXCEPT ALL SELECT * FROM newer) GROUP BY user_id)
SELECT coalesce(c.user_id, w.user_id) AS user_id, coalesce(c.n, 0) - least(coalesce(c.n, 0), coalesce(w.n, 0)) AS n_added,
       coalesce(w.n, 0) - least(coalesce(c.n, 0), coalesce(w.n, 0)) AS n_removed, least(coalesce(c.n, 0), coalesce(w.n, 0)) AS n_changed
FROM came c FULL JOIN went w ON c.user_id IS NOT DISTINCT FROM w.user_id""",
    "ingest_two_writers": """
SELECT 'rows' AS kind, event_type AS name, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT * FROM (VALUES ('records', 'logged', 1), ('folders', 'runs', 1), ('files', 'not as logged', 0), ('reruns', 'unchanged', 1))""",
    "csv_ingest_events": "SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props FROM events",
    # Days that ended a day before the newest event: the windows that are final.
    "stream_daily_volume": "SELECT event_type AS dataset_name, CAST(ts AS DATE) AS day, count(*) AS row_count FROM events "
    "WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2",
    "stream_ingest_events": _with(DIRTY) + f"""
SELECT event_id, event_type, CASE WHEN {N_ERRORS} = 0 THEN 'stored' ELSE {ERROR_LIST} END AS outcome FROM checked
UNION ALL SELECT count(*) FILTER (WHERE {N_ERRORS} = 0), '#records', 'row_count' FROM checked""",
    "stream_ingest_headers": _with(DIRTY) + f""",
f AS (SELECT *, {N_ERRORS} AS k, {ERROR_LIST} AS list, CAST(CAST(r_user_id AS DOUBLE) AS BIGINT) % 5 = 0 AS refused FROM checked),
good AS (SELECT * FROM f WHERE NOT refused AND k = 0)
SELECT 'stored' AS kind, event_type AS name, count(*) AS n FROM good GROUP BY event_type
UNION ALL SELECT 'quarantined', list, count(*) FROM f WHERE NOT refused AND k > 0 GROUP BY list
UNION ALL SELECT 'refused', name, 1 FROM (VALUES ('flag:missing_column'), ('colour:unexpected_column')) AS v(name)
UNION ALL SELECT 'refused', 'lines', count(*) + 1 FROM f WHERE refused
UNION ALL SELECT 'report', 'null_ratio_ok=' || (greatest(avg((value IS NULL)::INT), avg((props IS NULL)::INT), avg((flag IS NULL)::INT)) <= 0.1)::VARCHAR, count(*) FROM good
""" + "\n".join(f"UNION ALL SELECT 'nulls', '{c}', count(*) - count({c}) FROM good" for c in ["event_id", "ts", "user_id", "event_type", "value", "props", "flag"]),
    "manifest_verify": """
SELECT event_type AS dataset, count(*) AS n_rows,
  CASE row_number() OVER (ORDER BY event_type) WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' WHEN 3 THEN 'changed' ELSE 'ok' END AS outcome
FROM events GROUP BY event_type""",
    "quarantine_rows": _with(DIRTY) + f"""
SELECT event_id, event_type, CASE WHEN {N_ERRORS} = 0 THEN 'good' ELSE 'bad' END AS side, {N_ERRORS} AS n_errors FROM checked""",
    "ingest_rejected": _with(DIRTY) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS error_type, count(*) AS n_rows, "
        f"{'min(' + raw + ')' if raw else 'CAST(NULL AS VARCHAR)'} AS example FROM checked WHERE {flag} HAVING count(*) > 0"
        for c, t, flag, raw in ERROR_RULES) + "\nUNION ALL SELECT '_store', 'left_behind', 0, NULL",
    "contracts_json": _with(FINGERPRINTS) + "\nSELECT dataset_name, version, schema_hash, n_columns FROM fingerprints",
    "typed_dates": """WITH raw AS (
  SELECT CAST(o_orderkey AS BIGINT) AS key, trim(CASE WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y') || '-02-30'
      WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%Y-%-m-%-d')
      WHEN o_orderkey % 23 = 0 AND o_orderkey % 19 <> 0 THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d') END) AS t FROM orders),
typed AS (SELECT key, t, CASE WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(t AS DATE) END AS d FROM raw)
SELECT key, d AS date, d AS as_of, CASE WHEN t = '' THEN 'unexpected_null' WHEN d IS NULL THEN 'type_mismatch' ELSE '' END AS errors FROM typed""",
    "registry_roundtrip": _with(REGISTRATIONS) + """
SELECT r.name, r.version, r.registered_at, r.updated_at, CAST(h.rk AS INTEGER) AS rank, h.run_id, h.ingested_at, h.row_count, h.version AS run_version
FROM registrations r LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ingested_at DESC, run_id DESC) AS rk FROM runs) h
ON h.dataset_name = r.name AND h.rk <= 3""",
    "latest_health": _with(RUNS) + """,
vb AS (
  SELECT dataset_name, run_id, ingested_at, row_count AS c,
    count(*) OVER w AS n,
    coalesce(CAST(sum(row_count) OVER w AS HUGEINT), 0) AS s,
    coalesce(CAST(sum(CAST(row_count AS HUGEINT) * row_count) OVER w AS HUGEINT), 0) AS q
  FROM runs
  WINDOW w AS (PARTITION BY dataset_name ORDER BY ingested_at, run_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
rep AS (
  SELECT dataset_name, ingested_at + INTERVAL 5 MINUTE AS checked_at,
         CASE WHEN n + 1 < 4 THEN true ELSE (n * c - s) * (n * c - s) <= 9 * (n * q - s * s) END AS volume_ok
  FROM vb)
SELECT dataset_name, id, checked_at, status, volume_ok FROM (
  SELECT dataset_name, sha256(dataset_name || '|' || strftime(checked_at, '%Y-%m-%d %H:%M:%S.%f')) AS id, checked_at,
         CASE WHEN volume_ok THEN 'healthy' ELSE 'degraded' END AS status, volume_ok,
         row_number() OVER (PARTITION BY dataset_name ORDER BY checked_at DESC,
           sha256(dataset_name || '|' || strftime(checked_at, '%Y-%m-%d %H:%M:%S.%f')) DESC) AS rk
  FROM rep)
WHERE rk = 1""",
}

# A stream that checks runs as they arrive says what the batch says afterwards.
ORACLE_SQL["stream_volume_checks"] = ORACLE_SQL["volume_backfill"]
