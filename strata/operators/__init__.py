"""DataFrame -> DataFrame operators."""

from strata.operators.changes import change_counts, row_changes
from strata.operators.digest import content_digest
from strata.operators.fingerprint import contracts_frame, contracts_from_json, schema_fingerprint
from strata.operators.health import (
    aggregate_status,
    check_freshness,
    check_null_ratio,
    check_schema_hash,
    check_volume,
    null_ratio_long,
    volume_backfill,
)
from strata.operators.normalize import error_summary, gate_summary, normalize_types, quarantine_split, typed_rows
from strata.operators.point_in_time import asof_runs, point_in_time, resolve_run
from strata.operators.registry import (
    first_writer_wins,
    ingestion_history,
    latest_health,
    latest_ingestion,
    latest_registrations,
    records_to_append,
)
from strata.operators.validate import validate_schema, validation_errors

__all__ = [
    "change_counts",
    "row_changes",
    "content_digest",
    "contracts_frame",
    "contracts_from_json",
    "schema_fingerprint",
    "aggregate_status",
    "check_freshness",
    "check_null_ratio",
    "check_schema_hash",
    "check_volume",
    "null_ratio_long",
    "volume_backfill",
    "error_summary",
    "gate_summary",
    "typed_rows",
    "normalize_types",
    "quarantine_split",
    "asof_runs",
    "point_in_time",
    "resolve_run",
    "first_writer_wins",
    "ingestion_history",
    "latest_health",
    "latest_ingestion",
    "latest_registrations",
    "records_to_append",
    "validate_schema",
    "validation_errors",
]
