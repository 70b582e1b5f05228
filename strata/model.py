"""Contract model, enumerations and the fixed values the semantics depend on."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from datetime import timedelta
from enum import Enum

from pyspark.sql import types as T


# ---------------------------------------------------------------------------
# These must equal the reference semantics for equal answers.
# ---------------------------------------------------------------------------

class HealthStatus(str, Enum):
    HEALTHY = "healthy"
    DEGRADED = "degraded"
    FAILING = "failing"
    UNKNOWN = "unknown"  # registered, but no report exists yet


class ErrorType(str, Enum):
    MISSING_COLUMN = "missing_column"
    UNEXPECTED_COLUMN = "unexpected_column"
    TYPE_MISMATCH = "type_mismatch"
    UNEXPECTED_NULL = "unexpected_null"


# Contract column types.
CONTRACT_TYPES = ("int", "float", "string", "date", "timestamp", "boolean")

# Maximum age of the latest ingestion per expected frequency (no SLA for on_demand).
FRESHNESS_MAX_AGE = {
    "intraday": timedelta(hours=4),
    "daily": timedelta(hours=26),
    "weekly": timedelta(days=8),
    "monthly": timedelta(days=33),
    "on_demand": None,
}

# Volume check: newest record plus up to 30 baseline records; at least 3 baseline
# records are needed; bounds are mean +- 3 population standard deviations.
VOLUME_HISTORY = 31
VOLUME_MIN_RECORDS = 4
VOLUME_SIGMAS = 3

# Null-ratio threshold for nullable columns (strictly greater fails).
DEFAULT_NULLABLE_THRESHOLD = 0.10

# Point-in-time reads see ingestions up to the end of the as_of day, 23:59:59.
END_OF_DAY_SECONDS = 23 * 3600 + 59 * 60 + 59

# Boolean text accepted by CSV normalisation (compared lower-case).
BOOL_TRUE = ("true", "1", "yes")
BOOL_FALSE = ("false", "0", "no")

# Reason codes.
REASON_ON_DEMAND = "on_demand_no_sla"
REASON_NO_RECORD = "no_ingestion_record_found"
REASON_NO_HISTORY = "no_ingestion_history"
REASON_INSUFFICIENT = "insufficient_history"
REASON_EMPTY = "empty_dataframe"
REASON_COLUMN_MISSING = "column_missing_from_dataframe"

# Spark storage type per contract type.
SPARK_TYPE = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}

# Spark types a typed frame may carry for each contract type (no coercion).
ACCEPTED_TYPES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "string": (T.StringType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}

# Human-readable expected type used in type_mismatch details.
TYPE_LABEL = {
    "int": "integer (byte/short/int/long)",
    "float": "float (float/double)",
    "string": "string",
    "date": "date (date, timestamp or date-string)",
    "timestamp": "timestamp",
    "boolean": "boolean",
}


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str
    nullable: bool = False
    description: str = ""

    def __post_init__(self) -> None:
        if self.dtype not in CONTRACT_TYPES:
            raise ValueError(f"unknown contract type {self.dtype!r}")


@dataclass(frozen=True)
class Contract:
    """A declared dataset contract: name, version and an ordered column list."""

    name: str
    version: str
    columns: tuple[Column, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def fingerprint_json(self) -> str:
        """Canonical JSON: keys sorted, columns sorted by name, descriptions left out."""
        doc = {
            "name": self.name,
            "version": self.version,
            "columns": [
                {"name": c.name, "dtype": c.dtype, "nullable": c.nullable}
                for c in sorted(self.columns, key=lambda c: c.name)
            ],
        }
        return json.dumps(doc, sort_keys=True)

    def schema_hash(self) -> str:
        """Driver-side digest of one contract; the set form is operators.fingerprint."""
        return hashlib.sha256(self.fingerprint_json().encode()).hexdigest()

    def spark_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, SPARK_TYPE[c.dtype], c.nullable, {"description": c.description})
                for c in self.columns
            ]
        )

    def to_json(self) -> str:
        return json.dumps(
            {
                "name": self.name,
                "version": self.version,
                "columns": [
                    {"name": c.name, "dtype": c.dtype, "nullable": c.nullable, "description": c.description}
                    for c in self.columns
                ],
            }
        )

    @staticmethod
    def from_json(text: str) -> "Contract":
        doc = json.loads(text)
        return Contract(
            doc["name"],
            doc["version"],
            tuple(
                Column(c["name"], c["dtype"], bool(c.get("nullable", False)), c.get("description", ""))
                for c in doc["columns"]
            ),
        )
