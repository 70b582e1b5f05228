"""strata: governed dataset ingestion, health checks and point-in-time reads on Spark.

Every operator is a DataFrame -> DataFrame function that Catalyst plans; the
driver only ever sees small, bounded results (error tables, run scalars).
"""

from strata.model import Column, Contract, HealthStatus, ErrorType

__all__ = ["Column", "Contract", "HealthStatus", "ErrorType"]
