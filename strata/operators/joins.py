"""Joins whose broadcast side is checked, not assumed, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

# Bytes (as JSON text, an upper bound for the narrow key tables used here) under
# which a checked side is broadcast.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def checked_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``small`` materialised once (checkpoint to the shared folder), then
    marked for broadcast only if its rows take at most ``max_bytes``;
    otherwise returned as is, and Spark plans the join from run-time sizes.

    The checkpoint also cuts lineage, so the check and the join read the
    written rows instead of recomputing what produced them.
    """
    ensure_checkpoint_dir(small.sparkSession)
    materialized = small.checkpoint(eager=True)
    size = materialized.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(materialized) if size <= max_bytes else materialized
