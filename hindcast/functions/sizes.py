"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of narrow tables (classes, origins, anchors) that every executor may hold.
BROADCAST_ROWS = 100_000


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a hint to broadcast it if it has no more than `most` rows; beyond that the join is left to the optimizer, which deals out both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
