"""Broadcasts behind a check of what is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else ``df``.

    For configuration-like inputs whose size Spark cannot estimate.  Rows are
    counted by one small job; without the hint Spark picks the join itself.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
