"""Visitor measures and their tumbling-window statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse import schemas
from weirhouse.functions import times
from weirhouse.operators import visits


def _measures(rows: DataFrame, uv=0, pv=0, sv: int | Column = 0, uj=0, dur: int | Column = 0) -> DataFrame:
    values = dict(zip(schemas.VISITOR_MEASURES, (uv, pv, sv, uj, dur)))
    return rows.select(
        *[F.col(f"common.{d}").alias(d) for d in schemas.VISITOR_DIMS],
        *[(v if isinstance(v, Column) else F.lit(v)).cast("bigint").alias(n) for n, v in values.items()],
        "ts",
    )


def page_measures(pages: DataFrame) -> DataFrame:
    """One page view each; a session starts where ``last_page_id`` is null (not empty)."""
    return _measures(
        pages,
        pv=1,
        sv=F.when(visits.is_entry(empty_too=False), 1).otherwise(0),
        dur=F.coalesce(F.col("page.during_time"), F.lit(0)),
    )


def unique_visit_measures(rows: DataFrame) -> DataFrame:
    return _measures(rows, uv=1)


def bounce_measures(rows: DataFrame) -> DataFrame:
    return _measures(rows, uj=1)


def union_measures(pages: DataFrame, unique: DataFrame, bounced: DataFrame) -> DataFrame:
    """Bag union of the three inputs in one row type."""
    return (
        unique_visit_measures(unique)
        .unionByName(bounce_measures(bounced))
        .unionByName(page_measures(pages))
    )


def watermarked(measures: DataFrame, lateness: str) -> DataFrame:
    """Stream measures with a watermark of their own in ``et``; the slowest of united inputs then holds."""
    return measures.withColumn("et", times.event_time("ts")).withWatermark("et", lateness)


def windowed(
    measures: DataFrame,
    size: str = "10 seconds",
    dims: Sequence[str] = schemas.VISITOR_DIMS,
    lateness: str = "10 seconds",
) -> DataFrame:
    """Sums per tumbling event-time window and dimension values.

    Batch or stream; on a stream rows later than ``lateness`` are dropped, unless the inputs
    are ``watermarked`` already.  All
    aggregates have a partial form, so a dominant group is reduced before the
    shuffle.  ``ts`` is the latest event time.
    """
    if "et" in measures.columns:
        timed = measures
    elif measures.isStreaming:
        timed = watermarked(measures, lateness)
    else:
        timed = measures.withColumn("et", times.event_time("ts"))
    return (
        timed.groupBy(F.window("et", size).alias("w"), *dims)
        .agg(
            *[F.sum(m).alias(m) for m in schemas.VISITOR_MEASURES],
            F.max("ts").alias("ts"),
        )
        .select(
            times.text_of_millis(F.unix_millis("w.start")).alias("stt"),
            times.text_of_millis(F.unix_millis("w.end")).alias("edt"),
            *[c for c in schemas.VISITOR_STATS if c in dims],
            *schemas.VISITOR_MEASURES,
            "ts",
        )
    )


def visitor_stats(
    pages: DataFrame,
    size: str = "10 seconds",
    within_ms: int = 10_000,
    order: Sequence[str] = ("ts", "seq"),
    unique_mode: str = "day",
    slice_ms: int | None = None,
) -> DataFrame:
    """Page logs to visitor statistics in one batch plan; ``slice_ms`` as in ``bounces``."""
    unique = visits.unique_visits(pages, unique_mode, order)
    bounced = visits.bounces(pages, within_ms, order, slice_ms)
    return windowed(union_measures(pages, unique, bounced), size)
