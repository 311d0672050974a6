"""Late rows as data: what a watermark lets through, computed on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirhouse.sources.landing import land


def mark_late(rows: DataFrame, step: str, lateness_ms: int, window_ms: int, slice_size: int, ts: str = "ts") -> DataFrame:
    """``rows`` with ``watermark`` (null before the first) and ``late`` (batch).

    ``step`` is a whole number that tells the order of arrival; rows of one step (a micro-batch, or each row by
    itself) see the watermark that the steps before left: their largest ``ts`` less ``lateness_ms``.  A row is
    late when its tumbling window of ``window_ms`` has ended by then, and a windowed sum drops it.  Rows with a
    null step or time are never late and move nothing.

    The running maximum is one over all rows, yet no task sees them all: maxima per slice of steps are
    partial aggregates, their prefix is taken over one row per slice and written, and a second pass adds what
    came before within the slice.
    """
    slot = F.floor(F.col(step) / slice_size)
    placed = rows.withColumn("_slot", slot)
    tops = placed.where("_slot IS NOT NULL").groupBy("_slot").agg(F.max(ts).alias("_top"))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    prefix = land(tops.select("_slot", F.max("_top").over(before).alias("_before")), "late-prefix")
    # Steps are told apart within a slice: one maximum per step, so a window holds few rows of any step.
    per_step = placed.where("_slot IS NOT NULL").groupBy("_slot", F.col(step).alias("_step")).agg(F.max(ts).alias("_top"))
    within = Window.partitionBy("_slot").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    known = per_step.withColumn("_within", F.max("_top").over(within)).join(prefix, "_slot")
    marks = known.select(F.col("_slot").alias("_of"), F.col("_step").alias("_at"), (F.greatest("_within", "_before") - lateness_ms).alias("watermark"))
    end = (F.floor(F.col(ts) / window_ms) + 1) * window_ms
    met = placed.join(marks, (F.col("_slot") == F.col("_of")) & (F.col(step) == F.col("_at")), "left")
    return met.withColumn("late", F.coalesce(end <= F.col("watermark"), F.lit(False))).drop("_slot", "_of", "_at")


def split_late(rows: DataFrame, step: str, lateness_ms: int, window_ms: int, slice_size: int, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """The rows in time, and the late ones as a side output with the watermark they met."""
    marked = mark_late(rows, step, lateness_ms, window_ms, slice_size, ts)
    return marked.where(~F.col("late")).select(*[F.col(f"`{c}`") for c in rows.columns]), marked.where("late").drop("late")
