"""Join of two event streams on a key and a time distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.functions import times


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower_ms: int,
    upper_ms: int,
    bucket_ms: int | None = None,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Inner join where ``lower <= right_time - left_time <= upper``.

    Times are TIMESTAMP columns; column names of the two sides must differ.
    Both sides are also matched on a time bucket: a right row has one bucket, a
    left row those its interval touches.  Rows of one key far apart in time thus
    never meet, and a dominant key falls apart over time.  With the default
    bucket of eight interval widths a left row has 1.125 buckets on average.
    On streams the condition on the watermarked times lets Spark drop old state.
    """
    span = upper_ms - lower_ms
    if span < 0:
        raise ValueError("upper_ms is below lower_ms")
    bucket_ms = bucket_ms or max(8 * span, 1000)
    if left.isStreaming:
        left = left.withWatermark(left_time, lateness)
    if right.isStreaming:
        right = right.withWatermark(right_time, lateness)
    lt = F.unix_millis(left_time)
    # sequence() over slot numbers; every one is a bucket the interval touches
    touched = F.sequence(
        times.slot_of(lt + F.lit(lower_ms), bucket_ms), times.slot_of(lt + F.lit(upper_ms), bucket_ms)
    )
    lhs = left.withColumn("_lb", F.explode(touched))
    # a default for null times, which the time condition drops, saves a null check up to the scan
    own = F.coalesce(times.slot_of(F.unix_millis(right_time), bucket_ms), F.lit(0).cast("bigint"))
    rhs = right.withColumn("_rb", own)
    # milliseconds need no calendar: day-time intervals shift by exact amounts
    low = F.make_dt_interval(secs=F.lit(lower_ms / 1000))
    high = F.make_dt_interval(secs=F.lit(upper_ms / 1000))
    close = (F.col(right_time) >= F.col(left_time) + low) & (F.col(right_time) <= F.col(left_time) + high)
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_lb") == F.col("_rb"))
    return lhs.join(rhs, same & close, "inner").drop("_lb", "_rb")
