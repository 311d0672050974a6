"""Row numbers over a whole table without a task that sees it whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirhouse.llm.common import write_once

ROW_BITS = 33  # of monotonically_increasing_id: the row's number within its partition


def positions(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 by ``order`` within equal ``group`` columns, which hold no nulls)
    and ``total`` (rows of the group).

    Rows are dealt by ranges of group and order and written once; what is summed over a window is
    one row per partition and group.  Rows that tie are told apart by their number in the input,
    which also spreads equal rows over partitions; any of their orders is right."""
    by = [*[F.col(g) for g in group], *order, F.col("_salt")]
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = write_once(dealt.withColumns({"_part": F.spark_partition_id(), "_row": row}), name)
    sizes = numbered.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(*group)
    before = F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")
    shifts = sizes.select(*group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("total"))
    return numbered.join(shifts, [*group, "_part"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")
