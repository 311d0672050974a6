"""Rows of two streams that may still meet rows to come, kept as Parquet between batches.

Spark's join of two streams keeps every row of a batch as state, in the executors' memory or row by
row in RocksDB, before it lets any go.  Here a batch is joined as batch tables are, by sorting and
spilling, and only the rows near the watermark stay, as files beside the job's checkpoint.

The meaning is that of the stream join.  The watermark is the newest time of the side that is behind,
less the lateness.  Rows at or before the watermark that earlier batches left are late and dropped; a
row stays until no row after the watermark can lie in its interval.  What batch ``n`` keeps follows
from what ``n - 1`` kept and from its own rows, so a batch that runs again ends at the same.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse.sources import files
from weirhouse.sources.landing import land

KEPT = "_kept"
_MARKS = "side string, newest bigint"


@dataclass(frozen=True)
class OpenRows:
    """Open rows of a job's two sides under ``root``.

    ``reach_ms`` has, by side, how far after a row's time (epoch ms in ``time``) a row of the other side
    may lie and still meet it.
    """

    spark: SparkSession
    root: str
    reach_ms: Mapping[str, int]
    time: str
    lateness: str = "0 seconds"

    def begin(self, new: Mapping[str, DataFrame], batch_id: int) -> "Batch":
        """Land the rows of a batch, by side, beside those the batch before kept.

        The rows are read again by ``spark``, so that the batch runs with its settings.
        """
        marks: dict[str, int | None] = dict.fromkeys(self.reach_ms)
        if batch_id > 0:
            before = self._path(batch_id - 1)
            if not files.is_complete(self.spark, f"{before}/marks"):
                raise ValueError(f"no open rows of batch {batch_id - 1} in {self.root}: not a checkpoint of this job")
            marks = {r["side"]: r["newest"] for r in self.spark.read.schema(_MARKS).parquet(f"{before}/marks").collect()}
        late = self._watermark(marks)
        rows: dict[str, DataFrame] = {}
        for side, df in new.items():
            path = f"{self.root}/new/{side}"
            land(df, side, path)
            fresh = self.spark.read.schema(df.schema).parquet(path)
            if (newest := fresh.agg(F.max(self.time)).first()[0]) is not None:
                marks[side] = max(newest, newest if marks[side] is None else marks[side])
            if late is not None:
                fresh = fresh.filter(F.col(self.time) > late)
            rows[side] = fresh.withColumn(KEPT, F.lit(False))
            if batch_id > 0:
                old = self.spark.read.schema(df.schema).parquet(f"{self._path(batch_id - 1)}/{side}")
                rows[side] = rows[side].unionByName(old.withColumn(KEPT, F.lit(True)))
        return Batch(self, batch_id, rows, marks)

    def _path(self, batch_id: int) -> str:
        return f"{self.root}/batch={batch_id}"

    def _watermark(self, marks: Mapping[str, int | None]) -> int | None:
        """None until both sides had a row."""
        if None in marks.values():
            return None
        delay = F.unix_millis(F.timestamp_millis(F.lit(0)) + F.lit(self.lateness).cast(T.CalendarIntervalType()))
        return min(marks.values()) - self.spark.range(1).select(delay).first()[0]


@dataclass(frozen=True)
class Batch:
    """Rows of a batch by side: its own and those kept, which have ``KEPT`` set."""

    store: OpenRows
    batch_id: int
    rows: Mapping[str, DataFrame]
    marks: Mapping[str, int | None]

    def end(self) -> None:
        """Keep the rows that are still open; call it when the batch's results are written."""
        store, path = self.store, self.store._path(self.batch_id)
        mark = store._watermark(self.marks)
        for side, df in self.rows.items():
            is_open = F.lit(True) if mark is None else F.col(store.time) + F.lit(store.reach_ms[side]) > mark
            df.filter(is_open).drop(KEPT).write.mode("overwrite").parquet(f"{path}/{side}")
        marks = store.spark.createDataFrame([*self.marks.items()], _MARKS)
        marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks")  # last: what it stands for is whole
        files.remove(store.spark, f"{store.root}/new")
        files.remove(store.spark, store._path(self.batch_id - 2))  # that before it is needed if this batch runs again
