"""Patterns of strictly consecutive records of one key, with a time limit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirhouse.functions import times

MATCH, TIMEOUT = "match", "timeout"


@dataclass(frozen=True)
class Pattern:
    """Conditions that a record and those right after it meet one by one.

    ``Pattern.begin("start", cond).next("then", cond).within(10_000)``: the record of each step is the very
    next of its key, and the last comes less than the limit after the first.  A start *matches* when all
    steps do, *times out* when its steps so far are met and the next record does not come in time, and is
    dropped when a next record comes in time and does not meet its step.  Every record that meets the
    first condition is a start of its own.  A condition that is null is not met.
    """

    names: tuple[str, ...]
    conditions: tuple[Column, ...]
    within_ms: int | None = None

    @staticmethod
    def begin(name: str, condition: Column) -> "Pattern":
        return Pattern((name,), (condition,))

    def next(self, name: str, condition: Column) -> "Pattern":
        if name in self.names:
            raise ValueError(f"two steps are named {name!r}")
        return replace(self, names=(*self.names, name), conditions=(*self.conditions, condition))

    def within(self, limit_ms: int) -> "Pattern":
        return replace(self, within_ms=limit_ms)

    @property
    def length(self) -> int:
        return len(self.conditions)

    def met(self) -> Column:
        """The steps whose condition a record meets, as bits from the first."""
        bits = [F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(0) for i, c in enumerate(self.conditions)]
        total = bits[0]
        for b in bits[1:]:
            total = total + b
        return total.cast("int")


def _outcome(pattern: Pattern, t: Column, following: Sequence[Column]) -> Column:
    """(outcome, steps) of a start; null where it is dropped.  ``following`` are (t, met) of the next records."""
    out = F.struct(F.lit(MATCH).alias("outcome"), F.lit(pattern.length).alias("steps"))
    for step in range(pattern.length - 1, 0, -1):
        after = following[step - 1]
        late = after.isNull()
        if pattern.within_ms is not None:
            late = late | (after["t"] - t >= pattern.within_ms)
        meets = after["met"].bitwiseAND(F.lit(1 << step)) != 0
        out = F.when(late, F.struct(F.lit(TIMEOUT).alias("outcome"), F.lit(step).alias("steps"))).when(meets, out)
    return out


def find_pattern(
    rows: DataFrame,
    pattern: Pattern,
    key: Column,
    order: Sequence[str] = ("ts", "seq"),
    slice_ms: int = times.DAY_MS,
) -> DataFrame:
    """The starts of ``rows`` that match or time out, with ``outcome`` and ``steps`` met (batch).

    ``order`` starts with the event time in epoch milliseconds and is unique within a key.  Without a
    limit a start times out only where the key's records end.

    Rows are grouped by key and time slice of any width, so a key with a large share of the rows
    falls apart.  A slice's last records look into those that follow: each slice hands the first
    records it has, at most one less than the pattern is long, to the slices before it.
    Columns of records that are no start are not shuffled.
    """
    ahead = pattern.length - 1
    place = [f"_o{i}" for i in range(len(order))]
    seen = rows.select(
        key.alias("_key"),
        times.slot_of(order[0], slice_ms).alias("_slot"),
        *[F.col(c).alias(p) for c, p in zip(order, place)],
        pattern.met().alias("_met"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
    )
    starts = F.col("_met").bitwiseAND(F.lit(1)) != 0
    slim = seen.withColumn("_row", F.when(starts, F.col("_row")))
    look = F.struct(F.col("_o0").alias("t"), F.col("_met").alias("met"))
    if ahead:
        # The first records per slice: ranks are cut before the shuffle.
        in_slice = Window.partitionBy("_key", "_slot").orderBy(*place)
        first = slim.select("_key", "_slot", *place, "_met").withColumn("_rank", F.row_number().over(in_slice)).where(F.col("_rank") <= ahead)
        heads = first.groupBy("_key", "_slot").agg(F.sort_array(F.collect_list(F.struct(*place, "_met"))).alias("_heads"))
        later = Window.partitionBy("_key").orderBy("_slot").rowsBetween(1, ahead)
        handed = F.transform(F.flatten(F.collect_list("_heads").over(later)), lambda h: F.struct(h["_o0"].alias("t"), h["_met"].alias("met")))
        per_slice = heads.select("_key", "_slot", handed.alias("_handed"))
        left = F.count(F.lit(1)).over(Window.partitionBy("_key", "_slot")) - F.row_number().over(in_slice)
        slim = slim.withColumns({f"_n{k}": F.lead(look, k).over(in_slice) for k in range(1, ahead + 1)} | {"_left": left})
        slim = slim.where(starts).join(per_slice, ["_key", "_slot"], "left")
        following = [F.coalesce(f"_n{k}", F.get("_handed", (F.lit(k) - F.col("_left") - 1).cast("int"))) for k in range(1, ahead + 1)]
    else:
        slim, following = slim.where(starts), []
    found = slim.select("_row", _outcome(pattern, F.col("_o0"), following).alias("_out")).where(F.col("_out").isNotNull())
    return found.select("_row.*", "_out.outcome", "_out.steps")
