"""Visits of one visitor: entry pages, unique visits, bounces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirhouse.functions import times
from weirhouse.operators.asof_join import as_of_join
from weirhouse.operators.patterns import Pattern
from weirhouse.sources.landing import land


def is_entry(empty_too: bool = True) -> Column:
    """Entry page: no ``last_page_id``; with ``empty_too`` an empty one counts."""
    last = F.col("page.last_page_id")
    return (last.isNull() | (F.length(last) == 0)) if empty_too else last.isNull()


def unique_visits(
    pages: DataFrame, mode: str = "day", order: Sequence[str] = ("ts", "seq"), ttl_ms: int | None = None
) -> DataFrame:
    """Page records that count as a visit (batch).

    ``day``: the first record of a mid on each UTC+8 day.

    ``literal``: entry pages always count; another page is left out when an
    earlier record of the same mid *and second* opened a visit, which an entry
    page does, and so does the mid's very first record.  There is no expiry
    here; the stream form has one.

    Either way no task holds a whole mid: the first form ranks with a limit
    that also runs before the shuffle, the second works per mid and second.
    """
    if mode == "day":
        w = Window.partitionBy("common.mid", times.day_slot("ts")).orderBy(*order)
        return pages.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
    if mode != "literal":
        raise ValueError(f"unknown mode {mode!r}")
    if ttl_ms is not None:
        return _expiring_visits(pages, order, ttl_ms)

    mid, sec = F.col("common.mid"), times.slot_of("ts", 1000)
    opening = (
        pages.groupBy(mid.alias("_mid"))
        .agg(F.min("ts").alias("_first"))
        .select("_mid", times.slot_of("_first", 1000).alias("_sec"), F.lit(True).alias("_opens"))
    )
    in_second = Window.partitionBy("_mid", "_sec").orderBy(*order)
    earlier = in_second.rowsBetween(Window.unboundedPreceding, -1)
    entry = is_entry()
    after_entry = F.coalesce(F.max(entry).over(earlier), F.lit(False))
    after_first = F.coalesce(F.col("_opens"), F.lit(False)) & (F.row_number().over(in_second) > 1)
    return (
        pages.withColumns({"_mid": mid, "_sec": sec})
        .join(opening, ["_mid", "_sec"], "left")
        .withColumns({"_after_entry": after_entry, "_after_first": after_first})
        .filter(entry | ~(F.col("_after_entry") | F.col("_after_first")))
        .select(*pages.columns)
    )


def _expiring_visits(pages: DataFrame, order: Sequence[str], ttl_ms: int) -> DataFrame:
    """Literal visits whose state expires.

    Every entry and the mid's first record open a visit; from there a visit opened at t is followed by
    the first record at t + ``ttl_ms`` or later, unless an entry comes before it.  These steps depend on one another, so
    each moment of a mid becomes a pointer to the one that would follow it, and pointers are doubled
    (composed with themselves) until all moments reached from entries and first records are found: as many rounds as
    the longest stretch without an entry has binary digits in lifetimes.
    """
    slim = pages.select(F.col("common.mid").alias("mid"), F.col("ts").alias("t"), is_entry().alias("entry"))
    moments = land(slim.groupBy("mid", "t").agg(F.max("entry").alias("entry")), "visit-moments")
    # The first moment at or after another is the last one at or before it in reversed time.
    back = moments.select("mid", F.col("t").alias("next"), (-F.col("t")).alias("at"))
    entries = moments.where("entry").select("mid", F.col("t").alias("next_entry"), (-F.col("t")).alias("at"))
    later = as_of_join(moments.select("mid", "t", (-F.col("t") - ttl_ms).alias("at")), back, ["mid"], "at", ["next"], ttl_ms, how="inner")
    later = later.select("mid", "t", (-F.col("t") - 1).alias("at"), "next")
    guarded = as_of_join(later, entries, ["mid"], "at", ["next_entry"], ttl_ms)
    follows = guarded.where("next_entry IS NULL OR next_entry > next").select("mid", "t", "next")
    jumps = land(follows, "visit-jumps")
    first = moments.groupBy("mid").agg(F.min("t").alias("t"))
    opened = land(moments.where("entry").select("mid", "t").unionByName(first).distinct(), "visits-opened")
    while not jumps.isEmpty():
        reached = opened.join(jumps, ["mid", "t"]).select("mid", F.col("next").alias("t"))
        opened = land(opened.unionByName(reached).distinct(), "visits-opened")
        again = jumps.select("mid", F.col("t").alias("next"), F.col("next").alias("far"))
        jumps = land(jumps.join(again, ["mid", "next"]).select("mid", "t", F.col("far").alias("next")), "visit-jumps")

    held = opened.select("mid", F.col("t").alias("opened"), F.col("t").alias("at"))
    before = as_of_join(moments.select("mid", "t", (F.col("t") - 1).alias("at")), held, ["mid"], "at", ["opened"], ttl_ms)
    state = before.select(F.col("mid").alias("_mid"), F.col("t").alias("_t"), F.col("opened").alias("_opened"))
    same = Window.partitionBy("_mid", "_t").orderBy(*order)
    entry_before = F.coalesce(F.max(is_entry()).over(same.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    gone = F.col("_opened").isNull() | (F.col("ts") - F.col("_opened") >= ttl_ms)
    passes = F.when(gone, F.col("_nth") == 1).otherwise(times.slot_of("ts", 1000) != times.slot_of("_opened", 1000))
    return (
        pages.withColumns({"_mid": F.col("common.mid"), "_t": F.col("ts")})
        .join(state, ["_mid", "_t"])
        .withColumns({"_entry_before": entry_before, "_nth": F.row_number().over(same)})
        .filter(is_entry() | (~F.col("_entry_before") & passes))
        .select(*pages.columns)
    )


def bounce_pattern(within_ms: int = 10_000) -> Pattern:
    """An entry page and right after it another one, or none in time."""
    return Pattern.begin("start", is_entry()).next("next", is_entry()).within(within_ms)


def bounces(
    pages: DataFrame,
    within_ms: int = 10_000,
    order: Sequence[str] = ("ts", "seq"),
    slice_ms: int | None = None,
) -> DataFrame:
    """Entry pages whose next record is an entry page too, or did not come in time (batch).

    An entry record is *no* bounce just when the mid's next record comes in less
    than ``within_ms`` and is not an entry page.  Rows are grouped by mid and
    time slice, so a mid with a large share of the rows falls apart; what
    follows the last row of a slice is found in one of two exact ways:

    * slices at least ``within_ms`` long (default: eight times that): the first
      ``within_ms`` of a slice are copied to the slice before.  One shuffle.
    * shorter slices, for a long ``within_ms`` over dense data: the first row of
      every slice is passed to the mid's slice before it that has rows.

    Columns of records that cannot be emitted are not shuffled.  ``order`` starts
    with ``ts``.
    """
    slice_ms = slice_ms or 8 * within_ms
    place = [f"_o{i}" for i in range(len(order))]
    rows = pages.select(
        "*",
        F.col("common.mid").alias("_mid"),
        is_entry().alias("_entry"),
        F.col("ts").alias("_t"),
        *[F.col(c).alias(p) for c, p in zip(order, place)],
        times.slot_of("ts", slice_ms).alias("_slot"),
    )
    find = _next_from_copies if slice_ms >= within_ms else _next_from_slices
    stays = (F.col("_next_t") - F.col("_t") < within_ms) & ~F.col("_next_entry")
    return (
        find(rows, pages.columns, place, within_ms, slice_ms)
        .withColumn("_stays", F.coalesce(stays, F.lit(False)))
        .filter("_emits AND NOT _stays")
        .select(*pages.columns)
    )


def _slim(rows: DataFrame, columns: Sequence[str], emits: Column, slot: Column, place: Sequence[str]) -> DataFrame:
    return rows.select(
        "_mid",
        "_entry",
        "_t",
        *place,
        slot.alias("_slot"),
        emits.alias("_emits"),
        *[F.when(emits, F.col(c)).alias(c) for c in columns],
    )


def _next_in_slice(rows: DataFrame, place: Sequence[str]) -> DataFrame:
    w = Window.partitionBy("_mid", "_slot").orderBy(*place)
    return rows.withColumns(
        {"_next_t": F.lead("_t").over(w), "_next_entry": F.lead("_entry").over(w)}
    )


def _next_from_copies(rows, columns, place, within_ms, slice_ms):
    near_edge = F.pmod(F.col("ts"), F.lit(slice_ms)) < within_ms
    slots = F.when(near_edge, F.array(F.lit(0), F.lit(-1))).otherwise(F.array(F.lit(0)))
    placed = rows.select("*", F.explode(slots).alias("_shift"))
    emits = F.col("_entry") & (F.col("_shift") == 0)
    slot = F.col("_slot") + F.col("_shift")
    return _next_in_slice(_slim(placed, columns, emits, slot, place), place)


def _next_from_slices(rows, columns, place, within_ms, slice_ms):
    first = F.min(F.struct(*place, "_t", "_entry")).alias("_first")
    per_mid = Window.partitionBy("_mid").orderBy("_slot")
    following = (
        rows.groupBy("_mid", "_slot")
        .agg(first)
        .select("_mid", "_slot", F.lead("_first").over(per_mid).alias("_after"))
        .filter(F.col("_after").isNotNull())
    )
    slim = _slim(rows, columns, F.col("_entry"), F.col("_slot"), place)
    inner = _next_in_slice(slim, place)
    last = F.col("_next_t").isNull()
    return inner.join(following, ["_mid", "_slot"], "left").withColumns(
        {
            "_next_t": F.when(last, F.col("_after._t")).otherwise(F.col("_next_t")),
            "_next_entry": F.when(last, F.col("_after._entry")).otherwise(F.col("_next_entry")),
        }
    )
