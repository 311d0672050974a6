"""Stateful stream operators, one small state per visitor.

The processors see a narrow row: the visitor as text, order columns, a flag, and the record as
text they never look into.  Visitors are dealt over ``GROUPS`` groups by hash.  A call takes all
visitors of a group that a batch holds and works on whole columns, as a call costs milliseconds
whatever it does.  State and results are per visitor as before; memory per call follows the
watermark, or the visitors and a run of rows of one group, not the rows of a visitor.  They need
the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirhouse.functions import times
from weirhouse.operators import visits
from weirhouse.operators.patterns import Pattern
from weirhouse.session import ROCKSDB

DAY_MS, ZONE_MS = times.DAY_MS, times.ZONE_MS  # by value, as the processors travel without the library
#: Groups that visitors are dealt over; a checkpoint stays with the number it was begun with.
GROUPS = 1024
#: Rows of a group that are sorted together where records count in the order they come.
RUN_ROWS = 100_000

# The processors travel whole: the worker that sets up a stream on the driver sees no shipped files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _run(
    rows: DataFrame,
    processor: StatefulProcessor,
    keys: dict[str, Column],
    order: Sequence[str],
    flag: Column,
    lateness: str | None = None,
    time_mode: str = "None",
    says: str = "mark boolean",
) -> DataFrame:
    """Apply ``processor``; it answers with the record text and what ``says`` declares."""
    out = _answers(rows, processor, keys, order, flag, lateness, time_mode, says)
    said = T.StructType.fromDDL(says).names
    return _records(out, rows, said)


def _records(out: DataFrame, rows: DataFrame, said: Sequence[str]) -> DataFrame:
    """The records of ``rows`` from their texts, and the columns ``said`` beside them."""
    return out.select(F.from_json("record", rows.schema).alias("r"), *said).select("r.*", *said)


def _answers(rows, processor, keys, order, flag, lateness, time_mode, says, event_time="") -> DataFrame:
    columns = rows.columns
    if lateness is not None:
        rows = rows.withColumn("_et", times.event_time("ts")).withWatermark("_et", lateness)
    narrow = rows.select(
        F.pmod(F.hash(*keys.values()), F.lit(GROUPS)).alias("group"),
        F.to_json(F.struct(*[c.alias(k) for k, c in keys.items()])).alias("key"),  # a null key is a key, too
        *([F.col("_et")] if lateness is not None else []),
        F.col("ts").alias("t"),
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
        flag.alias("flag"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record"),
    )
    return narrow.groupBy("group").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=T.StructType.fromDDL(f"record string, {says}"),
        outputMode="append",
        timeMode=time_mode,
        eventTimeColumnName=event_time,
    )


def _runs(chunks: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Chunks put together until they hold ``rows`` rows."""
    held, count = [], 0
    for chunk in chunks:
        held.append(chunk)
        count += len(chunk)
        if count >= rows:
            yield pd.concat(held, ignore_index=True)
            held, count = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _firsts(rows: pd.DataFrame, order: Sequence[str]) -> pd.Series:
    """Marks the least row by order of each key."""
    lead = rows.sort_values(order, kind="stable").drop_duplicates("key").index
    return rows.index.isin(lead)


class _FirstOfBatch(StatefulProcessor):
    """The least row by order of each key of the batch, with the key and the end of its day.

    It holds nothing over batches; late rows are gone before it sees them."""

    def __init__(self, width: int):
        self._order = [f"o{i}" for i in range(width)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        best = None
        for chunk in rows:
            best = chunk if best is None else pd.concat([best, chunk], ignore_index=True)
            best = best[_firsts(best, self._order)]
        if best is not None and len(best):
            end = pd.to_datetime((best["flag"] + 1) * DAY_MS - ZONE_MS, unit="ms")
            yield pd.DataFrame({"record": best["record"], "key": best["key"], "day_end": end})

    def close(self) -> None:
        pass


class _FirstFlagged(StatefulProcessor):
    """Marks the first flagged row of a key, over all batches; others are unmarked.

    Within a batch the first is the least by order; just the best row so far of each key is
    held back.
    """

    def __init__(self, width: int):
        self._order = [f"o{i}" for i in range(width)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._done = handle.getMapState("done", "key string", "yes boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        known = {} if self._done.exists() else None  # None: nothing was ever marked
        best = None
        for chunk in rows:
            for k in chunk["key"].unique() if known is not None else ():
                if k not in known:
                    known[k] = self._done.containsKey((k,))
            may = chunk["flag"].to_numpy(bool)
            if known is not None:
                may &= ~chunk["key"].map(known).to_numpy(bool)
            rest, chunk = chunk[~may], chunk[may]
            if len(chunk):
                chunk = chunk if best is None else pd.concat([best, chunk], ignore_index=True)
                lead = _firsts(chunk, self._order)
                best, rest = chunk[lead], pd.concat([rest, chunk[~lead]], ignore_index=True)
            if len(rest):
                yield rest.assign(mark=False)[["record", "mark"]]
        if best is not None:
            for k in best["key"]:
                self._done.updateValue((k,), (True,))
            yield best.assign(mark=True)[["record", "mark"]]

    def close(self) -> None:
        pass


def correct_new_visitors(logs: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Stream form of ``logs.correct_new_visitors``; the state never expires.

    Only records that claim a new visitor go through the state; the others are neither
    shuffled nor handed to Python.
    """
    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    keys = {"mid": F.col("common.mid")}
    out = _run(logs.filter(claims), _FirstFlagged(len(order)), keys, order, F.lit(True))
    fixed = F.col("common").withField("is_new", F.when(F.col("mark"), F.lit("1")).otherwise(F.lit("0")))
    corrected = out.withColumn("common", fixed).select(*logs.columns)
    return logs.filter(~claims).unionByName(corrected)


def first_visits_of_day(
    pages: DataFrame, order: Sequence[str] = ("ts", "seq"), lateness: str = "1 day"
) -> DataFrame:
    """Stream form of ``unique_visits(mode='day')``: the first record to come.

    The first of a batch is found per mid and day; that none came in a batch before is left to
    ``dropDuplicates``, whose state is one key per mid and day and goes when the watermark has
    passed the day, as every record of it is late then.
    """
    day = times.day_slot("ts")
    keys = {"mid": F.col("common.mid"), "day": day}
    says = "key string, day_end timestamp"
    found = _answers(pages, _FirstOfBatch(len(order)), keys, order, day, lateness, "EventTime", says, "day_end")
    return _records(found.dropDuplicates(["key", "day_end"]), pages, ())


class _OpenVisit(StatefulProcessor):
    """Last second that opened a visit, per key; it expires ``ttl_ms`` after being written.

    By event time, expired ones are taken for gone when read, and cleared away by a timer of the group."""

    def __init__(self, width: int, ttl_ms: int, event_clock: bool):
        self._order = [f"o{i}" for i in range(width)]
        self._ttl = ttl_ms
        self._event = event_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        ttl = {} if self._event else {"ttlDurationMs": self._ttl}
        self._last = handle.getMapState("last", "key string", "t bigint", **ttl)
        self._clears = handle.getValueState("clears", "t bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        any_held = self._last.exists()
        held, lasts, newest = {}, {}, None
        for run in _runs(rows, RUN_ROWS):
            run = run.sort_values(["key", *self._order], ignore_index=True)
            passed, now, last = [], None, None
            for k, t, entry in zip(run["key"].tolist(), run["t"].tolist(), run["flag"].tolist()):
                if k != now:
                    if k not in lasts:
                        known = any_held and self._last.containsKey((k,))
                        held[k] = lasts[k] = self._last.getValue((k,))[0] if known else None
                    if now is not None:
                        lasts[now] = last
                    now, last = k, lasts[k]
                if entry or last is None or (self._event and t - last >= self._ttl):
                    last = t
                    passed.append(True)
                else:
                    passed.append(t // 1000 != last // 1000)
            lasts[now] = last
            kept = run[passed]
            if len(kept):
                yield kept.assign(mark=True)[["record", "mark"]]
        for k, last in lasts.items():
            if last != held[k]:
                self._last.updateValue((k,), (last,))
                newest = last if newest is None else max(newest, last)
        if self._event and newest is not None and not self._clears.exists():
            self._clear_at(newest + self._ttl)

    def _clear_at(self, at: int) -> None:
        self._handle.registerTimer(at)
        self._clears.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._clears.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        kept, gone = None, []
        for k, (t,) in self._last.iterator():
            if t + self._ttl <= watermark:
                gone.append(k)
            else:
                kept = t if kept is None else max(kept, t)
        if kept is None:
            self._last.clear()
        else:
            for k in gone:
                self._last.removeKey(k)
            self._clear_at(kept + self._ttl)  # so an expired one stays for less than another lifetime
        return iter(())

    def close(self) -> None:
        pass


def literal_visits(
    pages: DataFrame,
    order: Sequence[str] = ("ts", "seq"),
    ttl_ms: int = DAY_MS,
    clock: str = "event",
    lateness: str = "1 day",
) -> DataFrame:
    """Stream form of ``unique_visits(mode='literal')`` with its expiring state.

    Records count in the order they come; those of one fetched run of a group are sorted.
    ``clock='event'`` measures the expiry on the records, so a replay gives the
    same result; ``'processing'`` measures it on the wall clock with state TTL.
    """
    processor = _OpenVisit(len(order), ttl_ms, clock == "event")
    keys = {"mid": F.col("common.mid")}
    event = clock == "event"
    return _run(
        pages,
        processor,
        keys,
        order,
        visits.is_entry(),
        lateness if event else None,
        "EventTime" if event else "ProcessingTime",
    ).drop("mark")


class _Sequence(StatefulProcessor):
    """Holds records until the watermark has settled what follows them.

    The records of a group are held packed, one Arrow stream per call that added some."""

    def __init__(self, width: int, length: int, within_ms: int):
        self._order = [f"o{i}" for i in range(width)]
        self._length = length
        self._within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._names = ["key", "t", *self._order, "met", "record"]
        self._held = handle.getListState("held", "packed binary")
        self._timer = handle.getValueState("timer", "t bigint")

    @staticmethod
    def _pack(rows: pd.DataFrame) -> tuple:
        sink, table = io.BytesIO(), pa.Table.from_pandas(rows, preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return (sink.getvalue(),)

    def _settle(self, new: pd.DataFrame | None, watermark: int) -> pd.DataFrame | None:
        """Emit settled starts; keep what a later record could still decide.

        What was kept before is written anew only when something leaves."""
        parts = [pa.ipc.open_stream(r[0]).read_pandas() for r in self._held.get()]
        if not parts and new is None:
            return None
        held = pd.concat([*parts, *([] if new is None else [new])], ignore_index=True)
        held["_k"] = pd.factorize(held["key"])[0]
        held = held.sort_values(["_k", *self._order], ignore_index=True)
        t, met, k = (held[c].to_numpy("int64") for c in ("t", "met", "_k"))
        # A key's settled records come first; ``final``: where they end, per record.
        first = np.flatnonzero(np.diff(k, prepend=-1))
        ends = first + np.add.reduceat((t <= watermark).astype(np.int64), first)
        final = ends[k]
        start = np.flatnonzero((met & 1 == 1) & (np.arange(len(t)) < final))
        kept_from, found = ends.copy(), []
        for step in range(1, self._length):
            after = start + step
            here = after < final[start]
            at = np.minimum(after, len(t) - 1)
            late = here & (t[at] - t[start] >= self._within) | ~here & (watermark >= t[start] + self._within - 1)
            found.append((start[late], "timeout", step))
            waiting = start[~here & ~late]
            np.minimum.at(kept_from, k[waiting], waiting)
            start = start[here & ~late & (met[at] >> step & 1 == 1)]
        found.append((start, "match", self._length))
        kept = np.arange(len(t)) >= kept_from[k]
        if not kept.all():
            rest = held.loc[kept, self._names]
            if len(rest):
                self._held.put([self._pack(rest)])
            else:
                self._held.clear()
        elif new is not None:
            self._held.appendValue(self._pack(new))
        # By then the first one kept of some key is settled, so a record waits no longer than the limit after the watermark.
        leads = kept_from[kept_from < np.append(first[1:], len(t))]
        self._rearm(int(t[leads].min()) + self._within if len(leads) else None)
        texts = held["record"].to_numpy()
        parts = [pd.DataFrame({"record": texts[i], "outcome": how, "steps": n}) for i, how, n in found if len(i)]
        return pd.concat(parts, ignore_index=True) if parts else None

    def _rearm(self, at: int | None) -> None:
        armed = self._timer.get()[0] if self._timer.exists() else None
        if armed == at:
            return
        if armed is not None:
            self._handle.deleteTimer(armed)
            self._timer.clear()
        if at is not None:
            self._handle.registerTimer(at)
            self._timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        chunks = []
        for chunk in rows:
            # only a start can be emitted, so only its text is held
            texts = chunk["record"].where(chunk["flag"] & 1 == 1, None)
            chunks.append(chunk.assign(met=chunk["flag"], record=texts)[self._names])
        if chunks:
            out = self._settle(pd.concat(chunks, ignore_index=True), timerValues.getCurrentWatermarkInMs())
            if out is not None:
                yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._timer.clear()
        out = self._settle(None, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def close(self) -> None:
        pass


def find_pattern(
    rows: DataFrame,
    pattern: Pattern,
    key: Column,
    order: Sequence[str] = ("ts", "seq"),
    lateness: str = "1 second",
) -> DataFrame:
    """Stream form of ``patterns.find_pattern``; the pattern needs a time limit, which bounds its state."""
    if pattern.within_ms is None:
        raise ValueError("a pattern without a limit would hold records for ever")
    processor = _Sequence(len(order), pattern.length, pattern.within_ms)
    says = "outcome string, steps int"
    return _run(rows, processor, {"mid": key}, order, pattern.met(), lateness, "EventTime", says)


def bounces(
    pages: DataFrame,
    within_ms: int = 10_000,
    order: Sequence[str] = ("ts", "seq"),
    lateness: str = "1 second",
) -> DataFrame:
    """Stream form of ``visits.bounces``."""
    found = find_pattern(pages, visits.bounce_pattern(within_ms), F.col("common.mid"), order, lateness)
    return found.drop("outcome", "steps")
