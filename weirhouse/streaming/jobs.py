"""The warehouse's jobs as streaming queries.

Each function starts one query and returns it.  ``checkpoint`` is a folder of
its own per job; ``trigger`` holds the keyword of ``DataStreamWriter.trigger``.
Every stage reads and writes topics, so the jobs run, fail and restart alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirhouse import schemas
from weirhouse.functions import records
from weirhouse.operators import dims as dim_ops
from weirhouse.operators import logs as log_ops
from weirhouse.operators import orders, routing, stats
from weirhouse.sources import cdc, dim_store
from weirhouse.sources.topics import ARRIVAL, TopicSpec, read_topic, write_batch, write_topic
from weirhouse.streaming import open_rows, state

ORDER = ("ts", *ARRIVAL)
EVERY = {"processingTime": "10 seconds"}
RULE_ORDER = ("arrived", *ARRIVAL)
#: Changes of one table and operation that arrive within this time are joined with rules by one task.
ARRIVAL_SLICE_MS = 10_000


def sync_changes(
    messages: DataFrame, sink: TopicSpec, checkpoint: str, trigger: Mapping = EVERY
) -> StreamingQuery:
    """Connector messages (``topic``, ``value``) to envelopes in one topic."""
    envelopes = cdc.normalize_cdc(messages).select(*schemas.CHANGE.names)
    return write_topic(records.to_record(envelopes), sink, checkpoint).trigger(**trigger).start()


def split_logs(
    spark: SparkSession,
    source: TopicSpec,
    sink: TopicSpec,
    checkpoint: str,
    start: str = "dwd_start_log",
    page: str = "dwd_page_log",
    display: str = "dwd_display_log",
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Raw lines to start, page and display topics, with the new-visitor flag corrected."""
    state.use_rocksdb(spark)
    good = log_ops.good_logs(log_ops.clean_logs(read_topic(spark, source)), keep_text=True)
    fixed = state.correct_new_visitors(good, ORDER)
    rows = log_ops.split_rows(fixed, start, page, display, text="value")
    return write_topic(rows, sink, checkpoint).trigger(**trigger).start()


def keep_dirty_logs(
    spark: SparkSession, source: TopicSpec, sink: TopicSpec, checkpoint: str, trigger: Mapping = EVERY
) -> StreamingQuery:
    """The raw text of dirty lines."""
    dirty = log_ops.dirty_logs(log_ops.clean_logs(read_topic(spark, source)))
    return write_topic(dirty, sink, checkpoint).trigger(**trigger).start()


def rule_history_of_topic(spark: SparkSession, source: TopicSpec) -> DataFrame:
    """Every rule ever written to a topic of change envelopes of the rule table, with its arrival."""
    changes = cdc.parse_changes(read_topic(spark, source, streaming=False))
    return routing.rule_changes(changes, RULE_ORDER)


def rules_of_topic(spark: SparkSession, source: TopicSpec) -> DataFrame:
    """The rules in force, from a topic of change envelopes of the rule table."""
    return routing.latest_rules(rule_history_of_topic(spark, source), RULE_ORDER)


def route_changes(
    spark: SparkSession,
    source: TopicSpec,
    rules: Callable[[], DataFrame],
    facts: TopicSpec,
    store: str,
    checkpoint: str,
    trigger: Mapping = EVERY,
    as_of: bool = False,
    database: str | None = None,
) -> StreamingQuery:
    """Envelopes to fact topics and to the dimension store.

    ``rules`` is called once per batch.  With ``as_of`` it gives the history of rules
    (``rule_history_of_topic``) and a change goes by the rule that was in force when it arrived, however
    batches fall; else it gives one rule per table and operation, which applies to the whole batch.
    Changes that came before their rule are dropped.  With ``database``, tables of that name in the
    catalog follow the rules: a rule for the store creates its table or widens it, rows or none.
    """
    changes = routing.drop_empty(cdc.parse_changes(read_topic(spark, source)))

    def batch(rows: DataFrame, batch_id: int) -> None:
        known = rules().persist()
        if as_of:
            routed = routing.attach_rules_as_of(rows, known, "arrived", ARRIVAL_SLICE_MS, ARRIVAL)
        else:
            routed = routing.attach_rules(rows, known)
        routed = routed.persist()
        try:
            write_batch(routing.topic_rows(routed), facts, batch_id)
            tables = dim_store.store_tables(routing.store_rows(known), RULE_ORDER if as_of else ()).values()
            if database:
                dim_store.follow_rules(spark, tables, database, store)
            touched = dim_store.upsert(routing.store_rows(routed), store, tables, batch_id, ARRIVAL)
            if database:
                dim_store.show_new_buckets(spark, touched, database)
        finally:
            routed.unpersist()
            known.unpersist()

    return (
        changes.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def count_unrouted(
    spark: SparkSession,
    source: TopicSpec,
    rules: Callable[[], DataFrame],
    sink: TopicSpec,
    checkpoint: str,
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Counts, per batch, of the changes that ``route_changes`` gives no place."""
    changes = routing.drop_empty(cdc.parse_changes(read_topic(spark, source)))

    def batch(rows: DataFrame, batch_id: int) -> None:
        write_batch(records.to_record(routing.unrouted(rows, rules())), sink, batch_id)

    return (
        changes.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _pages(spark: SparkSession, source: TopicSpec) -> DataFrame:
    rows = records.parse_object(read_topic(spark, source), schemas.page_schema()).filter("record_ok")
    return rows.select("record.*", "value", *ARRIVAL)  # the text goes on whole


def find_unique_visits(
    spark: SparkSession,
    pages: TopicSpec,
    sink: TopicSpec,
    checkpoint: str,
    mode: str = "day",
    lateness: str = "1 day",
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    state.use_rocksdb(spark)
    find = {"day": state.first_visits_of_day, "literal": state.literal_visits}[mode]
    found = find(_pages(spark, pages), order=ORDER, lateness=lateness)
    return write_topic(found.select("value"), sink, checkpoint).trigger(**trigger).start()


def find_bounces(
    spark: SparkSession,
    pages: TopicSpec,
    sink: TopicSpec,
    checkpoint: str,
    within_ms: int = 10_000,
    lateness: str = "1 second",
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    state.use_rocksdb(spark)
    found = state.bounces(_pages(spark, pages), within_ms, ORDER, lateness)
    return write_topic(found.select("value"), sink, checkpoint).trigger(**trigger).start()


def widen_orders(
    spark: SparkSession,
    order_topic: TopicSpec,
    detail_topic: TopicSpec,
    dims: Callable[[], Mapping[str, DataFrame]],
    sink: TopicSpec,
    checkpoint: str,
    lower_ms: int = -5_000,
    upper_ms: int = 5_000,
    now_ms: Callable[[], int] = lambda: int(time.time() * 1000),
    lateness: str = "0 seconds",
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Orders with details and the dimensions as they are when a batch runs.

    A batch is joined with the rows that earlier ones left open (``open_rows``), which lie on disk, so
    the executors' memory bounds neither a batch nor what is open.
    """
    side = lambda name, spec: read_topic(spark, spec).select(F.lit(name).alias("side"), "value")
    texts = side("orders", order_topic).unionByName(side("details", detail_topic))
    reach = {"orders": upper_ms, "details": -lower_ms}
    kept = open_rows.OpenRows(spark, f"{checkpoint.rstrip('/')}/open-rows", reach, "create_ts", lateness)

    def batch(rows: DataFrame, batch_id: int) -> None:
        of = lambda name, schema: records.parse_strict(rows.filter(F.col("side") == name), schema)
        infos = orders.order_infos(of("orders", schemas.ORDER_INFO))
        details = orders.order_details(of("details", schemas.ORDER_DETAIL))
        now = kept.begin({"orders": infos, "details": details}, batch_id)
        joined = orders.join_timed(now.rows["orders"], now.rows["details"], lower_ms, upper_ms, met=open_rows.KEPT)
        wide = dim_ops.lookup_all(joined, dims(), dim_ops.order_dims(now_ms()))
        write_batch(records.to_record(wide), sink, batch_id)
        now.end()

    return (
        texts.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def widen_payments(
    spark: SparkSession,
    payment_topic: TopicSpec,
    wide_topic: TopicSpec,
    sink: TopicSpec,
    checkpoint: str,
    lower_ms: int = -15 * 60_000,
    upper_ms: int = 5_000,
    lateness: str = "0 seconds",
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    payments = records.parse_strict(read_topic(spark, payment_topic), schemas.PAYMENT_INFO)
    wide = records.parse_strict(read_topic(spark, wide_topic), schemas.ORDER_WIDE)
    joined = orders.payment_wide(payments, wide, lower_ms, upper_ms, lateness)
    return write_topic(records.to_record(joined), sink, checkpoint).trigger(**trigger).start()


def count_visitors(
    spark: SparkSession,
    pages: TopicSpec,
    unique: TopicSpec,
    bounced: TopicSpec,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    size: str = "10 seconds",
    lateness: str = "10 seconds",
    bounce_lateness: str | None = None,
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Window statistics; ``write`` stores a batch, as with ``jdbc.write_jdbc``.

    Windows close by the newest record of any topic.  With ``bounce_lateness`` (the bounce time and
    ``lateness`` together) each topic has a watermark of its own and the slowest one closes windows: then
    bounces, which are known only when their time is over, always count, but a topic that falls silent
    holds windows open.
    """
    strict = lambda spec: records.parse_strict(read_topic(spark, spec), schemas.page_schema())
    if bounce_lateness is None:
        rows = stats.union_measures(strict(pages), strict(unique), strict(bounced))
    else:
        rows = (
            stats.watermarked(stats.unique_visit_measures(strict(unique)), lateness)
            .unionByName(stats.watermarked(stats.bounce_measures(strict(bounced)), bounce_lateness))
            .unionByName(stats.watermarked(stats.page_measures(strict(pages)), lateness))
        )
    return (
        stats.windowed(rows, size, lateness=lateness)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

