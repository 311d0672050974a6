"""The registered queries: each operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.functions import records, times
from weirhouse.operators import dims, lateness, logs, orders, patterns, routing, stats, visits
from weirhouse.plans import replay as rp
from weirhouse.plans import tables as tb
from weirhouse.session import scratch_dir
from weirhouse.sources import cdc, dim_store, jdbc
from weirhouse.sources.landing import land
from weirhouse.sources.topics import TopicSpec, read_topic, write_batch
from weirhouse.streaming import jobs, state

# The tables are sparse in time, so seconds of the shop become hours here.
HOUR_MS = 3_600_000
WITHIN_MS = 6 * HOUR_MS
WINDOW = "6 hours"
NEAR_MS = 15 * times.DAY_MS
AS_OF_MS = 1_700_000_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as longs, as the comparing engine has them."""
    kinds = {T.IntegerType: "bigint", T.DecimalType: "double", T.BooleanType: "bigint"}
    to = {f.name: kinds.get(type(f.dataType)) for f in df.schema.fields}
    return df.selectExpr(*[f"CAST(`{n}` AS {kind}) AS `{n}`" if kind else f"`{n}`" for n, kind in to.items()])


def _flat_pages(rows: DataFrame, *names: str) -> DataFrame:
    """Chosen leaves of page records as plain columns."""
    where = {n: f"common.{n}" for n in schemas.COMMON_FIELDS} | {n: f"page.{n}" for n in schemas.PAGE_FIELDS}
    return rows.select(*[F.col(where.get(n, n)).alias(n) for n in names])


def _good_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.good_logs(logs.clean_logs(tb.log_lines(spark, sf_dir)))


def _fixed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good logs with the new-visitor flag corrected; landed, as that step reads them thrice."""
    return logs.correct_new_visitors(land(_good_logs(spark, sf_dir), "good-logs"))


def _bounces(pages: DataFrame) -> DataFrame:
    """Six hours' wait in hour slices: even a dominant visitor falls into many groups."""
    return visits.bounces(pages, WITHIN_MS, slice_ms=HOUR_MS)


def _dense_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with time running 3600 times slower: an hour becomes a second."""
    return tb.pages(spark, sf_dir).withColumn("ts", times.slot_of("ts", 3600))


# -- logs ---------------------------------------------------------------------


@query
def page_split(spark, sf_dir):
    pages = logs.page_logs(_fixed_logs(spark, sf_dir))
    return _flat_pages(
        pages.withColumn("shown", F.coalesce(F.size("displays"), F.lit(0)).cast("bigint")),
        "seq", "mid", "is_new", "page_id", "last_page_id", "during_time", "shown", "ts",
    )


@query
def start_split(spark, sf_dir):
    return _flat_pages(logs.start_logs(_good_logs(spark, sf_dir)), "seq", "mid", "is_new", "start", "ts")


@query
def display_explode(spark, sf_dir):
    shown = logs.display_logs(logs.page_logs(_good_logs(spark, sf_dir)), keep=["seq"])
    return shown.select("seq", *[F.col("display")[c].alias(c) for c in ("item", "order", "page_id")])


@query
def dirty_logs(spark, sf_dir):
    return logs.dirty_logs(logs.clean_logs(tb.log_lines(spark, sf_dir)))


@query
def parse_or_drop(spark, sf_dir):
    rows = records.parse_or_drop(tb.log_lines(spark, sf_dir), schemas.log_schema())
    return rows.select("common.mid", F.col("ts").cast("bigint").alias("ts"))


@query
def parse_strict(spark, sf_dir):
    lines = records.to_record(tb.order_infos(spark, sf_dir))
    return _plain(records.parse_strict(lines, schemas.ORDER_INFO))


@query
def new_visitor_fix(spark, sf_dir):
    return _flat_pages(logs.correct_new_visitors(tb.pages(spark, sf_dir)), "seq", "mid", "is_new", "ts")


@query
def split_to_topics(spark, sf_dir):
    """One pass to three topics, written and read back topic by topic."""
    fixed = _fixed_logs(spark, sf_dir)
    path = scratch_dir(spark, "split-to-topics")
    names = ("dwd_start_log", "dwd_page_log", "dwd_display_log")
    write_batch(logs.split_rows(fixed, *names), TopicSpec("logs", path=path))
    out = None
    for name in names:
        rows = read_topic(spark, TopicSpec(name, path=path, shared=True), streaming=False)
        rows = rows.select(F.lit(name).alias("topic"), "value")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def record_passthrough(spark, sf_dir):
    """Fields that no schema names, through clean, correction and split."""
    cleaned = logs.clean_logs(tb.rich_log_lines(spark, sf_dir))
    good = land(logs.good_logs(cleaned, keep_text=True), "whole-logs")
    names = ("dwd_start_log", "dwd_page_log", "dwd_display_log")
    rows = logs.split_rows(logs.correct_new_visitors(good), *names, text="value")
    leaves = {
        "mid": "common.mid", "is_new": "common.is_new", "os": "common.os", "uid": "common.uid", "ts": "ts",
        "entry": "start.entry", "loading": "start.loading", "code": "err.code", "page_item": "page.item",
        "during_time": "page.during_time", "item": "item", "x": "pos.x", "shown_on": "page_id",
        "first_x": "displays[0].pos.x", "first_on": "displays[0].page_id",
    }
    return rows.select("topic", *[F.get_json_object("value", f"$.{path}").alias(n) for n, path in leaves.items()])


# -- visits and statistics ----------------------------------------------------


@query
def entry_pages(spark, sf_dir):
    return tb.pages(spark, sf_dir).select(
        "seq",
        visits.is_entry().cast("bigint").alias("entry"),
        visits.is_entry(empty_too=False).cast("bigint").alias("session"),
    )


@query
def unique_visit_day(spark, sf_dir):
    found = visits.unique_visits(tb.pages(spark, sf_dir))
    return _flat_pages(found, "seq", "mid", "ts").withColumn("at", times.format_epoch("ts"))


@query
def unique_visit_literal(spark, sf_dir):
    return _flat_pages(visits.unique_visits(_dense_pages(spark, sf_dir), "literal"), "seq", "mid", "ts")


#: Of the slowed-down records: some gaps are longer, some shorter.
VISIT_TTL_MS = 20_000


@query
def unique_visit_literal_ttl(spark, sf_dir):
    """Open visits expire, on slowed-down records with gaps on both sides of the lifetime."""
    found = visits.unique_visits(_dense_pages(spark, sf_dir), "literal", ttl_ms=VISIT_TTL_MS)
    return _flat_pages(found, "seq", "mid", "ts")


@query
def pattern_bounce(spark, sf_dir):
    """Bounces as a declared pattern, with how they came about."""
    pages = tb.pages(spark, sf_dir)
    found = patterns.find_pattern(pages, visits.bounce_pattern(WITHIN_MS), F.col("common.mid"), slice_ms=HOUR_MS)
    return _plain(_flat_pages(found, "seq", "mid", "ts", "outcome", "steps"))


def _buying() -> patterns.Pattern:
    """A view, right after it a click, right after it a purchase, within two days."""
    on = lambda name: F.col("page.page_id") == name
    return patterns.Pattern.begin("seen", on("view")).next("chosen", on("click")).next("bought", on("purchase")).within(2 * times.DAY_MS)


@query
def pattern_three_steps(spark, sf_dir):
    found = patterns.find_pattern(tb.pages(spark, sf_dir), _buying(), F.col("common.mid"), slice_ms=6 * HOUR_MS)
    return _plain(_flat_pages(found, "seq", "mid", "ts", "outcome", "steps"))


#: How far the watermark stays behind.
LATENESS_MS = 2 * times.DAY_MS


@query
def late_rows(spark, sf_dir):
    """The rows that a watermark of two days drops, and the watermark they met."""
    _, late = lateness.split_late(tb.arrivals(spark, sf_dir), "step", LATENESS_MS, HOUR_MS, slice_size=8)
    return _flat_pages(late, "seq", "mid", "ts", "step", "watermark")


@query
def late_windows(spark, sf_dir):
    """Page windows without the late rows."""
    kept, _ = lateness.split_late(tb.arrivals(spark, sf_dir), "step", LATENESS_MS, HOUR_MS, slice_size=8)
    return stats.windowed(stats.page_measures(kept), "1 hour", dims=["ch"])


@query
def bounce(spark, sf_dir):
    return _flat_pages(_bounces(tb.pages(spark, sf_dir)), "seq", "mid", "ts")


@query
def bounce_ten_seconds(spark, sf_dir):
    return _flat_pages(visits.bounces(tb.pages(spark, sf_dir)), "seq", "mid", "ts")


@query
def visitor_measures(spark, sf_dir):
    pages = tb.pages(spark, sf_dir)
    return stats.union_measures(pages, visits.unique_visits(pages), _bounces(pages))


@query
def page_windows(spark, sf_dir):
    return stats.windowed(stats.page_measures(tb.pages(spark, sf_dir)), "1 hour", dims=["ch"])


@query
def visitor_stats(spark, sf_dir):
    return stats.visitor_stats(tb.pages(spark, sf_dir), WINDOW, WITHIN_MS, slice_ms=HOUR_MS)


@query
def visitor_stats_from_logs(spark, sf_dir):
    """The whole way: raw lines, clean, correct, split, measure, window."""
    pages = land(logs.page_logs(_fixed_logs(spark, sf_dir)), "page-logs")
    return stats.visitor_stats(pages, WINDOW, WITHIN_MS, slice_ms=HOUR_MS)


@query
def stats_sink_rows(spark, sf_dir):
    return jdbc.sink_rows(visitor_stats(spark, sf_dir), schemas.VISITOR_STATS, exclude=["ts"])


# -- orders and payments ------------------------------------------------------


@query
def time_format(spark, sf_dir):
    text = times.format_epoch("ts")
    return tb.pages(spark, sf_dir).select(
        "seq",
        text.alias("from_millis"),
        times.format_epoch(times.slot_of("ts", 1000).cast("string")).alias("from_seconds"),
        times.parse_time(text).alias("ms"),
    )


@query
def order_times(spark, sf_dir):
    infos = orders.order_infos(tb.order_infos(spark, sf_dir))
    return infos.select("id", "create_date", "create_hour", "create_ts")


@query
def date_parts(spark, sf_dir):
    return tb.payment_infos(spark, sf_dir).select(
        "id",
        times.create_date("create_time").alias("create_date"),
        times.create_hour("create_time").alias("create_hour"),
    )


@query
def user_age(spark, sf_dir):
    users = tb.dims(spark, sf_dir)["dim_user_info"]
    return users.select("ID", times.age_years("BIRTHDAY", AS_OF_MS).cast("bigint").alias("age"))


@query
def record_json(spark, sf_dir):
    return records.to_record(
        _flat_pages(tb.pages(spark, sf_dir), "mid", "page_id", "last_page_id", "during_time", "ts")
    )


def _joined_details(spark, sf_dir):
    return orders.join_order_details(
        tb.order_infos(spark, sf_dir), tb.order_details(spark, sf_dir), -NEAR_MS, NEAR_MS
    )


@query
def order_wide_interval(spark, sf_dir):
    wide = _joined_details(spark, sf_dir)
    return _plain(wide.select(*schemas.ORDER_WIDE.names[:23]))


@query
def dim_enrich(spark, sf_dir):
    """All six lookups on every order line, the order's date left aside."""
    facts = tb.order_details(spark, sf_dir).select("id", "order_id", "sku_id").join(
        tb.order_infos(spark, sf_dir).select(F.col("id").alias("order_id"), "user_id", "province_id"), "order_id"
    )
    return _plain(dims.lookup_all(facts, tb.dims(spark, sf_dir), dims.order_dims(AS_OF_MS)))


def _order_wide(spark, sf_dir):
    return dims.lookup_all(
        _joined_details(spark, sf_dir), tb.dims(spark, sf_dir), dims.order_dims(AS_OF_MS)
    )


@query
def order_wide(spark, sf_dir):
    return _plain(_order_wide(spark, sf_dir))


@query
def payment_wide(spark, sf_dir):
    return _plain(orders.payment_wide(tb.payment_infos(spark, sf_dir), _order_wide(spark, sf_dir)))


@query
def payment_orders(spark, sf_dir):
    """The second join's own bounds on whole orders, one line per order."""
    infos = orders.order_infos(tb.order_infos(spark, sf_dir)).select(
        F.col("id").alias("order_id"), "user_id", "total_amount", "create_time"
    )
    both = orders.payment_wide(tb.payment_infos(spark, sf_dir), infos)
    return _plain(both.select("payment_id", "order_id", "total_amount", "payment_create_time", "order_create_time"))


# -- changes, rules, dimension tables -------------------------------------------


def _changes(spark, sf_dir):
    return cdc.normalize_cdc(tb.change_messages(spark, sf_dir))


@query
def cdc_normalize(spark, sf_dir):
    maps = {m: F.to_json(m) for m in ("data", "before")}
    return _changes(spark, sf_dir).withColumns(maps)


def _typed_changes(spark, sf_dir):
    """Typed messages through the change topic: to envelopes, to text and back."""
    sent = cdc.normalize_cdc(tb.typed_change_messages(spark, sf_dir)).select(*schemas.CHANGE.names)
    return cdc.parse_changes(records.to_record(sent))


@query
def cdc_typed_cells(spark, sf_dir):
    """Routed data keeps numbers, nested values and text as they were sent."""
    rules = tb.rules(spark).withColumn("sinkColumns", F.lit("id,price,price_text,open,more"))
    return routing.topic_rows(routing.attach_rules(_typed_changes(spark, sf_dir), rules))


@query
def cdc_types(spark, sf_dir):
    """The types that a table's cells have in common; digits of decimals left aside."""
    types = cdc.column_types(_typed_changes(spark, sf_dir))
    return types.select("tableName", "column", F.regexp_replace("type", r"\(\d+,\d+\)", "").alias("type"))


@query
def cdc_drop_empty(spark, sf_dir):
    return routing.drop_empty(_changes(spark, sf_dir)).select("tableName", "type", "seq")


def _routed(spark, sf_dir):
    return routing.attach_rules(routing.drop_empty(_changes(spark, sf_dir)), tb.rules(spark))


@query
def cdc_route(spark, sf_dir):
    return routing.topic_rows(_routed(spark, sf_dir))


@query
def cdc_route_store(spark, sf_dir):
    return routing.store_rows(_routed(spark, sf_dir)).select(
        "sinkTable", "sinkPk", "type", F.to_json("data").alias("data")
    )


@query
def cdc_unrouted(spark, sf_dir):
    return routing.unrouted(routing.drop_empty(_changes(spark, sf_dir)), tb.rules(spark))


#: Arrival numbers per slice of the as-of join.
ARRIVALS = 256


def _rule_history(spark, sf_dir):
    return routing.rule_changes(cdc.normalize_cdc(tb.rule_history_messages(spark, sf_dir)), ["seq"])


@query
def cdc_route_as_of(spark, sf_dir):
    """Changes and rule messages in one order of arrival: each change by the rule in force then."""
    changes = routing.drop_empty(_changes(spark, sf_dir))
    routed = routing.attach_rules_as_of(changes, _rule_history(spark, sf_dir), "seq", ARRIVALS)
    return routed.select("tableName", "type", "seq", "sinkType", "sinkTable", F.to_json("data").alias("data"))


@query
def cdc_unrouted_as_of(spark, sf_dir):
    """How many changes of each kind came while no rule was in force for them."""
    changes = routing.drop_empty(_changes(spark, sf_dir))
    routed = routing.attach_rules_as_of(changes, _rule_history(spark, sf_dir), "seq", ARRIVALS, how="left")
    return routed.filter("sinkTable IS NULL").groupBy("tableName", "type").agg(F.count("*").alias("changes"))


@query
def rule_upkeep(spark, sf_dir):
    changes = cdc.normalize_cdc(tb.rule_messages(spark, sf_dir))
    rules = routing.latest_rules(routing.rule_changes(changes, ["seq"]), ["seq"])
    return rules.select("sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns")


USER_TABLE = dim_store.DimTable("dim_user_info", ("id", "name", "last_order", "urgent"))


@query
def dim_upsert(spark, sf_dir):
    return dim_store.merge(
        tb.user_changes(spark, sf_dir), USER_TABLE, ["seq"], tb.user_rows(spark, sf_dir)
    )


@query
def dim_upsert_store(spark, sf_dir):
    """The same through the store: rows first, then the changes in two batches."""
    root = scratch_dir(spark, "dim-store")
    first = tb.user_rows(spark, sf_dir).select(
        F.map_filter(
            F.create_map(*[x for c in USER_TABLE.columns for x in (F.lit(c), F.col(c))]),
            lambda k, v: v.isNotNull(),
        ).alias("data"),
        F.lit(-1).cast("bigint").alias("seq"),
    )
    changes = tb.user_changes(spark, sf_dir)
    middle = changes.agg(F.percentile_approx("seq", 0.5)).first()[0]
    batches = [first, changes.filter(F.col("seq") <= middle), changes.filter(F.col("seq") > middle)]
    for n, rows in enumerate(batches):
        dim_store.upsert(rows.withColumn("sinkTable", F.lit(USER_TABLE.name)), root, [USER_TABLE], n, ["seq"])
    return dim_store.read(spark, root, USER_TABLE)


@query
def dim_tables_of_rules(spark, sf_dir):
    """Catalog tables that follow two deliveries of rule messages: columns and keys as they end up."""
    changes = cdc.normalize_cdc(tb.store_rule_messages(spark, sf_dir))
    history = land(routing.rule_changes(changes, ["seq"]), "store-rules")
    middle = history.agg(F.percentile_approx("seq", 0.5)).first()[0]
    root = scratch_dir(spark, "dim-tables")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}-database'")
    try:
        for known in (history.where(F.col("seq") <= middle), history):
            dim_store.follow_rules(spark, dim_store.store_tables(known, ["seq"]).values(), database, root)
        rows = []
        for name in [t.name for t in spark.catalog.listTables(database)]:
            key = spark.sql(f"SHOW TBLPROPERTIES {database}.{name} ('weirhouse.pk')").first()["value"]
            names = [c for c in spark.table(f"{database}.{name}").columns if c != dim_store.BUCKET]
            rows += [(name, c, i, c == key) for i, c in enumerate(names)]
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return _plain(spark.createDataFrame(rows, "table_name string, column_name string, place bigint, is_key boolean"))


@query
def camel_names(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return records.rename_lower_camel(records.as_strings(rows))


# -- the same on streams ----------------------------------------------------------


@query
def stream_new_visitor_fix(spark, sf_dir):
    state.use_rocksdb(spark)
    out = rp.replay_pages(spark, "new-visitor", tb.pages(spark, sf_dir), state.correct_new_visitors)
    return _flat_pages(out, "seq", "mid", "is_new", "ts")


@query
def stream_unique_visit_day(spark, sf_dir):
    state.use_rocksdb(spark)
    out = rp.replay_pages(spark, "unique-day", tb.pages(spark, sf_dir), state.first_visits_of_day)
    return _flat_pages(out, "seq", "mid", "ts").withColumn("at", times.format_epoch("ts"))


@query
def stream_unique_visit_literal(spark, sf_dir):
    """With an expiry so long that it never comes, as the batch form has none."""
    state.use_rocksdb(spark)
    out = rp.replay_pages(
        spark,
        "unique-literal",
        _dense_pages(spark, sf_dir),
        lambda pages: state.literal_visits(pages, ttl_ms=365 * times.DAY_MS),
    )
    return _flat_pages(out, "seq", "mid", "ts")


@query
def stream_unique_visit_literal_ttl(spark, sf_dir):
    """With a lifetime that ends many visits."""
    state.use_rocksdb(spark)
    out = rp.replay_pages(
        spark,
        "unique-literal-ttl",
        _dense_pages(spark, sf_dir),
        lambda pages: state.literal_visits(pages, ttl_ms=VISIT_TTL_MS),
    )
    return _flat_pages(out, "seq", "mid", "ts")


@query
def stream_pattern_three_steps(spark, sf_dir):
    state.use_rocksdb(spark)
    find = lambda pages: state.find_pattern(pages, _buying(), F.col("common.mid"))
    out = rp.replay_pages(spark, "three-steps", tb.pages(spark, sf_dir), find)
    return _plain(_flat_pages(out, "seq", "mid", "ts", "outcome", "steps"))


@query
def stream_late_windows(spark, sf_dir):
    """Deliveries one after the other, each with late rows: what the watermark lets through."""
    total = tb.table(spark, sf_dir, "events").count()
    rows = tb.arrivals(spark, sf_dir, total // 3, 3)
    pages = rows.drop("step")
    steps = [r["step"] for r in rows.select("step").distinct().orderBy("step").collect()]  # six at most
    replay = rp.Replay(spark, "late-windows")
    slices = rp.with_sentinel([{"pages": rows.filter(F.col("step") == n).drop("step")} for n in steps], pages)

    def start():
        measures = stats.page_measures(replay.source("pages", pages))
        return [replay.store(stats.windowed(measures, "1 hour", dims=["ch"], lateness="2 days"), "out")]

    rp.run_slices(replay, slices, start)
    return spark.read.parquet(replay.path("out"))


@query
def stream_visitor_chain(spark, sf_dir):
    """From the page topic alone: unique visits and bounces to topics, all three to window sums."""
    state.use_rocksdb(spark)
    pages = tb.pages(spark, sf_dir)
    replay = rp.Replay(spark, "visitor-chain")
    parts = rp.time_slices({"pages": (pages, "ts")}, 2)
    parts[-1] = {"pages": parts[-1]["pages"].unionByName(rp.sentinel_pair(pages))}
    topic = {n: TopicSpec(n, path=replay.path(n)) for n in ("pages", "unique", "bounced")}
    checkpoint = lambda n: replay.path(f"{n}-checkpoint")

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{replay.path('out')}/batch={batch_id}")

    def start():
        yield jobs.find_unique_visits(spark, topic["pages"], topic["unique"], checkpoint("unique"), trigger=rp.NOW)
        yield jobs.find_bounces(spark, topic["pages"], topic["bounced"], checkpoint("bounced"), WITHIN_MS, trigger=rp.NOW)
        yield jobs.count_visitors(
            spark, *topic.values(), write, checkpoint("stats"), WINDOW, bounce_lateness="7 hours", trigger=rp.NOW
        )

    rp.run_slices(replay, [{"pages": records.to_record(p["pages"])} for p in parts], start)
    return spark.read.parquet(replay.path("out")).drop("batch")


@query
def stream_bounce(spark, sf_dir):
    state.use_rocksdb(spark)
    out = rp.replay_pages(
        spark, "bounce", tb.pages(spark, sf_dir), lambda pages: state.bounces(pages, WITHIN_MS)
    )
    return _flat_pages(out, "seq", "mid", "ts")


@query
def stream_visitor_stats(spark, sf_dir):
    """Three streams, united and counted per window."""
    pages = tb.pages(spark, sf_dir)
    inputs = {
        "pages": pages,
        "unique": visits.unique_visits(pages),
        "bounced": _bounces(pages),
    }
    replay = rp.Replay(spark, "visitor-stats")
    slices = rp.with_sentinel(rp.time_slices({n: (df, "ts") for n, df in inputs.items()}, 2), pages)

    def start():
        rows = stats.union_measures(*[replay.source(n, pages) for n in inputs])
        return [replay.store(stats.windowed(rows, WINDOW), "out")]

    rp.run_slices(replay, slices, start)
    return spark.read.parquet(replay.path("out"))


def _feed_slices(inputs, count=2):
    """Typed rows to JSON topic text, cut at common times of their ``create_time``."""
    timed = {n: df.withColumn("_ms", times.parse_time("create_time")) for n, df in inputs.items()}
    slices = rp.time_slices({n: (df, "_ms") for n, df in timed.items()}, count)
    return [{n: records.to_record(df.drop("_ms")) for n, df in part.items()} for part in slices]


@query
def stream_order_wide(spark, sf_dir):
    """The order job on topics, with the dimension tables read per batch."""
    replay = rp.Replay(spark, "order-wide")
    slices = _feed_slices({"orders": tb.order_infos(spark, sf_dir), "details": tb.order_details(spark, sf_dir)})
    sink = TopicSpec("dwm_order_wide", path=replay.path("out"))

    def start():
        yield jobs.widen_orders(
            spark,
            TopicSpec("dwd_order_info", path=replay.path("orders")),
            TopicSpec("dwd_order_detail", path=replay.path("details")),
            lambda: tb.dims(spark, sf_dir),
            sink,
            replay.path("checkpoint"),
            -NEAR_MS,
            NEAR_MS,
            now_ms=lambda: AS_OF_MS,
            trigger=rp.NOW,
        )

    rp.run_slices(replay, slices, start, stateful=False)
    return _plain(records.parse_strict(read_topic(spark, sink, streaming=False), schemas.ORDER_WIDE))


@query
def stream_payment_wide(spark, sf_dir):
    replay = rp.Replay(spark, "payment-wide")
    slices = _feed_slices({"payments": tb.payment_infos(spark, sf_dir), "wide": _order_wide(spark, sf_dir)})
    sink = TopicSpec("dwm_payment_wide", path=replay.path("out"))

    def start():
        yield jobs.widen_payments(
            spark,
            TopicSpec("dwd_payment_info", path=replay.path("payments")),
            TopicSpec("dwm_order_wide", path=replay.path("wide")),
            sink,
            replay.path("checkpoint"),
            trigger=rp.NOW,
        )

    rp.run_slices(replay, slices, start)
    return _plain(records.parse_strict(read_topic(spark, sink, streaming=False), schemas.PAYMENT_WIDE))


def _synced_changes(spark, sf_dir, name):
    """Change messages through the sync and routing jobs; the replay with their output."""
    replay = rp.Replay(spark, name)
    messages = tb.change_messages(spark, sf_dir).select("topic", "value")
    changes = TopicSpec("ods_base_db", path=replay.path("changes"))
    facts = TopicSpec("facts", path=replay.path("facts"))

    def start():
        yield jobs.sync_changes(
            replay.source("messages", messages), changes, replay.path("sync-checkpoint"), rp.NOW
        )
        yield jobs.route_changes(
            spark,
            changes,
            lambda: tb.rules(spark),
            facts,
            replay.path("store"),
            replay.path("route-checkpoint"),
            rp.NOW,
        )

    rp.run_slices(replay, [{"messages": messages}], start)
    return replay


@query
def stream_cdc_route(spark, sf_dir):
    replay = _synced_changes(spark, sf_dir, "cdc-route")
    out = None
    for name in [sink for _, _, kind, sink, _ in tb.RULES if kind == routing.SINK_TOPIC]:
        rows = read_topic(spark, TopicSpec(name, path=replay.path("facts"), shared=True), streaming=False)
        rows = rows.select(F.lit(name).alias("topic"), "value")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def stream_dim_upsert(spark, sf_dir):
    """The dimension table the routing job filled."""
    replay = _synced_changes(spark, sf_dir, "cdc-store")
    rule = next(r for r in tb.rules(spark).collect() if r["sinkType"] == routing.SINK_STORE)
    return dim_store.read(spark, replay.path("store"), dim_store.DimTable.of_rule(rule))
