"""Streams: state over batches and restarts, late rows, and the jobs end to end."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import PAGES, page, pages
from test_visits import T0, brute_bounces, brute_literal, random_pages
from weirhouse import schemas
from weirhouse.functions import records, times
from weirhouse.operators import logs, patterns, stats
from weirhouse.operators.interval_join import interval_join
from weirhouse.operators.patterns import Pattern
from weirhouse.sources import dim_store
from weirhouse.sources.topics import TopicSpec, read_topic
from weirhouse.streaming import jobs, state

NOW = {"availableNow": True}
SECOND = 1000


class Feed:
    """Batches of page rows into a stream; every batch restarts the query."""

    def __init__(self, spark, tmp_path, operator):
        state.use_rocksdb(spark)
        self.spark, self.root, self.operator = spark, str(tmp_path), operator

    def __call__(self, *rows):
        pages(self.spark, list(rows)).write.mode("append").parquet(f"{self.root}/in")
        source = self.spark.readStream.schema(PAGES).parquet(f"{self.root}/in")
        query = (
            self.operator(source)
            .writeStream.option("checkpointLocation", f"{self.root}/ck")
            .trigger(**NOW)
            .format("parquet")
            .option("path", f"{self.root}/out")
            .start()
        )
        query.awaitTermination()
        return self

    @property
    def out(self):
        return self.spark.read.parquet(f"{self.root}/out")

    def seqs(self):
        return sorted(r["seq"] for r in self.out.collect())


def test_new_visitor_state_survives_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path, state.correct_new_visitors)
    feed(page("a", 5, 1, is_new="1", displays=[{"k": "v", "n": None}]), page("a", 4, 2, is_new="1"), page("b", 1, 3))
    feed(page("a", 9, 4, is_new="1"), page("b", 2, 5, is_new="1"), page("b", 3, 6, is_new=None))
    flags = {r["seq"]: r["common"]["is_new"] for r in feed.out.collect()}
    assert flags == {1: "0", 2: "1", 3: "0", 4: "0", 5: "1", 6: None}
    row = feed.out.filter("seq = 1").first()
    assert row["displays"] == [{"k": "v", "n": None}] and row["page"]["during_time"] == 1 and row["ts"] == 5


def test_first_visit_of_day_over_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, state.first_visits_of_day)
    day = times.DAY_MS
    start = 18_000 * day - times.ZONE_MS
    feed(page("a", start + 9, 1), page("a", start + 5, 2), page("b", start, 3))
    feed(page("a", start + 10, 4), page("a", start + day, 5))
    # four days later the state of the first day is gone, and its rows are late
    feed(page("a", start + 4 * day, 6))
    feed(page("a", start + 20, 7), page("a", start + 4 * day + 1, 8))
    assert feed.seqs() == [2, 3, 5, 6]


def test_literal_visits_and_their_expiry(spark, tmp_path):
    rows = random_pages(5, span=60_000)
    rows.sort(key=lambda r: (r[3], r[4]))
    feed = Feed(spark, tmp_path / "a", lambda p: state.literal_visits(p, lateness="1 second"))
    feed(*rows[:200])
    feed(*rows[200:])
    assert feed.seqs() == brute_literal(rows)

    feed = Feed(spark, tmp_path / "b", lambda p: state.literal_visits(p, ttl_ms=10 * SECOND, lateness="1 second"))
    feed(page("a", T0, 1, ""), page("a", T0 + 1, 2), page("a", T0 + 5 * SECOND, 3), page("a", T0 + 5 * SECOND, 4))
    # ten seconds after the entry page the state is gone: 5 opens a visit, 6 falls in its second
    feed(page("a", T0 + 10 * SECOND, 5), page("a", T0 + 10 * SECOND + 1, 6), page("a", T0 + 12 * SECOND, 7))
    assert feed.seqs() == [1, 3, 4, 5, 7]


def test_bounces_wait_for_the_watermark(spark, tmp_path):
    rows = random_pages(6, n=300)
    rows.sort(key=lambda r: r[3])
    feed = Feed(spark, tmp_path, state.bounces)
    cut = T0 + 100_000
    feed(*[r for r in rows if r[3] < cut])
    early = feed.seqs()
    feed(*[r for r in rows if r[3] >= cut], page("end", T0 + 10**7, 10**6))
    assert feed.seqs() == brute_bounces(rows, 10_000)
    assert set(early) <= set(feed.seqs())


def test_bounces_in_any_order_and_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda p: state.bounces(p, lateness="60 seconds"))
    feed(page("a", T0 + 9_999, 2, "x"), page("b", T0 + 10_000, 3, "x"), page("c", T0, 4, ""))
    feed(page("a", T0, 1, ""), page("b", T0, 5, ""))  # earlier pages that come later
    assert feed.seqs() == []
    feed(page("end", T0 + 10**6, 9))
    assert feed.seqs() == [4, 5]
    feed(page("a", T0 + 1, 6, ""))  # far behind the watermark: dropped
    feed(page("end", T0 + 10**7, 10))
    assert feed.seqs() == [4, 5]


def test_window_statistics_drop_late_rows(spark, tmp_path):
    t = T0 - T0 % 10_000
    feed = Feed(spark, tmp_path, lambda p: stats.windowed(stats.page_measures(p)))
    feed(page("a", t, 1), page("a", t + 9_999, 2))
    feed(page("a", t + 19_000, 3))  # watermark t + 9 s: the first window is open
    feed(page("a", t + 5, 4), page("a", t + 30_000, 5))
    feed(page("a", t + 6, 6), page("a", t + 90_000, 7))  # 6 is late
    out = {r["stt"]: r["pv_ct"] for r in feed.out.collect()}
    first = {k: v for k, v in sorted(out.items())}
    assert list(first.values()) == [3, 1, 1]


def test_interval_join_drops_old_state(spark, tmp_path):
    """The time condition and the watermarks together clear the join's state."""

    def write(n, ms):
        for side in "lr":
            spark.createDataFrame([("k", m) for m in ms], f"{side}k string, {side}ms bigint").write.mode(
                "append"
            ).parquet(f"{tmp_path}/{side}")

    def run():
        src = lambda s: spark.readStream.schema(f"{s}k string, {s}ms bigint").parquet(f"{tmp_path}/{s}").withColumn(
            f"{s}t", times.event_time(f"{s}ms"))
        q = (
            interval_join(src("l"), src("r"), "lk", "rk", "lt", "rt", -5_000, 5_000)
            .writeStream.option("checkpointLocation", f"{tmp_path}/ck").trigger(**NOW)
            .format("parquet").option("path", f"{tmp_path}/out").start()
        )
        q.awaitTermination()
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    write(0, [T0, T0 + 5_000, T0 + 5_001])
    run()
    write(1, [T0 + 10**6])
    left = run()
    assert left <= 4  # only the rows of the last batch
    got = spark.read.parquet(f"{tmp_path}/out").filter(F.col("lms") < T0 + 10**6)
    assert sorted((r["lms"] - T0, r["rms"] - T0) for r in got.collect()) == [
        (0, 0), (0, 5_000), (5_000, 0), (5_000, 5_000), (5_000, 5_001), (5_001, 5_000), (5_001, 5_001)]


def feed_topic(spark, spec, *texts):
    rows = spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")
    rows.write.mode("append").parquet(spec.path)


def run(query):
    query.awaitTermination()


def test_log_jobs_end_to_end(spark, tmp_path):
    """Lines to visitor statistics over five jobs, against the batch operators."""
    at = lambda name: TopicSpec(name, path=str(tmp_path / name))
    ck = lambda name: str(tmp_path / f"ck-{name}")
    raw, split, dirty, uv, uj = at("ods_base_log"), at("dwd"), at("dirty"), at("uv"), at("uj")
    page_topic = TopicSpec("dwd_page_log", path=split.path, shared=True)
    texts = [
        {"common": r[0], "page": r[1], "ts": r[3], "displays": [{"item": str(r[4])}] if r[4] % 5 == 0 else None}
        for r in sorted(random_pages(8, n=200, span=10**6), key=lambda r: r[3])
    ]
    start = {"common": {"mid": "m0", "is_new": "1"}, "start": {"entry": "icon"}, "ts": T0}
    end = {"common": {"mid": "end"}, "page": {"page_id": "p", "last_page_id": "x"}, "ts": T0 + 10**8}
    stored = str(tmp_path / "stats")
    for part in ([start, *texts[:100], "broken {"], [*texts[100:], end]):
        feed_topic(spark, raw, *part)
        run(jobs.split_logs(spark, raw, split, ck("split"), trigger=NOW))
        run(jobs.keep_dirty_logs(spark, raw, dirty, ck("dirty"), trigger=NOW))
        run(jobs.find_unique_visits(spark, page_topic, uv, ck("uv"), trigger=NOW))
        run(jobs.find_bounces(spark, page_topic, uj, ck("uj"), trigger=NOW))
    run(jobs.count_visitors(
        spark, page_topic, uv, uj,
        lambda rows, n: rows.write.mode("overwrite").parquet(f"{stored}/batch={n}"), ck("stats"), trigger=NOW))

    assert [r["value"] for r in read_topic(spark, dirty, False).collect()] == ["broken {"]
    typed = logs.good_logs(logs.clean_logs(
        spark.createDataFrame([(json.dumps(t), i) for i, t in enumerate([start, *texts, end])], "value string, seq bigint")))
    fixed = logs.correct_new_visitors(typed)
    assert logs.start_logs(fixed).count() == read_topic(
        spark, TopicSpec("dwd_start_log", path=split.path, shared=True), False).count() == 1
    shown = read_topic(spark, TopicSpec("dwd_display_log", path=split.path, shared=True), False)
    assert sorted(json.loads(r["value"])["item"] for r in shown.collect()) == sorted(
        t["displays"][0]["item"] for t in texts if t["displays"])
    want = stats.visitor_stats(logs.page_logs(fixed))
    is_last = F.col("ts") < T0 + 10**8  # the window of the last record is still open
    rows = lambda df: sorted(map(tuple, df.filter(is_last).select(*schemas.VISITOR_STATS).collect()), key=str)
    assert rows(spark.read.parquet(stored)) == rows(want)


def test_change_jobs_end_to_end(spark, tmp_path):
    at = lambda name: TopicSpec(name, path=str(tmp_path / name))
    messages = spark.createDataFrame([], "topic string, value string")
    msg = lambda table, op, after: (f"s.shop.{table}", json.dumps({"op": op, "after": after}))
    rules = [("user", "insert", "hbase", "dim_user", "id,name", None, None)]

    def step(*rows):
        spark.createDataFrame(list(rows), messages.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(messages.schema).parquet(f"{tmp_path}/in")
        run(jobs.sync_changes(source, at("db"), str(tmp_path / "ck1"), NOW))
        run(jobs.route_changes(
            spark, at("db"), lambda: spark.createDataFrame(rules, schemas.RULE), at("facts"),
            str(tmp_path / "store"), str(tmp_path / "ck2"), NOW, database="jobs_test"))

    spark.sql(f"CREATE DATABASE jobs_test LOCATION '{tmp_path}/db'")
    step(msg("user", "c", {"id": 1, "name": "a"}), msg("order", "c", {"id": 5, "sum": 2}), msg("user", "d", None))
    # a new rule holds from the next batch on; the order before it is lost
    rules += [("order", "insert", "kafka", "dwd_order", "id", None, None),
              ("user", "update", "hbase", "dim_user", "id,name", None, None)]
    step(msg("order", "c", {"id": 6, "sum": 2}), msg("user", "u", {"id": 1, "name": "b"}), msg("user", "u", {"id": 1, "name": "c"}))
    facts = read_topic(spark, TopicSpec("dwd_order", path=at("facts").path, shared=True), False)
    assert [r["value"] for r in facts.collect()] == ['{"id":6}']
    assert [tuple(r)[:2] for r in spark.table("jobs_test.dim_user").collect()] == [("1", "c")]
    spark.sql("DROP DATABASE jobs_test CASCADE")
    user = dim_store.DimTable("dim_user", ("id", "name"))
    assert [tuple(r) for r in dim_store.read(spark, str(tmp_path / "store"), user).collect()] == [("1", "c")]


def test_order_jobs_end_to_end(spark, tmp_path):
    at = lambda name: TopicSpec(name, path=str(tmp_path / name))
    info = lambda i, t: {"id": i, "user_id": 1, "province_id": 1, "total_amount": "9.50", "create_time": t}
    detail = lambda i, o, t: {"id": i, "order_id": o, "sku_id": 7, "sku_num": 1, "create_time": t}
    pay = {"id": 70, "order_id": 1, "user_id": 2, "total_amount": 8, "create_time": "2021-07-02 20:15:00"}
    names = {"n": "first"}

    def dim_tables():
        row = lambda cols, *vals: spark.createDataFrame([vals], ", ".join(f"{c} string" for c in cols.split()))
        return {
            "dim_user_info": row("ID GENDER BIRTHDAY", "1", "F", "2000-01-01"),
            "dim_base_province": row("ID NAME AREA_CODE ISO_CODE ISO_3166_2", "1", names["n"], "a", "b", "c"),
            "dim_sku_info": row("ID SPU_ID TM_ID CATEGORY3_ID", "7", "1", "2", "3"),
            "dim_spu_info": row("ID SPU_NAME", "1", "s"),
            "dim_base_trademark": row("ID TM_NAME", "2", "t"),
            "dim_base_category3": row("ID NAME", "3", "c"),
        }

    def step(infos, details):
        feed_topic(spark, at("orders"), *infos)
        feed_topic(spark, at("details"), *details)
        run(jobs.widen_orders(spark, at("orders"), at("details"), dim_tables, at("wide"), str(tmp_path / "ck"), trigger=NOW))

    step([info(1, "2021-07-02 20:09:06")], [detail(11, 1, "2021-07-02 20:09:08")])
    names["n"] = "second"  # a changed dimension is seen by the next batch
    step([info(2, "2021-07-02 21:00:00")], [detail(12, 2, "2021-07-02 21:00:05"), detail(13, 2, "2021-07-02 21:00:06")])
    wide = records.parse_strict(read_topic(spark, at("wide"), False), schemas.ORDER_WIDE)
    got = {r["detail_id"]: (r["province_name"], r["category3_name"], str(r["total_amount"])) for r in wide.collect()}
    assert got == {11: ("first", "c", "9.50"), 12: ("second", "c", "9.50")}

    feed_topic(spark, at("pay"), pay)
    run(jobs.widen_payments(spark, at("pay"), at("wide"), at("paid"), str(tmp_path / "ckp"), trigger=NOW))
    paid = records.parse_strict(read_topic(spark, at("paid"), False), schemas.PAYMENT_WIDE)
    assert [(r["payment_id"], r["detail_id"], r["user_id"]) for r in paid.collect()] == [(70, 11, 2)]

    feed_topic(spark, at("orders"), "not json")
    query = jobs.widen_orders(spark, at("orders"), at("details"), dim_tables, at("wide"), str(tmp_path / "ck"), trigger=NOW)
    with pytest.raises(Exception):
        query.awaitTermination()


def test_orders_and_details_meet_over_batches_without_state_in_memory(spark, tmp_path):
    """What is open lies in files and goes when the watermark has passed it; late rows meet nothing; a batch may run again."""
    at = lambda name: TopicSpec(name, path=str(tmp_path / name))
    text = lambda s: f"2021-07-02 20:{s // 60:02d}:{s % 60:02d}"
    dims = {
        name: spark.createDataFrame([], ", ".join(f"{c} string" for c in cols.split()))
        for name, cols in {
            "dim_user_info": "ID GENDER BIRTHDAY",
            "dim_base_province": "ID NAME AREA_CODE ISO_CODE ISO_3166_2",
            "dim_sku_info": "ID SPU_ID TM_ID CATEGORY3_ID",
            "dim_spu_info": "ID SPU_NAME",
            "dim_base_trademark": "ID TM_NAME",
            "dim_base_category3": "ID NAME",
        }.items()
    }

    def go():
        run(jobs.widen_orders(
            spark, at("orders"), at("details"), lambda: dims, at("wide"), str(tmp_path / "ck"),
            -5_000, 9_000, lateness="10 seconds", trigger=NOW,
        ))

    def found():
        rows = records.parse_strict(read_topic(spark, at("wide"), False), schemas.ORDER_WIDE).collect()
        return sorted((r["order_id"], r["detail_id"], r["create_time"]) for r in rows)

    rnd = random.Random(7)
    infos, details = [], []  # (id, second) and (id, order, second)
    for k in range(4):  # a batch reaches 5 seconds into the time of the one before
        when = lambda: rnd.randrange(20 * k, 20 * k + 25)  # noqa: E731, B023
        some = [(rnd.randrange(12), when()) for _ in range(12)], [(100 * k + i, rnd.randrange(12), when()) for i in range(60)]
        infos, details = infos + some[0], details + some[1]
        late = [(900, some[0][0][0], 0)] if k == 3 else []
        feed_topic(spark, at("orders"), *[{"id": i, "create_time": text(s)} for i, s in some[0]])
        feed_topic(spark, at("details"), *[{"id": i, "order_id": o, "create_time": text(s)} for i, o, s in some[1] + late])
        go()
    want = sorted((o, d, text(s)) for o, s in infos for d, x, t in details if x == o and -5 <= t - s <= 9)
    assert found() == want and len(want) > 20

    assert not (tmp_path / "ck" / "state").exists()
    mark = min(max(s for _, s in infos), max(s for *_, s in details)) - 10
    kept = tmp_path / "ck" / "open-rows"
    assert sorted(p.name for p in kept.iterdir()) == ["batch=2", "batch=3"]
    ids = lambda side: sorted((r["id"], r["create_time"]) for r in spark.read.parquet(str(kept / "batch=3" / side)).collect())
    assert ids("orders") == sorted((i, text(s)) for i, s in infos if s + 9 > mark)
    assert ids("details") == sorted((i, text(s)) for i, _, s in details if s + 5 > mark)

    for again in (["commits/3", "commits/.3.crc"], ["commits/3", "commits/.3.crc", "open-rows/batch=3/marks/_SUCCESS"]):
        for name in again:
            (tmp_path / "ck" / name).unlink(missing_ok=True)
        (tmp_path / "wide" / "batch=3" / "_SUCCESS").unlink()
        go()
        assert found() == want


def test_changes_go_by_the_rule_of_their_arrival(spark, tmp_path):
    """All is there before the job starts, in one batch; each change still has its own rule."""
    at = lambda n, **kw: TopicSpec(n, path=str(tmp_path / n), **kw)
    envelope = lambda table, data: json.dumps({"database": "c", "tableName": table, "type": "insert", "data": data, "before": {}})
    rule = lambda sink, cols: envelope("rules", {"source_table": "t", "operate_type": "insert", "sink_type": "kafka", "sink_table": sink, "sink_columns": cols})
    for n, (topic, text) in enumerate([
        ("db", envelope("t", {"id": "0"})), ("rules", rule("one", "id")), ("db", envelope("t", {"id": "1", "name": "x"})),
        ("rules", rule("two", "id,name")), ("db", envelope("t", {"id": "2", "name": "y"}))]):
        feed_topic(spark, at(topic), text)
        time.sleep(0.05)
    history = lambda: jobs.rule_history_of_topic(spark, at("rules"))
    run(jobs.route_changes(spark, at("db"), history, at("facts"), str(tmp_path / "store"), str(tmp_path / "ck"), {"availableNow": True}, as_of=True))
    got = {r["topic"]: json.loads(r["value"]) for r in spark.read.option("basePath", str(tmp_path / "facts")).parquet(str(tmp_path / "facts" / "batch=0")).collect()}
    assert got == {"one": {"id": "1"}, "two": {"id": "2", "name": "y"}}


def test_pattern_in_any_order_over_batches(spark, tmp_path):
    """Three steps over several batches equal the batch operator, whatever the order within a batch."""
    rnd = random.Random(4)
    rows = sorted((page(f"m{rnd.randrange(3)}", rnd.randrange(0, 60_000), k, page_id=rnd.choice("aabc")) for k in range(400)), key=lambda r: r[3])
    rows.append(page("zz", 10**7, 999))
    on = lambda n: F.col("page.page_id") == n
    pattern = Pattern.begin("x", on("a")).next("y", on("a")).next("z", on("b")).within(900)
    feed = Feed(spark, tmp_path, lambda pages: state.find_pattern(pages, pattern, F.col("common.mid")))
    for k in range(0, len(rows), 150):
        part = rows[k : k + 150]
        rnd.shuffle(part)
        feed(*part)
    got = sorted((r.seq, r.outcome, r.steps) for r in feed.out.collect())
    want = patterns.find_pattern(pages(spark, rows), pattern, F.col("common.mid"))
    assert got == sorted((r.seq, r.outcome, r.steps) for r in want.collect() if r.seq != 999) and len(got) > 20
    with pytest.raises(ValueError, match="limit"):
        state.find_pattern(pages(spark, rows), Pattern.begin("x", on("a")), F.col("common.mid"))


def _state_rows(spark, tmp_path, operator, rows):
    """State rows by operator after one batch of ``rows``."""
    feed = Feed(spark, tmp_path, operator)
    pages(spark, rows).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(PAGES).parquet(f"{tmp_path}/in")
    query = feed.operator(source).writeStream.option("checkpointLocation", f"{tmp_path}/ck").trigger(**NOW).format("parquet").option("path", f"{tmp_path}/out").start()
    query.awaitTermination()
    return {o["operatorName"]: o["numRowsTotal"] for o in query.recentProgress[0]["stateOperators"]}


def test_visitors_share_calls_of_a_group(spark, tmp_path, monkeypatch):
    """Three hundred visitors meet Python in at most four groups; per visitor and day there is only a key."""
    monkeypatch.setattr(state, "GROUPS", 4, raising=False)
    rows = [page(f"m{n}", T0 + n, n, "") for n in range(300)]
    found = _state_rows(spark, tmp_path / "a", state.first_visits_of_day, rows)
    assert found["transformWithStateInPandasExec"] == 0 and found["dedupe"] == 300
    assert _state_rows(spark, tmp_path / "b", state.bounces, rows)["transformWithStateInPandasExec"] <= 4 * 5


def test_one_batch_in_small_chunks_is_sorted(spark, tmp_path):
    """Rows of a visitor that reach Python in several chunks of one batch still count in order."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        rows = random_pages(9, n=300, span=60_000)
        random.Random(1).shuffle(rows)
        feed = Feed(spark, tmp_path, lambda p: state.literal_visits(p, lateness="1 day"))
        feed(*rows)
        assert feed.seqs() == brute_literal(sorted(rows, key=lambda r: (r[3], r[4])))
    finally:
        spark.conf.set(key, before)


def test_null_visitors_and_short_lateness(spark, tmp_path):
    """A null visitor is one visitor; a day's key stays until the watermark has passed the day."""
    feed = Feed(spark, tmp_path, lambda p: state.first_visits_of_day(p, lateness="1 minute"))
    start = 18_000 * times.DAY_MS - times.ZONE_MS
    feed(page("a", start + 5, 1), page(None, start + 6, 2), page(None, start + 7, 3))
    feed(page("b", start + 10 * 3_600_000, 4))
    feed(page("a", start + 11 * 3_600_000, 5), page(None, start + 11 * 3_600_000, 6))
    assert feed.seqs() == [1, 2, 4]
