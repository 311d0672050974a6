import json

from pyspark.sql import functions as F

from helpers import lines, page, pages, seqs
from weirhouse.operators import logs


def line(mid="m", ts=1, is_new="0", start=None, page_id="p", displays=None, **more):
    r = {"common": {"mid": mid, "is_new": is_new}, "page": {"page_id": page_id, "during_time": 3}, "ts": ts}
    if start is not None:
        r["start"] = start
    if displays is not None:
        r["displays"] = displays
    return {**r, **more}


def test_dirty_rows_keep_their_text(spark):
    bad = ["{", "", "[1]", json.dumps({"page": {}, "ts": 1}), json.dumps(line(mid=None)),
           json.dumps({"common": {"mid": "m"}, "ts": 1}), json.dumps(line(ts=None)),
           json.dumps({**line(), "page": None, "start": ""})]
    good = [line(), line(start={"entry": "icon"}, page=None, ts=None), line(start="x", page=None)]
    cleaned = logs.clean_logs(lines(spark, bad + good))
    assert sorted(r["value"] for r in logs.dirty_logs(cleaned).collect()) == sorted(bad)
    assert logs.good_logs(cleaned).count() == len(good)
    assert "dirty" not in logs.good_logs(cleaned).columns


def test_split(spark):
    shown = [{"item": "1"}, {"item": "2", "page_id": "wrong"}]
    df = logs.good_logs(logs.clean_logs(lines(spark, [
        line(start="icon", displays=shown), line(start="", displays=shown), line(displays=[]), line()])))
    assert seqs(logs.start_logs(df)) == [0]
    out = logs.page_logs(df)
    assert seqs(out) == [1, 2, 3]
    want = [{"item": "1", "page_id": "p"}, {"item": "2", "page_id": "p"}]
    assert out.filter("seq = 1").first()["displays"] == want
    assert out.filter("seq = 2").first()["displays"] == []
    assert [r["display"] for r in logs.display_logs(out).collect()] == want
    assert out.first()["page"]["during_time"] == 3

    rows = [(r["topic"], json.loads(r["value"])) for r in logs.split_rows(df, "s", "p", "d").collect()]
    assert [v for t, v in rows if t == "d"] == want
    assert sum(t == "s" for t, _ in rows) == 1 and sum(t == "p" for t, _ in rows) == 3
    # the start record keeps its displays as they came
    assert next(v for t, v in rows if t == "s")["displays"] == shown
    assert next(v for t, v in rows if t == "p")["displays"] == want


def test_whole_records_go_on(spark):
    rich = {"item": 7, "pos": {"x": [1, None, "a"]}}
    records = [
        line(start={"entry": "icon", "ms": 5}, page=None, err={"code": 1.5}),
        line(displays=[rich, {"page_id": 3}], actions=[{"id": "1"}, 2]),
        line(is_new="1", ts=2, extra=True),
        {**line(is_new="1", ts=3, extra=[]), "common": {"mid": "m", "is_new": "1", "os": {"v": "9"}, "uid": 12}},
        {**line(), "page": {"page_id": "p", "during_time": "long", "item": "i"}},
    ]
    twice = '{"common":{"mid":"m","mid":"m","is_new":"0"},"page":{"page_id":"q"},"ts":9}'
    odd = ' {"ts": 9,  "common": {"mid": "m", "is_new": 0, "z": 1.50}, "page": {}}'
    good = logs.good_logs(logs.clean_logs(lines(spark, [*records, twice, odd])), keep_text=True)
    rows = logs.split_rows(logs.correct_new_visitors(good), "s", "p", "d", text="value").collect()
    out = {t: [json.loads(r["value"]) for r in rows if r["topic"] == t] for t in "spd"}
    assert out["s"] == records[:1]
    shown = [{**rich, "page_id": "p"}, {"page_id": "p"}]
    assert out["d"] == shown
    want = [
        {**records[1], "displays": shown},
        records[2],
        {**records[3], "common": {**records[3]["common"], "is_new": "0"}},
        {**records[4], "page": {"page_id": "p", "item": "i"}},
        json.loads(odd),
    ]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted((r for r in out["p"] if r["page"].get("page_id") != "q"), key=key) == sorted(want, key=key)
    assert sum(r["page"].get("page_id") == "q" for r in out["p"]) == 1
    assert odd in [r["value"] for r in rows]  # an unchanged line stays as it is


def test_repeated_names_lose_no_field(spark):
    text = '{"common":{"mid":"m","is_new":"0","z":1,"z":2},"page":{"page_id":"p"},"ts":9,"displays":[{"n":{"a":1,"a":2}}],"actions":[1]}'
    good = logs.good_logs(logs.clean_logs(spark.createDataFrame([(text, 1)], "value string, seq bigint")), keep_text=True)
    rows = logs.split_rows(logs.correct_new_visitors(good), "s", "p", "d", text="value").collect()
    out = {r["topic"]: json.loads(r["value"]) for r in rows}
    assert out["d"] == {"n": {"a": 2}, "page_id": "p"}
    assert out["p"]["actions"] == [1] and out["p"]["common"] == {"mid": "m", "is_new": "0", "z": 2}


def test_new_visitor_flag(spark):
    df = pages(spark, [
        page("a", 1, 1, is_new="0"), page("a", 2, 2, is_new="1"), page("a", 2, 3, is_new="1"),
        page("a", 3, 4, is_new="0"), page("a", 4, 5, is_new="1"), page("b", 9, 6, is_new="1"),
        page("c", 1, 7, is_new=None), page("d", None, 8, is_new="1"), page("d", 1, 9, is_new="1")])
    out = {r["seq"]: r["common"]["is_new"] for r in logs.correct_new_visitors(df).collect()}
    assert out == {1: "0", 2: "1", 3: "0", 4: "0", 5: "0", 6: "1", 7: None, 8: "1", 9: "0"}


def test_dominant_visitor_is_spread(spark):
    df = spark.range(3000).select(
        F.struct(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
                 F.lit("1").alias("is_new")).alias("common"),
        F.col("id").alias("ts"), F.col("id").alias("seq"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = logs.correct_new_visitors(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the join exchanges hash the whole identity, and ranks are cut before the shuffle
        assert "WindowGroupLimit" in plan and "Partial" in plan
        assert plan.count("hashpartitioning(coalesce(_mid") == 2 or plan.count("hashpartitioning(_mid") >= 2
        assert out.filter("common.is_new = '1'").count() == 2001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
