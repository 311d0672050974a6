import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.functions import records
from weirhouse.operators import routing
from weirhouse.sources import cdc


def messages(spark, rows):
    rows = [(t, v if isinstance(v, str) else json.dumps(v), i) for i, (t, v) in enumerate(rows)]
    return spark.createDataFrame(rows, "topic string, value string, seq bigint")


def plain(image):
    return {k: v.toPython() for k, v in image.items()}


def test_cells_keep_their_types(spark):
    body = '{"op":"c","after":{"p":12.50,"t":"12.50","n":{"a":[1,{"b":null}],"a":[2]},"z":null,"t2":"x","t2":"y","m":1e3}}'
    sent = cdc.normalize_cdc(messages(spark, [("s.shop.user", body)]))
    (r,) = cdc.parse_changes(records.to_record(sent.drop("seq"))).select(F.to_json("data").alias("data")).collect()
    assert r["data"] == '{"p":12.5,"t":"12.50","n":{"a":[2]},"t2":"y","m":1000}'
    more = [body, '{"op":"c","after":{"p":1,"n":"x"}}']
    types = cdc.column_types(cdc.normalize_cdc(messages(spark, [("s.shop.user", m) for m in more])))
    got = {r["column"]: r["type"] for r in types.collect()}
    assert got == {"p": "DECIMAL(21,1)", "t": "STRING", "n": "VARIANT", "t2": "STRING", "m": "DOUBLE"}


def test_envelope(spark):
    df = messages(spark, [
        ("srv.shop.user", {"before": None, "after": {"id": 1, "name": "x", "gone": None}, "op": "c", "ts_ms": 5}),
        ("srv.shop.user", {"after": {"id": 1}, "before": {"id": 2}, "op": "u"}),
        ("srv.shop.user", {"before": {"id": 2}, "after": None, "op": "d"}),
        ("srv.shop.user", {"schema": {}, "payload": {"after": {"id": 7}, "op": "r"}})])
    got = [(*r[:4], plain(r["data"]), plain(r["before"])) for r in cdc.normalize_cdc(df).orderBy("seq").collect()]
    assert got == [
        (0, "shop", "user", "insert", {"id": 1, "name": "x"}, {}),
        (1, "shop", "user", "update", {"id": 1}, {"id": 2}),
        (2, "shop", "user", "delete", {}, {"id": 2}),
        (3, "shop", "user", "read", {"id": 7}, {}),
    ]
    for bad in ("{", {"after": {"id": 1}, "op": "z"}, {"after": {"id": 1}}):
        with pytest.raises(Exception, match="bad change record"):
            cdc.normalize_cdc(messages(spark, [("a.b.c", bad)])).collect()


def test_envelope_text_round_trip_drops_bad_rows(spark):
    text = json.dumps({"database": "d", "tableName": "t", "type": "insert", "data": {"id": 1}, "before": {}})
    df = messages(spark, [("x", text), ("x", "{"), ("x", "[]")]).drop("topic")
    (r,) = cdc.parse_changes(df).collect()
    assert plain(r["data"]) == {"id": 1} and r["seq"] == 0


def changes(spark, rows):
    rows = [("db", t, op, data, before or {}, i) for i, (t, op, data, before) in enumerate(rows)]
    return spark.createDataFrame(rows, T.StructType([*schemas.CHANGE.fields, T.StructField("seq", T.LongType())]))


def rules(spark, rows):
    return spark.createDataFrame(rows, schemas.RULE)


def test_route(spark):
    df = changes(spark, [
        ("user", "insert", {"id": "1", "name": "x", "secret": "s"}, None),
        ("order", "insert", {"id": "2", "sum": "3"}, None),
        ("order", "update", {"id": "2"}, None),
        ("stats", "insert", {"id": "4"}, None),
        ("user", "delete", {}, {"id": "1"})])
    r = rules(spark, [
        ("user", "insert", "hbase", "dim_user", "id,name,missing", None, None),
        ("order", "insert", "kafka", "dwd_order", "id, sum", "id", None),  # the blank is part of the name
        ("stats", "insert", "clickhouse", "s", "id", None, None)])
    live = routing.drop_empty(df)
    assert live.count() == 4
    routed = routing.attach_rules(live, r)
    (dim,) = routing.store_rows(routed).collect()
    assert dim["data"] == {"id": "1", "name": "x"} and dim["sinkTable"] == "dim_user" and dim["sinkPk"] == "id"
    assert [tuple(x) for x in routing.topic_rows(routed).collect()] == [("dwd_order", '{"id":"2"}')]
    lost = {(x["tableName"], x["type"]): (x["reason"], x["changes"]) for x in routing.unrouted(live, r).collect()}
    assert lost == {("order", "update"): ("no rule", 1), ("stats", "insert"): ("sink type clickhouse", 1)}


def test_changes_without_key_are_counted(spark):
    r = spark.createDataFrame([("user", "insert", "hbase", "dim_user", "name", "id", None)], schemas.RULE)
    live = changes(spark, [("user", "insert", {"id": "1", "name": "x"}, None), ("user", "insert", {"name": "y"}, None)])
    (lost,) = routing.unrouted(live, r).collect()
    assert (lost["reason"], lost["changes"]) == ("no key", 1)


def test_rules_in_force(spark):
    row = lambda table, sink, op="insert": {
        "source_table": table, "operate_type": op, "sink_type": "kafka", "sink_table": sink, "sink_columns": "id"}
    camel = {"sourceTable": "e", "operateType": "insert", "sinkType": "kafka", "sinkTable": "e1", "sinkColumns": "id"}
    df = changes(spark, [
        ("r", "insert", row("a", "a1"), None), ("r", "update", row("a", "a2"), row("a", "a1")),
        ("r", "insert", row("b", "b1"), None), ("r", "delete", {}, row("b", "b1")),
        ("r", "insert", row("c", "c1"), None), ("r", "update", row("d", "d1"), row("c", "c1")),
        ("r", "insert", row("a", "u1", "update"), None), ("r", "read", camel, None)])
    out = routing.latest_rules(routing.rule_changes(df, ["seq"]), ["seq"]).collect()
    got = {(r["sourceTable"], r["operateType"]): r["sinkTable"] for r in out}
    assert got == {("a", "insert"): "a2", ("d", "insert"): "d1", ("a", "update"): "u1", ("e", "insert"): "e1"}


def test_rules_without_removals(spark):
    df = rules(spark, [("a", "insert", "kafka", "x", "id", None, None)]).withColumn("n", F.lit(1))
    assert routing.latest_rules(df, ["n"]).count() == 1
