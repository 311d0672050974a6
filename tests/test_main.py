"""The command line's jobs on file topics: changes to wide payments."""

import json

import pytest

from weirhouse import __main__ as cli
from weirhouse.sources.topics import read_topic
from weirhouse.streaming import jobs


def envelope(table, data):
    return json.dumps({"database": "c", "tableName": table, "type": "insert", "data": data, "before": {}})


def test_changes_to_wide_payments(spark, tmp_path):
    s = cli.Settings(spark, {"root": str(tmp_path / "t"), "checkpoint": str(tmp_path / "ck"), "store": str(tmp_path / "d"), "once": True})
    rule = lambda table, kind, sink, cols: envelope("table_process", {
        "source_table": table, "operate_type": "insert", "sink_type": kind, "sink_table": sink, "sink_columns": cols})
    dims = {
        "dim_user_info": {"id": 1, "gender": "F", "birthday": "2000-01-01"},
        "dim_base_province": {"id": 2, "name": "P", "area_code": "02", "iso_code": "i", "iso_3166_2": "j"},
        "dim_sku_info": {"id": 3, "spu_id": 4, "tm_id": 5, "category3_id": 6},
        "dim_spu_info": {"id": 4, "spu_name": "spu"},
        "dim_base_trademark": {"id": 5, "tm_name": "tm"},
        "dim_base_category3": {"id": 6, "name": "cat"},
    }
    facts = {
        "order_info": {"id": 10, "user_id": 1, "province_id": 2, "total_amount": "7.25", "create_time": "2021-07-02 20:09:06"},
        "order_detail": {"id": 11, "order_id": 10, "sku_id": 3, "sku_num": 2, "create_time": "2021-07-02 20:09:06"},
        "payment_info": {"id": 12, "order_id": 10, "user_id": 1, "total_amount": "7.25", "create_time": "2021-07-02 20:10:06"},
    }
    with pytest.raises(ValueError, match="no rule fills"):
        spark.createDataFrame([(rule("x", "kafka", "y", "id"),)], "value string").write.parquet(s.topic(cli.RULE_CHANGES).path)
        s.dims()
    rules = [rule(n, "hbase", n, ",".join(row)) for n, row in dims.items()]
    rules += [rule(n, "kafka", f"dwd_{n}", ",".join(row)) for n, row in facts.items()]
    spark.createDataFrame([(r,) for r in rules], "value string").write.mode("append").parquet(s.topic(cli.RULE_CHANGES).path)
    messages = [(f"s.shop.{n}", json.dumps({"op": "c", "after": row})) for n, row in {**dims, **facts}.items()]
    messages.append(("s.shop.other", json.dumps({"op": "c", "after": {"id": 1}})))
    spark.createDataFrame(messages, "topic string, value string").write.parquet(str(tmp_path / "t" / "connector"))
    for job in ("sync-changes", "route-changes", "unrouted-changes", "order-wide", "payment-wide"):
        cli.start(job, s).awaitTermination()
    (row,) = read_topic(spark, s.topic(cli.PAYMENT_WIDE), streaming=False).collect()
    paid = json.loads(row["value"])
    assert paid["payment_id"] == 12 and paid["total_amount"] == 7.25 and paid["user_gender"] == "F"
    assert (paid["province_name"], paid["spu_name"], paid["tm_name"], paid["category3_name"]) == ("P", "spu", "tm", "cat")
    lost = [json.loads(r["value"]) for r in read_topic(spark, s.topic(cli.UNROUTED), streaming=False).collect()]
    assert lost == [{"tableName": "other", "type": "insert", "reason": "no rule", "changes": 1}]
    assert jobs.rules_of_topic(spark, s.topic(cli.RULE_CHANGES)).count() == 10


def test_dirty_logs(spark, tmp_path):
    s = cli.Settings(spark, {"root": str(tmp_path / "t"), "checkpoint": str(tmp_path / "ck"), "once": True})
    good = json.dumps({"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 1})
    spark.createDataFrame([(good,), ("{",)], "value string").write.parquet(s.topic(cli.RAW_LOG).path)
    cli.start("dirty-logs", s).awaitTermination()
    assert [r["value"] for r in read_topic(spark, s.topic(cli.DIRTY_LOG), streaming=False).collect()] == ["{"]


def test_unknown_job(spark):
    with pytest.raises(SystemExit):
        cli.start("nothing", cli.Settings(spark, {"root": "x", "checkpoint": "y"}))
    with pytest.raises(SystemExit):
        cli.main([])
