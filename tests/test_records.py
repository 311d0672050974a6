import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import lines
from weirhouse import schemas
from weirhouse.functions import records

GOOD = {"common": {"mid": "m", "is_new": 1}, "page": {"page_id": "p"}, "ts": "12"}


def outcome(spark, text):
    row = records.parse_object(lines(spark, [text]), schemas.log_schema()).first()
    return row["record_ok"], row["record"]


def test_scalars_come_as_text(spark):
    ok, r = outcome(spark, GOOD)
    assert ok and r["common"]["is_new"] == "1" and r["ts"] == "12"
    ok, r = outcome(spark, {**GOOD, "start": {"entry": "icon"}})
    assert ok and json.loads(r["start"]) == {"entry": "icon"}


@pytest.mark.parametrize(
    "text",
    [None, "", "  ", "null", "[1]", "7", '{"common":', json.dumps([GOOD]), json.dumps(GOOD) + " tail",
     json.dumps(GOOD) + json.dumps(GOOD), json.dumps(GOOD) + "," + json.dumps(GOOD),
     json.dumps({**GOOD, "displays": 5}), json.dumps({**GOOD, "common": "x"})],
)
def test_bad_texts(spark, text):
    assert not outcome(spark, text)[0]
    df = lines(spark, [text, GOOD])
    assert records.parse_or_drop(df, schemas.log_schema()).count() == 1
    with pytest.raises(Exception, match="bad record"):
        records.parse_strict(df, schemas.log_schema()).collect()


def test_text_is_parsed_once(spark):
    parsed = records.parse_or_drop(lines(spark, [GOOD]), schemas.log_schema())
    used = parsed.filter(F.col("common.mid").isNotNull()).select("common.mid", "page.page_id", "ts")
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_repeated_keys_last_wins(spark):
    row = spark.createDataFrame([('{"a":1,"b":null,"a":2,"page_id":"old"}',)], "t string")
    m = F.from_json("t", T.MapType(T.StringType(), T.StringType()))
    assert row.select(records.put(m, "page_id", F.lit("new")).alias("m")).first()["m"] == {
        "a": "2", "b": None, "page_id": "new"}
    assert row.select(records.last_keys(m).alias("m")).first()["m"] == {"a": "2", "page_id": "old"}


def test_null_fields_are_left_out(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert records.to_record(df).first()["value"] == '{"a":1,"c":"x"}'


def test_names(spark):
    assert [records.lower_camel(n) for n in ("order_id", "ORDER_ID", "id", "sku_num_2", "_id")] == [
        "orderId", "orderId", "id", "skuNum2", "Id"]
    assert records.split_columns("a,b ,c,,") == ["a", "b ", "c"]
    df = records.rename_lower_camel(records.as_strings(spark.createDataFrame([(1, True)], "user_id int, is_ok boolean")))
    assert df.dtypes == [("userId", "string"), ("isOk", "string")] and df.first()["userId"] == "1"


def test_quoted_numbers(spark):
    schema = schemas.PAYMENT_INFO
    good = {"id": "12", "order_id": 5, "total_amount": "7.25", "user_id": "", "subject": 9}
    (r,) = records.parse_strict(lines(spark, [good]), schema).collect()
    assert (r["id"], r["order_id"], str(r["total_amount"]), r["user_id"], r["subject"]) == (12, 5, "7.25", None, "9")
    for bad in ({**good, "id": "x"}, {**good, "total_amount": "7,25"}, {**good, "id": {"a": 1}}):
        assert records.parse_or_drop(lines(spark, [bad, good]), schema).count() == 1
    nested = {"common": {"mid": "m"}, "page": {"during_time": "31"}, "ts": "5"}
    (r,) = records.parse_strict(lines(spark, [nested]), schemas.page_schema()).collect()
    assert (r["page"]["during_time"], r["ts"], r["displays"]) == (31, 5, None)
    assert records.parse_strict(lines(spark, [{"ts": 1}]), schemas.page_schema()).first()["page"] is None
    assert records.parse_or_drop(lines(spark, [{"page": {"during_time": "x"}}]), schemas.page_schema()).count() == 0


def test_text_that_closes_its_own_wrapping_is_dirty(spark):
    good = '{"common":{"mid":"m"},"ts":3}'
    schema = T.StructType.fromDDL("common struct<mid string>, ts bigint")
    rows = spark.createDataFrame([(good,), (good + '],"x":[1',), (good + '},"y":{"x":1',), (good + "," + good,)], "value string")
    assert [r.record_ok for r in records.parse_object(rows, schema).collect()] == [True, False, False, False]


def test_money_with_more_digits_than_it_keeps_does_not_fit(spark):
    schema = T.StructType.fromDDL("amount decimal(18,2)")
    rows = spark.createDataFrame([('{"amount":"12.345"}',), ('{"amount":12.340}',), ('{"amount":null}',)], "value string")
    assert [r.record_ok for r in records.parse_object(rows, schema).collect()] == [False, True, True]
