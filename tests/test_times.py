import pytest
from pyspark.sql import functions as F

from weirhouse.functions import times


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Shanghai"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_samples_both_ways_in_any_session_zone(spark, zone):
    assert one(spark, times.format_epoch("c"), c="1625227746000") == "2021-07-02 20:09:06"
    assert one(spark, times.format_epoch("c"), c="1625227746") == "2021-07-02 20:09:06"
    assert one(spark, times.parse_time("c"), c="2021-07-02 20:09:06") == 1625227746000
    # a local time the New York clock skips in spring
    assert one(spark, times.text_of_millis("c"), c=1615660200000) == "2021-03-14 02:30:00"
    assert one(spark, times.parse_time("c"), c="2021-03-14 02:30:00") == 1615660200000


def test_other_lengths_and_texts_fail(spark):
    for bad in ("162522774600", "12", None):
        with pytest.raises(Exception, match="epoch"):
            one(spark, times.format_epoch(F.col("c").cast("string")), c=bad)
    assert one(spark, times.format_epoch("c", strict=False), c="12") is None
    with pytest.raises(Exception):
        one(spark, times.parse_time("c"), c="2021-07-02")
    assert one(spark, times.parse_time("c", strict=False), c="2021-07-02") is None


def test_date_and_hour(spark):
    assert one(spark, times.create_date("c"), c="2021-07-02 20:09:06") == "2021-07-02"
    assert one(spark, times.create_hour("c"), c="2021-07-02 20:09:06") == "20"
    for bad in ("2021-07-02", "2021-07-02 ", "2021-07-02  20:09:06", "a b c"):
        with pytest.raises(Exception, match="time format"):
            one(spark, times.create_date("c"), c=bad)


def test_slots(spark):
    for ms, want in [(0, 0), (999, 0), (1000, 1), (-1, -1), (-1000, -1), (-1001, -2)]:
        assert one(spark, times.slot_of("c", 1000), c=ms) == want
    # the UTC+8 day turns at 16:00 UTC
    turn = 16 * 3_600_000
    assert one(spark, times.day_slot("c"), c=turn) - one(spark, times.day_slot("c"), c=turn - 1) == 1


def test_age(spark):
    born = 946656000000  # 2000-01-01 00:00:00 +08:00
    for text in ("2000-01-01", "2000-01-01 00:00:00"):
        assert one(spark, times.age_years("c", born + times.YEAR_MS), c=text) == 1
        assert one(spark, times.age_years("c", born + times.YEAR_MS - 1), c=text) == 0
        assert one(spark, times.age_years("c", born - times.YEAR_MS + 1), c=text) == 0
        assert one(spark, times.age_years("c", born - times.YEAR_MS), c=text) == -1
    assert one(spark, times.age_years("c", born), c="soon") is None
