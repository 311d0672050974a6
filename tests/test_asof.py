"""As-of joins, rules as of arrival, late rows and expiring visits against plain loops."""

import random

import pytest
from helpers import page, pages, seqs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.operators import lateness, routing, visits
from weirhouse.operators.asof_join import as_of_join


def test_as_of_join(spark):
    rnd = random.Random(1)
    left = [(rnd.choice(["a", "b", "c", None]), rnd.choice([rnd.randrange(-200, 200), None]), k) for k in range(400)]
    right = [(rnd.choice(["a", "b", "d", None]), rnd.choice([rnd.randrange(-200, 200), None]), k, f"v{k}") for k in range(90)]
    rows = spark.createDataFrame(left, "key string, at long, seq long")
    versions = spark.createDataFrame(right, "key string, at long, nth long, v string")

    def plain(key, at):
        met = [(x[1], x[2], x[3]) for x in right if key is not None and x[0] == key and at is not None and x[1] is not None and x[1] <= at]
        return max(met)[2] if met else None

    want = sorted((seq, plain(key, at)) for key, at, seq in left)
    for size in (1, 7, 1000):
        got = as_of_join(rows, versions, ["key"], "at", ["v"], size, ["nth"])
        assert sorted((r.seq, r.v) for r in got.collect()) == want
        inner = as_of_join(rows, versions, ["key"], "at", ["v"], size, ["nth"], how="inner")
        assert sorted((r.seq, r.v) for r in inner.collect()) == [w for w in want if w[1]]


def test_rules_apply_from_their_arrival(spark):
    change = T.StructType([*schemas.CHANGE.fields, T.StructField("at", T.LongType())])
    rows = [("db", "t", "insert", {"id": "1", "name": "x"}, {}, at) for at in (1, 5, 6, 9, 10, 20, 30)]
    history = [(table, "insert", "kafka", sink, cols, None, None, gone, at) for table, sink, cols, gone, at in [
        ("t", "first", "id", False, 5), ("t", "second", "id,name", False, 10), ("u", "other", "id", False, 1),
        ("t", None, None, True, 15), ("t", "moved", "name", False, 30), ("t", "gone", "id", True, 30)]]
    rule = T.StructType([*schemas.RULE.fields, T.StructField("removed", T.BooleanType()), T.StructField("at", T.LongType())])
    changes, rules = spark.createDataFrame(rows, change), spark.createDataFrame(history, rule)
    got = routing.attach_rules_as_of(changes, rules, "at", 4).select("at", "sinkTable", "data").collect()
    first, second = {"id": "1"}, {"id": "1", "name": "x"}
    assert sorted((r.at, r.sinkTable, r.data) for r in got) == [
        (5, "first", first), (6, "first", first), (9, "first", first), (10, "second", second), (30, "moved", {"name": "x"})]
    every = routing.attach_rules_as_of(changes, rules, "at", 1000, how="left")
    assert {r.at for r in every.where("sinkTable IS NULL").collect()} == {1, 20}


def test_late_rows(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice([rnd.randrange(0, 60), None]), rnd.choice([rnd.randrange(0, 5000), None])) for k in range(500)]
    df = spark.createDataFrame(rows, "seq long, step long, ts long")
    kept, late = lateness.split_late(df, "step", 300, 100, slice_size=7)

    def mark(step):
        before = [t for _, s, t in rows if s is not None and t is not None and step is not None and s < step]
        return max(before) - 300 if before else None

    want = {k: mark(s) for k, s, t in rows if t is not None and mark(s) is not None and (t // 100 + 1) * 100 <= mark(s)}
    assert {r.seq: r.watermark for r in late.collect()} == want and want
    assert sorted(r.seq for r in kept.collect()) == sorted(k for k, _, _ in rows if k not in want)
    assert kept.columns == df.columns


@pytest.mark.parametrize("ttl", [1, 900, 3000, 50_000])
def test_visits_expire(spark, ttl):
    rnd = random.Random(ttl)
    rows = [page(f"m{rnd.randrange(4)}", rnd.randrange(0, 90_000) // 250 * 250, k, rnd.choice([None, "", *["home"] * 20])) for k in range(600)]
    state, want = {}, []
    for common, at, _, ts, seq in sorted(rows, key=lambda r: (r[3], r[4])):
        mid, entry = common["mid"], not at["last_page_id"]
        gone = mid not in state or ts - state[mid] >= ttl
        if entry or gone or ts // 1000 != state[mid] // 1000:
            want.append(seq)
        if entry or gone:
            state[mid] = ts
    found = visits.unique_visits(pages(spark, rows), "literal", ttl_ms=ttl)
    assert seqs(found) == sorted(want)


def test_visits_of_no_rows(spark):
    assert visits.unique_visits(pages(spark, []), "literal", ttl_ms=10).count() == 0
    assert lateness.mark_late(pages(spark, []).withColumn("step", F.lit(1)), "step", 1, 1, 1).count() == 0


def test_neither_side_is_computed_twice(spark):
    seen = {n: spark.sparkContext.accumulator(0) for n in ("left", "right")}

    def counted(name):
        count = seen[name]

        def value(x):
            count.add(1)
            return x

        return F.udf(value, "long")

    rows = lambda n, name: spark.range(n, numPartitions=2).select(
        F.concat(F.lit("k"), F.col("id") % 2).alias("k"), F.col("id").alias("at"), counted(name)("id").alias(f"v_{name}")
    )
    met = as_of_join(rows(60, "left"), rows(40, "right"), ["k"], "at", ["v_right"], 8)
    got = {r.v_left: r.v_right for r in met.collect()}
    assert got == {i: i if i < 40 else 38 + i % 2 for i in range(60)}
    assert (seen["left"].value, seen["right"].value) == (60, 40)
