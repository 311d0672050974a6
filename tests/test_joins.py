import random

import pytest
from pyspark.sql import functions as F

from weirhouse import schemas
from weirhouse.functions import sizes, times
from weirhouse.operators import dims, orders
from weirhouse.operators.interval_join import interval_join

T0 = 1_625_227_746_000


def sides(spark, left, right):
    mk = lambda rows, p: spark.createDataFrame(rows, f"{p}k string, {p}ms bigint").withColumn(
        f"{p}t", times.event_time(f"{p}ms")
    )
    return mk(left, "l"), mk(right, "r")


def joined(spark, left, right, lower, upper, **kw):
    a, b = sides(spark, left, right)
    out = interval_join(a, b, "lk", "rk", "lt", "rt", lower, upper, **kw)
    assert out.columns == ["lk", "lms", "lt", "rk", "rms", "rt"]
    return sorted((r["lk"], r["lms"], r["rms"]) for r in out.collect())


@pytest.mark.parametrize("bucket_ms", [None, 1, 333, 10**9])
def test_bounds_are_inclusive(spark, bucket_ms):
    right = [("a", T0 + d) for d in (-5001, -5000, -1, 0, 5000, 5001)] + [("b", T0), (None, T0)]
    if bucket_ms == 1:  # many buckets per row, so a narrow interval
        got = joined(spark, [("a", T0)], right, -1, 0, bucket_ms=1)
        assert [r - T0 for _, _, r in got] == [-1, 0]
        return
    got = joined(spark, [("a", T0), (None, T0)], right, -5000, 5000, bucket_ms=bucket_ms)
    assert [r - T0 for _, _, r in got] == [-5000, -1, 0, 5000]


def test_one_sided_interval(spark):
    got = joined(spark, [("a", T0)], [("a", T0 + d) for d in (-900_001, -900_000, 5_000, 5_001)], -900_000, 5_000)
    assert [r - T0 for _, _, r in got] == [-900_000, 5_000]
    assert joined(spark, [("a", T0)], [("a", T0), ("a", T0 + 1)], 0, 0) == [("a", T0, T0)]
    with pytest.raises(ValueError):
        joined(spark, [("a", T0)], [("a", T0)], 1, 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = lambda n: [(rnd.choice("aab"), T0 + rnd.randrange(-40_000, 40_000)) for _ in range(n)]
    left, right = rows(60), rows(80)
    want = sorted((k, t, u) for k, t in left for j, u in right if j == k and -2_000 <= u - t <= 500)
    assert want and joined(spark, left, right, -2_000, 500) == want


def test_dominant_key_is_cut_by_time(spark):
    """Rows of one key far apart never share a join bucket."""
    a = spark.range(2000).select(F.lit("hot").alias("lk"), times.event_time(F.col("id") * 60_000).alias("lt"))
    b = spark.range(2000).select(F.lit("hot").alias("rk"), times.event_time(F.col("id") * 60_000 + 1).alias("rt"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = interval_join(a, b, "lk", "rk", "lt", "rt", -5_000, 5_000)
        assert out.count() == 2000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        sides = [line for line in plan.splitlines() if "hashpartitioning(" in line]
        assert sides and all("_lb" in line or "_rb" in line for line in sides), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SPEC = dims.DimSpec("d", "k", {"name": "NAME", "size": lambda dim: F.col("SIZE").cast("int")})


def test_lookup_keeps_every_fact(spark):
    dim = spark.createDataFrame([("1", "one", "10"), ("3", None, "x")], "ID string, NAME string, SIZE string")
    dim = dim.withColumn("SIZE", F.col("SIZE").try_cast("int").cast("string"))
    facts = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old"), (3, "old"), (1, "old")], "k bigint, name string")
    out = dims.lookup(facts, dim, SPEC)
    assert out.columns == ["k", "name", "size"]
    rows = sorted(((r["k"] or 0), r["name"], r["size"]) for r in out.fillna({"name": "-", "size": 0}).collect())
    assert rows == [(0, "-", 0), (1, "one", 10), (1, "one", 10), (2, "-", 0), (3, "-", 0)]


def test_dominant_fact_key_is_split_at_run_time(spark):
    """Without broadcast the sort-merge lookup of a hot key becomes a skew join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        dim = spark.range(5000).select(
            F.col("id").cast("string").alias("ID"), F.col("id").cast("string").alias("NAME"), F.lit("1").alias("SIZE")
        )
        out = dims.lookup(facts, dim, SPEC)
        rows = out.collect()
        assert len(rows) == 60_000 and all(str(r["k"]) == r["name"] for r in rows)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _one_by_one(facts, tables, specs):
    for spec in specs:
        facts = dims.lookup(facts, tables[spec.table], spec)
    return facts


OUTER = [
    dims.DimSpec("item", "item_id", {"kind_id": "KIND", "owner_id": "OWNER"}),
    dims.DimSpec("kind", "kind_id", {"kind": "NAME", "above_id": "ABOVE"}),
    dims.DimSpec("kind", "above_id", {"above": "NAME"}),
    dims.DimSpec("owner", "owner_id", {"owner": "NAME"}),
]


@pytest.fixture
def outer_tables(spark):
    return {
        "item": spark.sql("SELECT * FROM VALUES ('1','7','x'), ('2','8',NULL), ('3',NULL,'y') AS t(ID, KIND, OWNER)"),
        "kind": spark.sql("SELECT * FROM VALUES ('7','seven','9'), ('9','nine','7'), ('8',NULL,'5') AS t(ID, NAME, ABOVE)"),
        "owner": spark.sql("SELECT * FROM VALUES ('x','ex') AS t(ID, NAME)"),
    }


def test_outer_dimensions_give_what_lookups_one_by_one_give(spark, outer_tables):
    facts = spark.sql("SELECT * FROM VALUES (10,1), (11,2), (12,3), (13,4), (14,NULL), (10,1) AS t(id, item_id)")
    shadowed = facts.withColumns({"kind_id": F.lit("8"), "owner": F.lit("mine")})
    same_name = [*OUTER[:2], dims.DimSpec("owner", "owner_id", {"kind": "NAME"})]
    for rows, specs in [(facts, OUTER), (shadowed, OUTER), (facts, same_name), (shadowed, OUTER[1:2])]:
        want, got = _one_by_one(rows, outer_tables, specs), dims.lookup_all(rows, outer_tables, specs)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_facts_meet_a_dimension_once_per_key_of_their_own(spark, outer_tables):
    facts = spark.range(10).select("id", F.col("id").alias("item_id"), F.col("id").alias("user_id"))
    users = outer_tables | {"user": spark.sql("SELECT '1' AS ID, 'one' AS NAME")}
    specs = [dims.DimSpec("user", "user_id", {"user": "NAME"}), *OUTER]
    plan, joins = dims.lookup_all(facts, users, specs)._jdf.queryExecution().optimizedPlan(), 0
    while not plan.children().isEmpty():
        joins += plan.nodeName() == "Join"
        plan = plan.children().head()
    assert joins == 2


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(10)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(sizes.broadcast_if_small(df, 10)) and not hinted(sizes.broadcast_if_small(df, 9))


def order(oid, at, user=1, province=1):
    return (oid, province, "1001", user, 100, 1, 2, 103, 5, "2030-01-01 00:00:00", at, "2030-01-01 00:00:00")


def money(rows, schema):
    from decimal import Decimal

    kinds = [f.dataType for f in schema.fields]
    return [tuple(Decimal(v) if k == schemas.MONEY and v is not None else v for v, k in zip(r, kinds)) for r in rows]


@pytest.fixture
def shop(spark):
    mk = lambda rows, schema: spark.createDataFrame(money(rows, schema), schema)
    infos = mk([order(1, "2021-07-02 20:09:06", user=11, province=3), order(2, "2021-07-02 20:09:06", user=99)], schemas.ORDER_INFO)
    details = mk(
        [(101, 1, 7, 50, 2, "sku7", "2021-07-02 20:09:11", 90, 3, 4), (102, 1, 8, 10, 1, "sku8", "2021-07-02 20:09:12", 10, 0, 0),
         (103, 2, 9, 1, 1, "sku9", "2021-07-02 20:09:01", 1, None, None)], schemas.ORDER_DETAIL)
    payments = mk([(900, 1, 12, 98, "s", "ali", "2021-07-02 20:24:06", "cb"), (901, 2, 99, 1, "s", "wx", "2021-07-02 20:24:07", "cb")], schemas.PAYMENT_INFO)
    table = lambda rows, cols: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols.split()))
    dim = {
        "dim_user_info": table([("11", "F", "2000-01-01 00:00:00")], "ID GENDER BIRTHDAY"),
        "dim_base_province": table([("3", "P3", "03", "CN-3", "CN-III")], "ID NAME AREA_CODE ISO_CODE ISO_3166_2"),
        "dim_sku_info": table([("7", "70", "71", "72"), ("9", "90", None, "")], "ID SPU_ID TM_ID CATEGORY3_ID"),
        "dim_spu_info": table([("70", "spu70")], "ID SPU_NAME"),
        "dim_base_trademark": table([("71", "tm71")], "ID TM_NAME"),
        "dim_base_category3": table([("72", "cat72")], "ID NAME"),
    }
    return infos, details, payments, dim


def test_wide_order(spark, shop):
    infos, details, _, dim = shop
    out = orders.order_wide(infos, details, dim, 946656000000 + 21 * times.YEAR_MS)
    assert out.schema.names == schemas.ORDER_WIDE.names and len(out.columns) == 35
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.ORDER_WIDE.fields]
    rows = {r["detail_id"]: r.asDict() for r in out.collect()}
    assert set(rows) == {101, 103}  # 102 came six seconds after its order
    r = rows[101]
    assert (r["order_id"], r["sku_num"], r["create_date"], r["create_hour"]) == (1, 2, "2021-07-02", "20")
    assert (r["user_age"], r["user_gender"], r["province_3166_2_code"]) == (21, "F", "CN-III")
    assert (r["spu_name"], r["tm_name"], r["category3_name"]) == ("spu70", "tm71", "cat72")
    assert r["total_amount"] == 100 and r["split_coupon_amount"] == 4
    assert r["expire_time"] is r["operate_time"] is r["split_feight_fee"] is None
    lost = rows[103]  # no user, no province, a sku whose own references are empty
    assert lost["spu_id"] == 90 and lost["category3_id"] is None
    assert all(lost[c] is None for c in ("user_age", "user_gender", "province_name", "spu_name", "tm_name"))


def test_wide_payment(spark, shop):
    infos, details, payments, dim = shop
    wide = orders.order_wide(infos, details, dim, 0)
    out = orders.payment_wide(payments, wide)
    assert out.schema.names == schemas.PAYMENT_WIDE.names and len(out.columns) == 36
    (r,) = out.collect()  # the second payment is one second too late
    assert (r["payment_id"], r["order_id"], r["user_id"], r["total_amount"]) == (900, 1, 12, 98)
    assert (r["payment_create_time"], r["order_create_time"]) == ("2021-07-02 20:24:06", "2021-07-02 20:09:06")
    assert r["detail_id"] == 101 and r["spu_name"] == "spu70" and r["callback_time"] == "cb"
