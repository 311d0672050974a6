"""The warehouse's records, seen in the benchmark tables.

``events`` serves as behaviour log, ``orders``/``lineitem`` as orders and their
details, the other tables as dimensions.  Whole tables, no sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirhouse import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(name: str):
    """Epoch milliseconds of a zone-less time taken as UTC, whatever the session zone."""
    since = F.col(name) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    part = lambda unit: F.date_part(F.lit(unit), since)
    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000 + F.floor(part("SECOND") * 1000).cast("bigint")


def _text(name: str):
    return F.substring(F.col(name).cast("string"), 1, 19)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, seq, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.struct(
            F.concat(F.lit("m"), user).alias("mid"),
            F.concat(F.lit("v"), user % 3).alias("vc"),
            F.concat(F.lit("ch"), seq % 4).alias("ch"),
            F.concat(F.lit("ar"), user % 5).alias("ar"),
            F.when(kind == "signup", "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.struct(
            kind.alias("page_id"),
            F.when(kind == "view", "").when(kind != "signup", "home").alias("last_page_id"),
            F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
        ).alias("page"),
        _millis("ts").alias("ts"),
        seq.alias("seq"),
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one page record."""
    return _events(spark, sf_dir).drop("k")


def arrivals(spark: SparkSession, sf_dir: str, together: int = 64, behind: int = 40) -> DataFrame:
    """Page records with the number of the delivery they came in, ``together`` of them at a time; every
    seventh or so came up to ``behind`` deliveries later."""
    e = _events(spark, sf_dir)
    late = F.when(F.col("k") % 7 == 0, F.col("k") % behind).otherwise(0)
    return e.withColumn("step", F.floor(F.col("seq") / together) + late).drop("k")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one raw log line.

    Errors become start records (even k) or broken text (odd k, in three
    shapes); clicks carry two displays.
    """
    e = _events(spark, sf_dir)
    k, is_error = F.col("k"), F.col("page.page_id") == "error"
    display = lambda n: F.create_map(
        F.lit("item"), (k + n).cast("string"), F.lit("order"), F.lit(str(n))
    )
    record = F.struct(
        "common",
        F.when(~is_error, F.col("page")).alias("page"),
        F.when(F.col("page.page_id") == "click", F.array(display(1), display(2))).alias("displays"),
        F.when(is_error, '{"entry":"icon"}').alias("start"),
        "ts",
    )
    text = F.to_json(record)
    broken = (
        F.when(k % 3 == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(k % 3 == 1, F.concat(text, F.lit(" tail")))
        .otherwise(F.substring(text, 1, 20))
    )
    return e.select(F.when(is_error & (k % 2 == 1), broken).otherwise(text).alias("value"), "seq")


def rich_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line that holds more than the known fields: objects, numbers, nested displays."""
    e, k = _events(spark, sf_dir), F.col("k")
    is_error = F.col("page.page_id") == "error"
    common = F.col("common").withField("os", F.concat(F.lit("os"), k % 3)).withField("uid", k)
    display = lambda n: F.struct((k + n).alias("item"), F.struct(F.lit(n).alias("x")).alias("pos"))
    record = F.struct(
        common.alias("common"),
        F.when(~is_error, F.col("page").withField("item", k)).alias("page"),
        F.when(F.col("page.page_id") == "click", F.array(display(1), display(2))).alias("displays"),
        F.when(is_error, F.struct(F.lit("icon").alias("entry"), k.alias("loading"))).alias("start"),
        F.struct((k % 7).alias("code")).alias("err"),
        "ts",
    )
    return e.select(F.to_json(record).alias("value"), "seq")


def order_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice").cast(schemas.MONEY)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        F.lit(0).cast(schemas.MONEY).alias("activity_reduce_amount"),
        F.lit(None).cast(schemas.MONEY).alias("coupon_reduce_amount"),
        total.alias("original_total_amount"),
        F.lit(5).cast(schemas.MONEY).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        _text("o_orderdate").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast(schemas.MONEY)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        price.alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"),
        _text("l_shipdate").alias("create_time"),
        price.alias("split_total_amount"),
        F.lit(None).cast(schemas.MONEY).alias("split_activity_amount"),
        F.lit(None).cast(schemas.MONEY).alias("split_coupon_amount"),
    )


def payment_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, up to twenty minutes after it."""
    paid = F.timestamp_add("SECOND", F.col("o_orderkey") % 1200, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1_000_000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_totalprice").cast(schemas.MONEY) - 1).cast(schemas.MONEY).alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("subject"),
        F.col("o_orderpriority").alias("payment_type"),
        F.substring(paid.cast("string"), 1, 19).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"),
    )


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six dimension tables, all text.  Some keys have no row, by nature of the tables."""
    text = lambda c: F.col(c).cast("string")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
    return {
        "dim_user_info": customer.select(
            text("c_custkey").alias("ID"),
            F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("GENDER"),
            born.cast("string").alias("BIRTHDAY"),
        ),
        "dim_base_province": nation.select(
            text("n_nationkey").alias("ID"),
            F.col("n_name").alias("NAME"),
            text("n_regionkey").alias("AREA_CODE"),
            F.concat(F.lit("CN-"), "n_nationkey").alias("ISO_CODE"),
            F.concat(F.lit("X-"), "n_nationkey").alias("ISO_3166_2"),
        ),
        "dim_sku_info": part.select(
            text("p_partkey").alias("ID"),
            text("p_size").alias("SPU_ID"),
            F.regexp_extract("p_brand", r"(\d+)", 1).alias("TM_ID"),
            (F.col("p_partkey") % 7).cast("string").alias("CATEGORY3_ID"),
        ),
        "dim_spu_info": supplier.select(text("s_suppkey").alias("ID"), F.col("s_name").alias("SPU_NAME")),
        "dim_base_trademark": nation.select(
            text("n_nationkey").alias("ID"), F.col("n_name").alias("TM_NAME")
        ),
        "dim_base_category3": table(spark, sf_dir, "region").select(
            text("r_regionkey").alias("ID"), F.col("r_name").alias("NAME")
        ),
    }


def _image(**cells):
    return F.create_map(*[x for n, c in cells.items() for x in (F.lit(n), c.cast("string"))])


def _message(topic: str, op, before, after, seq) -> list:
    body = F.struct(before.alias("before"), after.alias("after"), op.alias("op"))
    return [
        F.lit(topic).alias("topic"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        seq.alias("seq"),
    ]


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database changes: orders (all four operations), users, skus and spus."""
    none = F.lit(None).cast("map<string,string>")
    status = F.col("o_orderstatus")
    old = _image(id=F.col("o_orderkey"), status=F.lit("new"))
    new = _image(
        id=F.col("o_orderkey"), status=status, user_id=F.col("o_custkey"), coupon=F.lit(None).cast("string")
    )
    gone = (status == "P") & (F.col("o_orderpriority") == "5-LOW")
    op = F.when(gone, "d").when(status == "P", "r").when(status == "F", "u").otherwise("c")
    orders = table(spark, sf_dir, "orders").select(
        *_message(
            "srv.shop.order_info",
            op,
            F.when(gone | (status == "F"), old),
            F.when(~gone, new),
            F.col("o_orderkey"),
        )
    )
    simple = [
        ("customer", "user_info", "c", _image(id=F.col("c_custkey"), name=F.col("c_name"), seg=F.col("c_mktsegment")), "c_custkey"),
        ("part", "sku_info", "r", _image(id=F.col("p_partkey"), name=F.col("p_name")), "p_partkey"),
        ("supplier", "spu_info", "c", _image(id=F.col("s_suppkey"), name=F.col("s_name")), "s_suppkey"),
    ]
    out = orders
    for name, target, code, image, key in simple:
        out = out.unionByName(
            table(spark, sf_dir, name).select(
                *_message(f"srv.shop.{target}", F.lit(code), none, image, F.col(key))
            )
        )
    return out


def typed_change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted orders with cells of every JSON type, the price as a number and as text."""
    price = F.col("o_totalprice").cast("decimal(14,2)")
    cells = F.struct(
        F.col("o_orderkey").alias("id"),
        price.alias("price"),
        price.cast("string").alias("price_text"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.struct(F.array("o_custkey", F.lit(None)).alias("keys"), F.col("o_orderpriority").alias("priority")).alias("more"),
        F.lit(None).cast("string").alias("coupon"),
    )
    rows = table(spark, sf_dir, "orders")
    none = F.lit(None).cast("map<string,string>")
    return rows.select(*_message("srv.shop.order_info", F.lit("c"), none, cells, F.col("o_orderkey")))


# Routing rules of the example shop: (table, operation, kind of sink, sink, columns).
RULES = [
    ("order_info", "insert", "kafka", "dwd_order_info", "id,status,user_id"),
    ("order_info", "update", "kafka", "dwd_order_update", "id,status"),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name"),
    ("spu_info", "insert", "clickhouse", "spu_stats", "id"),
]


def rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({', '.join(repr(v) for v in r)}, NULL, NULL)" for r in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(schemas.RULE.names)})").select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.RULE.fields]
    )


def rule_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a write to the rule table; errors with k divisible by 3 delete."""
    e = _events(spark, sf_dir)
    deletes = (F.col("page.page_id") == "error") & (F.col("k") % 3 == 0)
    key = dict(
        source_table=F.concat(F.lit("t"), F.col("common.mid")),
        operate_type=F.element_at(
            F.array(F.lit("insert"), F.lit("update")), ((F.col("k") % 2) + 1).cast("int")
        ),
    )
    new = _image(
        **key,
        sink_type=F.lit("kafka"),
        sink_table=F.concat(F.lit("dwd_"), F.col("seq")),
        sink_columns=F.lit("id,name"),
    )
    none = F.lit(None).cast("map<string,string>")
    return e.select(
        *_message(
            "srv.config.table_process",
            F.when(deletes, "d").otherwise("u"),
            F.when(deletes, _image(**key)).otherwise(none),
            F.when(~deletes, new),
            F.col("seq"),
        )
    )


def rule_history_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message of the rule table about the shop's tables, in the order of ``seq``.

    Errors delete a rule; every eleventh message moves its rule from another table.
    """
    e, k = _events(spark, sf_dir), F.col("k")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (n + 1).cast("int"))
    tables = ("order_info", "user_info", "sku_info", "spu_info")
    operation = pick(F.col("seq") % 3, "insert", "update", "read")
    key = dict(source_table=pick(k % 4, *tables), operate_type=operation)
    new = _image(
        **key,
        sink_type=pick(k % 5, "hbase", "kafka", "kafka", "clickhouse", "kafka"),
        sink_table=F.concat(F.lit("sink_"), F.col("seq")),
        sink_columns=pick(F.col("seq") % 2, "id,status,name", "id,user_id,seg"),
    )
    moved_from = _image(source_table=pick((k + 1) % 4, *tables), operate_type=operation)
    none = F.lit(None).cast("map<string,string>")
    deletes, moves = F.col("page.page_id") == "error", F.col("seq") % 11 == 0
    before = F.when(deletes, _image(**key)).when(moves, moved_from).otherwise(none)
    return e.select(
        *_message("srv.config.table_process", F.when(deletes, "d").otherwise("u"), before, F.when(~deletes, new), F.col("seq"))
    )


def store_rule_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a rule that fills one of four dimension tables, in the order of ``seq``.

    Column lists differ by kind of event, and some lack the key.
    """
    e, k = _events(spark, sf_dir), F.col("k")
    number = F.col("seq") % 4
    new = _image(
        source_table=F.concat(F.lit("t"), number),
        operate_type=F.lit("insert"),
        sink_type=F.lit("hbase"),
        sink_table=F.concat(F.lit("dim_t"), number),
        sink_columns=F.concat(F.lit("name,"), F.col("page.page_id"), F.lit(",c"), k % 9, F.when(k % 2 == 0, F.lit(",code")).otherwise("")),
        sink_pk=F.when(number == 0, F.lit("code")),
    )
    none = F.lit(None).cast("map<string,string>")
    return e.select(*_message("srv.config.table_process", F.lit("u"), none, new, F.col("seq")))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order writes its customer's row; finished ones leave ``urgent`` alone."""
    finished = F.col("o_orderstatus") == "F"
    short = _image(id=F.col("o_custkey"), last_order=F.col("o_orderkey"))
    full = _image(
        id=F.col("o_custkey"), last_order=F.col("o_orderkey"), urgent=F.col("o_orderpriority")
    )
    return table(spark, sf_dir, "orders").select(
        F.when(finished, short).otherwise(full).alias("data"), F.col("o_orderkey").alias("seq")
    )


def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("last_order"),
        F.col("c_mktsegment").alias("urgent"),
    )
