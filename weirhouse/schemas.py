"""Record shapes of the warehouse layers.

Money is ``decimal(18,2)``; event time is epoch milliseconds in ``ts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

COMMON_FIELDS = ("mid", "vc", "ch", "ar", "is_new")
PAGE_FIELDS = ("page_id", "last_page_id", "during_time")


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def log_schema(
    common_extra: Sequence[str] = (),
    page_extra: Sequence[str] = (),
    top_extra: Sequence[T.StructField] = (),
) -> T.StructType:
    """Parsing schema of one raw log line.

    Scalars are read as text, so ``1`` and ``"1"`` come out alike, and are cast
    later.  ``common`` and ``page`` are structs rather than maps: a Parquet scan
    then reads just the leaves a query touches.
    """
    return T.StructType(
        [
            T.StructField("common", _strings((*COMMON_FIELDS, *common_extra))),
            T.StructField("page", _strings((*PAGE_FIELDS, *page_extra))),
            T.StructField("displays", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
            T.StructField("start", T.StringType()),
            T.StructField("ts", T.StringType()),
            *top_extra,
        ]
    )


def page_schema() -> T.StructType:
    """One record of the page topic, after parsing."""
    return T.StructType(
        [
            T.StructField("common", _strings(COMMON_FIELDS)),
            T.StructField(
                "page",
                T.StructType(
                    [
                        T.StructField("page_id", T.StringType()),
                        T.StructField("last_page_id", T.StringType()),
                        T.StructField("during_time", T.LongType()),
                    ]
                ),
            ),
            T.StructField("displays", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
            T.StructField("ts", T.LongType()),
        ]
    )


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "money": MONEY,
    "texts": T.MapType(T.StringType(), T.StringType()),
}


def _ddl(text: str) -> T.StructType:
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CHANGE = _ddl(
    "database string, tableName string, type string,"
    " data texts, before texts"
)

RULE = _ddl(
    "sourceTable string, operateType string, sinkType string, sinkTable string,"
    " sinkColumns string, sinkPk string, sinkExtend string"
)

ORDER_INFO = _ddl(
    "id bigint, province_id bigint, order_status string, user_id bigint,"
    " total_amount money, activity_reduce_amount money,"
    " coupon_reduce_amount money, original_total_amount money,"
    " feight_fee money, expire_time string, create_time string, operate_time string"
)

ORDER_DETAIL = _ddl(
    "id bigint, order_id bigint, sku_id bigint, order_price money, sku_num bigint,"
    " sku_name string, create_time string, split_total_amount money,"
    " split_activity_amount money, split_coupon_amount money"
)

PAYMENT_INFO = _ddl(
    "id bigint, order_id bigint, user_id bigint, total_amount money, subject string,"
    " payment_type string, create_time string, callback_time string"
)

ORDER_WIDE = _ddl(
    "detail_id bigint, order_id bigint, sku_id bigint, order_price money,"
    " sku_num bigint, sku_name string, province_id bigint, order_status string,"
    " user_id bigint, total_amount money, activity_reduce_amount money,"
    " coupon_reduce_amount money, original_total_amount money,"
    " feight_fee money, split_feight_fee money,"
    " split_activity_amount money, split_coupon_amount money,"
    " split_total_amount money, expire_time string, create_time string,"
    " operate_time string, create_date string, create_hour string, province_name string,"
    " province_area_code string, province_iso_code string, province_3166_2_code string,"
    " user_age int, user_gender string, spu_id bigint, tm_id bigint, category3_id bigint,"
    " spu_name string, tm_name string, category3_name string"
)

# The payment record replaces the order's date columns with two create times.
PAYMENT_WIDE = T.StructType(
    _ddl(
        "payment_id bigint, subject string, payment_type string,"
        " payment_create_time string, callback_time string"
    ).fields
    + [
        T.StructField("order_create_time" if f.name == "create_time" else f.name, f.dataType)
        for f in ORDER_WIDE.fields
        if f.name not in ("expire_time", "operate_time", "create_date", "create_hour")
    ]
)

VISITOR_DIMS = ("ch", "ar", "is_new", "vc")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
VISITOR_STATS = ("stt", "edt", "vc", "ch", "ar", "is_new", *VISITOR_MEASURES, "ts")
