"""Wide orders and wide payments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.functions import times
from weirhouse.operators import dims as dim_ops
from weirhouse.operators.interval_join import interval_join


def order_infos(orders: DataFrame) -> DataFrame:
    """Add ``create_date``, ``create_hour`` and ``create_ts``; a bad time fails."""
    return orders.withColumns(
        {
            "create_date": times.create_date("create_time"),
            "create_hour": times.create_hour("create_time"),
            "create_ts": times.parse_time("create_time"),
        }
    )


def order_details(details: DataFrame) -> DataFrame:
    return details.withColumn("create_ts", times.parse_time("create_time"))


def _typed(df: DataFrame, sources: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """All fields of ``schema`` in order, from the named columns; those without one are null."""
    return df.selectExpr(
        *[
            f"CAST({sources.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def join_order_details(
    orders: DataFrame,
    details: DataFrame,
    lower_ms: int = -5_000,
    upper_ms: int = 5_000,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Orders with their details created near them, as wide rows without dimensions.

    ``expire_time``, ``operate_time`` and ``split_feight_fee`` stay null, as do
    the dimension columns until ``dims.lookup_all`` fills them.
    """
    return join_timed(order_infos(orders), order_details(details), lower_ms, upper_ms, lateness)


def join_timed(
    infos: DataFrame,
    details: DataFrame,
    lower_ms: int,
    upper_ms: int,
    lateness: str = "0 seconds",
    met: str | None = None,
) -> DataFrame:
    """``join_order_details`` of rows that have their ``create_ts``, as from ``order_infos`` and ``order_details``.

    Rows whose flag ``met`` is set on both sides met before and are not joined again.
    """
    left = _prefixed(infos, "o_").withColumn("o_et", times.event_time("o_create_ts"))
    right = _prefixed(details, "d_").withColumn("d_et", times.event_time("d_create_ts"))
    both = interval_join(
        left, right, "o_id", "d_order_id", "o_et", "d_et", lower_ms, upper_ms, lateness=lateness
    )
    if met:
        both = both.filter(~(F.col(f"o_{met}") & F.col(f"d_{met}")))
    from_order = (
        "order_status create_time create_date create_hour activity_reduce_amount"
        " coupon_reduce_amount original_total_amount feight_fee total_amount province_id user_id"
    ).split()
    from_detail = (
        "sku_id sku_name order_price sku_num split_activity_amount split_coupon_amount"
        " split_total_amount"
    ).split()
    sources = {"order_id": "o_id", "detail_id": "d_id"}
    sources |= {c: f"o_{c}" for c in from_order}
    sources |= {c: f"d_{c}" for c in from_detail}
    return _typed(both, sources, schemas.ORDER_WIDE)


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    dims: Mapping[str, DataFrame],
    as_of_ms: Column | int,
    lower_ms: int = -5_000,
    upper_ms: int = 5_000,
) -> DataFrame:
    """The whole wide order; ``as_of_ms`` is the moment ages are counted at."""
    wide = join_order_details(orders, details, lower_ms, upper_ms)
    return dim_ops.lookup_all(wide, dims, dim_ops.order_dims(as_of_ms))


def payment_wide(
    payments: DataFrame,
    wide_orders: DataFrame,
    lower_ms: int = -15 * 60_000,
    upper_ms: int = 5_000,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Payments with the order rows created shortly before them.

    Fields both have (``order_id``, ``user_id``, ``total_amount``) are the
    payment's; the two create times get names of their own.
    """
    left = _prefixed(payments, "p_").withColumn(
        "p_et", times.event_time(times.parse_time("p_create_time"))
    )
    right = _prefixed(wide_orders, "w_").withColumn(
        "w_et", times.event_time(times.parse_time("w_create_time"))
    )
    both = interval_join(
        left, right, "p_order_id", "w_order_id", "p_et", "w_et", lower_ms, upper_ms, lateness=lateness
    )
    sources = {c: f"w_{c}" for c in wide_orders.columns}
    sources |= {c: f"p_{c}" for c in payments.columns}
    sources |= {
        "payment_id": "p_id",
        "payment_create_time": "p_create_time",
        "order_create_time": "w_create_time",
    }
    return _typed(both, sources, schemas.PAYMENT_WIDE)
