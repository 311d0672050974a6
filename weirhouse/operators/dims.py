"""Dimension lookup: attach columns of a keyed dimension table to facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse.functions import times


@dataclass(frozen=True)
class DimSpec:
    """How one dimension is attached.

    ``columns`` maps output names to a dimension column name or to a function
    from the dimension DataFrame to a Column.  Dimension values are text.
    """

    table: str
    fact_key: str
    columns: Mapping[str, str | Callable[[DataFrame], Column]]
    dim_key: str = "ID"


def _key(spec: DimSpec) -> str:
    return f"_{spec.table}_{spec.fact_key}"


def _picked(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """The dimension's key and the columns it brings."""
    key = F.col(spec.dim_key).cast("string").alias(_key(spec))
    return dim.select(key, *[(c(dim) if callable(c) else F.col(c)).alias(out) for out, c in spec.columns.items()])


def _attach(rows: DataFrame, picked: DataFrame, spec: DimSpec) -> DataFrame:
    brought = [c for c in picked.columns if c != _key(spec)]
    kept = [c for c in rows.columns if c not in brought]
    out_order = rows.columns + [c for c in brought if c not in rows.columns]
    return (
        rows.select(*kept)
        .join(picked, F.col(spec.fact_key).cast("string") == F.col(_key(spec)), "left")
        .select(*out_order)
    )


def lookup(facts: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Left join on the dimension's primary key; a missing row gives nulls.

    There is no broadcast hint on purpose.  Spark broadcasts the projected
    dimension when its size, estimated or measured by AQE, is under
    ``autoBroadcastJoinThreshold``; beyond it the join is a sort-merge join whose
    skewed fact partitions AQE splits.
    """
    return _attach(facts, _picked(dim, spec), spec)


def lookup_all(facts: DataFrame, dims: Mapping[str, DataFrame], specs: Sequence[DimSpec]) -> DataFrame:
    """Lookups in order; a later one may use a key an earlier one brought.

    Such an outer dimension is joined to the dimension that brings its key, before that one meets the
    facts: they are shuffled, where nothing is broadcast, once per key of their own.  Where two
    lookups bring a column of the same name, the later one holds, and all go over the facts.
    """
    brought = [c for spec in specs for c in spec.columns]
    order = list(dict.fromkeys([*facts.columns, *brought]))
    if len(set(brought)) < len(brought):
        for spec in specs:
            facts = lookup(facts, dims[spec.table], spec)
        return facts
    sides = [_picked(dims[spec.table], spec) for spec in specs]
    for i in reversed(range(len(specs))):
        # the columns of a side's own outer dimensions are there already, as those come later in the list
        inner = next((j for j in range(i) if specs[i].fact_key in specs[j].columns), None)
        if inner is None:
            continue
        sides[inner], sides[i] = _attach(sides[inner], sides[i], specs[i]), None
    for spec, side in zip(specs, sides, strict=True):
        if side is not None:
            facts = _attach(facts, side, spec)
    return facts.select(*order)


def order_dims(as_of_ms: Column | int) -> list[DimSpec]:
    """The six dimensions of the wide order; sku comes before its three outer tables."""
    long_of = lambda name: lambda dim: F.col(name).try_cast("bigint")
    return [
        DimSpec(
            "dim_user_info",
            "user_id",
            {"user_age": lambda dim: times.age_years("BIRTHDAY", as_of_ms), "user_gender": "GENDER"},
        ),
        DimSpec(
            "dim_base_province",
            "province_id",
            {
                "province_name": "NAME",
                "province_area_code": "AREA_CODE",
                "province_iso_code": "ISO_CODE",
                "province_3166_2_code": "ISO_3166_2",
            },
        ),
        DimSpec(
            "dim_sku_info",
            "sku_id",
            {
                "spu_id": long_of("SPU_ID"),
                "tm_id": long_of("TM_ID"),
                "category3_id": long_of("CATEGORY3_ID"),
            },
        ),
        DimSpec("dim_spu_info", "spu_id", {"spu_name": "SPU_NAME"}),
        DimSpec("dim_base_trademark", "tm_id", {"tm_name": "TM_NAME"}),
        DimSpec("dim_base_category3", "category3_id", {"category3_name": "NAME"}),
    ]
