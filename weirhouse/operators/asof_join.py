"""As-of join: each row meets the last version of its key at its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    left: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Sequence[str],
    slice_size: int,
    order: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """``left`` plus the ``take`` columns of the key's last version with ``versions.at <= left.at`` (batch).

    ``at`` is a whole number on both sides (milliseconds, an offset); versions at one moment are told
    apart by ``order``.  A null key or a null ``at`` meets no version.  With ``how='inner'`` rows without a
    version are left out.

    Rows are grouped by key and slice of ``at``, so a key with a large share of the rows falls apart.  What
    is in force when a slice begins comes from the slices before it: one version per key and slice, by a
    partial aggregation, carried on over the key's slices that hold anything.  ``slice_size`` is to
    be chosen so that a key's rows of one slice fit a task; it does not change the result.
    """
    slot = F.floor(F.col(at) / slice_size)
    found = F.struct(*[F.col(f"`{c}`") for c in take])
    place = F.struct(F.col(at).alias("at"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    by = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    key_names = [f"_k{i}" for i in range(len(keys))]
    known = versions.select(*by, slot.alias("_slot"), place.alias("_place"), found.alias("_found"))
    known = known.dropna(subset=[*key_names, "_slot"])
    rows = left.select(*by, slot.alias("_slot"), F.col(at).alias("_at"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))

    # Dealt once; the carried versions and the windows both read what was dealt, so neither side is computed
    # twice.  Asking for the rows and times keeps these columns in both readings, without which those would differ.
    side = known.select(*key_names, "_slot", F.col("_place.at").alias("_at"), "_place", "_found")
    both = rows.unionByName(side, allowMissingColumns=True).repartition(*key_names, "_slot")
    lasts = F.max_by("_found", "_place").alias("_last")
    per_slot = both.groupBy(*key_names, "_slot").agg(lasts, F.count("_row").alias("_rows"), F.max("_at").alias("_until"))
    before = Window.partitionBy(*key_names).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slot.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).where("_rows > 0 AND _until IS NOT NULL")
    own = [*key_names, "_slot"]
    carried = carried.select(*[F.col(c).alias(f"{c}_own") for c in own], "_carried")

    # A version comes before the rows of its own moment.
    until = Window.partitionBy(*key_names, "_slot").orderBy("_at", F.col("_place").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_within", F.last("_found", ignorenulls=True).over(until)).where(F.col("_row").isNotNull())
    # No version has a null key, so nulls that meet bring nothing; plain equality would filter one reading only.
    met = within.join(carried, [F.col(c).eqNullSafe(F.col(f"{c}_own")) for c in own], "left")
    out = met.select("_row.*", F.coalesce("_within", "_carried").alias("_met"))
    out = out if how == "left" else out.where(F.col("_met").isNotNull())
    return out.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_met.`{c}`").alias(c) for c in take])
