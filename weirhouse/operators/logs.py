"""Behaviour logs: clean, correct the new-visitor flag, split by kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.functions import records
from weirhouse.session import allow_repeated_names


def clean_logs(lines: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """Parse log lines; adds the parsed columns and ``dirty``.

    Dirty are: text that is not one fitting JSON object, a record without
    ``common`` or ``common.mid``, and one that is neither a start record nor a
    page record with a ``page`` and a ``ts``.  Other input columns stay.
    """
    schema = schema or schemas.log_schema()
    parsed = records.parse_object(lines, schema, value)
    r = F.col("record")
    ts = r["ts"].try_cast("bigint")
    page = r["page"].withField("during_time", r["page"]["during_time"].try_cast("bigint"))
    is_start = F.coalesce(F.length(r["start"]) > 0, F.lit(False))
    usable = is_start | (r["page"].isNotNull() & ts.isNotNull())
    good = F.col("record_ok") & r["common"]["mid"].isNotNull() & usable
    known = {"page": page, "ts": ts}
    return parsed.select(
        *lines.columns,
        *[known.get(f.name, r[f.name]).alias(f.name) for f in schema.fields],
        (~F.coalesce(good, F.lit(False))).alias("dirty"),
    )


def good_logs(cleaned: DataFrame, value: str = "value", keep_text: bool = False) -> DataFrame:
    """The clean rows; ``keep_text`` leaves the raw line in, for ``split_rows``."""
    good = cleaned.filter(~F.col("dirty")).drop("dirty")
    return good if keep_text else good.drop(value)


def dirty_logs(cleaned: DataFrame, value: str = "value") -> DataFrame:
    """The side output: the raw text only."""
    return cleaned.filter("dirty").select(value)


def correct_new_visitors(logs: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Per ``mid`` keep ``is_new='1'`` on its first such record only (batch).

    ``order`` must be unique within a mid.  The first records are found with a
    rank limit that Spark also applies before its shuffle, and are joined back
    on the whole row identity: a mid holding a large share of the rows is
    spread over all partitions.  Records not claiming a new visitor never move.
    For streams see ``weirhouse.streaming.state.correct_new_visitors``.
    """
    flag = F.col("common.is_new")  # plain comparisons, which a Parquet scan takes over
    ident = ["_mid", *[f"_o{i}" for i in range(len(order))]]
    keys = [F.col("common.mid").alias("_mid"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]]

    claimed = logs.filter(flag == "1")
    first = Window.partitionBy("_mid").orderBy(*ident[1:])
    firsts = (
        claimed.select(*keys)
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .withColumn("_rank", F.lit(True))
    )
    rows, same = claimed.select("*", *keys), F.lit(True)
    for c in ident:  # a start record may lack its time
        same = same & rows[c].eqNullSafe(firsts[c])
    fixed = (
        rows.join(firsts, same, "left")
        .withColumn(
            "common",
            F.col("common").withField("is_new", F.when(F.col("_rank"), F.lit("1")).otherwise(F.lit("0"))),
        )
        .select(*logs.columns)
    )
    return logs.filter((flag != "1") | flag.isNull()).unionByName(fixed)


def is_start(logs: DataFrame) -> Column:
    return F.coalesce(F.length(logs["start"]) > 0, F.lit(False))


def start_logs(logs: DataFrame) -> DataFrame:
    """Records with a non-empty ``start``."""
    return logs.filter(is_start(logs))


def page_logs(logs: DataFrame) -> DataFrame:
    """The rest.  Each display carries the ``page_id`` of its page here too."""
    tagged = F.transform("displays", lambda d: records.put(d, "page_id", F.col("page.page_id")))
    has_any = F.col("displays").isNotNull() & (F.size("displays") > 0)
    pages = logs.filter(~is_start(logs))
    return pages.withColumn("displays", F.when(has_any, tagged).otherwise(F.col("displays"))).drop("start")


def display_logs(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per display of ``page_logs`` output; ``keep`` carries columns along."""
    return pages.select(*keep, F.explode("displays").alias("display"))


_FIELDS = "map<string,variant>"


def _whole_records(logs: DataFrame, text: str) -> DataFrame:
    """Adds ``_whole`` and ``_shown``: the line's whole record and displays as JSON, whatever else they
    hold.  Only what the split changes differs from the line; an unchanged line stays as it is."""
    page_id, flag = F.col("page.page_id"), F.col("common.is_new")
    allow_repeated_names(logs.sparkSession)
    # Out of a generator, so that the text is parsed once.
    rows = logs.select("*", F.inline(F.array(F.struct(F.try_parse_json(text).alias("_v")))))
    part = lambda path, kind=_FIELDS: F.try_variant_get("_v", path, kind)
    top = part("$")
    common = records.put(part("$.common"), "is_new", flag, "variant")
    page = F.map_filter(part("$.page"), lambda k, _: k != "during_time")
    shown = F.transform(part("$.displays", f"array<{_FIELDS}>"), lambda d: records.put(d, "page_id", page_id, "variant"))
    new_flag = ~part("$.common.is_new", "string").eqNullSafe(flag)
    no_number = F.col("page.during_time").isNull() & F.coalesce(F.length(part("$.page.during_time", "string")) > 0, F.lit(False))
    tagged = ~is_start(logs) & F.coalesce(F.size(shown) > 0, F.lit(False))
    for changed, key, new in ((new_flag, "common", common), (no_number, "page", page), (tagged, "displays", shown)):
        top = F.when(changed, records.put(top, key, F.to_variant_object(new), "variant")).otherwise(top)
    whole = F.when(new_flag | no_number | tagged, F.to_json(top)).otherwise(F.col(text))
    known = F.col("_v").isNotNull()
    return rows.withColumns(
        {"_whole": F.when(known, whole), "_shown": F.when(known, F.transform(shown, lambda d: F.to_json(d)))}
    ).drop("_v")


def split_rows(logs: DataFrame, start: str, page: str, display: str, text: str | None = None) -> DataFrame:
    """All three outputs in one pass: rows of target ``topic`` and JSON ``value``.

    ``logs`` are good, corrected logs; the names are those of the target topics.
    With ``text``, the column of the raw lines, the whole records go on, with fields this package does not
    know and with their JSON types; of a repeated name the last value, where the line is changed.  Else the known
    fields do.
    """
    if text is not None:
        logs = _whole_records(logs, text)
    tagged = F.transform("displays", lambda d: records.put(d, "page_id", F.col("page.page_id")))
    first = logs.withColumn("_start", is_start(logs)).withColumn(
        "displays",
        F.when(~F.col("_start") & (F.size("displays") > 0), tagged).otherwise(F.col("displays")),
    )
    fields = [c for c in ("common", "page", "displays", "start", "ts") if c in logs.columns]
    whole = F.to_json(F.struct(*fields))
    each = F.transform(F.coalesce("displays", F.array().cast("array<map<string,string>>")), lambda d: F.to_json(d))
    if text is not None:
        whole, each = F.coalesce("_whole", whole), F.coalesce("_shown", each)
    to = lambda topic, value: F.struct(F.lit(topic).alias("topic"), value.alias("value"))
    shown = F.transform(each, lambda d: to(display, d))
    rows = F.when(F.col("_start"), F.array(to(start, whole))).otherwise(
        F.concat(F.array(to(page, whole)), shown)
    )
    return first.select(F.explode(rows).alias("r")).select("r.topic", "r.value")
