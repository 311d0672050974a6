"""Change records and the rules that route them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirhouse import schemas
from weirhouse.functions import records
from weirhouse.operators.asof_join import as_of_join

# Sink kinds a rule may name; rows for the last one go nowhere.
SINK_STORE = "hbase"
SINK_TOPIC = "kafka"
SINK_ANALYTIC = "clickhouse"

RULE_COLUMNS = tuple(schemas.RULE.names)


def drop_empty(changes: DataFrame) -> DataFrame:
    """Changes without data (deletes) are left out."""
    return changes.filter(F.coalesce(F.size("data") > 0, F.lit(False)))


def _rule_of(m: str) -> dict:
    """Rule fields of a config row; its columns may be snake or camel case."""
    snake = {n: "".join("_" + ch.lower() if ch.isupper() else ch for ch in n) for n in RULE_COLUMNS}
    return {n: F.coalesce(F.col(m)[n], F.col(m)[snake[n]]).cast("string") for n in RULE_COLUMNS}


def rule_changes(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Change records of the rule table as rule rows plus ``removed`` and ``order``.

    A delete removes the rule of its ``before`` row, and so does an update that
    moves a rule to another key.
    """
    new, old = _rule_of("data"), _rule_of("before")
    row = lambda d, gone: F.struct(
        *[d[n].alias(n) for n in RULE_COLUMNS], F.lit(gone).alias("removed")
    )
    has_new, has_old = F.size("data") > 0, F.size("before") > 0
    moved = ~(
        new["sourceTable"].eqNullSafe(old["sourceTable"]) & new["operateType"].eqNullSafe(old["operateType"])
    )
    rows = F.filter(
        F.array(
            F.when(has_old & (~has_new | moved), row(old, True)),
            F.when(has_new, row(new, False)),
        ),
        lambda r: r.isNotNull(),
    )
    return changes.select(*order, F.explode(rows).alias("r")).select(*order, "r.*")


def latest_rules(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rule in force per table and operation: the last written, unless removed."""
    w = Window.partitionBy("sourceTable", "operateType").orderBy(*[F.col(c).desc() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(w))
        .filter("_rank = 1")
        .filter(~F.coalesce(F.col("removed"), F.lit(False)) if "removed" in rows.columns else F.lit(True))
        .select(*RULE_COLUMNS)
    )


def _cut_to_rule(rows: DataFrame) -> DataFrame:
    """Data cut to the columns of the rule beside it; rows without a rule keep theirs."""
    is_key = lambda k: (F.col("sinkType") == SINK_STORE) & (k == F.col("sinkPk"))
    keep = F.map_filter("data", lambda k, _: F.array_contains("_columns", k) | F.coalesce(is_key(k), F.lit(False)))
    cut = F.when(F.col("_columns").isNull(), F.col("data")).otherwise(keep)
    return rows.withColumn("data", cut).drop("_columns")


def _sink_of_rule() -> list[Column | str]:
    return ["sinkType", "sinkTable", F.split("sinkColumns", ",").alias("_columns"), F.coalesce("sinkPk", F.lit("id")).alias("sinkPk")]


def attach_rules(changes: DataFrame, rules: DataFrame, how: str = "inner") -> DataFrame:
    """Add the sink of each change and cut its data to the rule's columns.

    Column names are compared as written, without trimming.  Rows for the store
    keep their key column in any case.  ``rules`` has one row per (table,
    operation); Spark picks the join by its statistics.
    Changes without a rule are dropped unless ``how='left'``.
    """
    r = rules.select(F.col("sourceTable").alias("_table"), F.col("operateType").alias("_type"), *_sink_of_rule())
    matches = (F.col("tableName") == F.col("_table")) & (F.col("type") == F.col("_type"))
    return _cut_to_rule(changes.join(r, matches, how).drop("_table", "_type"))


def attach_rules_as_of(
    changes: DataFrame,
    history: DataFrame,
    at: str,
    slice_size: int,
    order: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """As ``attach_rules``, each change with the rule that was in force when it arrived (batch).

    ``history`` holds all rule rows ever written, as ``rule_changes`` gives them; ``at`` is the moment of
    arrival on both sides, and a rule applies from its own moment on, until one for the same table and
    operation follows or removes it.  A change that came before its first rule has none.
    """
    versions = history.select(
        F.col("sourceTable").alias("tableName"),
        F.col("operateType").alias("type"),
        at,
        *order,
        *_sink_of_rule(),
        F.coalesce("removed", F.lit(False)).alias("_removed"),
    )
    take = ["sinkType", "sinkTable", "_columns", "sinkPk", "_removed"]
    # What is removed comes before what is put at the same moment of one message.
    met = as_of_join(changes, versions.withColumn("_puts", ~F.col("_removed")), ["tableName", "type"], at, take, slice_size, [*order, "_puts"])
    live = ~F.coalesce(F.col("_removed"), F.lit(True))
    met = met.withColumns({c: F.when(live, F.col(c)) for c in ("sinkType", "sinkTable", "_columns", "sinkPk")})
    return _cut_to_rule((met if how == "left" else met.where(live)).drop("_removed"))


def topic_rows(routed: DataFrame) -> DataFrame:
    """Fact rows: the target topic and the data alone, as JSON."""
    return routed.filter(F.col("sinkType") == SINK_TOPIC).select(
        F.col("sinkTable").alias("topic"), F.to_json("data").alias("value")
    )


def store_rows(routed: DataFrame) -> DataFrame:
    """Rows for the dimension store."""
    return routed.filter(F.col("sinkType") == SINK_STORE)


def unrouted(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """How many changes reach no sink, by table, operation and reason.

    A change for the store without a value of its key column can't be merged and counts too.
    """
    no_key = (F.col("sinkType") == SINK_STORE) & F.try_element_at("data", F.col("sinkPk")).isNull()
    why = (
        F.when(F.col("sinkType").isNull(), F.lit("no rule"))
        .when(no_key, F.lit("no key"))
        .otherwise(F.concat(F.lit("sink type "), F.col("sinkType")))
    )
    return (
        attach_rules(changes, rules, "left")
        .filter(no_key | ~F.coalesce(F.col("sinkType").isin(SINK_STORE, SINK_TOPIC), F.lit(False)))
        .groupBy("tableName", "type", why.alias("reason"))
        .agg(F.count("*").alias("changes"))
    )


def sink_columns(rule_columns: str) -> list[str]:
    return records.split_columns(rule_columns)
