"""Dimension tables on Parquet, partitioned by a hash of the key.

A table is the folder ``<root>/<table>/_bucket=N``, one row per key.  An upsert merges a batch
into the buckets its keys fall in and replaces only those, so a read is one plain scan however
many batches there were, and an upsert costs what the touched buckets hold.  All values are text.

The rows of the touched buckets are written aside before any bucket is replaced.  A batch that
runs again after a crash, at whatever point, starts from there and ends at the same table.  A
reader that lists a table's files just before a batch replaces them fails on the missing file and
has to be run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse.functions import records

BUCKET = "_bucket"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class DimTable:
    """Name, columns and key of a dimension table, from its routing rule.

    ``buckets`` must stay the same for the life of a stored table; choose it so that a bucket
    holds a few hundred megabytes.
    """

    name: str
    columns: tuple[str, ...]
    pk: str = "id"
    extend: str = ""
    buckets: int = 32

    @staticmethod
    def of_rule(rule) -> "DimTable":
        """The rule's columns, and its key where they lack it: routing keeps the key in any case."""
        pk = "id" if rule["sinkPk"] is None else rule["sinkPk"]
        columns = records.split_columns(rule["sinkColumns"])
        return DimTable(
            rule["sinkTable"],
            tuple(columns if pk in columns else [*columns, pk]),
            pk,
            "" if rule["sinkExtend"] is None else rule["sinkExtend"],
        )

    @staticmethod
    def of_rules(rules) -> "dict[str, DimTable]":
        """Tables by name; one that several rules fill has the columns of all of them."""
        tables: dict[str, DimTable] = {}
        for new in map(DimTable.of_rule, rules):
            old = tables.setdefault(new.name, new)
            columns = dict.fromkeys((*old.columns, *new.columns))
            tables[new.name] = DimTable(old.name, tuple(columns), old.pk, old.extend)
        return tables

    def schema(self) -> T.StructType:
        """All text; the key column is not nullable."""
        return T.StructType([T.StructField(c, T.StringType(), c != self.pk) for c in self.columns])

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def create_sql(self, database: str, root: str | None = None) -> str:
        """Statement for a catalog table, over the stored one where ``root`` is given.

        Spark has no primary keys, so the key is a property.
        """
        cols = [f"{_quoted(c)} STRING" for c in self.columns]
        stored = ""
        if root is not None:
            cols.append(f"{_quoted(BUCKET)} INT")
            stored = f" PARTITIONED BY ({_quoted(BUCKET)}) LOCATION {_text(f'{root}/{self.name}')}"
        return (
            f"CREATE TABLE IF NOT EXISTS {_quoted(database)}.{_quoted(self.name)} ({', '.join(cols)}) USING parquet"
            f"{stored} TBLPROPERTIES ('weirhouse.pk'={_text(self.pk)}) {self.extend}".rstrip()
        )


def store_tables(rules: DataFrame, order: Sequence[str] = ()) -> dict[str, DimTable]:
    """The tables that rule rows for the store fill, with the columns of all rules in ``order``.

    Rules that say the same are brought together before they come to the driver, so a long
    history of rules gives no more rows than there are different rules.
    """
    said = ["sinkTable", "sinkColumns", "sinkPk", "sinkExtend"]
    place = F.min(F.struct(*order)) if order else F.lit(0)
    different = rules.groupBy(*said).agg(place.alias("_place"))
    return DimTable.of_rules(different.orderBy("_place", *said).collect())


def follow_rules(spark: SparkSession, tables: Iterable[DimTable], database: str, root: str) -> None:
    """Catalog tables over the store, as rules name them: new ones are created, others gain columns.

    A column that no rule names any more stays.
    """
    for table in tables:
        name = f"{_quoted(database)}.{_quoted(table.name)}"
        if not spark.catalog.tableExists(name):
            spark.sql(table.create_sql(database, root))
            continue
        has = {c.lower() for c in spark.table(name).columns}
        new = [c for c in table.columns if c.lower() not in has]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{_quoted(c)} STRING' for c in new)})")


def show_new_buckets(spark: SparkSession, tables: Iterable[DimTable], database: str) -> None:
    """Let the catalog see the buckets that batches added to the tables' folders."""
    for table in tables:
        name = f"{_quoted(database)}.{_quoted(table.name)}"
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)


def _cell(column: str) -> Column:
    """A cell of a change as text; nested values as JSON."""
    return F.try_element_at("data", F.lit(column)).cast("string")


def _last(value: Column, order: Column, present: Column) -> Column:
    """The value written last, among rows that wrote the column."""
    return F.max_by(F.when(present, F.struct(value.alias("v"))), F.when(present, order))["v"]


def merge(
    changes: DataFrame, table: DimTable, order: Sequence[str], current: DataFrame | None = None
) -> DataFrame:
    """Upsert change rows (``data`` maps) into ``current`` by key.

    A change sets the columns it holds and leaves the others.  One aggregation
    with partial results per task, so a key changed very often costs no skew.
    Rows without the key are left out.
    """
    place = F.struct(F.lit(1).alias("_new"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    cells = lambda src, has: [
        F.struct(src(c).alias("v"), has(c).alias("on")).alias(f"c{i}") for i, c in enumerate(table.columns)
    ]
    rows = changes.select(
        _cell(table.pk).alias("_pk"),
        place.alias("_place"),
        *cells(_cell, lambda c: F.map_contains_key("data", c)),
    ).filter(F.col("_pk").isNotNull())
    if current is not None:
        nothing = F.lit(None)
        order_types = {f.name: f.dataType for f in changes.schema.fields}
        old_place = F.struct(
            F.lit(0).alias("_new"),
            *[nothing.cast(order_types[c]).alias(f"_o{i}") for i, c in enumerate(order)],
        )
        rows = rows.unionByName(
            current.select(
                F.col(f"`{table.pk}`").alias("_pk"),
                old_place.alias("_place"),
                *cells(lambda c: F.col(f"`{c}`"), lambda c: F.lit(True)),
            )
        )
    return rows.groupBy("_pk").agg(
        *[
            _last(F.col(f"c{i}.v"), F.col("_place"), F.col(f"c{i}.on")).alias(c)
            for i, c in enumerate(table.columns)
        ]
    ).drop("_pk")


def _scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _stored(table: DimTable) -> T.StructType:
    return T.StructType([*table.schema().fields, T.StructField(BUCKET, T.IntegerType())])


def read(spark: SparkSession, root: str, table: DimTable) -> DataFrame:
    """The table, one row per key; without rows where no batch has filled it."""
    rows = _scan(spark, f"{root}/{table.name}", _stored(table))
    return spark.createDataFrame([], table.schema()) if rows is None else rows.drop(BUCKET)


def _stage(changes: DataFrame, root: str, table: DimTable, batch_id: int, order: Sequence[str], buckets: list[int]) -> str:
    """Write the touched buckets as they will be, beside the table; its folder."""
    spark = changes.sparkSession
    staged, ready = f"{root}/_staged/{table.name}", f"{root}/_ready/{table.name}"
    last = _scan(spark, ready, T.StructType([T.StructField("batch", T.LongType())]))
    if last is not None and [r["batch"] for r in last.take(1)] == [batch_id]:
        return staged  # the table may be half replaced: it is not to be merged again
    current = _scan(spark, f"{root}/{table.name}", _stored(table))
    if current is not None:
        current = current.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
    merged = merge(changes, table, order, current).withColumn(BUCKET, table.bucket_of(F.col(_quoted(table.pk))))
    merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
    done = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
    done.coalesce(1).write.mode("overwrite").parquet(ready)
    return staged


def upsert(
    changes: DataFrame,
    root: str,
    tables: Iterable[DimTable],
    batch_id: int,
    order: Sequence[str],
    table_col: str = "sinkTable",
) -> list[DimTable]:
    """Store one micro-batch of changes (``data`` maps) for all tables; those that were touched.

    ``order`` tells the order of changes within the batch.  ``changes`` is read several times.  A
    batch that runs again adds nothing; the batches of one store are numbered by one checkpoint.
    Changes without their table's key are left out, those for a table that is not among
    ``tables`` fail the batch.
    """
    known = {t.name: t for t in tables}
    name = F.col(table_col)
    places = [F.when(name == t.name, t.bucket_of(_cell(t.pk))) for t in known.values()]
    keyed = [F.when(name == t.name, _cell(t.pk).isNotNull()) for t in known.values()]
    # at most one row per bucket of each table
    rows = changes.select(
        name.alias("name"),
        F.coalesce(*places, F.lit(-1)).alias("bucket"),
        F.coalesce(*keyed, F.lit(True)).alias("keyed"),
    )
    found = rows.where("keyed").groupBy("name").agg(F.collect_set("bucket").alias("buckets")).collect()
    unknown = sorted(str(r["name"]) for r in found if r["name"] not in known)
    if unknown:
        raise ValueError(f"no columns known for {unknown}")
    touched = []
    for r in sorted(found, key=lambda r: r["name"]):
        table = known[r["name"]]
        staged = _stage(changes.where(name == table.name), root, table, batch_id, order, sorted(r["buckets"]))
        whole = changes.sparkSession.read.schema(_stored(table)).parquet(staged)
        out = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
        out.parquet(f"{root}/{table.name}")
        touched.append(table)
    return touched
