"""Relational reads and the analytic-store sink.

Written against Spark's JDBC source; no driver jar ships with this package.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from weirhouse.functions import records


def read_jdbc(
    spark: SparkSession,
    url: str,
    sql: str,
    camel_case: bool = False,
    driver: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a query as text, optionally with lowerCamel column names.

    ``split`` is (column, lower, upper, parts): parallel range reads of a large
    result instead of one connection.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if driver:
        reader = reader.option("driver", driver)
    if split:
        column, lower, upper, parts = split
        reader = (
            reader.option("dbtable", f"({sql}) q")
            .option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", parts)
        )
    else:
        reader = reader.option("query", sql)
    rows = records.as_strings(reader.load())
    return records.rename_lower_camel(rows) if camel_case else rows


def sink_rows(rows: DataFrame, columns: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """The columns to insert, in declared order, without those marked as not stored."""
    return rows.select(*[c for c in columns if c not in set(exclude)])


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    columns: Sequence[str],
    exclude: Sequence[str] = (),
    batch_size: int = 1000,
    driver: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Append a batch; statements of ``batch_size`` rows are sent together."""
    writer = (
        sink_rows(rows, columns, exclude)
        .write.mode("append")
        .format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .options(**(options or {}))
    )
    if driver:
        writer = writer.option("driver", driver)
    writer.save()
