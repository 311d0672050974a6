"""Landing: write an intermediate result once where several readers follow."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weirhouse.session import scratch_dir


def land(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet (by default to the shared scratch folder) and read back.

    Costly steps before it (parsing) run once, later readers get column pruning
    and pushed filters, and a lost executor does not repeat the steps before.
    """
    path = path or scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
