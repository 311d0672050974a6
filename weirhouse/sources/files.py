"""Folders of any store Spark can write: whether the job that wrote one was committed, and their removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def is_complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def remove(spark: SparkSession, path: str) -> None:
    """The folder and all in it; nothing happens where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
