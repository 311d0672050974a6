"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirhouse.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"

#: Bytes of words of letters and digits, A-Z lower-cased; all others become spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@cache
def _package_zip() -> str:
    """The package as a zip; a driver-local file, which Spark itself hands to the executors."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="weirhouse-"), "weirhouse_pkg.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("weirhouse", os.path.relpath(full, root)))
    return path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped and os.path.isdir(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))):
        spark.sparkContext.addPyFile(_package_zip())
        _shipped.add(app)


#: What empties the caches that operators keep in a Python worker between tasks.
caches: list[Callable[[], None]] = []


def drop_caches() -> None:
    """For tasks that need none of them: a reused worker keeps what earlier stages left."""
    for empty in caches:
        empty()
    pa.default_memory_pool().release_unused()


def quoted(name: str) -> str:
    """A column name of any letters, as one part."""
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def sliced(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts of ``batch`` with at most so many text bytes each (a longer text is alone)."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return batch.column(column).cast(pa.binary()).fill_null(b"").to_pylist()
