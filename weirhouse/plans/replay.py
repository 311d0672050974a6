"""Tables replayed as streams: event-time slices are fed one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirhouse.functions import times
from weirhouse.session import scratch_dir

NOW = {"availableNow": True}
SENTINEL = "sentinel"


class Replay:
    """Folders of one replay under the shared scratch folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def feed(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", "zstd").parquet(self.path(name))

    def source(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.readStream.schema(like.schema).parquet(self.path(name))

    def store(self, rows: DataFrame, name: str) -> StreamingQuery:
        return (
            rows.writeStream.option("checkpointLocation", self.path(f"{name}-checkpoint"))
            .trigger(**NOW)
            .format("parquet")
            .option("path", self.path(name))
            .start()
        )


def time_slices(inputs: dict[str, tuple[DataFrame, str]], count: int) -> list[dict[str, DataFrame]]:
    """Cut inputs, each with the name of its epoch-ms column, at common times."""
    bounds = None
    for rows, ts in inputs.values():
        b = rows.select(F.col(ts).alias("ts"))
        bounds = b if bounds is None else bounds.unionByName(b)
    low, high = bounds.agg(F.min("ts"), F.max("ts")).first()
    width = (high - low) // count + 1
    # the time is used once, as it may be a long expression
    part = lambda rows, ts, i: rows.filter(F.floor((F.col(ts) - low) / width) == i)
    return [{n: part(rows, ts, i) for n, (rows, ts) in inputs.items()} for i in range(count)]


def run_slices(
    replay: Replay,
    slices: Sequence[dict[str, DataFrame]],
    start: Callable[[], Iterable[StreamingQuery]],
    stateful: bool = True,
) -> None:
    """Feed a slice, run the queries until they have taken it, go on with the next.

    Every slice restarts the queries from their checkpoints.  ``start`` may be a
    generator: a query is started when the one before it has ended.  State is
    kept in at most two partitions per core, as its number cannot adapt later; queries
    that have none run with the session's number.
    """
    conf, key = replay.spark.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    if stateful:
        conf.set(key, str(min(int(before), 2 * replay.spark.sparkContext.defaultParallelism)))
    try:
        for inputs in slices:
            for name, rows in inputs.items():
                replay.feed(name, rows)
            for query in start():
                query.awaitTermination()
    finally:
        conf.set(key, before)


def sentinel_pages(pages: DataFrame) -> DataFrame:
    """One page record long after all others; it moves the watermark past them."""
    last = pages.agg(F.max(F.struct("ts", "seq", "common", "page")).alias("r")).select("r.*")
    return last.select(
        F.col("common").withField("mid", F.lit(SENTINEL)).alias("common"),
        "page",
        (F.col("ts") + 30 * times.DAY_MS).alias("ts"),
        (F.col("seq") + 1).alias("seq"),
    ).select(*pages.columns)


def sentinel_pair(pages: DataFrame) -> DataFrame:
    """Two entry pages of one visitor long after all others: the second settles the first."""
    one = sentinel_pages(pages).withColumn("page", F.col("page").withField("last_page_id", F.lit("")))
    two = one.withColumns({"ts": F.col("ts") + 30 * times.DAY_MS, "seq": F.col("seq") + 1})
    return one.unionByName(two)


def with_sentinel(slices: list[dict[str, DataFrame]], pages: DataFrame) -> list[dict[str, DataFrame]]:
    """The sentinel joins the last slice of every input."""
    last = sentinel_pages(pages)
    return slices[:-1] + [{n: rows.unionByName(last) for n, rows in slices[-1].items()}]


def replay_pages(
    spark: SparkSession,
    name: str,
    pages: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    count: int = 2,
) -> DataFrame:
    """Run a stateful page operator over replayed pages; its output without the sentinel."""
    replay = Replay(spark, name)
    slices = with_sentinel(time_slices({"pages": (pages, "ts")}, count), pages)
    run_slices(replay, slices, lambda: [replay.store(operator(replay.source("pages", pages)), "out")])
    return spark.read.parquet(replay.path("out")).filter(F.col("common.mid") != SENTINEL)
