"""Topics: Kafka in production, folders of Parquet files where there is no broker."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from weirhouse.sources import files


@dataclass(frozen=True)
class TopicSpec:
    """One topic.

    ``path`` names a folder of Parquet files with a text column ``value``, plus
    a partition column ``topic`` when the folder holds several topics (then
    ``name`` picks one).  Otherwise ``servers`` are Kafka bootstrap servers.
    ``options`` go to the reader or writer unchanged.
    """

    name: str
    path: str | None = None
    servers: str | None = None
    group: str | None = None
    shared: bool = False
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.path) == bool(self.servers):
            raise ValueError("a topic needs either a path or servers")

    def kafka_options(self) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.servers}
        if self.group:
            opts["kafka.group.id"] = self.group
        return opts | dict(self.options)


# Columns that identify and order the messages of a topic, after the event time.
ARRIVAL = ("part", "offset")


def read_topic(spark: SparkSession, spec: TopicSpec, streaming: bool = True) -> DataFrame:
    """The topic's messages as text in ``value``, with ``part``, ``offset`` and ``arrived``.

    The first two identify a message: Kafka's partition and offset, or a file and a
    row of it, where files sort by the time they were written.  ``arrived`` is the epoch
    millisecond of the message, or of its file; it orders messages of several topics.
    """
    reader = spark.readStream if streaming else spark.read
    if spec.path:
        schema = "value string, topic string" if spec.shared else "value string"
        rows = (
            reader.schema(schema)
            .option("recursiveFileLookup", str(not spec.shared).lower())
            .options(**spec.options)
            .format("parquet")
            .load(spec.path)
        )
        if spec.shared:
            rows = rows.filter(F.col("topic") == spec.name)
        return rows.select(
            "value",
            F.concat_ws(
                " ",
                F.lpad(F.unix_millis("_metadata.file_modification_time").cast("string"), 15, "0"),
                F.col("_metadata.file_path"),
            ).alias("part"),
            F.col("_metadata.row_index").alias("offset"),
            F.unix_millis("_metadata.file_modification_time").alias("arrived"),
        )
    rows = reader.format("kafka").option("subscribe", spec.name).options(**spec.kafka_options()).load()
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("part"),
        "offset",
        F.unix_millis("timestamp").alias("arrived"),
    )


def write_topic(rows: DataFrame, spec: TopicSpec, checkpoint: str) -> DataStreamWriter:
    """Stream writer of ``value`` to one topic, or with ``topic`` in the rows to many.

    The caller sets the trigger and starts it.  The file form is exactly-once,
    Kafka's at-least-once.
    """
    many = "topic" in rows.columns
    out = (
        rows.select("value", *(["topic"] if many else []))
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if spec.path:
        out = out.format("parquet").option("path", spec.path)
        return out.partitionBy("topic") if many else out
    out = out.format("kafka").options(**spec.kafka_options())
    return out if many else out.option("topic", spec.name)


def write_batch(rows: DataFrame, spec: TopicSpec, batch_id: int | None = None) -> None:
    """Write one batch of ``value``, or with ``topic`` in the rows to many topics.

    For ``foreachBatch``: with a ``batch_id`` the file form writes a folder of its
    own and does nothing when that is complete, so a batch that runs again adds
    no second copy.  Rows for many topics are rebalanced first: a dominant topic
    gets several writers and a small one a single file.
    """
    many = "topic" in rows.columns
    rows = rows.select("value", *(["topic"] if many else []))
    if spec.path:
        path = spec.path if batch_id is None else f"{spec.path.rstrip('/')}/batch={batch_id}"
        if batch_id is not None and files.is_complete(rows.sparkSession, path):
            return
        if many:
            rows.hint("rebalance", "topic").write.mode("overwrite").partitionBy("topic").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return
    out = rows.write.format("kafka").options(**spec.kafka_options())
    (out if many else out.option("topic", spec.name)).save()
