"""Database change records in Debezium's JSON form.

Row images are maps of VARIANT cells, so a cell keeps the JSON type it was sent with: numbers stay
numbers, nested values stay nested, and text that looks like a number stays text.  A number of
more than 38 digits becomes a double, and a decimal loses trailing zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirhouse import schemas
from weirhouse.functions import records
from weirhouse.session import allow_repeated_names

# Operation codes of the change format and the names used here.
OPERATIONS = {"c": "insert", "r": "read", "u": "update", "d": "delete"}

_IMAGE = T.MapType(T.StringType(), T.VariantType())
_BODY = T.StructType(
    [T.StructField("before", _IMAGE), T.StructField("after", _IMAGE), T.StructField("op", T.StringType())]
)
_ENVELOPE = T.StructType([*_BODY.fields, T.StructField("payload", _BODY)])
_CHANGE = T.StructType(
    [T.StructField(f.name, _IMAGE if f.name in ("data", "before") else f.dataType) for f in schemas.CHANGE.fields]
)


def normalize_cdc(messages: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """Change messages to the common envelope; other input columns stay.

    ``database`` and ``tableName`` are the second and third part of the topic
    name.  A missing row image is an empty map, and null columns are left out of
    an image.  Of a repeated name the last value holds.  A message wrapped in ``payload`` is
    unwrapped.  Bad messages and unknown operations fail the job.
    """
    allow_repeated_names(messages.sparkSession)
    rest = [c for c in messages.columns if c not in (topic, value)]
    parsed = records.parse_object(messages, _ENVELOPE, value)
    parts = F.split(F.col(topic), r"\.")
    empty = F.create_map().cast(_IMAGE)
    image = lambda m: F.coalesce(records.last_keys(m, "variant"), empty)
    names = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    bad = F.raise_error(F.concat(F.lit("bad change record: "), F.coalesce(F.col(value), F.lit("null"))))
    ok, record = F.col("record_ok"), F.col("record")
    body = F.when(record["payload"].isNotNull(), record["payload"]).otherwise(
        F.struct(*[record[n].alias(n) for n in _BODY.names])
    )

    def envelope(b: Column) -> Column:
        kind = F.try_element_at(names, b["op"])
        return F.struct(
            F.when(ok & kind.isNotNull(), kind).otherwise(bad.cast("string")).alias("type"),
            image(b["after"]).alias("data"),
            image(b["before"]).alias("before"),
        )

    # a generator, as in parse_object: the images are built once per message
    return parsed.select(
        *rest,
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("tableName"),
        F.inline(F.transform(F.array(body), envelope)),
    )


def parse_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Envelopes from topic text; broken text is dropped."""
    allow_repeated_names(lines.sparkSession)
    rest = [c for c in lines.columns if c != value]
    return (
        records.parse_object(lines, _CHANGE, value)
        .filter("record_ok")
        .select(*rest, "record.*")
        .withColumns({m: records.last_keys(F.col(m), "variant") for m in ("data", "before")})
    )


def column_types(changes: DataFrame, *by: str) -> DataFrame:
    """The type of each column of each table, one that fits all cells sent; one partial aggregate."""
    keys = [*(by or ("tableName",)), "column"]
    cells = changes.select(*keys[:-1], F.explode("data").alias("column", "_cell"))
    return cells.groupBy(*keys).agg(F.schema_of_variant_agg("_cell").alias("type"))
