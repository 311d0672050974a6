"""JSON records: parsing with a validity flag, maps, serialising, names."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text_schema(kind: T.DataType) -> T.DataType:
    """``kind`` with its numbers read as text, at the top and inside structs."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _text_schema(f.dataType)) for f in kind.fields])
    return T.StringType() if isinstance(kind, T.NumericType) else kind


def _typed(c: Column, kind: T.DataType) -> Column:
    if kind == _text_schema(kind):
        return c
    if isinstance(kind, T.StructType):
        fields = [_typed(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.try_cast(kind)


def _fits(c: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether every number in ``c`` is one, as ``typed`` has it; empty text counts as none."""
    if kind == _text_schema(kind):
        return F.lit(True)
    if isinstance(kind, T.StructType):
        return reduce(and_, [_fits(c[f.name], typed[f.name], f.dataType) for f in kind.fields])
    if isinstance(kind, T.DecimalType):  # a number with more digits than the type keeps does not fit
        return c.isNull() | (c == "") | F.coalesce(typed == c.try_cast(T.DecimalType(38, 18)), F.lit(False))
    return c.isNull() | (c == "") | typed.isNotNull()


def parse_object(df: DataFrame, schema: T.StructType, value: str = "value", into: str = "record") -> DataFrame:
    """Add ``into`` (struct) and ``<into>_ok`` (boolean) from the JSON text ``value``.

    A row is fine when its text is exactly one JSON object that fits the schema.
    Spark's parser stops after the first value and so would take text with a
    tail; wrapping the line as the only element of an array exposes that.  A text
    that holds a closing bracket may close the array itself, so it must parse inside
    an object as well: no text can close both.  Others are parsed once.
    Numbers may be quoted, as in records made of text maps.

    The result comes out of a generator on purpose: the optimizer does not move
    filters or copies of an expression through one, so a text is parsed once
    however often its fields are used.
    """
    wrapped = T.StructType(
        [T.StructField("r", T.ArrayType(_text_schema(schema))), T.StructField("_bad", T.StringType())]
    )
    text = _col(value)
    once = F.concat(F.lit('{"r":['), text, F.lit("]}"))
    twice = F.concat(F.lit('{"r":['), text, F.lit('],"s":{"x":'), text, F.lit("}}"))
    parsed = F.from_json(
        F.when(F.contains(text, F.lit("]")), twice).otherwise(once),
        wrapped,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )

    def cast(p: Column) -> Column:
        first = F.get(p["r"], F.lit(0))
        one = p["_bad"].isNull() & (F.size(p["r"]) == 1) & first.isNotNull()
        return F.struct(first.alias("text"), _typed(first, schema).alias("typed"), one.alias("one"))

    def outcome(o: Column) -> Column:  # of its own, so that a number is cast once
        ok = o["one"] & _fits(o["text"], o["typed"], schema)
        return F.struct(o["typed"].alias(into), F.coalesce(ok, F.lit(False)).alias(f"{into}_ok"))

    return df.select("*", F.inline(F.transform(F.transform(F.array(parsed), cast), outcome)))


def parse_or_drop(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse and keep only good rows, one column per schema field."""
    return parse_object(df, schema, value).filter("record_ok").select("record.*")


def parse_strict(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse; text that is not one object of this schema fails the job."""
    bad = F.raise_error(F.concat(F.lit("bad record: "), F.coalesce(_col(value), F.lit("null"))))
    checked = F.when(F.col("record_ok"), F.col("record")).otherwise(bad.cast(schema))
    return parse_object(df, schema, value).select(checked.alias("record")).select("record.*")


def to_record(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as one JSON object; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(value))


def put(m: Column, key: str, value: Column, kind: str = "string") -> Column:
    """``m``, whose values are of ``kind``, with ``key`` set.

    A parsed map may hold a key twice, which Spark's map builders reject; the
    last one wins here.
    """
    keys = F.map_keys(m)
    kept = F.filter(
        F.map_entries(m),
        lambda e, i: (e["key"] != F.lit(key))
        & (F.size(keys) - F.array_position(F.reverse(keys), e["key"]) == i),
    )
    entry = F.struct(F.lit(key).alias("key"), value.cast(kind).alias("value"))
    return F.map_from_entries(F.concat(kept, F.array(entry)))


def last_keys(m: Column, kind: str = "string") -> Column:
    """``m``, whose values are of ``kind``, without null values, and with the last value of a repeated key."""
    keys = F.map_keys(m)
    is_null = lambda v: v.isNull() | F.is_variant_null(v) if kind == "variant" else v.isNull()
    last = F.map_from_entries(
        F.filter(
            F.map_entries(m),
            lambda e, i: ~is_null(e["value"])
            & (F.size(keys) - F.array_position(F.reverse(keys), e["key"]) == i),
        )
    )
    # most maps repeat no key: those need no search and no new map of keys
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_filter(m, lambda _, v: ~is_null(v))).otherwise(last)


def lower_camel(name: str) -> str:
    """``order_id`` to ``orderId``."""
    first, *rest = [w for w in name.lower().split("_")]
    return first + "".join(w[:1].upper() + w[1:] for w in rest)


def rename_lower_camel(df: DataFrame) -> DataFrame:
    return df.toDF(*[lower_camel(c) for c in df.columns])


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def split_columns(text: str) -> list[str]:
    """A comma list as written: no trimming, trailing empty names dropped."""
    return re.sub(r",+$", "", text).split(",")
