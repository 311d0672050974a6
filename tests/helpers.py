"""Small builders of records for the tests."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from weirhouse import schemas

PAGES = T.StructType([*schemas.page_schema().fields, T.StructField("seq", T.LongType())])


def page(mid, ts, seq=0, last="home", is_new="0", page_id="p", during=1, ch="c", displays=None):
    return (
        {"mid": mid, "vc": "v", "ch": ch, "ar": "a", "is_new": is_new},
        {"page_id": page_id, "last_page_id": last, "during_time": during},
        displays,
        ts,
        seq,
    )


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def lines(spark, texts):
    texts = [t if isinstance(t, str) or t is None else json.dumps(t) for t in texts]
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq bigint")


def seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())
