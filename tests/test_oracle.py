"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from pyspark.sql.types import StructType

import __spark_entry__ as entry
from compare import differences
from weirhouse.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())


def test_each_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert differences(entry.queries()[name](spark, SF), entry.oracle_sql()[name], SF) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert isinstance(df.schema, StructType) and df.count() > 0
