"""Plan properties that keep the operators fit for large and skewed tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weirhouse.plans import catalog
from weirhouse.operators import logs, stats, visits
from weirhouse.plans import tables as tb

SF = "/root/testdata/sf0.001"
# The warehouse's own queries; those of the llm subpackage may use Python.
BATCH = sorted(n for n in catalog.QUERIES if not n.startswith("stream_"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for node in ("Cartesian", "NestedLoop", "Python", "SinglePartition", "InPandas"):
        assert node not in plan, node


@pytest.fixture
def pages_table(spark, tmp_path):
    tb.pages(spark, SF).withColumn("displays", F.array(F.create_map(F.lit("a"), F.lit("b")))).write.parquet(
        str(tmp_path / "pages")
    )
    return spark.read.parquet(str(tmp_path / "pages"))


def read_schemas(plan):
    return re.findall(r"ReadSchema: (struct<.*)", plan)


def test_stats_read_only_the_leaves_they_use(spark, pages_table):
    found = read_schemas(plan_of(stats.visitor_stats(pages_table)))
    assert len(found) == 3
    for schema in found:
        assert "displays" not in schema and "page_id:" not in schema.replace("last_page_id", "")


def test_bounce_is_one_shuffle_by_visitor_and_slice(spark, pages_table):
    plan = plan_of(visits.bounces(pages_table))
    assert plan.count("Exchange") == 1 and "hashpartitioning(_mid" in plan and "_slot" in plan


def test_first_of_day_is_cut_before_the_shuffle(spark, pages_table):
    plan = plan_of(visits.unique_visits(pages_table))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange") == 1


def test_claims_are_filtered_in_the_scan(spark, pages_table):
    plan = plan_of(logs.correct_new_visitors(pages_table))
    assert plan.count("PushedFilters: [") >= 3 and "EqualTo(common.is_new,1)" in plan


def test_window_sums_are_partial_before_the_shuffle(spark, pages_table):
    plan = plan_of(stats.windowed(stats.page_measures(pages_table)))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "partial_max" in plan


def test_time_slices_compute_the_time_once(spark):
    from weirhouse.plans import replay

    at = [0, 1, 49, 50, 51, 99, 100, 101, None]
    rows = spark.createDataFrame([(x,) for x in at], "x long").withColumn("ts", F.hypot("x", F.lit(0)).cast("long") + 7)
    parts = [p["n"] for p in replay.time_slices({"n": (rows, "ts")}, 2)]
    assert [sorted(r.x for r in p.collect()) for p in parts] == [[0, 1, 49, 50], [51, 99, 100, 101]]
    for part in parts:
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        (condition,) = [line for line in plan.splitlines() if "Filter" in line]
        assert condition.count("HYPOT") == 1
