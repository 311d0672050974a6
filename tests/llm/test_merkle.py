"""The Merkle manifest against a tree built in plain Python."""

import brute
import pytest
from pyspark.sql import functions as F

from weirhouse.llm import merkle, ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, grp string, node string, block string, total int, proof string, members int, _salt int"


def rows_of(n):
    langs = ["en", "en", "en", "de", None, "", "fr ü"]
    rows = [(k, f"text {k}\n" * (k % 3), langs[k % 5], "s" if k % 2 else None, k if k % 4 else None) for k in range(n)]
    # null ids, an id twice, equal rows, a lone empty group, a lone group of other letters, a long text
    return rows + [(None, None, "en", None, None), (None, "x", "en", "s", 1), (3, "y", "en", "s", 1), (3, "y", "en", "s", 1), (3, "z", "en", "s", 1), (9, "", "", "", 0), (8, "ab " * 100_000, "fr ü", "s", 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", "n", "b", 2, "p", 3, 4) for r in rows], SCHEMA)


def plain(rows, arity):
    return sorted(((i, x, s, r, tuple(p)) for i, x, s, r, p in brute.manifest([(i, s, g, n, t) for i, t, g, s, n in rows], arity)), key=str)


def got(df):
    out = df.withColumn("proof", F.transform("proof", lambda s: F.struct(s["left"].cast("string"), s["right"].cast("string")))).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in out), key=str)


@pytest.mark.parametrize(("n", "arity", "depth"), [(120, 2, 1), (120, 2, 3), (121, 3, 2), (40, 2, 8), (1, 2, 2)])
def test_proofs(spark, n, arity, depth):
    rows = rows_of(n)
    df = merkle.manifest(frame(spark, rows), arity=arity, depth=depth)
    assert got(df) == plain(rows, arity)
    folded = df.select("root", merkle.fold(F.col("leaf"), F.col("proof")).alias("again")).distinct().collect()
    assert len(folded) == 1 and folded[0].root == folded[0].again


def test_one_row_and_none(spark):
    one = merkle.manifest(frame(spark, [(1, "a", None, None, None)])).first()
    assert one.leaf == one.subroot == one.root == brute.leaf((1, None, None, None, "a")) and one.proof == []
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_tampering_shows(spark):
    rows = rows_of(30)
    changed = F.when(F.col("doc_id") == 7, merkle.leaf(text=F.lit("other")))
    df = merkle.manifest(frame(spark, rows), carry={"changed": changed})
    bad = df.where(merkle.fold(F.coalesce("changed", "leaf"), F.col("proof")) != F.col("root"))
    assert [r.doc_id for r in bad.collect()] == [7]


def test_positions_of_equal_rows_are_spread(spark):
    rows = spark.range(0, 1000, 1, 8).select(F.lit("g").alias("g"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranked.positions(rows, ["g"], [F.col("x")], "equal")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.pos for r in placed.collect()) == list(range(1000)) and placed.where("total <> 1000").count() == 0
