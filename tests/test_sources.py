import pytest
from pyspark.sql import functions as F

from weirhouse.sources import dim_store, files, jdbc
from weirhouse.sources.landing import land
from weirhouse.sources.topics import TopicSpec, read_topic, write_batch, write_topic

NOW = {"availableNow": True}


def values(df):
    return sorted(r["value"] for r in df.collect())


def text(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_topic_needs_one_place():
    with pytest.raises(ValueError):
        TopicSpec("t")
    with pytest.raises(ValueError):
        TopicSpec("t", path="p", servers="s")
    spec = TopicSpec("t", servers="h:1", group="g", options={"startingOffsets": "earliest"})
    assert spec.kafka_options() == {
        "kafka.bootstrap.servers": "h:1", "kafka.group.id": "g", "startingOffsets": "earliest"}


def test_topic_from_stream_to_stream(spark, tmp_path):
    a, b = TopicSpec("a", path=str(tmp_path / "a")), TopicSpec("b", path=str(tmp_path / "b"))
    write_batch(text(spark, "x", "y"), a)
    for more in ([], ["z"]):
        if more:
            text(spark, *more).write.mode("append").parquet(a.path)
        copy = read_topic(spark, a).select(F.upper("value").alias("value"))
        write_topic(copy, b, str(tmp_path / "ck")).trigger(**NOW).start().awaitTermination()
    out = read_topic(spark, b, streaming=False)
    assert values(out) == ["X", "Y", "Z"]
    assert out.select("part", "offset").distinct().count() == 3


def test_many_topics(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string")
    spec = TopicSpec("all", path=str(tmp_path / "out"))
    write_batch(rows, spec, batch_id=0)
    write_batch(rows, spec, batch_id=0)  # the same batch again adds nothing
    write_batch(rows.filter("topic = 'b'"), spec, batch_id=1)
    for streaming in (False, True):
        got = read_topic(spark, TopicSpec("a", path=spec.path, shared=True), streaming)
        if streaming:
            q = got.writeStream.format("memory").queryName("many").trigger(**NOW).start()
            q.awaitTermination()
            got = spark.table("many")
        assert values(got) == ["1", "3"]
    assert values(read_topic(spark, TopicSpec("b", path=spec.path, shared=True), False)) == ["2", "2"]


def test_unfinished_batch_is_written_again(spark, tmp_path):
    spec = TopicSpec("t", path=str(tmp_path))
    write_batch(text(spark, "half"), spec, batch_id=3)
    (tmp_path / "batch=3" / "_SUCCESS").unlink()
    assert not files.is_complete(spark, str(tmp_path / "batch=3"))
    write_batch(text(spark, "whole"), spec, batch_id=3)
    assert values(read_topic(spark, spec, False)) == ["whole"]
    assert files.is_complete(spark, str(tmp_path / "batch=3"))


USER = dim_store.DimTable("dim_user", ("id", "name", "city"))


def ups(spark, *rows):
    rows = [("dim_user", data, i) for i, data in enumerate(rows)]
    return spark.createDataFrame(rows, "sinkTable string, data map<string,string>, seq bigint")


def table(df):
    return {r["id"]: (r["name"], r["city"]) for r in df.collect()}


def test_merge_sets_only_what_a_change_holds(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", None)], USER.schema())
    new = ups(spark, {"id": "1", "name": "A"}, {"id": "3", "city": "z"}, {"id": "1", "name": "AA"}, {"name": "no key"})
    out = dim_store.merge(new, USER, ["seq"], old)
    assert out.columns == list(USER.columns)
    assert table(out) == {"1": ("AA", "x"), "2": ("b", None), "3": (None, "z")}
    nulls = ups(spark, {"id": "1", "name": None})
    assert table(dim_store.merge(nulls, USER, ["seq"], old))["1"] == (None, "x")


def test_merge_is_partial_before_its_shuffle(spark):
    plan = dim_store.merge(ups(spark, {"id": "1"}), USER, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 3 and plan.count("Exchange") == 1


def test_store(spark, tmp_path):
    root = str(tmp_path)
    put = lambda n, *rows: dim_store.upsert(ups(spark, *rows), root, [USER], n, ["seq"])
    assert dim_store.read(spark, root, USER).count() == 0
    assert put(0, {"id": "1", "name": "a"}, {"id": "2", "name": "b"}, {"name": "no key"}) == [USER]
    put(0, {"id": "1", "name": "a"}, {"id": "2", "name": "b"})
    assert table(dim_store.read(spark, root, USER)) == {"1": ("a", None), "2": ("b", None)}
    put(1, {"id": "1", "city": "x"})
    assert put(2) == [] and put(3, {"name": "no key"}) == []
    assert table(dim_store.read(spark, root, USER)) == {"1": ("a", "x"), "2": ("b", None)}
    put(10, {"id": "2", "name": "B"}, {"id": "9", "name": "n"})
    assert table(dim_store.read(spark, root, USER)) == {"1": ("a", "x"), "2": ("B", None), "9": ("n", None)}
    other = dim_store.DimTable("dim_other", ("id",))
    assert dim_store.read(spark, root, other).count() == 0
    with pytest.raises(ValueError, match="dim_user"):
        dim_store.upsert(ups(spark, {"id": "1"}), root, [other], 11, ["seq"])
    wide = dim_store.DimTable("dim_user", (*USER.columns, "age"))
    dim_store.upsert(ups(spark, {"id": "1", "age": "7"}), root, [wide], 12, ["seq"])
    got = {r["id"]: (r["city"], r["age"]) for r in dim_store.read(spark, root, wide).collect()}
    assert got == {"1": ("x", "7"), "2": (None, None), "9": (None, None)}


def test_only_touched_buckets_are_replaced(spark, tmp_path):
    root, people = str(tmp_path), [{"id": str(i), "name": "a"} for i in range(300)]
    dim_store.upsert(ups(spark, *people), root, [USER], 0, ["seq"])
    files_of = lambda: {p.parent.name: p.name for p in (tmp_path / "dim_user").glob("*/*.parquet")}
    before = files_of()
    dim_store.upsert(ups(spark, {"id": "7", "name": "b"}), root, [USER], 1, ["seq"])
    after = files_of()
    assert len(before) == USER.buckets and sum(after[b] != before[b] for b in before) == 1
    got = table(dim_store.read(spark, root, USER))
    assert len(got) == 300 and [i for i, (name, _) in got.items() if name == "b"] == ["7"]


@pytest.mark.parametrize("lost", ["nothing yet", "a bucket"])
def test_store_survives_a_crash_while_buckets_are_replaced(spark, tmp_path, monkeypatch, lost):
    root = str(tmp_path)
    dim_store.upsert(ups(spark, *[{"id": str(i), "name": "a"} for i in range(100)]), root, [USER], 0, ["seq"])
    batch = ups(spark, {"id": "1", "city": "x"}, {"id": "2", "city": "y"})
    stage = dim_store._stage

    def stop(*args):
        if lost == "a bucket":
            stage(*args)
        raise RuntimeError("crash")

    monkeypatch.setattr(dim_store, "_stage", stop)
    with pytest.raises(RuntimeError):
        dim_store.upsert(batch, root, [USER], 1, ["seq"])
    monkeypatch.undo()
    if lost == "a bucket":  # deleted, and its new files not yet moved in
        bucket = spark.range(1).select(USER.bucket_of(F.lit("1"))).first()[0]
        for p in (tmp_path / "dim_user" / f"_bucket={bucket}").iterdir():
            p.unlink()
        assert dim_store.read(spark, root, USER).count() < 100
    dim_store.upsert(batch, root, [USER], 1, ["seq"])
    got = table(dim_store.read(spark, root, USER))
    assert len(got) == 100 and got["1"] == ("a", "x") and got["2"] == ("a", "y") and got["3"] == ("a", None)


def test_catalog_tables_follow_rules(spark, tmp_path):
    root = str(tmp_path / "store")
    spark.sql(f"CREATE DATABASE dims_test LOCATION '{tmp_path}/db'")
    rule = lambda at, columns, pk=None: ("user", "insert", "hbase", "dim_ox", columns, pk, None, at)
    schema = "sourceTable string, operateType string, sinkType string, sinkTable string, sinkColumns string, sinkPk string, sinkExtend string, at int"
    tables = lambda *rules: dim_store.store_tables(spark.createDataFrame(rules, schema), ["at"])
    first, both = rule(1, "name,z"), rule(2, "id,a b,Name")
    try:
        dim_store.follow_rules(spark, tables(first).values(), "dims_test", root)
        assert spark.table("dims_test.`dim_ox`").columns == ["name", "z", "id", "_bucket"]
        known = tables(both, first, first)
        dim_store.follow_rules(spark, tables(first, rule(2, "a b")).values(), "dims_test", root)
        dim_store.follow_rules(spark, known.values(), "dims_test", root)  # a name in other case is no new column
        assert spark.table("dims_test.`dim_ox`").columns == ["name", "z", "id", "a b", "_bucket"]
        row = spark.createDataFrame([("dim_ox", {"id": "1", "a b": "v"}, 1)], "sinkTable string, data map<string,string>, seq int")
        now = tables(first, rule(2, "a b")).values()
        touched = dim_store.upsert(row, root, now, 0, ["seq"])
        dim_store.show_new_buckets(spark, touched, "dims_test")
        assert [tuple(r)[:4] for r in spark.table("dims_test.`dim_ox`").collect()] == [(None, None, "1", "v")]
    finally:
        spark.sql("DROP DATABASE dims_test CASCADE")


def test_table_from_rule(spark):
    rule = {"sinkTable": "dim_x", "sinkColumns": "id,name", "sinkPk": None, "sinkExtend": None}
    t = dim_store.DimTable.of_rule(rule)
    assert (t.name, t.columns, t.pk, t.extend) == ("dim_x", ("id", "name"), "id", "")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in t.schema().fields] == [
        ("id", "string", False), ("name", "string", True)]
    assert dim_store.DimTable.of_rule({**rule, "sinkPk": "name", "sinkExtend": "x"}).pk == "name"
    keyless = dim_store.DimTable.of_rule({**rule, "sinkColumns": "name"})
    assert keyless.columns == ("name", "id")  # the key is a column in any case
    both = dim_store.DimTable.of_rules([rule, {**rule, "sinkColumns": "id,age"}, {**rule, "sinkTable": "dim_y"}])
    assert {n: x.columns for n, x in both.items()} == {"dim_x": ("id", "name", "age"), "dim_y": ("id", "name")}
    odd = dim_store.DimTable("a`b", ("c`d", "o'k"), "o'k").create_sql("shop")
    assert odd.startswith("CREATE TABLE IF NOT EXISTS `shop`.`a``b` (`c``d` STRING, `o'k` STRING)") and r"'o\'k'" in odd
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_test")
    spark.sql(t.create_sql("shop_test"))
    spark.sql(t.create_sql("shop_test"))
    assert spark.table("shop_test.dim_x").dtypes == [("id", "string"), ("name", "string")]
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_sink_rows_in_declared_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    assert jdbc.sink_rows(df, ["a", "b", "c"], exclude=["b"]).columns == ["a", "c"]


class Recorder:
    """Stands in for a reader or writer; no database is started for the tests."""

    def __init__(self):
        self.options_seen, self.saved = {}, False

    def format(self, name):
        assert name == "jdbc"
        return self

    def mode(self, name):
        assert name == "append"
        return self

    def option(self, key, value):
        self.options_seen[key] = value
        return self

    def options(self, **kw):
        self.options_seen |= kw
        return self

    def save(self):
        self.saved = True


def test_jdbc_options(spark, monkeypatch):
    rec = Recorder()
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    monkeypatch.setattr(jdbc, "sink_rows", lambda *a: type("Rows", (), {"write": rec}))
    jdbc.write_jdbc(df, "jdbc:x", "visitor_stats", ["a"], driver="d.D", options={"user": "u"})
    assert rec.saved and rec.options_seen == {
        "url": "jdbc:x", "dbtable": "visitor_stats", "batchsize": 1000, "user": "u", "driver": "d.D"}
    rec = Recorder()
    rec.load = lambda: df.withColumnRenamed("a", "user_id")
    out = jdbc.read_jdbc(type("S", (), {"read": rec}), "jdbc:x", "select 1", camel_case=True)
    assert out.dtypes == [("userId", "string"), ("b", "string")] and rec.options_seen["query"] == "select 1"
    jdbc.read_jdbc(type("S", (), {"read": rec}), "jdbc:x", "select 1", split=("id", 0, 9, 3))
    assert rec.options_seen["numPartitions"] == 3 and rec.options_seen["dbtable"] == "(select 1) q"


def test_land(spark, tmp_path):
    df = spark.range(5).withColumn("s", F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))
    back = land(df, "x", str(tmp_path / "t"))
    assert back.schema.names == ["id", "s"] and back.count() == 5
    assert "struct<s:struct<a:int>>" in back.select("s.a")._jdf.queryExecution().executedPlan().toString()


