import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from agentaudit.operators import loops, replay, skew
from agentaudit.plans import fixtures


def test_hot_keys_finds_the_large_group(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    assert skew.hot_keys(df, "k", 1_000) == ["hot"]
    assert skew.hot_keys(df, "k", 50_000) == []


def test_hot_groups_are_numbered_like_others(spark):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 50}", rnd.choice("ab"), rnd.randrange(40)) for i in range(5_000)]
    df = spark.createDataFrame(rows, "k string, g string, t int").repartition(5)
    order = [F.col("t")]
    got = skew.number_rows(df, ["k", "g"], order, "n", hot=["hot"])
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "g").orderBy("t")).cast("long"))
    key = lambda d: sorted(map(tuple, d.select("k", "g", "t", "n").collect()))
    assert key(got) == key(want)


def test_exact_copies_are_split_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"))
    got = skew.number_rows(df, ["k"], [F.col("t")], "n", hot=["hot"])
    assert sorted(r.n for r in got.select("n").collect()) == list(range(1, 20_001))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 20_000


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("hot", 5)], "k string, t int")
    got = skew.number_rows(df, ["k"], [F.col("t")], "n", hot=["hot"])
    assert sorted(map(tuple, got.collect()), key=str) == [("hot", 5, 1), (None, 1, 1), (None, 2, 2)]


def test_operators_agree_on_hot_traces(spark, sf):
    records = fixtures.records(spark, sf)
    hot = [r.trace_id for r in records.select("trace_id").distinct().limit(20).collect()]
    for run in (replay.steps, loops.loops):
        plain, split = run(records, hot=[]), run(records, hot=hot)
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_join_with_hot_keys(spark):
    rows = [("hot" if i % 3 else f"k{i % 50}", "x" if i % 2 else "y", i) for i in range(3_000)] + [(None, "x", -1)]
    left = spark.createDataFrame(rows, "k string, g string, i int")
    right = spark.createDataFrame([("hot", "x", 1), ("k3", "y", 2), ("k4", "y", 3)], "k string, g string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = left.join(right, ["k", "g"], how)
        for hot in ([], ["hot\0x"], ["hot\0x", "hot\0y", "k4\0y"]):
            got = skew.join_unique(left, right, ["k", "g"], how, hot)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_are_found_once_and_passed_on(spark):
    left = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    joined = skew.join_unique(left, right, ["k"], "left", skew.hot_keys(left, "k", 500))
    assert "Union" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.where("v = 1").count() == 1_000 and joined.count() == 3_000
