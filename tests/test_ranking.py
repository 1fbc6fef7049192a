"""Bucketed ranks equal rank() over one window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions.ranking import least_per_group, ranked, ranked_up_to, split_ranks
from shelfline.functions.search import places_up_to


def test_ranks_equal_the_window(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 50 > 0, F.pmod(F.col("id") * 7919, F.lit(1000)) / 100 - 2).alias("v"))
    want = {r.id: r.k for r in df.select("id", F.rank().over(Window.orderBy("v")).alias("k")).collect()}
    for step, steps in ((0.01, 4096), (1.0, 4), (100.0, 2)):
        assert {r.id: r.k for r in ranked(df, "v", "k", step, steps).collect()} == want
    assert ranked(df.limit(0), "v", "k", 0.1).count() == 0


def test_no_task_orders_all_rows(spark):
    plan = ranked(spark.range(10).withColumn("v", F.rand(1)), "v", "k", 0.1)._jdf.queryExecution().executedPlan().toString()
    single = [x for x in plan.splitlines() if "SinglePartition" in x]
    assert len(single) == 1                                # the bucket totals


def _stored(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_split_ranks_equal_the_window(spark, tmp_path):
    # one group holds two thirds, one value a third of all rows, values span many magnitudes
    n = F.pmod(F.col("id") * 7919, F.lit(1009))
    value = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 1.0).otherwise(F.pow(F.lit(1.05), n) - 2)
    df = _stored(spark, spark.range(4000).select("id", F.when(F.col("id") % 6 > 3, F.col("id") % 7).alias("g"), value.alias("v")), tmp_path)
    want = {r.id: r.k for r in df.select("id", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())).alias("k")).collect()}
    for pieces in (2, 16, 300):
        assert {r.id: r.k for r in split_ranks(df, "v", "k", "g", df, pieces).collect()} == want


def test_best_of_two_orders(spark, tmp_path):
    df = _stored(spark, spark.range(3000).select(
        "id", (F.col("id") % 3).alias("g"), F.floor(F.pmod(F.col("id") * 7919, F.lit(3001)) / 4).cast("double").alias("a"),
        F.when(F.col("id") % 4 > 0, F.pmod(F.col("id") * 104729, F.lit(2999)) / 7).otherwise(0.5).alias("b")), tmp_path)
    w = Window.partitionBy("g")
    whole = df.withColumn("ra", F.rank().over(w.orderBy("a"))).withColumn("rb", F.rank().over(w.orderBy("b")))
    for k in (1, 5, 10_000):                              # ties go over the limit; a limit above all rows keeps all
        want = {tuple(r) for r in whole.filter((F.col("ra") <= k) | (F.col("rb") <= k)).collect()}
        got = ranked_up_to(df, {"a": "ra", "b": "rb"}, k, "g")
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert ranked_up_to(df.limit(0), {"a": "ra"}, 3, "g").count() == 0


def test_only_the_best_of_each_task_are_sent(spark, tmp_path):
    df = _stored(spark, spark.range(100).select((F.col("id") % 2).alias("g"), F.rand(1).alias("v")), tmp_path)
    plan = least_per_group(df, "v", 10, "g")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_binary_search(spark):
    values = sorted([0, 0, 3, 5, 5, 5, 9])
    df = spark.range(-2, 12).select("id", F.array(*[F.lit(v) for v in values]).alias("vs"))
    for most in (7, 8, 1000):
        assert all(r.n == sum(v <= r.id for v in values) for r in df.select("id", places_up_to(F.col("vs"), F.col("id"), most).alias("n")).collect())
    assert df.select(places_up_to(F.array().cast("array<int>"), F.col("id"), 0).alias("n")).distinct().first().n == 0
