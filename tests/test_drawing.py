"""Draws from value and weight sets; row counts between listed scales."""

import pytest
from pyspark.sql import functions as F

from shelfline.plans import drawing
from shelfline.plans.drawing import LISTED_COUNTS, LISTED_SCALES, Distribution, draw, listed_count

ROWS = [("a", 1, 5, 0, None), ("b", 2, 3, 10, None), ("c", 3, 0, 1, 0), ("d", 4, 2, None, -4)]


def dist(spark, rows=ROWS):
    return Distribution(spark.createDataFrame(rows, "v string, n int, x int, y int, z int"), ("v", "n"), ("x", "y", "z"))


def test_each_place_draws_its_entry(spark):
    got = draw(spark.range(-10, 40).withColumn("v", F.lit("own")), dist(spark), F.col("id")).collect()
    assert len(got) == 50
    for r in got:
        assert r.v == "own" and tuple(r.drawn_x) == ([("a", 1)] * 5 + [("b", 2)] * 3 + [("d", 4)] * 2)[r.id % 10]
        assert tuple(r.drawn_y) == ([("b", 2)] * 10 + [("c", 3)])[r.id % 11] and r.drawn_z is None


def test_shares_follow_the_weights(spark):
    n = 20_000
    rows = [(f"v{i}", i, 1 + i % 7, 1000 if i == 3 else 1, 1) for i in range(300)]
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    drawn = draw(spark.range(n), dist(spark, rows), place).cache()
    for k, w in ((2, "x"), (3, "y"), (4, "z")):
        total = sum(r[k] for r in rows)
        counts = {r.v: r["count"] for r in drawn.groupBy(F.col(f"drawn_{w}.v").alias("v")).count().collect()}
        for r in rows:
            mean = n * r[k] / total
            assert abs(counts.get(r[0], 0) - mean) < 5 * mean ** 0.5 + 5
    drawn.unpersist()


def test_null_places_empty_and_large_distributions(spark, monkeypatch):
    some = spark.createDataFrame([(1,), (None,)], "p long")
    got = {r.p: r for r in draw(some, dist(spark), F.col("p")).collect()}
    assert got[1].drawn_x.v == "a" and got[None].drawn_x is None
    none = Distribution(dist(spark).entries.limit(0), ("v", "n"), ("x",))
    assert [r.drawn_x for r in draw(some, none, F.col("p")).collect()] == [None, None]
    monkeypatch.setattr(drawing, "MOST_ENTRIES", 3)
    with pytest.raises(Exception, match="over 3 entries"):
        draw(some, dist(spark), F.col("p")).collect()


def test_draws_join_no_ranges(spark):
    plan = draw(spark.range(10), dist(spark), F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert ">=" not in "".join(x for x in plan.splitlines() if "Join" in x) and plan.count("BroadcastNestedLoopJoin") <= 2


def test_counts_at_and_between_listed_scales(spark):
    for counts in LISTED_COUNTS.values():
        scales = [float(s) for s in LISTED_SCALES] + [0.01, 5.5, 200.0, 2000.0, 200000.0]
        got = [r.n for r in spark.createDataFrame([(s,) for s in scales], "s double").select(
            listed_count(F.col("s"), F.array(*[F.lit(float(n)) for n in counts])).alias("n")).collect()]
        assert got[:9] == list(counts) and abs(got[9] - counts[0] / 100) < 1e-9
        assert abs(got[10] - (counts[0] + counts[1]) / 2) < 1e-9 and abs(got[11] - (counts[2] + counts[3]) / 2) < 1e-9
        assert abs(got[12] - (counts[4] + counts[5]) / 2) < 1e-9
        assert abs(got[13] - (counts[8] + (counts[8] - counts[7]) / 70000 * 100000)) < 1e-6
