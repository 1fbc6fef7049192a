"""Column sketches, row checksums and the as-of merge."""

import random

from pyspark.sql import functions as F

from shelfline.operators.asof import asof_merge
from shelfline.plans.profiles import column_sketches, refreshed_sketches, row_checksum, statistics


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select(F.floor(F.col("id") / 1000).cast("int").alias("b"), F.pmod(F.col("id") * 7919, F.lit(20011)).alias("v"),
                                      F.concat(F.lit("t"), F.pmod("id", F.lit(3000)).cast("string")).alias("s"),
                                      F.lit(None).cast("decimal(7,2)").alias("nothing"),
                                      F.when(F.col("id") % 4 > 0, F.date_add(F.lit("2000-01-01").cast("date"), F.pmod("id", F.lit(900)).cast("int"))).alias("d"))


def by_column(df):
    return {r.column_name: r for r in df.collect()}


def test_estimates_stay_within_their_bounds(spark):
    got = by_column(statistics(column_sketches(numbers(spark, 0, 20_000), F.col("b"))))
    assert abs(got["v"].distinct_estimate - 20_000) < 0.05 * 20_000 and abs(got["s"].distinct_estimate - 3000) < 150
    values = sorted(i * 7919 % 20011 for i in range(20_000))
    for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        rank = sum(v <= got["v"][name] for v in values) / len(values)
        assert abs(rank - q) < 0.03
    assert (got["v"].min_value, got["v"].max_value, got["v"].nulls) == (str(values[0]), str(values[-1]), 0)
    assert got["d"].nulls == 5000 and got["d"].min_value == "2000-01-02" and got["s"].q50 is None
    assert got["nothing"].nulls == 20_000 and got["nothing"].min_value is None and got["nothing"].q50 is None


def test_a_refresh_sketches_the_touched_buckets_only(spark):
    rows = numbers(spark, 0, 6000)
    stored = column_sketches(rows, F.col("b")).checkpoint()
    assert stored.select("bucket").distinct().count() == 6
    changed = rows.filter("b = 5 AND v < 10000").union(numbers(spark, 6000, 7000))          # rows of bucket 5 go, bucket 6 comes
    new = refreshed_sketches(stored, changed, F.col("b"), {5, 6})
    whole = column_sketches(rows.filter("b < 5").union(changed), F.col("b"))
    exact = ["rows", "nulls", "min_value", "max_value", "distinct_estimate"]
    assert {c: [r[k] for k in exact] for c, r in by_column(statistics(new)).items()} == {
        c: [r[k] for k in exact] for c, r in by_column(statistics(whole)).items()}


def test_an_empty_table(spark):
    rows = numbers(spark, 0, 0)
    assert column_sketches(rows, F.col("b")).count() == 0
    assert row_checksum(rows).first().rows == 0 and row_checksum(rows).first().checksum_1 == "0"


def test_one_changed_cell_changes_the_checksum(spark):
    rows = numbers(spark, 0, 500)
    a = row_checksum(rows).first()
    assert a == row_checksum(rows.repartition(7)).first()
    for c, v in (("s", F.lit("x")), ("v", F.lit(-1)), ("nothing", F.lit(1).cast("decimal(7,2)")), ("d", F.lit(None).cast("date"))):
        b = row_checksum(rows.withColumn(c, F.when(F.col("s") == "t77", v).otherwise(F.col(c)))).first()
        assert b.rows == a.rows and b.checksum_1 != a.checksum_1 and b.checksum_2 != a.checksum_2


def brute(facts, revisions):
    out = []
    for k, i, d in facts:
        seen = [(rd, v) for ri, rd, v in revisions if ri == i and i is not None and d is not None and rd is not None and rd <= d]
        out.append((k, max(seen)[1] if seen else None))
    return sorted(out)


def test_asof_merge_equals_the_range_join(spark):
    r = random.Random(3)
    ids = ["hot"] * 6 + ["a", "b", "c", None]
    facts = [(k, r.choice(ids), r.choice([None, *range(0, 200)])) for k in range(1500)]
    facts += [(2000 + k, "hot", 50) for k in range(700)]                     # one day holds a third of all facts
    revisions = [("hot", d, d) for d in range(3, 190, 2)] + [("a", 100, 1), ("a", 100, 2), ("b", 0, 9), (None, 1, 5), ("z", 1, 1), ("b", None, 3)]
    f = spark.createDataFrame(facts, "k int, id string, day int")
    v = spark.createDataFrame(revisions, "rid string, start int, v int")
    for n in (1, 5, 40):
        got = asof_merge(f, "id", "day", v, "rid", "start", partitions=n)
        assert got.columns == ["k", "id", "day", "revision"]
        assert sorted(((x.k, x.revision and x.revision.v) for x in got.collect()), key=str) == sorted(brute(facts, revisions), key=str)
    assert asof_merge(f.limit(0), "id", "day", v, "rid", "start").count() == 0
    none = asof_merge(f, "id", "day", v.limit(0), "rid", "start")
    assert none.count() == len(facts) and none.filter("revision IS NOT NULL").count() == 0


def test_a_hot_id_is_spread(spark):
    """One id on one day: its facts lie in many partitions, and none is multiplied."""
    f = spark.range(20_000).select("id", F.lit("hot").alias("item"), F.lit(10).alias("day"))
    v = spark.createDataFrame([("hot", d, d) for d in range(500)], "rid string, start int, v int")
    got = asof_merge(f, "item", "day", v, "rid", "start", partitions=16)
    assert got.count() == 20_000 and {x.v for x in got.select("revision.v").distinct().collect()} == {10}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
