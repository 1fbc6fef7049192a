"""Ranks over a whole table without one task that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.search import places_up_to


def ranked(df: DataFrame, value: str, out: str, step: float, steps: int = 4096) -> DataFrame:
    """``df`` plus ``out``: rank() over all rows by ``value`` ascending (ties share a rank, nulls first).

    Rows are counted for each distinct value, and the values fall into
    ``steps`` buckets of width ``step`` (outliers into the first and last). A
    value's rank is one more than the rows of the buckets before and of the
    lesser values in its bucket. Only the bucket totals (``steps`` rows at
    most) meet in one task.
    """
    counts = df.groupBy(F.col(value).alias("rank_value")).agg(F.count(F.lit(1)).alias("rank_rows"))
    bucket = F.when(F.col("rank_value").isNull(), -1).otherwise(
        F.least(F.greatest(F.floor(F.col("rank_value") / step), F.lit(0)), F.lit(steps - 1)))
    counts = counts.withColumn("rank_bucket", bucket.cast("int"))
    before = lambda w: F.coalesce(F.sum("rank_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = counts.groupBy("rank_bucket").agg(F.sum("rank_rows").alias("rank_rows"))
    totals = totals.select("rank_bucket", before(Window.orderBy("rank_bucket")).alias("rank_base"))
    placed = (counts.withColumn("rank_own", before(Window.partitionBy("rank_bucket").orderBy(F.col("rank_value").asc_nulls_first())))
              .join(F.broadcast(totals), "rank_bucket")
              .select("rank_value", (F.col("rank_base") + F.col("rank_own") + 1).cast("int").alias(out)))
    return df.join(placed, F.col(value).eqNullSafe(F.col("rank_value"))).drop("rank_value")


def least_per_group(df: DataFrame, value: str, k: int, by: str) -> DataFrame:
    """(by, ``value``): the k-th least value of each group, of smaller groups the greatest; nulls first.

    Every task sends at most ``k`` rows of a group, so no task sees a group.
    """
    w = Window.partitionBy(by).orderBy(F.col(value).asc_nulls_first())
    return (df.select(by, value).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= k)
            .groupBy(by).agg(F.max(value).alias(value)))


def split_ranks(df: DataFrame, value: str, out: str, by: str, only: DataFrame, pieces: int | None = None) -> DataFrame:
    """``only`` plus ``out``: rank() of its ``value`` among the rows of ``df`` with its ``by`` (nulls first).

    ``df``, a stored table, is counted by distinct value. Splitters drawn from
    those values (``pieces``, by default two a shuffle task, held on the driver) cut them into pieces
    of about equal size, however the values lie; a value's rank is one more than
    the rows of its group in the pieces before and of the lesser values in its
    piece. Only piece totals meet in one task. ``only`` should be few rows.
    """
    pieces = pieces or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(by).alias("_by"), F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    cuts = counts.agg(F.percentile_approx("_value", [i / pieces for i in range(1, pieces)], 10 * pieces)).first()[0] or []
    cuts = sorted(set(cuts))
    piece = F.lit(0) if not cuts else F.when(F.col("_value").isNull(), -1).otherwise(
        places_up_to(F.array(*[F.lit(c) for c in cuts]), F.col("_value"), len(cuts)))
    counts = counts.withColumn("_piece", piece)
    before = lambda w: F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = counts.groupBy("_by", "_piece").agg(F.sum("_rows").alias("_rows"))
    totals = totals.select(F.col("_by").alias("_tby"), F.col("_piece").alias("_tpiece"),
                           before(Window.partitionBy("_by").orderBy("_piece")).alias("_base"))
    own = before(Window.partitionBy("_by", "_piece").orderBy(F.col("_value").asc_nulls_first()))
    placed = (counts.withColumn("_own", own)
              .join(totals, F.col("_by").eqNullSafe(F.col("_tby")) & (F.col("_piece") == F.col("_tpiece")))
              .select("_by", "_value", (F.col("_base") + F.col("_own") + 1).cast("int").alias(out)))
    return only.join(placed, F.col(by).eqNullSafe(F.col("_by")) & F.col(value).eqNullSafe(F.col("_value"))).drop("_by", "_value")


def ranked_up_to(df: DataFrame, ranks: dict[str, str], k: int, by: str) -> DataFrame:
    """The rows of ``df`` (a stored table) with rank ``k`` or better in one of ``ranks`` (value: name of its rank), with all ranks.

    Ranks are within ``by``, ascending, ties share one. Rows above the k-th
    value in every order are left out first; only those left get exact ranks.
    """
    left = df
    keep = F.lit(False)
    for i, value in enumerate(ranks):
        bound = least_per_group(df, value, k, by).select(F.col(by).alias(f"_by{i}"), F.col(value).alias(f"_at{i}"))
        left = left.join(bound, F.col(by).eqNullSafe(F.col(f"_by{i}")))
        keep = keep | F.coalesce(F.col(value) <= F.col(f"_at{i}"), F.lit(True))
    left = left.filter(keep).select(*df.columns)
    for value, name in ranks.items():
        left = split_ranks(df, value, name, by, left)
    best = F.lit(False)
    for name in ranks.values():
        best = best | (F.col(name) <= k)
    return left.filter(best)
