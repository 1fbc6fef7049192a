"""ROLLUP with SQL empty-input semantics, in one pass.

In SQL the grand-total grouping set ``()`` of a ROLLUP yields one row even
when the input is empty (keys NULL, SUM/AVG NULL, COUNT(col) 0). Spark's
Expand-based rollup emits nothing for an empty input. :func:`rollup` unions
a single all-NULL sentinel row into the input: NULL inputs are ignored by
every aggregate, so the sentinel changes no value, but it guarantees the
grand-total group exists. Groups that contain only the sentinel are
dropped at every other level. Cost: one extra input row, no extra pass.

Aggregates passed in must ignore NULL inputs (use ``count(col)``, not
``count(*)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """``df.rollup(*keys).agg(*aggs)`` that always has its grand-total row."""
    real = df.withColumn("_real", F.lit(1))
    sentinel = df.sparkSession.range(1).select(
        *[F.lit(None).cast(t).alias(c) for c, t in df.dtypes], F.lit(None).cast("int").alias("_real"))
    r = real.unionByName(sentinel).rollup(*keys).agg(
        *aggs, F.grouping_id().alias("_gid"), F.count("_real").alias("_n_real"))
    full = (1 << len(keys)) - 1
    return r.filter((F.col("_n_real") > 0) | (F.col("_gid") == full)).drop("_gid", "_n_real")


def grouping_levels(df: DataFrame, keys: list[str], levels: list[list[str]],
                    aggs: list[Column]) -> DataFrame:
    """UNION ALL over ``levels`` of ``df.groupBy(*level).agg(*aggs)``, with the
    keys outside a level NULL; columns ``keys`` then the aggregates.

    Evaluated as one GROUPING SETS aggregate: a single Expand over one copy
    of ``df`` with partial aggregation before one shuffle, instead of one
    aggregate per level whose plans each repeat the whole input subtree (and
    make every adaptive re-plan walk all copies). A grand-total level ``[]``
    keeps its one row on empty input, as a global aggregate does, through
    the sentinel row described above.
    """
    sets = [[F.col(k) for k in lv] for lv in levels]
    if not any(len(lv) == 0 for lv in levels):
        return df.groupingSets(sets, *keys).agg(*aggs)
    real = df.withColumn("_real", F.lit(1))
    sentinel = df.sparkSession.range(1).select(
        *[F.lit(None).cast(t).alias(c) for c, t in df.dtypes], F.lit(None).cast("int").alias("_real"))
    r = real.unionByName(sentinel).groupingSets(sets, *keys).agg(
        *aggs, F.grouping_id().alias("_gid"), F.count("_real").alias("_n_real"))
    full = (1 << len(keys)) - 1
    return r.filter((F.col("_n_real") > 0) | (F.col("_gid") == full)).drop("_gid", "_n_real")


def block_of(key: str) -> Column:
    """The block of 64 neighbouring values of an integer key that a value is in; null for a null."""
    return F.shiftright(F.col(key).cast("long"), 6)


def bits_of(key: str) -> Column:
    """Aggregate over rows of one :func:`block_of`: a bit for every value of the key; null without any.

    ``bit_count`` of it is an exact distinct count, with a group a block in place of a group a value."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _place(key)))


def has_bit(bits: str, key: str) -> Column:
    """Whether the :func:`bits_of` a block hold a value of the key that is in this block; false for a null of either."""
    return F.coalesce(F.getbit(F.col(bits), _place(key)) == 1, F.lit(False))


def _place(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit(63)).cast("int")
