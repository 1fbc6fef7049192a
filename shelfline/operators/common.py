"""Shared helpers for the operator showcases over the driver tables."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.tables import read_table

B = F.broadcast  # bounded dimensions only (nation: 25 rows, region: 5 rows)


def T(spark: SparkSession, sf_dir: str) -> SimpleNamespace:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    return SimpleNamespace(**{n: read_table(spark, sf_dir, n) for n in names})


def dec(c: str) -> Column:
    """Two-decimal money as an exact decimal (sums are then order-independent)."""
    return F.col(c).cast("decimal(12,2)")


def dsum(c: str, alias: str) -> Column:
    """Exact decimal sum of a two-decimal money column, reported as double."""
    return F.sum(dec(c)).cast("double").alias(alias)


def revenue() -> Column:
    """Discounted line revenue in exact decimal: price * (1 - discount)."""
    return dec("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def day(c: str) -> Column:
    return F.to_date(F.col(c))


def in_year(c: str, year: int) -> Column:
    """Timestamps of one year as a range, which the scan can evaluate."""
    return ((F.to_date(F.col(c)) >= F.lit(f"{year}-01-01").cast("date"))
            & (F.to_date(F.col(c)) < F.lit(f"{year + 1}-01-01").cast("date")))


def year_of(c: str) -> Column:
    return F.year(F.to_date(F.col(c)))
