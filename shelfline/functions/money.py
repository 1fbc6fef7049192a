"""Exact integer-cent arithmetic and result normalisation, all JVM-side.

Money in the star schema is derived in whole cents (64-bit integers) and
turned into ``decimal(7,2)`` only at the end, so every engine that follows
the same rules produces bit-identical amounts. Query outputs use
:func:`avg_exact` / :func:`as_double` so a decimal sum and its float view
are the same in every engine (the decimal is exact, the cast is correctly
rounded).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(col: Column | str) -> Column:
    """Round a two-decimal double to whole cents (exact for |x| < 2^44)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("long")


def idiv(num: Column, den: int) -> Column:
    """Floor division of a non-negative integer column by a positive constant.

    ``floor(num / den)`` in double is exact here: the quotient is correctly
    rounded and any non-integer quotient is at least 1/den away from the
    next integer, far more than one ulp while ``num < 2^52``. The numerator
    is referenced once, so chained derivations do not grow the expression."""
    return F.floor(num / F.lit(den)).cast("long")


def rdiv(num: Column, den: int) -> Column:
    """Division rounded half-up, for non-negative numerators."""
    return idiv(num * 2 + F.lit(den), 2 * den)


def to_money(cents_col: Column, precision: int = 7) -> Column:
    """Whole cents -> decimal(precision, 2). The product is exact, and cheaper than a decimal division."""
    return (cents_col.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def as_double(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double")


def avg_exact(col: Column | str) -> Column:
    """Average as exact decimal sum / count, returned as double.

    ``avg(decimal)`` has engine-specific result scales; an exact sum divided
    by an exact count in IEEE double is identical everywhere.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("double") / F.count(c)


def stddev_samp_exact(col: Column | str) -> Column:
    """Sample standard deviation of an INTEGER column from exact integer sums.

    ``sqrt((n*sum(x^2) - sum(x)^2) / (n*(n-1)))``: the sums are exact 64-bit
    integers, so the one rounding step (int -> double, divide, sqrt) is the
    same in every IEEE engine, unlike streaming variance updates whose
    rounding depends on the merge order of partial aggregates.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("long")
    n = F.count(c)
    num = (n * F.sum(c * c) - F.sum(c) * F.sum(c)).cast("double")
    return F.when(n > 1, F.sqrt(num / (n * (n - 1)).cast("double")))


def round_ratio2(num: Column, den: Column) -> Column:
    """round(num/den, 2) half-up for non-negative integers, exactly."""
    return F.when(den > 0, idiv_col(num * 200 + den, den * 2) / 100.0)


def idiv_col(num: Column, den: Column) -> Column:
    """Floor division of non-negative integer columns."""
    return ((num - F.pmod(num, den)) / den).cast("long")
