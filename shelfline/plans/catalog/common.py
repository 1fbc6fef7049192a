"""Shared vocabulary for catalogue queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F

from shelfline.functions.money import as_double, avg_exact  # noqa: F401
from shelfline.plans.registry import star_query  # noqa: F401

B = F.broadcast   # only for dimensions bounded by construction (calendar, outlets, demographics)


def order(*cols: str) -> list[Column]:
    """Sort spec: ``"x"`` ascending, ``"-x"`` descending, NULLs last in both."""
    out = []
    for c in cols:
        if c.startswith("-"):
            out.append(F.col(c[1:]).desc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_last())
    return out


def topk(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """ORDER BY ... LIMIT n (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order(*cols)).limit(n)


def dbl(c: str, alias: str | None = None) -> Column:
    return F.col(c).cast("double").alias(alias or c)


def dates_between(st, start: str, days: int, cols=("d_date_sk",)) -> DataFrame:
    """date_dim rows in [start, start + days] (a bounded calendar slice)."""
    d0 = F.lit(start).cast("date")
    return st.date_dim.filter(F.col("d_date").between(d0, F.date_add(d0, days))).select(*cols)


def zip5(c: str) -> Column:
    return F.substring(F.col(c), 1, 5)


def demographics(st, *cols):
    """The customer demographics (1,920,800 rows), never sent whole to every task.

    Its file is small enough to look like a broadcast side, its rows are not.
    """
    cd = st.customer_demographics
    return (cd.select(*cols) if cols else cd).hint("merge")


def demographics_of(st, pairs, *cols):
    """The demographics with one of the (marital status, education) pairs, sent to every task.

    A pair has 54,880 rows (all combinations of the other attributes), whatever
    the size of the source.
    """
    cd = st.customer_demographics
    hit = F.lit(False)
    for m, e in pairs:
        hit = hit | ((F.col("cd_marital_status") == m) & (F.col("cd_education_status") == e))
    return F.broadcast(cd.filter(hit).select(*cols))
