"""Binary search in a sorted array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def places_up_to(values: Column, x: Column, most: int) -> Column:
    """How many entries of the ascending array ``values`` (``most`` at most) are <= ``x``; 0 for a null ``x``.

    Steps of falling powers of two, so about log2(most) comparisons a row.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(max(most, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(values, at + step - 1) <= x, at + step).otherwise(at))
