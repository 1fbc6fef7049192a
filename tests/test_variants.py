"""Metamorphic checks: each variant answers exactly like its base query, and
the ROLLUP operator equals its UNION ALL expansion."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK

PAIRS = [("q05", "q05a"), ("q10", "q10a"), ("q14_1", "q14a"), ("q18", "q18a"), ("q27", "q27a"),
         ("q35", "q35a"), ("q36", "q36a"), ("q51", "q51a"), ("q67", "q67a"), ("q70", "q70a"),
         ("q77", "q77a"), ("q80", "q80a"), ("q86", "q86a"), ("agg_rollup", "agg_rollup_union")]


@pytest.mark.parametrize("base,variant", PAIRS)
def test_variant_equals_base(spark, base, variant):
    q = E.queries()
    a, b = q[base](spark, SF_CHECK), q[variant](spark, SF_CHECK)
    b = b.select(*a.columns)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_q22a_differs_from_q22_only_above_detail(spark):
    q = E.queries()
    a = q["q22"](spark, SF_CHECK).filter("i_category IS NOT NULL")
    b = q["q22a"](spark, SF_CHECK).filter("i_category IS NOT NULL")
    assert a.exceptAll(b).count() == 0
