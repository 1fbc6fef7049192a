"""Histories from keep-or-change proposals."""

import datetime as dt

from pyspark.sql import functions as F

from shelfline.plans.history import audit, history, proposal

COLUMNS = ["a", "b"]


def day(n):
    return dt.date(2000, 1, 1) + dt.timedelta(n)


def proposals(spark, rows):
    """Rows (id, day, order, a, keeps a, b, keeps b)."""
    df = spark.createDataFrame(rows, "id string, s date, o int, av int, ak boolean, bv string, bk boolean")
    return df.select("id", "s", proposal(F.col("av"), F.col("ak"), F.col("o")).alias("a"), proposal(F.col("bv"), F.col("bk"), F.col("o")).alias("b"))


def built(spark, rows):
    return history(proposals(spark, rows), "id", "s", "e", COLUMNS)


def test_kept_values_are_carried_and_equal_neighbours_merged(spark):
    rows = [("x", day(0), 0, 1, False, "p", False), ("x", day(5), 0, 9, True, "q", False), ("x", day(9), 0, 1, False, "z", True),
            ("x", day(12), 0, None, False, "q", False), ("x", day(20), 0, 5, True, "q", True), ("x", day(30), 0, 1, False, "q", False),
            ("y", day(3), 0, 7, True, "r", False), (None, day(0), 0, 1, False, "p", False), ("z", None, 0, 1, False, "p", False)]
    got = sorted(tuple(r) for r in built(spark, rows).collect())
    assert got == [("x", day(0), day(4), 1, "p", 1), ("x", day(5), day(11), 1, "q", 2),      # day 9 changes nothing
                   ("x", day(12), day(29), None, "q", 3),                                    # null is a value; day 20 keeps it
                   ("x", day(30), None, 1, "q", 4), ("y", day(3), None, None, "r", 1)]


def test_proposals_of_one_day_fold_by_order(spark):
    rows = [("x", day(0), 2, 1, False, "late", False), ("x", day(0), 1, 8, False, "early", False),
            ("x", day(0), 3, 0, True, "last", False), ("x", day(0), 3, 0, True, "last", False)]
    assert [tuple(r) for r in built(spark, rows).collect()] == [("x", day(0), None, 1, "last", 1)]


def test_random_histories_equal_a_replay(spark):
    rows, want = [], {}
    for i in range(60):
        state, seen, steps = [None, None], None, []
        for d in range(0, 40, 1 + i % 4):
            ak, bk = (i * 31 + d * 7) % 3 > 0, (i * 17 + d * 5) % 4 > 0
            rows.append((f"k{i}", day(d), 0, d % 2, ak, "uv"[d % 2], bk))
            state = [state[0] if ak else d % 2, state[1] if bk else "uv"[d % 2]]
            if seen is None or state != seen:
                steps.append((day(d), *state))
                seen = list(state)
        ends = [s[0] - dt.timedelta(1) for s in steps[1:]] + [None]
        want[f"k{i}"] = [(s[0], e, s[1], s[2], n + 1) for n, (s, e) in enumerate(zip(steps, ends))]
    out = built(spark, rows)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.id, r.s)):
        got.setdefault(r.id, []).append(tuple(r)[1:])
    assert got == want
    clean = audit(out, "id", "s", "e", COLUMNS).first()
    assert clean.ids == 60 and clean.gaps == clean.overlaps == clean.repeats == clean.ids_without_one_open == 0


def test_audit_sees_what_is_wrong(spark):
    rows = [("g", day(0), day(3), 1, "p"), ("g", day(5), None, 2, "p"), ("o", day(0), day(6), 1, "p"), ("o", day(5), None, 2, "p"),
            ("r", day(0), day(4), 1, None), ("r", day(5), None, 1, None), ("n", day(0), None, 1, "p"), ("n", day(5), None, 2, "p")]
    bad = audit(spark.createDataFrame(rows, "id string, s date, e date, a int, b string"), "id", "s", "e", COLUMNS).first()
    assert (bad.ids, bad.revisions, bad.gaps, bad.overlaps, bad.repeats, bad.ids_without_one_open) == (4, 8, 1, 2, 1, 1)


def test_empty_tables(spark):
    out = built(spark, [("x", day(0), 0, 1, False, "p", False)]).limit(0)
    assert out.count() == 0 and tuple(audit(out, "id", "s", "e", COLUMNS).first()) == (0,) * 9
