"""Feeds merged into type-1 and type-2 dimensions."""

import datetime as dt

from shelfline.streaming import dimensions as D

DIM = D.Dimension("t", "sk", "id", ("o",), ("h",), "s", "e")
SCHEMA = "sk long, id string, s date, e date, o string, h int, other string"
FEED = "id string, o string, h int"


def day(text):
    return dt.date.fromisoformat(text)


ROWS = [(1, "a", day("1997-01-01"), day("1999-12-31"), "x", 1, "p"), (2, "a", day("2000-01-01"), None, "x", 2, "q"),
        (3, "b", day("1997-01-01"), None, "x", 1, "r"), (4, "c", day("1997-01-01"), None, None, None, "s"),
        (5, "d", day("2002-01-01"), None, "x", 1, "t"), (6, None, day("1997-01-01"), None, "x", 1, "u")]
CHANGES = [("a", "y", 3), ("b", None, 1), ("c", None, 7), ("d", None, 2), ("e", None, 4), ("f", "z", None), (None, "lost", 0)]


def test_every_kind_of_change(spark):
    rows, feed = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(CHANGES, FEED)
    out = D.apply_feed(rows, feed, DIM, "2002-01-01")
    assert out.columns == [*rows.columns, "status"]
    got = {(r.id, r.status, r.s, r.e, r.o, r.h, r.other) for r in out.collect()}
    assert got == {
        ("a", "overwritten", day("1997-01-01"), day("1999-12-31"), "y", 1, "p"),        # overwritten in a closed revision too
        ("a", "closed", day("2000-01-01"), day("2001-12-31"), "y", 2, "q"),
        ("a", "opened", day("2002-01-01"), None, "y", 3, "q"),
        ("b", "unchanged", day("1997-01-01"), None, "x", 1, "r"),
        ("c", "closed", day("1997-01-01"), day("2001-12-31"), None, None, "s"),         # a value where there was none
        ("c", "opened", day("2002-01-01"), None, None, 7, "s"),
        ("d", "overwritten", day("2002-01-01"), None, "x", 2, "t"),                     # began that day: corrected
        ("e", "inserted", day("2002-01-01"), None, None, 4, None),
        ("f", "inserted", day("2002-01-01"), None, "z", None, None),
        (None, "unchanged", day("1997-01-01"), None, "x", 1, "u")}
    assert sorted(r.sk for r in out.collect()) == list(range(1, 11))


def test_a_second_run_changes_nothing(spark, tmp_path):
    rows, feed = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(CHANGES, FEED)
    table = D.VersionedTable(spark, str(tmp_path), "sk", 1)
    table.create(rows)
    before = table.folders()
    assert D.merge_stored(table, feed, DIM, "2002-01-01") == 2 and table.read().count() == 10
    assert D.merge_stored(table, feed, DIM, "2002-01-01") == 2
    assert table.read(1).count() == 6
    same = {b for b in before if table.folders().get(b) == before[b]}
    assert len(same) == 2                                        # those of keys 3 and 6 keep their files
    once = sorted(map(str, table.read().collect()))
    again = D.apply_feed(table.read(), feed, DIM, "2002-01-01")
    assert {r.status for r in again.collect()} == {"unchanged"} and sorted(map(str, again.drop("status").collect())) == once


def test_type_one_and_empty_tables(spark):
    one = D.Dimension("t", "sk", "id", ("o", "h"))
    rows, feed = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(CHANGES, FEED)
    got = D.apply_feed(rows, feed, one, "2002-01-01")
    assert {r.status for r in got.collect()} == {"unchanged", "overwritten", "inserted"} and got.count() == 8
    assert {(r.sk, r.h) for r in got.filter("id = 'a'").collect()} == {(1, 3), (2, 3)}
    none = D.apply_feed(rows.limit(0), feed, DIM, "2002-01-01")
    assert sorted(r.sk for r in none.collect()) == list(range(1, 7)) and none.filter("status <> 'inserted'").count() == 0
    assert D.apply_feed(rows, feed.limit(0), DIM, "2002-01-01").filter("status <> 'unchanged'").count() == 0


def test_new_keys_do_not_depend_on_the_partitions(spark):
    feed = spark.createDataFrame([(f"n{i}", "x", i) for i in range(500)], FEED)
    rows = spark.createDataFrame(ROWS, SCHEMA)
    keys = [{r.id: r.sk for r in D.apply_feed(rows, feed.repartition(n), DIM, "2002-01-01").filter("status = 'inserted'").collect()}
            for n in (1, 7)]
    assert keys[0] == keys[1] and sorted(keys[0].values()) == list(range(7, 507))
