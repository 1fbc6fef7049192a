"""Stored tables: versions, untouched files, appended and rewritten partitions."""

import pytest

from shelfline.sources.versions import NO_DATE, VersionedTable

SCHEMA = "d int, k long"


def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path), "d", 10)
    t.create(spark.createDataFrame([(2450815 + i, i) for i in range(35)] + [(None, 99)], SCHEMA))
    return t


def keys(df):
    return sorted(r.k for r in df.collect())


def test_a_rewrite_touches_its_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path)
    before = t.folders()
    assert t.version() == 1 and set(before) == {0, 1, 2, 3, NO_DATE}
    assert t.rewrite({1}, lambda rows: rows.filter("k <> 12")) == 2
    after = t.folders()
    assert {b for b in before if before[b] != after[b]} == {1}
    assert keys(t.read()) == [*range(12), *range(13, 35), 99] and keys(t.read(1)) == [*range(35), 99]
    assert t.rewrite({77}, lambda rows: rows) == 2                       # nothing there, nothing published
    t.rewrite({2}, lambda rows: rows.filter("false"))
    assert 2 not in t.folders() and len(keys(t.read())) == 25


def test_an_append_adds_files(spark, tmp_path):
    t = table(spark, tmp_path)
    before = t.folders()
    t.append(spark.createDataFrame([(2450815, 100), (2450915, 101)], SCHEMA))
    after = t.folders()
    assert all(after[b][:len(before[b])] == before[b] for b in before) and len(after[0]) == 2 and set(after) - set(before) == {10}
    assert keys(t.read()) == [*range(35), 99, 100, 101]


def test_an_unpublished_commit_is_not_seen(spark, tmp_path):
    t = table(spark, tmp_path)
    t._write(spark.createDataFrame([(2450815, 100)], SCHEMA))
    assert t.version() == 1 and 100 not in keys(t.read())
    with pytest.raises(RuntimeError):
        t._publish(0, t.folders(), t.read().schema)                      # version 1 is there


def test_an_emptied_table_can_be_read(spark, tmp_path):
    t = table(spark, tmp_path)
    t.rewrite(set(t.folders()), lambda rows: rows.filter("false"))
    assert keys(t.read()) == [] and t.read().columns == ["d", "k"]


def test_a_delete_can_be_repeated(spark, tmp_path):
    """Sales of a range go with their returns wherever these lie; a second run finds nothing to do."""
    from shelfline.streaming.refresh import delete_from_stored
    sales = VersionedTable(spark, f"{tmp_path}/s", "sold", 10)
    returns = VersionedTable(spark, f"{tmp_path}/r", "back", 10)
    sales.create(spark.createDataFrame([(2450815 + i, i, 1) for i in range(40)] + [(None, 90, 1)], "sold int, item long, number long"))
    returns.create(spark.createDataFrame([(2450815 + i + 15, i, 1) for i in range(0, 40, 2)] + [(None, 4, 1)], "back int, item long, number long"))
    old = sales.folders(), returns.folders()
    args = (sales, returns, [(2450818, 2450819), (2450822, 2450823)], ("item", "number"), ("item", "number"))
    assert delete_from_stored(*args) == (2, 2)
    assert sorted(r.item for r in sales.read().collect()) == sorted({*range(40), 90} - {3, 4, 7, 8})
    assert sorted(r.item for r in returns.read().collect()) == sorted(set(range(0, 40, 2)) - {4, 8})
    assert {b for b in old[0] if sales.folders()[b] != old[0][b]} == {0}
    # the returns of 4 (one of them without a date) and 8 lie in buckets of their own
    assert {b for b in old[1] if returns.folders().get(b) != old[1][b]} == {1, 2, NO_DATE}
    assert delete_from_stored(*args) == (2, 2)
    assert sales.read(1).count() == 41 and returns.read(1).count() == 21
