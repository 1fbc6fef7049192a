"""What a job leaves on disk: no shuffle of a write that is over, no version that nobody reads."""

import threading
import time

import pytest

from shelfline.plans.star import load_star
from shelfline.session import SHUFFLES_END, held
from shelfline.sources.versions import OPEN_FILES, VersionedTable
from tests.conftest import SF_SMALL


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.length())) if n.startswith("shuffle_")}


def ends_with(spark, before):
    """Files are removed by messages to the executors: within seconds."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_a_commit_leaves_no_shuffle(spark, tmp_path):
    before = shuffle_files(spark)
    t = VersionedTable(spark, str(tmp_path), "d", 10)
    t.create(spark.range(2000).selectExpr("cast(2450815 + id % 35 as int) d", "id k"))
    t.append(spark.range(35).selectExpr("cast(2450815 + id as int) d", "id + 5000 k"))
    assert not ends_with(spark, before) and t.read().count() == 2035


def test_a_loaded_fact_leaves_no_shuffle_and_is_packed(spark):
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.shelfline.star.version", "left-on-disk")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        before = shuffle_files(spark)
        st = load_star(spark, SF_SMALL)
        files = [f for t in ("store_returns", "customer", "store") for f in st[t].inputFiles()]
        assert not ends_with(spark, before) and files and all(f.endswith(".zstd.parquet") for f in files)
    finally:
        spark.conf.unset("spark.shelfline.star.version")
        spark.conf.set("spark.sql.parquet.compression.codec", codec)


@pytest.mark.parametrize("days", [35, 400])                  # within the open files, and more buckets than these
def test_buckets_of_unsorted_rows(spark, tmp_path, days):
    """A task writes the buckets that it meets, in any order."""
    rows = spark.range(0, 4000, 1, 2).selectExpr(f"if(id % 7 = 0, null, cast(2450815 + id * 37 % {days} as int)) d", "id k")
    t = VersionedTable(spark, str(tmp_path), "d", 10)
    t.create(rows, clustered=True)
    assert len(t.folders()) == -(-days // 10) + 1
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    for b in t.folders():
        assert {r[0] for r in t.read_buckets({b}).select(t.bucket()).distinct().collect()} == {b}


def test_vacuum_keeps_what_the_latest_version_names(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path), "d", 10)
    t.create(spark.range(30).selectExpr("cast(2450815 + id as int) d", "id k"))
    first = t.folders()
    t.rewrite({1}, lambda rows: rows.filter("k <> 12"))
    t.rewrite({2}, lambda rows: rows.filter("false"))
    for _ in range(2):                                       # a second time there is nothing to do
        t.vacuum()
        assert t.version() == 3 and sorted(r.k for r in t.read().collect()) == sorted({*range(20)} - {12})
    assert (tmp_path / first[0][0]).exists() and not (tmp_path / first[1][0]).exists() and not (tmp_path / first[2][0]).exists()
    assert [p.name for p in (tmp_path / "versions").iterdir() if p.name.isdigit()] == ["3"]
    t.append(spark.createDataFrame([(2450815, 100)], "d int, k long"))
    assert t.version() == 4 and t.read().count() == 20


def test_a_delete_keeps_no_replaced_files(spark):
    from shelfline.streaming import refresh
    made, create = [], refresh._stored_copy
    refresh._stored_copy = lambda *a: made.append(create(*a)) or made[-1]
    try:
        assert refresh.refresh_delete_stored(load_star(spark, SF_SMALL)).count() == 7
    finally:
        refresh._stored_copy = create
    assert len(made) == 7 and any(t.version() > 1 for t in made)
    for t in made:
        assert sorted(f.name for f in _versions(t)) == [str(t.version())]


def _versions(t):
    from pathlib import Path
    return [p for p in Path(t.path.removeprefix("file:"), "versions").iterdir() if p.name.isdigit()]


def test_settings_are_put_back(spark):
    key = next(iter(SHUFFLES_END))
    spark.conf.set(key, "false")
    try:
        inside, leave = threading.Event(), threading.Event()

        def other():
            with held(spark, SHUFFLES_END):
                inside.set()
                leave.wait(10)
        worker = threading.Thread(target=other)
        with held(spark, SHUFFLES_END | OPEN_FILES):
            worker.start()
            inside.wait(10)
        assert spark.conf.get(key) == "true"                 # the other thread is still inside
        leave.set()
        worker.join()
        assert spark.conf.get(key) == "false"
        with pytest.raises(ValueError), held(spark, SHUFFLES_END):
            raise ValueError
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


KEYS = [5, 5, 6, 63, 64, 65, -1, -64, -65, 1 << 40, (1 << 40) + 1, None, None]


@pytest.mark.parametrize("parent", [[5, 63, -1, 1 << 40, 5], [5, None, 64, -65], [None], [], KEYS])
def test_orphans_by_pass_and_by_count(spark, parent):
    from shelfline.plans.building import key_blocks, orphans_by_count, orphans_by_pass
    child = spark.createDataFrame([(k, (n % 3) or None) for n, k in enumerate(KEYS)], "a long, b int")
    keys, few = spark.createDataFrame([(k,) for k in parent], "k long"), spark.createDataFrame([(1,), (1,), (None,)], "k int")
    lost = sum(k is not None and k not in parent for k in KEYS)
    want = {"c.a": lost, "c.b": sum(n % 3 == 2 for n in range(len(KEYS)))}
    refs = [("a", key_blocks(keys, "k"), None), ("b", few, "k")]
    assert dict(map(tuple, orphans_by_pass(child, refs, "c").collect())) == want
    assert dict(map(tuple, orphans_by_count(child, "a", keys, "k", "c").collect())) == {"c.a": lost}
    # an empty child has no count, in either form
    none = child.limit(0)
    assert [r.orphans for r in orphans_by_pass(none, refs, "c").collect()] == [None, None]
    assert [r.orphans for r in orphans_by_count(none, "a", keys, "k", "c").collect()] == [None]


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_no_row_is_shuffled_to_a_parent(spark, monkeypatch, most):
    """dq_fk: a child's row, or its key, crosses no exchange on the way to a parent; if its blocks are too many, a count a key does."""
    from shelfline.plans import building
    monkeypatch.setattr(building, "_SENT_BLOCKS", most)
    st = load_star(spark, SF_SMALL)
    modes = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = building.dq_fk(st)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in modes.items():
            spark.conf.set(k, v)
    for col in ("ss_customer_sk", "cs_ship_addr_sk", "ws_bill_cdemo_sk", "inv_item_sk"):
        below = [x.split("\n")[1] for x in text.split(f"hashpartitioning({col}#")[1:]]
        assert bool(below) == (most == 0) and all("partial_count(1)" in x for x in below), (col, below)
    found = {r.fk_name: r.orphans for r in building.dq_fk(st).collect()}
    assert len(found) == 106
    for t, col, dim, key in building.FK:
        if t in ("web_page", "promotion"):                   # some of these name items and customers beyond the small tables
            child = st[t].filter(f"{col} is not null")
            assert found[f"{t}.{col}"] == child.join(st[dim], child[col] == st[dim][key], "left_anti").count()
    assert sum(found.values()) > 0


def test_the_jvm_compiles_the_passes(spark):
    import re

    from shelfline.plans import building
    st = load_star(spark, SF_SMALL)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(building.dq_fk(st)._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, max(sizes)
