"""What a job writes, shuffles and computes a row stays small when its tables grow."""

import os
import re
from datetime import date
from types import SimpleNamespace

from pyspark.sql import functions as F

from shelfline.plans.building import PK, inventory_snapshot, key_counts
from shelfline.plans.profiles import column_sketches, row_checksum
from shelfline.plans.star import FACTS, StarBuilder, load_star
from shelfline.sources.versions import VersionedTable
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_is_built_when_it_is_read(spark):
    spark.conf.set("spark.shelfline.star.version", "built-on-read")
    try:
        st = load_star(spark, SF_SMALL)
        n = st.web_returns.count()
        built = {f.split("-")[0] for f in os.listdir(st.root.removeprefix("file:")) if not f.endswith((".CURRENT", ".crc"))}
        assert n > 0 and built == {"_lines", "web_returns"}
        from shelfline.plans.star import _LOADED
        _LOADED.clear()                                     # another session finds the table and does not build it again
        again = load_star(spark, SF_SMALL)
        assert again is not st and again.web_returns.inputFiles() == st.web_returns.inputFiles()
    finally:
        spark.conf.unset("spark.shelfline.star.version")


def test_facts_are_dealt_before_they_are_priced(spark):
    b = StarBuilder(spark, SF_SMALL, tasks=4)
    for name in ("store_sales", "store_returns", "catalog_sales", "catalog_returns", "web_sales", "web_returns"):
        text = plan(b.table(name))
        assert "rangepartitioning(_date" in text, name
        assert sorted(map(str, b.table(name).collect())) == sorted(map(str, StarBuilder(spark, SF_SMALL).table(name).collect()))


def test_the_jvm_compiles_what_writes_a_fact(spark):
    """HotSpot interprets a method of over 8,000 bytes of code, however often it runs."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        b = StarBuilder(spark, SF_SMALL, tasks=4)
        for name in FACTS:
            text = spark._jvm.PythonSQLUtils.explainString(b.table(name)._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, (name, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_blocks_of_inventory_come_from_all_tasks(spark):
    below = plan(StarBuilder(spark, SF_SMALL, tasks=4).inventory()).split("rangepartitioning(")[1]
    assert "hashpartitioning(pk" in below and below.index("explode") < below.index("hashpartitioning(pk")


def test_snapshots_that_no_line_outsells_are_not_shuffled(spark):
    """q72: the year's inventory meets the largest quantity of the lines left before any exchange of it."""
    from shelfline.plans.catalog.returns_chain import q72
    modes = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q72(load_star(spark, SF_SMALL))
        text = plan(df)
    finally:
        for k, v in modes.items():
            spark.conf.set(k, v)
    dealt = next(p for p in text.split("hashpartitioning(inv_item_sk")[1:])          # what lies below that exchange
    assert "inv_quantity_on_hand" in dealt.split("most_sold")[0] and "most_sold" in dealt.split("inventory-")[0]


def test_q72_without_lines_or_quantities(spark):
    """No largest quantity (no lines, or null ones only): no rows, as of the join."""
    from shelfline.plans.catalog.returns_chain import q72
    st = load_star(spark, SF_SMALL)
    tables = {t: st[t] for t in ("date_dim", "household_demographics", "customer_demographics", "inventory", "warehouse", "item",
                                 "promotion", "catalog_returns")}
    null = F.lit(None).cast("int")
    for sales in (st.catalog_sales.limit(0), st.catalog_sales.withColumn("cs_quantity", null)):
        assert q72(SimpleNamespace(**tables, catalog_sales=sales)).count() == 0
    # null quantities beside others, and quantities at the bound, change no row of the others
    mixed = st.catalog_sales.unionByName(st.catalog_sales.withColumn("cs_quantity", null))
    assert q72(SimpleNamespace(**tables, catalog_sales=mixed)).collect() == q72(st).collect()


INVENTORY = [(d, i, w, q) for d in (10, 17, 24) for w in (1, 2) for i, q in ((1, 5), (63, 6), (64, None), (-7, 8), (1 << 40, 9))] + [
    (10, 1, 1, 4), (10, 1, 1, 5), (10, None, 1, 3), (10, None, 1, 2), (None, 1, 1, 1), (10, 64, None, 7), (10, 64, None, 7)]


def test_keys_are_counted_by_blocks(spark):
    rows = spark.createDataFrame(INVENTORY, "inv_date_sk int, inv_item_sk long, inv_warehouse_sk int, inv_quantity_on_hand int").coalesce(1)
    keys = PK["inventory"]
    whole = (len(INVENTORY), len(INVENTORY) - len({r[:3] for r in INVENTORY}))
    assert tuple(key_counts(rows, keys, "inv_item_sk").first()) == tuple(key_counts(rows, keys).first()) == whole
    assert tuple(key_counts(rows.limit(0), keys, "inv_item_sk").first()) == tuple(key_counts(rows.limit(0), keys).first())
    text = plan(key_counts(rows, keys, "inv_item_sk"))
    assert "shiftright" in text


def test_a_snapshot_is_not_expanded(spark):
    rows = spark.createDataFrame(INVENTORY, "inv_date_sk int, inv_item_sk long, inv_warehouse_sk int, inv_quantity_on_hand int")
    days = spark.createDataFrame([(10, date(1998, 1, 1), 1998, 4), (17, date(1998, 1, 8), 1998, 3), (24, date(1999, 1, 1), 1999, 5)],
                                 "d_date_sk int, d_date date, d_year int, d_dow int")
    got = inventory_snapshot(SimpleNamespace(inventory=rows, date_dim=days))
    assert "Expand" not in plan(got)
    want = []
    year, dow = {10: 1998, 17: 1998, 24: 1999}, {10: 4, 17: 3, 24: 5}
    for w, y in {(r[2], year[r[0]]) for r in INVENTORY if r[0]}:
        of = [r for r in INVENTORY if r[2] == w and year.get(r[0]) == y]
        on_hand = [r[3] for r in of if r[3] is not None]
        want.append((w, y, len({r[0] for r in of}), len({r[1] for r in of} - {None}), sum(on_hand) / len(on_hand),
                     min(dow[r[0]] for r in of), max(dow[r[0]] for r in of)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())


def test_inventory_shuffles_blocks_of_weeks(spark):
    dealt, whole = StarBuilder(spark, SF_SMALL, tasks=4).inventory(), StarBuilder(spark, SF_SMALL).inventory()
    below = plan(dealt).split("rangepartitioning(")[1]
    assert "inv_date_sk" not in below and dealt.count() == whole.count() and dealt.exceptAll(whole).isEmpty()


def test_clustered_rows_are_stored_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([(2450815 + i, i) for i in range(20)] + [(None, 99)], "d int, k long").coalesce(1)
    t = VersionedTable(spark, str(tmp_path), "d", 10)
    t.create(rows, clustered=True)
    files = [f for x in t.folders().values() for f in os.listdir(f"{tmp_path}/{x[0]}") if f.endswith(".parquet")]
    assert len(files) == 3 and sorted(r.k for r in t.read().collect()) == [*range(20), 99]


def test_profiles_compute_no_wide_decimal_a_row(spark):
    rows = spark.range(100).select("id", F.col("id").cast("int").alias("i"), F.lit(1).cast("decimal(7,2)").alias("m"))
    assert "cast(id" not in plan(row_checksum(rows)).split("sum(")[1] and "decimal(20,0))" not in plan(row_checksum(rows)).split("HashAggregate")[-1]
    assert "decimal(20,2)" not in column_sketches(rows)._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]


def test_the_checksum_is_that_of_the_digests(spark):
    import hashlib
    got = row_checksum(spark.range(50)).first()
    digests = [hashlib.md5(str(i).encode()).hexdigest() for i in range(50)]
    assert [got.checksum_1, got.checksum_2] == [str(sum(int(d[k:k + 8], 16) for d in digests)) for k in (0, 8)]
