"""Order and return feeds: rejected lines, unknown ids, replays, whole rows."""

import pytest
from pyspark.sql import functions as F

from shelfline.plans.star import load_star
from shelfline.sources.versions import VersionedTable
from shelfline.streaming import channels as C
from tests.conftest import SF_SMALL

CHANNEL = {c.name: c for c in C.CHANNELS}


@pytest.fixture(scope="module")
def st(spark):
    return load_star(spark, SF_SMALL)


def feed(spark, st, ch):
    """Four headers and eight lines made by hand from one item with two revisions."""
    two = st.item.filter("i_rec_end_date IS NOT NULL").orderBy("i_item_sk").first()
    later = st.item.filter((F.col("i_item_id") == two.i_item_id) & F.col("i_rec_end_date").isNull()).first()
    cust = st.customer.orderBy("c_customer_sk").first()
    outlet = st[ch.outlet[0]].orderBy(ch.outlet[1]).first()
    heads = [(3, "1998-03-01", 77, cust.c_customer_id, outlet[ch.outlet[2]]), (7, "2000-03-01", None, None, "nowhere"),
             (11, "yesterday", 1, "nobody", None), (15, None, 1, None, None)]
    lines = [(3, 1, two.i_item_id, 2, "3.00", "1.00", None), (3, 2, two.i_item_id, 2, "4.00", None, None),
             (3, 3, "no item", 1, "1.00", "0.00", "no promo"), (7, 1, two.i_item_id, 3, "2.50", "0.00", None),
             (11, 1, two.i_item_id, 1, "1.00", "0.00", None), (15, 1, two.i_item_id, 1, "1.00", "0.00", None),
             (99, 1, two.i_item_id, 1, "1.00", "0.00", None), (99, 2, None, 1, "1.00", "0.00", None)]
    h = spark.createDataFrame(heads, "order_id long, order_date string, order_time int, bill_customer_id string, outlet_id string")
    x = spark.createDataFrame(lines, "order_id long, line_number long, item_id string, quantity int, sales_price string, coupon_amt string, promo_id string")
    x = x.withColumn("sales_price", F.col("sales_price").cast("decimal(7,2)")).withColumn("coupon_amt", F.col("coupon_amt").cast("decimal(7,2)"))
    if ch.ships:
        h = h.withColumn("ship_customer_id", F.col("bill_customer_id")).withColumn("ship_mode_id", F.lit(None).cast("string"))
        x = (x.withColumn("ship_date", F.lit("1998-13-45")).withColumn("warehouse_id", F.lit(None).cast("string"))
             .withColumn("page_id", F.lit(None).cast("string")).withColumn("ship_cost", F.lit("0.50").cast("decimal(7,2)")))
    return h, x, two, later, cust


@pytest.mark.parametrize("name", CHANNEL)
def test_lines_and_their_faults(spark, st, name):
    ch = CHANNEL[name]
    h, x, two, later, cust = feed(spark, st, ch)
    resolved = C.resolve_orders(st, ch, h, x)
    rows = C.sales_rows(st, ch, resolved)
    assert rows.schema.simpleString() == st[f"{name}_sales"].schema.simpleString()
    p = ch.sales
    got = {r[f"{p}_{ch.number}"]: r for r in rows.collect()}
    assert set(got) == {3, 7}
    # the revision of the order's day; no time given, no fault; an unknown outlet has no tax
    assert got[3][f"{p}_item_sk"] == two.i_item_sk and got[7][f"{p}_item_sk"] == later.i_item_sk
    assert got[3][f"{p}_sold_time_sk"] == 77 and got[7][f"{p}_sold_time_sk"] is None and got[7][f"{p}_{ch.outlet_key}"] is None
    assert got[3][f"{p}_customer_sk" if name == "store" else f"{p}_ship_customer_sk"] == cust.c_customer_sk
    rate = st[ch.outlet[0]].orderBy(ch.outlet[1]).first()[ch.outlet[3]]
    assert got[3][f"{p}_net_paid"] == 5 and float(got[3][f"{p}_ext_tax"]) == round(5 * float(rate), 2) and got[7][f"{p}_ext_tax"] == 0
    assert got[3][f"{p}_net_profit"] == 5 - 2 * two.i_wholesale_cost
    assert got[3][f"{p}_ext_discount_amt"] == 2 * (two.i_current_price - 3)
    if ch.ships:
        assert float(got[7][f"{p}_net_paid_inc_ship"]) == 9.0 and got[3][f"{p}_ship_date_sk"] is None
    out = {(r.order_id, r.line_number, r.role): (r.value, r.rejected) for r in C.rejects(ch, resolved).collect()}
    bad = {k: v for k, v in out.items() if v[1]}
    assert bad == {(3, 2, "repeated"): (two.i_item_id, True), (3, 3, "item"): ("no item", True), (11, 1, "sold_date"): ("yesterday", True),
                   (11, 1, "item"): (two.i_item_id, True), (15, 1, "sold_date"): (None, True), (15, 1, "item"): (two.i_item_id, True),
                   (99, 1, "header"): ("99", True), (99, 2, "header"): ("99", True)}
    assert out[3, 3, "promo"] == ("no promo", False) and out[7, 1, "outlet"] == ("nowhere", False)
    assert out[11, 1, "bill_customer"] == ("nobody", False)
    assert ((3, 1, "ship_date") in out) == ch.ships


def test_a_replay_adds_nothing_and_touches_few_buckets(spark, st, tmp_path):
    ch = CHANNEL["web"]
    h, x, *_ = feed(spark, st, ch)
    table = VersionedTable(spark, str(tmp_path), "ws_sold_date_sk")
    table.create(st.web_sales)
    before, n = table.folders(), st.web_sales.count()
    C.load_orders(st, ch, table, h, x)
    assert table.version() == 2 and table.read().count() == n + 2
    after = table.folders()
    assert sum(after[b] != before.get(b) for b in after) == 2
    assert all(after[b][:len(f)] == f for b, f in before.items())
    C.load_orders(st, ch, table, h, x)
    assert table.version() == 2
    other = st.item.filter("i_rec_end_date IS NULL AND i_rec_start_date < '1999-01-01'").orderBy("i_item_sk").first().i_item_id
    more = x.union(x.filter("order_id = 7").withColumn("line_number", F.lit(9).cast("long")).withColumn("item_id", F.lit(other)))
    C.load_orders(st, ch, table, h, more)                      # a repeated feed with one line more
    assert table.version() == 3 and table.read().count() == n + 3


def test_empty_feeds(spark, st):
    for ch in C.CHANNELS:
        h, x, *_ = feed(spark, st, ch)
        resolved = C.resolve_orders(st, ch, h.limit(0), x.limit(0))
        assert C.sales_rows(st, ch, resolved).count() == 0 and C.rejects(ch, resolved).count() == 0
        f = C.return_feed(st, ch).limit(0)
        assert C.return_rows(st, ch, C.resolve_returns(st, ch, f)).count() == 0


@pytest.mark.parametrize("name", CHANNEL)
def test_returns_are_whole_rows_of_known_sales(spark, st, name):
    ch = CHANNEL[name]
    f = C.return_feed(st, ch, days=400, flaws=False)
    r = C.resolve_returns(st, ch, f)
    assert r.filter("NOT linked").count() == 0 and r.count() == f.count()
    rows = C.return_rows(st, ch, r)
    stored = st[f"{name}_returns"]
    assert rows.schema.simpleString() == stored.schema.simpleString()
    # amounts, dates and keys of the sale come back as they were; customers' profiles are today's
    same = [c for c in stored.columns if not any(k in c for k in ("cdemo", "hdemo", "addr"))]
    # of an order with two revisions of one business id the returns may take the other one
    single = (st[f"{name}_sales"].join(st.item, ch.sale("item_sk") == F.col("i_item_sk"))
              .groupBy(ch.sale(ch.number).alias("n"), "i_item_id").count().filter("count > 1").select("n").distinct())
    mine = rows.join(single, F.col(f"{ch.returns}_{ch.number}") == F.col("n"), "left_anti").select(same)
    theirs = stored.join(single, F.col(f"{ch.returns}_{ch.number}") == F.col("n"), "left_anti").select(same)
    assert mine.count() and mine.exceptAll(theirs).count() == 0
