"""Incremental refresh of the star schema (survey section 2.3).

Staging feeds carry business ids (customer id, item id, store id, ISO date
text) the way an operational system would send them. Applying a feed means
resolving every business id to its surrogate key -- items as of the sale
date, because the item dimension keeps type-2 history -- deriving the money
columns, and appending; deletes remove date ranges and cascade to returns;
type-2 updates close the current revision and open a new one.

Each ``apply_*`` function is a pure DataFrame transformation of one batch,
so the same code runs as a batch job or per micro-batch from Structured
Streaming through :func:`stream_refresh` (``foreachBatch``). The registered
jobs build their feeds from the loaded tables (the latest weeks of activity
re-expressed with business ids) and report what an apply would write.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions.money import rdiv, to_money
from shelfline.plans.registry import star_query
from shelfline.plans.star import FRESH_PURCHASE
from shelfline.session import SHUFFLES_END, held
from shelfline.sources.io import scratch_path
from shelfline.sources.versions import VersionedTable

B = F.broadcast
FAR_FUTURE = "9999-12-31"
KEY_BLOCK_BITS = 20          # a million keys in a block


# --------------------------------------------------------------------------- feeds (derived from loaded data)
def purchase_feed(st, days: int = 60) -> DataFrame:
    """Store purchases of the last ``days`` days, re-expressed with business ids
    and fresh purchase ids (the shape of an operational purchase feed)."""
    last = st.store_sales.agg(F.max("ss_sold_date_sk").alias("last_sk"))
    ss = st.store_sales.crossJoin(B(last)).filter(F.col("ss_sold_date_sk") > F.col("last_sk") - days)
    return (ss.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("ss_sold_date_sk") == F.col("d_date_sk"))
              .join(st.item.select("i_item_sk", "i_item_id"), F.col("ss_item_sk") == F.col("i_item_sk"))
              .join(st.customer.select("c_customer_sk", "c_customer_id"), F.col("ss_customer_sk") == F.col("c_customer_sk"), "left")
              .join(B(st.store.select("s_store_sk", "s_store_id")), F.col("ss_store_sk") == F.col("s_store_sk"), "left")
              .select((F.col("ss_ticket_number") + FRESH_PURCHASE).alias("purchase_id"),
                      F.col("ss_item_sk").alias("line_number"), F.col("i_item_id").alias("item_id"),
                      F.col("c_customer_id").alias("customer_id"), F.col("s_store_id").alias("store_id"),
                      F.date_format("d_date", "yyyy-MM-dd").alias("purchase_date"),
                      F.col("ss_quantity").alias("quantity"), F.col("ss_sales_price").alias("sale_price"),
                      F.col("ss_coupon_amt").alias("coupon_amt")))


def _item_as_of(st, date_col: str) -> tuple[DataFrame, F.Column]:
    it = st.item.select("i_item_sk", F.col("i_item_id").alias("r_item_id"), "i_rec_start_date", "i_rec_end_date",
                        "i_wholesale_cost", "i_current_price")
    cond = ((F.col(date_col) >= F.col("i_rec_start_date"))
            & (F.col(date_col) <= F.coalesce(F.col("i_rec_end_date"), F.lit(FAR_FUTURE).cast("date"))))
    return it, cond


# --------------------------------------------------------------------------- U1: insert sales
def apply_insert_sales(st, feed: DataFrame) -> DataFrame:
    """Resolve a purchase feed to store_sales rows (surrogate keys, prices)."""
    f = feed.withColumn("sold_date", F.to_date("purchase_date"))
    it, asof = _item_as_of(st, "sold_date")
    r = (f.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("sold_date") == F.col("d_date"), "left")
          .join(it, (F.col("item_id") == F.col("r_item_id")) & asof, "left")
          .join(st.customer.select("c_customer_sk", "c_customer_id", "c_current_addr_sk", "c_current_cdemo_sk",
                                   "c_current_hdemo_sk"), F.col("customer_id") == F.col("c_customer_id"), "left")
          .join(B(st.store.select("s_store_sk", "s_store_id")), F.col("store_id") == F.col("s_store_id"), "left"))
    q = F.col("quantity")
    ext_sales = F.col("sale_price") * q
    ext_whole = F.col("i_wholesale_cost") * q
    net_paid = ext_sales - F.col("coupon_amt")
    return r.select(
        F.col("d_date_sk").alias("ss_sold_date_sk"), F.col("i_item_sk").alias("ss_item_sk"),
        F.col("c_customer_sk").alias("ss_customer_sk"), F.col("c_current_cdemo_sk").alias("ss_cdemo_sk"),
        F.col("c_current_hdemo_sk").alias("ss_hdemo_sk"), F.col("c_current_addr_sk").alias("ss_addr_sk"),
        F.col("s_store_sk").alias("ss_store_sk"), F.col("purchase_id").alias("ss_ticket_number"),
        q.alias("ss_quantity"), F.col("sale_price").alias("ss_sales_price"),
        ext_sales.cast("decimal(7,2)").alias("ss_ext_sales_price"), ext_whole.cast("decimal(7,2)").alias("ss_ext_wholesale_cost"),
        F.col("coupon_amt").alias("ss_coupon_amt"), net_paid.cast("decimal(7,2)").alias("ss_net_paid"),
        (net_paid - ext_whole).cast("decimal(7,2)").alias("ss_net_profit"))


@star_query("refresh_insert_sales")
def refresh_insert_sales(st, days=60):
    """Insert refresh: resolve the latest purchases' business ids and price them."""
    rows = apply_insert_sales(st, purchase_feed(st, days))
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.sum(F.col("ss_item_sk").isNull().cast("int")).alias("unresolved_items"),
                    F.sum(F.col("ss_sold_date_sk").isNull().cast("int")).alias("unresolved_dates"),
                    F.count("ss_customer_sk").alias("resolved_customers"),
                    F.sum("ss_net_paid").cast("double").alias("net_paid"),
                    F.sum("ss_net_profit").cast("double").alias("net_profit"))


# --------------------------------------------------------------------------- U2: insert returns
def return_feed(st, days: int = 60) -> DataFrame:
    last = st.store_returns.agg(F.max("sr_returned_date_sk").alias("last_sk"))
    sr = st.store_returns.crossJoin(B(last)).filter(F.col("sr_returned_date_sk") > F.col("last_sk") - days)
    return (sr.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("sr_returned_date_sk") == F.col("d_date_sk"))
              .join(st.item.select("i_item_sk", "i_item_id"), F.col("sr_item_sk") == F.col("i_item_sk"))
              .join(B(st.reason.select("r_reason_sk", "r_reason_id")), F.col("sr_reason_sk") == F.col("r_reason_sk"), "left")
              .select(F.col("sr_ticket_number").alias("purchase_id"), F.col("i_item_id").alias("item_id"),
                      F.date_format("d_date", "yyyy-MM-dd").alias("return_date"),
                      F.col("sr_return_quantity").alias("return_qty"), F.col("sr_return_amt").alias("return_amt"),
                      F.col("r_reason_id").alias("reason_id")))


def apply_insert_returns(st, feed: DataFrame) -> DataFrame:
    """Resolve a return feed and link each return to its original sale line."""
    f = feed.withColumn("ret_date", F.to_date("return_date"))
    it, asof = _item_as_of(st, "ret_date")
    r = (f.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("ret_date") == F.col("d_date"), "left")
          .join(it, (F.col("item_id") == F.col("r_item_id")) & asof, "left")
          .join(B(st.reason.select("r_reason_sk", "r_reason_id")), F.col("reason_id") == F.col("r_reason_id"), "left"))
    sale = st.store_sales.select("ss_ticket_number", "ss_item_sk", "ss_customer_sk", "ss_store_sk", "ss_quantity")
    # the sold item may be an earlier revision of the same business id: match on ticket + business id
    sale = sale.join(st.item.select(F.col("i_item_sk").alias("s_item_sk"), F.col("i_item_id").alias("s_item_id")),
                     F.col("ss_item_sk") == F.col("s_item_sk"))
    j = r.join(sale, (F.col("purchase_id") == F.col("ss_ticket_number")) & (F.col("item_id") == F.col("s_item_id")), "left")
    return j.select(F.col("d_date_sk").alias("sr_returned_date_sk"), F.col("ss_item_sk").alias("sr_item_sk"),
                    F.col("ss_customer_sk").alias("sr_customer_sk"), F.col("ss_store_sk").alias("sr_store_sk"),
                    F.col("r_reason_sk").alias("sr_reason_sk"), F.col("purchase_id").alias("sr_ticket_number"),
                    F.col("return_qty").alias("sr_return_quantity"), F.col("return_amt").alias("sr_return_amt"),
                    (F.col("return_qty") > F.col("ss_quantity")).alias("over_returned"))


@star_query("refresh_insert_returns")
def refresh_insert_returns(st, days=60):
    """Insert refresh of returns: business-key resolution plus link to the sale."""
    rows = apply_insert_returns(st, return_feed(st, days))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count("sr_item_sk").alias("linked_to_sale"),
                    F.count("sr_reason_sk").alias("resolved_reasons"),
                    F.sum(F.coalesce(F.col("over_returned").cast("int"), F.lit(0))).alias("over_returned"),
                    F.sum("sr_return_amt").cast("double").alias("return_amt"))


# --------------------------------------------------------------------------- U3: inventory
def inventory_feed(st, weeks: int = 4) -> DataFrame:
    last = st.inventory.agg(F.max("inv_date_sk").alias("last_sk"))
    inv = st.inventory.crossJoin(B(last)).filter(F.col("inv_date_sk") > F.col("last_sk") - 7 * weeks)
    return (inv.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("inv_date_sk") == F.col("d_date_sk"))
               .join(st.item.select("i_item_sk", "i_item_id"), F.col("inv_item_sk") == F.col("i_item_sk"))
               .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_id")), F.col("inv_warehouse_sk") == F.col("w_warehouse_sk"))
               .select(F.col("w_warehouse_id").alias("warehouse_id"), F.col("i_item_id").alias("item_id"),
                       F.date_format(F.date_add("d_date", 7 * weeks), "yyyy-MM-dd").alias("inv_date"),
                       F.col("inv_quantity_on_hand").alias("qty_on_hand")))


def apply_inventory(st, feed: DataFrame) -> DataFrame:
    f = feed.withColumn("snap_date", F.to_date("inv_date"))
    it, asof = _item_as_of(st, "snap_date")
    r = (f.join(B(st.date_dim.select("d_date_sk", "d_date")), F.col("snap_date") == F.col("d_date"), "left")
          .join(it, (F.col("item_id") == F.col("r_item_id")) & asof, "left")
          .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_id")), F.col("warehouse_id") == F.col("w_warehouse_id"), "left"))
    return r.select(F.col("d_date_sk").alias("inv_date_sk"), F.col("i_item_sk").alias("inv_item_sk"),
                    F.col("w_warehouse_sk").alias("inv_warehouse_sk"), F.col("qty_on_hand").alias("inv_quantity_on_hand"))


@star_query("refresh_inventory")
def refresh_inventory(st, weeks=4):
    """Inventory refresh: the next snapshots keyed by business ids, resolved."""
    rows = apply_inventory(st, inventory_feed(st, weeks))
    return rows.groupBy("inv_warehouse_sk").agg(F.count(F.lit(1)).alias("rows"),
                                                F.count("inv_item_sk").alias("resolved_items"),
                                                F.sum("inv_quantity_on_hand").alias("qty"))


# --------------------------------------------------------------------------- U4: deletes
def apply_delete(sales: DataFrame, returns: DataFrame, ranges: list[tuple[int, int]],
                 date_col: str, keys: tuple[str, str], rkeys: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Delete sales in the date ranges and cascade to their returns.

    The ranges are a handful of literals, so the sale filter is a plain
    predicate (pushed to the scan); the cascade is an anti join of returns
    against the deleted (item, order) keys."""
    in_range = None
    for lo, hi in ranges:
        c = F.col(date_col).between(lo, hi)
        in_range = c if in_range is None else (in_range | c)
    kept = sales.filter(~in_range | F.col(date_col).isNull())
    deleted = sales.filter(in_range).select(F.col(keys[0]).alias("d_k0"), F.col(keys[1]).alias("d_k1"))
    kept_returns = returns.join(deleted, (F.col(rkeys[0]) == F.col("d_k0")) & (F.col(rkeys[1]) == F.col("d_k1")),
                                "left_anti")
    return kept, kept_returns


def delete_inventory(inventory: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Snapshots outside the date ranges (inventory has ranges of its own and no returns)."""
    hit = None
    for lo, hi in ranges:
        c = F.col("inv_date_sk").between(lo, hi)
        hit = c if hit is None else (hit | c)
    return inventory.filter(~hit | F.col("inv_date_sk").isNull())


@star_query("refresh_delete")
def refresh_delete(st, ranges=((2451180, 2451181), (2451300, 2451301), (2451420, 2451421)),
                   inventory_ranges=((2451179, 2451185), (2451298, 2451304), (2451417, 2451423))):
    """Delete three two-day ranges of sales of every channel with their returns,
    and three weekly ranges of inventory; rows and money that stay."""
    out = []
    for channel, p, r, number, amount in [("store", "ss", "sr", "ticket_number", "return_amt"),
                                          ("catalog", "cs", "cr", "order_number", "return_amount"),
                                          ("web", "ws", "wr", "order_number", "return_amt")]:
        kept, kept_returns = apply_delete(st[f"{channel}_sales"], st[f"{channel}_returns"], list(ranges), f"{p}_sold_date_sk",
                                          (f"{p}_item_sk", f"{p}_{number}"), (f"{r}_item_sk", f"{r}_{number}"))
        out += [(f"{channel}_sales", kept, f"{p}_net_paid"), (f"{channel}_returns", kept_returns, f"{r}_{amount}")]
    out.append(("inventory", delete_inventory(st.inventory, list(inventory_ranges)), "inv_quantity_on_hand"))
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.sum(m).cast("double").alias("total"))
             .select(F.lit(t).alias("table_name"), "rows", "total") for t, df, m in out]
    total = parts[0]
    for x in parts[1:]:
        total = total.unionByName(x)
    return total


# --------------------------------------------------------------------------- stored tables
def _in_ranges(date_col: str, ranges) -> F.Column:
    hit = F.lit(False)
    for lo, hi in ranges:
        hit = hit | F.col(date_col).between(lo, hi)
    return F.coalesce(hit, F.lit(False))


def delete_from_stored(sales: VersionedTable, returns: VersionedTable, ranges: list[tuple[int, int]],
                       keys: tuple[str, str], rkeys: tuple[str, str]) -> tuple[int, int]:
    """Delete the sales of the date ranges and their returns from stored tables; the new versions.

    Only buckets that lose rows are rewritten. The returns go first, while the
    sales still name them, so a run that stops between the two can be repeated.
    """
    gone = (sales.read().filter(_in_ranges(sales.date_col, ranges))
            .select(F.col(keys[0]).alias("d_k0"), F.col(keys[1]).alias("d_k1")).distinct())
    match = (F.col(rkeys[0]) == F.col("d_k0")) & (F.col(rkeys[1]) == F.col("d_k1"))
    hit = returns.read().join(gone, match, "left_semi").select(returns.bucket().alias("b")).distinct()
    touched = {r.b for r in hit.collect()}                      # ranges of the calendar
    after_returns = returns.rewrite(touched, lambda rows: rows.join(gone, match, "left_anti"))
    hit = sales.read().filter(_in_ranges(sales.date_col, ranges)).select(sales.bucket().alias("b")).distinct()
    after_sales = sales.rewrite({r.b for r in hit.collect()}, lambda rows: rows.filter(~_in_ranges(sales.date_col, ranges)))
    return after_sales, after_returns


def _stored_copy(st, table: str, date_col: str) -> VersionedTable:
    out = VersionedTable(st.spark, scratch_path(st.spark, f"stored-{table}"), date_col)
    out.create(st[table], clustered=True)          # star facts lie in files of few dates
    return out


@star_query("refresh_delete_stored")
def refresh_delete_stored(st, ranges=((2451180, 2451181), (2451300, 2451301), (2451420, 2451421)),
                          inventory_ranges=((2451179, 2451185), (2451298, 2451304), (2451417, 2451423))):
    """The deletes of every channel and of inventory, written; the tables as a reader finds them after.

    The stored tables are this run's own: what a delete has replaced is removed after it."""
    out = []
    for channel, p, r, number, amount in [("store", "ss", "sr", "ticket_number", "return_amt"),
                                          ("catalog", "cs", "cr", "order_number", "return_amount"),
                                          ("web", "ws", "wr", "order_number", "return_amt")]:
        sales = _stored_copy(st, f"{channel}_sales", f"{p}_sold_date_sk")
        returns = _stored_copy(st, f"{channel}_returns", f"{r}_returned_date_sk")
        with held(st.spark, SHUFFLES_END):
            delete_from_stored(sales, returns, list(ranges), (f"{p}_item_sk", f"{p}_{number}"), (f"{r}_item_sk", f"{r}_{number}"))
        sales.vacuum()
        returns.vacuum()
        out += [(f"{channel}_sales", sales, f"{p}_net_paid"), (f"{channel}_returns", returns, f"{r}_{amount}")]
    inventory = _stored_copy(st, "inventory", "inv_date_sk")
    hit = inventory.read().filter(_in_ranges("inv_date_sk", inventory_ranges)).select(inventory.bucket().alias("b")).distinct()
    inventory.rewrite({x.b for x in hit.collect()}, lambda rows: rows.filter(~_in_ranges("inv_date_sk", inventory_ranges)))
    inventory.vacuum()
    out.append(("inventory", inventory, "inv_quantity_on_hand"))
    return functools.reduce(DataFrame.unionByName, [
        t.read().agg(F.count(F.lit(1)).alias("rows"), F.sum(m).cast("double").alias("total"))
        .select(F.lit(n).alias("table_name"), "rows", "total") for n, t, m in out])


@star_query("refresh_inventory_stored")
def refresh_inventory_stored(st, weeks=4):
    """The inventory feed appended to the stored table; the table as a reader finds it after."""
    table = _stored_copy(st, "inventory", "inv_date_sk")
    table.append(apply_inventory(st, inventory_feed(st, weeks)))
    return table.read().groupBy("inv_warehouse_sk").agg(F.count(F.lit(1)).alias("rows"), F.count("inv_item_sk").alias("resolved_items"),
                                                        F.sum("inv_quantity_on_hand").alias("qty"))


# --------------------------------------------------------------------------- U5: type-2 update
def price_change_feed(st, every: int = 5, pct: int = 10) -> DataFrame:
    """New prices for every ``every``-th business id (+pct%)."""
    cur = st.item.filter(F.col("i_rec_end_date").isNull())
    return cur.filter(F.pmod(F.col("i_item_sk"), F.lit(every)) == 0).select(
        F.col("i_item_id").alias("item_id"),
        to_money(rdiv((F.col("i_current_price") * 100).cast("long") * (100 + pct), 100)).alias("new_price"))


def apply_scd2(dim: DataFrame, changes: DataFrame, effective: str, key_offset: DataFrame) -> DataFrame:
    """Close the current revision of each changed business id the day before
    ``effective`` and open a new revision with the next surrogate keys after
    the largest (numbered in steps: inside blocks of old keys, after the counts
    of the blocks before, so no task orders the whole dimension)."""
    eff = F.lit(effective).cast("date")
    cur = F.col("i_rec_end_date").isNull()
    tagged = dim.join(changes, dim.i_item_id == changes.item_id, "left")
    changed = cur & F.col("item_id").isNotNull()
    old = tagged.select(*[F.when(changed, F.date_sub(eff, 1)).otherwise(F.col(c)).alias(c) if c == "i_rec_end_date"
                          else F.col(c) for c in dim.columns], F.when(changed, F.lit("closed")).otherwise(F.lit("unchanged")).alias("status"))
    block = F.shiftright(F.col("i_item_sk").cast("long"), KEY_BLOCK_BITS)
    numbered = tagged.filter(changed).withColumn("key_block", block)
    counts = numbered.groupBy("key_block").agg(F.count(F.lit(1)).alias("block_rows"))
    before = counts.select("key_block", F.coalesce(F.sum("block_rows").over(
        Window.orderBy("key_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rows_before"))
    numbered = (numbered.join(before, "key_block").withColumn(
        "key_place", F.col("rows_before") + F.row_number().over(Window.partitionBy("key_block").orderBy("i_item_sk"))))
    new = (numbered.crossJoin(F.broadcast(key_offset))
           .select(*[(F.col("key_place") + F.col("max_sk")).cast("long").alias(c) if c == "i_item_sk"
                     else eff.alias(c) if c == "i_rec_start_date"
                     else F.lit(None).cast("date").alias(c) if c == "i_rec_end_date"
                     else F.col("new_price").alias(c) if c == "i_current_price"
                     else F.col(c) for c in dim.columns], F.lit("opened").alias("status")))
    return old.unionByName(new)


@star_query("refresh_scd2")
def refresh_scd2(st, effective="2001-01-01"):
    """Type-2 price update of the item dimension: closed + opened revisions."""
    key_offset = st.item.agg(F.max("i_item_sk").alias("max_sk"))
    out = apply_scd2(st.item, price_change_feed(st), effective, key_offset)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("rows"),
                                     F.countDistinct("i_item_id").alias("business_ids"),
                                     F.sum("i_current_price").cast("double").alias("price_sum"),
                                     F.min("i_item_sk").alias("min_sk"), F.max("i_item_sk").alias("max_sk"))


# --------------------------------------------------------------------------- streaming adapter
def stream_refresh(spark: SparkSession, st, feed_dir: str, feed_schema, target_path: str, checkpoint: str):
    """Apply purchase-feed files as they arrive: a file-source stream whose
    micro-batches are resolved by :func:`apply_insert_sales` and written to
    ``target_path``. A batch owns the partition of its batch id and overwrites
    it, so a batch that is run again after a failure replaces its rows."""
    stream = spark.readStream.schema(feed_schema).parquet(feed_dir)

    def _apply(batch: DataFrame, batch_id: int) -> None:
        apply_insert_sales(st, batch).write.mode("overwrite").parquet(f"{target_path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(_apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
