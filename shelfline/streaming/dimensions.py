"""Dimension feeds merged into type-1 and type-2 dimensions.

One full outer join of the dimension (all revisions) with the feed, by business
id, decides every row. A feed states new values of tracked columns; null means
"not stated". Columns to overwrite change in every revision of the id. Columns
with history, if one of them differs in the current revision, close it the day
before the feed takes effect and open a new one; a revision that began on that
very day is corrected in place. Unknown ids are inserted. A type-1 dimension is
one without history columns. Applying a feed again changes nothing.

A feed names an id once; rows without an id are not applied.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.money import rdiv, to_money
from shelfline.plans.registry import star_query
from shelfline.sources.io import scratch_path
from shelfline.sources.versions import VersionedTable
from shelfline.streaming.channels import _staged

KEYS_A_BUCKET = 1 << 20


@dataclass(frozen=True)
class Dimension:
    table: str
    sk: str
    id: str
    overwrite: tuple[str, ...]
    history: tuple[str, ...] = ()
    start: str | None = None
    end: str | None = None


ITEM = Dimension("item", "i_item_sk", "i_item_id", ("i_manager_id", "i_container"),
                 ("i_current_price", "i_wholesale_cost", "i_color"), "i_rec_start_date", "i_rec_end_date")
STORE = Dimension("store", "s_store_sk", "s_store_id", ("s_hours", "s_floor_space"),
                  ("s_manager", "s_number_employees"), "s_rec_start_date", "s_rec_end_date")
CUSTOMER = Dimension("customer", "c_customer_sk", "c_customer_id", ("c_email_address", "c_last_name", "c_preferred_cust_flag"))


def _any(conditions: list[Column]) -> Column:
    return functools.reduce(Column.__or__, conditions, F.lit(False))


def merge_dimension(rows: DataFrame, feed: DataFrame, dim: Dimension, effective: str) -> DataFrame:
    """The dimension after the feed, with ``status``: unchanged, overwritten, closed, opened or inserted.

    Opened and inserted rows have no surrogate key yet (see :func:`numbered`).
    """
    eff = F.lit(effective).cast("date")
    tracked = dim.overwrite + dim.history
    f = feed.filter(F.col(dim.id).isNotNull()).select(F.col(dim.id).alias("_id"), *[F.col(c).alias(f"_{c}") for c in tracked])
    j = rows.join(f, F.col(dim.id) == F.col("_id"), "full_outer")

    def differs(c: str) -> Column:
        return F.col(f"_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}"))

    known = F.col(dim.id).isNotNull() & F.col("_id").isNotNull()
    new = F.col(dim.id).isNull() & F.col("_id").isNotNull()
    current = F.col(dim.end).isNull() if dim.end else F.lit(True)
    moved = known & current & _any([differs(c) for c in dim.history])
    same_day = F.col(dim.start) == eff if dim.start else F.lit(False)
    fixed = known & (_any([differs(c) for c in dim.overwrite]) | (moved & same_day))
    status = (F.when(new, F.array(F.lit("inserted"))).when(moved & ~same_day, F.array(F.lit("closed"), F.lit("opened")))
              .when(fixed, F.array(F.lit("overwritten"))).otherwise(F.array(F.lit("unchanged"))))
    j = j.withColumn("_in_place", moved & same_day).withColumn("status", F.explode(status))
    s = F.col("status")

    def value(c: str) -> Column:
        if c == dim.sk:
            return F.when(s.isin("opened", "inserted"), None).otherwise(F.col(c))
        if c == dim.id:
            return F.coalesce(dim.id, "_id")
        if c == dim.start:
            return F.when(s.isin("opened", "inserted"), eff).otherwise(F.col(c))
        if c == dim.end:
            return F.when(s == "closed", F.date_sub(eff, 1)).when(s.isin("opened", "inserted"), None).otherwise(F.col(c))
        if c in dim.overwrite:
            return F.coalesce(f"_{c}", c)
        if c in dim.history:
            return F.when(s.isin("opened", "inserted") | F.col("_in_place"), F.coalesce(f"_{c}", c)).otherwise(F.col(c))
        return F.col(c)

    return j.select(*[value(x.name).cast(x.dataType).alias(x.name) for x in rows.schema], "status")


def numbered(merged: DataFrame, dim: Dimension, largest: int) -> DataFrame:
    """Surrogate keys after ``largest`` for the rows without one.

    New ids are numbered inside 4,096 buckets of their digest, after the counts
    of the buckets before, so no task orders them all.
    """
    bucket = F.substring(F.md5(F.col(dim.id).cast("binary")), 1, 3)
    fresh = merged.filter(F.col(dim.sk).isNull() & F.col("status").isin("opened", "inserted")).withColumn("_bucket", bucket)
    counts = fresh.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))               # at most 4,096 rows
    before = counts.select("_bucket", F.coalesce(F.sum("_n").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(dim.id))
    kind = merged.schema[dim.sk].dataType
    fresh = (fresh.join(F.broadcast(before), "_bucket")
             .withColumn(dim.sk, (F.lit(largest) + F.col("_before") + place).cast(kind)).select(*merged.columns))
    return merged.filter(~(F.col(dim.sk).isNull() & F.col("status").isin("opened", "inserted"))).unionByName(fresh)


def apply_feed(rows: DataFrame, feed: DataFrame, dim: Dimension, effective: str) -> DataFrame:
    """The numbered dimension after the feed, with ``status``; written once."""
    merged = _staged(merge_dimension(rows, feed, dim, effective), f"merge-{dim.table}")
    largest = rows.agg(F.max(dim.sk)).first()[0] or 0
    return numbered(merged, dim, largest)


def stored_dimension(spark, path: str, dim: Dimension) -> VersionedTable:
    """A stored dimension, cut into buckets of a million surrogate keys."""
    return VersionedTable(spark, path, dim.sk, KEYS_A_BUCKET)


def merge_stored(table: VersionedTable, feed: DataFrame, dim: Dimension, effective: str) -> int:
    """Merge a feed into a stored dimension by one commit; only buckets with changed keys are rewritten."""
    rows = table.read()
    changed = _staged(apply_feed(rows, feed, dim, effective).filter("status <> 'unchanged'"), f"changed-{dim.table}")
    if changed.isEmpty():
        return table.version()
    old = changed.filter(F.col("status").isin("closed", "overwritten"))
    touched = {r.b for r in old.select(table.bucket().alias("b")).distinct().collect()}      # one for a million keys
    gone = old.select(F.col(dim.sk).alias("_sk"))
    return table.rewrite(touched, lambda kept: kept.join(gone, F.col(dim.sk) == F.col("_sk"), "left_anti"),
                         plus=changed.drop("status"))


# --------------------------------------------------------------------------- feeds (derived from loaded data)
def item_feed(st) -> DataFrame:
    """New prices for every fifth item, another manager for the next fifth, and new items."""
    cur = st.item.filter(F.col("i_rec_end_date").isNull())
    k = F.pmod("i_item_sk", F.lit(5))
    price = to_money(rdiv((F.col("i_current_price") * 100).cast("long") * 110, 100))
    old = cur.filter(k < 2).select("i_item_id", F.when(k == 1, F.pmod(F.col("i_manager_id"), F.lit(50)) + 1).alias("i_manager_id"),
                                   F.lit(None).cast("string").alias("i_container"), F.when(k == 0, price).alias("i_current_price"),
                                   F.lit(None).cast("decimal(7,2)").alias("i_wholesale_cost"), F.when(k == 0, F.col("i_color")).alias("i_color"))
    new = cur.filter(F.pmod("i_item_sk", F.lit(50)) == 3).select(
        F.concat(F.lit("NEW"), F.col("i_item_id")).alias("i_item_id"), "i_manager_id", F.lit("Box").alias("i_container"),
        "i_current_price", "i_wholesale_cost", "i_color")
    return old.unionByName(new)


def store_feed(st) -> DataFrame:
    """Another manager for every third store, other hours for the next third."""
    k = F.pmod("s_store_sk", F.lit(3))
    return st.store.filter(F.col("s_rec_end_date").isNull() & (k < 2)).select(
        "s_store_id", F.when(k == 1, "9AM-9PM").alias("s_hours"), F.lit(None).cast("int").alias("s_floor_space"),
        F.when(k == 0, F.concat(F.lit("New "), F.col("s_manager"))).alias("s_manager"),
        F.lit(None).cast("int").alias("s_number_employees"))


def customer_feed(st) -> DataFrame:
    """Other mail addresses for every seventh customer, and new customers."""
    c, text = st.customer, F.lit(None).cast("string")
    old = c.filter(F.pmod("c_customer_sk", F.lit(7)) == 0).select(
        "c_customer_id", F.concat(F.lit("new."), F.col("c_email_address")).alias("c_email_address"), text.alias("c_last_name"),
        F.lit("N").alias("c_preferred_cust_flag"))
    new = c.filter(F.pmod("c_customer_sk", F.lit(40)) == 1).select(
        F.concat(F.lit("NEW"), F.col("c_customer_id")).alias("c_customer_id"), text.alias("c_email_address"), "c_last_name",
        F.lit("Y").alias("c_preferred_cust_flag"))
    return old.unionByName(new)


FEEDS = ((ITEM, item_feed), (STORE, store_feed), (CUSTOMER, customer_feed))


def _rows_of(dim: Dimension, rows: DataFrame) -> DataFrame:
    """Rows of any dimension under common names; tracked columns as one text."""
    def day(c):
        return F.date_format(c, "yyyy-MM-dd") if c else F.lit(None).cast("string")
    values = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in dim.overwrite + dim.history])
    return rows.select(F.lit(dim.table).alias("table_name"), F.col(dim.id).alias("business_id"), F.col(dim.sk).cast("long").alias("sk"),
                       day(dim.start).alias("start_date"), day(dim.end).alias("end_date"), values.alias("tracked"), "status")


@star_query("refresh_dimensions")
def refresh_dimensions(st, effective="2002-01-01"):
    """Every row that the item, store and customer feeds change, close, open or insert."""
    return functools.reduce(DataFrame.unionByName, [
        _rows_of(d, apply_feed(st[d.table], feed(st), d, effective)).filter("status <> 'unchanged'") for d, feed in FEEDS])


@star_query("refresh_dimensions_stored")
def refresh_dimensions_stored(st, effective="2002-01-01"):
    """The feeds merged into stored dimensions, each of them twice; the tables as a reader finds them after."""
    out = []
    for d, feed in FEEDS:
        table = stored_dimension(st.spark, scratch_path(st.spark, f"stored-{d.table}"), d)
        table.create(st[d.table])
        for _ in range(2):
            version = merge_stored(table, feed(st), d, effective)
        rows = _rows_of(d, table.read().withColumn("status", F.lit(None).cast("string")))
        out.append(rows.groupBy("table_name").agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("business_id").alias("ids"), F.countDistinct("sk").alias("keys"),
            F.sum(F.col("end_date").isNull().cast("int")).alias("current_rows"), F.max("sk").alias("largest_sk"),
            F.sum(F.length("tracked")).alias("tracked_chars"), F.countDistinct("tracked").alias("tracked_values"),
            F.lit(version).cast("long").alias("version")))
    return functools.reduce(DataFrame.unionByName, out)
