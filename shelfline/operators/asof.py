"""As-of merge: for every fact the last revision of its id that began on or before its day.

Facts and revisions are united and range-partitioned by (id, day), revisions
before the facts of their day; each partition is numbered and written. Within a
partition the last revision seen is carried forward; what a partition inherits
from those before it is one row a partition. So no row is multiplied, whatever
the number of revisions, and an id that holds a large share of the facts is
spread over many partitions (a share of a single day too, by a hash of the row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.plans.registry import star_query
from shelfline.sources.io import scratch_path


def asof_merge(facts: DataFrame, fact_id: str, fact_day: str, revisions: DataFrame, rev_id: str, rev_day: str,
               out: str = "revision", partitions: int | None = None) -> DataFrame:
    """``facts`` with ``out``: the revision's row as a struct, or null.

    Facts without id or day get null; of several revisions of one id and day the
    one with the largest row counts.
    """
    spark = facts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact, rev = F.struct(*facts.columns), F.struct(*revisions.columns)
    kind = facts.withColumn("_f", fact).withColumn("_r", F.lit(None)).schema["_f"].dataType
    rkind = revisions.withColumn("_r", rev).schema["_r"].dataType
    left = facts.select(F.col(fact_id).alias("id"), F.col(fact_day).alias("day"), F.lit(1).alias("is_fact"), fact.alias("fact"),
                        F.lit(None).cast(rkind).alias("rev"))
    right = (revisions.filter(F.col(rev_id).isNotNull() & F.col(rev_day).isNotNull())
             .select(F.col(rev_id).alias("id"), F.col(rev_day).alias("day"), F.lit(0).alias("is_fact"), F.lit(None).cast(kind).alias("fact"),
                     rev.alias("rev")))
    path = scratch_path(spark, "asof")
    salt = F.when(F.col("is_fact") == 1, F.xxhash64("fact"))
    (left.unionByName(right).repartitionByRange(n, "id", "day", "is_fact", salt)
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    # what a partition hands on: the last revision of the largest (id, day) it has seen
    last = rows.groupBy("part").agg(F.max(F.when(F.col("is_fact") == 0, F.struct("id", "day", "rev"))).alias("last"))     # a row a partition
    before = last.select("part", F.last("last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    seen = Window.partitionBy("part", "id").orderBy("day", "is_fact", "rev").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (rows.withColumn("_seen", F.last("rev", ignorenulls=True).over(seen)).filter("is_fact = 1")
            .join(F.broadcast(before), "part", "left"))
    inherited = F.when(F.col("before.id") == F.col("id"), F.col("before.rev"))
    found = F.when(F.col("day").isNotNull(), F.coalesce("_seen", inherited))
    return rows.select("fact.*", found.alias(out))


@star_query("join_asof_merge")
def join_asof_merge(st):
    """Store sales against the catalog's last quoted list price of the item, by year: quoted lines and the difference."""
    quotes = (st.catalog_sales.groupBy("cs_item_sk", "cs_sold_date_sk").agg(F.max("cs_list_price").alias("quoted")))
    sales = st.store_sales.select("ss_item_sk", "ss_sold_date_sk", "ss_quantity", "ss_sales_price")
    j = asof_merge(sales, "ss_item_sk", "ss_sold_date_sk", quotes, "cs_item_sk", "cs_sold_date_sk")
    gap = F.col("ss_quantity") * (F.col("revision.quoted") - F.col("ss_sales_price"))
    lag = (F.col("ss_sold_date_sk") - F.col("revision.cs_sold_date_sk")).cast("long")
    return (j.join(F.broadcast(st.date_dim.select("d_date_sk", "d_year")), F.col("ss_sold_date_sk") == F.col("d_date_sk"))
            .groupBy("d_year").agg(F.count(F.lit(1)).alias("lines"), F.count("revision").alias("quoted_lines"),
                                   F.sum(gap).cast("double").alias("gap"), F.sum(lag).alias("lag_days")))
