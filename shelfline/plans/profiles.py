"""Profiles of whole tables: mergeable column statistics and row checksums.

Statistics are kept for each (date bucket, column): row and null counts, least
and largest value, a distinct-count sketch (HyperLogLog) and, for numbers, a
quantile sketch (KLL). All come out of one aggregate of the table, a wide row a
bucket, combined before the shuffle; no row is multiplied. A refresh sketches
only the buckets it touched and merges them with what is stored.

A row's checksum is taken over all its columns as text (decimals with their two
digits, dates as ISO text, null as ``~``); sums of 32-bit parts of its digest do
not depend on the order of rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.registry import star_query
from shelfline.plans.star import _FACT_DATE, TABLES
from shelfline.sources.io import date_bucket

HLL_BITS, KLL_K = 12, 200              # 1.6 % standard error; 1.3 % of rank
NO_BUCKET = -1_000_000
WIDTH_DAYS = 30


def _number(f: T.StructField) -> Column | None:
    """Numbers, and dates as days, that compare as the column does; None for text."""
    if isinstance(f.dataType, T.DateType):
        return F.unix_date(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return F.col(f.name).cast("decimal(20,2)")
    return F.col(f.name) if isinstance(f.dataType, T.NumericType) else None


def _wide(f: T.StructField) -> bool:
    """Numbers whose hundredths may not fit a long: their distinct values are sketched as text."""
    return isinstance(f.dataType, (T.FloatType, T.DoubleType)) or (
        isinstance(f.dataType, T.DecimalType) and (f.dataType.precision > 16 or f.dataType.scale > 2))


def column_sketches(rows: DataFrame, bucket: Column | None = None) -> DataFrame:
    """One row for each (``bucket``, ``column_name``) of a table: mergeable statistics."""
    bucket = F.lit(NO_BUCKET) if bucket is None else F.coalesce(bucket, F.lit(NO_BUCKET))
    aggs, cols, parts = [F.count(F.lit(1)).alias("rows")], [], []
    for i, f in enumerate(rows.schema):
        n, nothing = _number(f), F.lit(None)
        # what the aggregates read is computed once a row, ahead of them; only the least and largest value become decimals
        cols.append((F.col(f.name).cast("string") if n is None else n).alias(f"v{i}"))
        v = f"v{i}"
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}")]
        if n is not None:
            whole = n.cast("long") if isinstance(f.dataType, (T.IntegralType, T.DateType)) else (n * 100).cast("long")
            cols += [n.cast("double").alias(f"d{i}"), (F.col(f.name).cast("string") if _wide(f) else whole).alias(f"t{i}")]
            aggs += [F.hll_sketch_agg(f"t{i}", F.lit(HLL_BITS)).alias(f"h{i}"),
                     F.kll_sketch_agg_double(f"d{i}", F.lit(KLL_K)).alias(f"k{i}")]
        else:
            aggs.append(F.hll_sketch_agg(v, F.lit(HLL_BITS)).alias(f"h{i}"))
        low, high = F.col(f"a{i}"), F.col(f"z{i}")
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("kind"), F.col(f"n{i}").alias("present"),
            (low if n is not None else nothing).cast("decimal(20,2)").alias("low"), (high if n is not None else nothing).cast("decimal(20,2)").alias("high"),
            (nothing if n is not None else low).cast("string").alias("low_text"), (nothing if n is not None else high).cast("string").alias("high_text"),
            F.col(f"h{i}").alias("distinct_sketch"), (F.col(f"k{i}") if n is not None else nothing).cast("binary").alias("quantile_sketch")))
    wide = rows.select(bucket.alias("_bucket"), *cols).groupBy("_bucket").agg(*aggs)
    return wide.select(F.col("_bucket").alias("bucket"), "rows", F.explode(F.array(*parts)).alias("p")).select("bucket", "rows", "p.*")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column: the statistics of all buckets."""
    return sketches.groupBy("column_name", "kind").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def refreshed_sketches(stored: DataFrame, touched_rows: DataFrame, bucket: Column, touched: set[int]) -> DataFrame:
    """The stored sketches with those of the touched buckets replaced; only these buckets' rows are read."""
    return stored.filter(~F.col("bucket").isin(sorted(touched))).unionByName(column_sketches(touched_rows, bucket))


def statistics(sketches: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Readable statistics per column: exact counts, least and largest value, estimated distinct values and quantiles."""
    m = merged_sketches(sketches)

    def text(number: str, string: str) -> Column:
        c, kind = F.col(number), F.col("kind")
        return (F.when(kind == "date", F.date_from_unix_date(c.cast("int")).cast("string"))
                .when(kind.isin("int", "bigint"), c.cast("decimal(20,0)").cast("string"))
                .when(kind.startswith("decimal"), c.cast("string")).otherwise(F.col(string)))
    # text, and a column without a value, has an empty quantile sketch, which has no quantiles
    quantile = F.when(F.col("low").isNotNull(), F.col("quantile_sketch"))
    return m.select("column_name", "rows", (F.col("rows") - F.col("present")).alias("nulls"), text("low", "low_text").alias("min_value"),
                    text("high", "high_text").alias("max_value"), F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
                    *[F.kll_sketch_get_quantile_double(quantile, F.lit(q)).alias(f"q{int(100 * q)}") for q in quantiles])


def table_sketches(st, table: str) -> DataFrame:
    date_col = _FACT_DATE.get(table)
    return column_sketches(st[table], date_bucket(date_col, WIDTH_DAYS) if date_col else None)


@star_query("profile_columns")
def profile_columns(st):
    """Rows, nulls, least and largest value of every column of every table, merged from the date buckets' sketches."""
    return functools.reduce(DataFrame.unionByName, [
        statistics(table_sketches(st, t), ()).select(F.lit(t).alias("table_name"), "column_name", "rows", "nulls", "min_value", "max_value")
        for t in TABLES])


def row_checksum(rows: DataFrame) -> DataFrame:
    """Row count and two order-independent sums over the digests of whole rows."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rows.columns])
    digest = rows.select(F.md5(text.cast("binary")).alias("d")).select(
        *[F.conv(F.substring("d", at, 8), 16, 10).cast("long").alias(f"p{at}") for at in (1, 9)])

    def part(start: int) -> Column:
        # halves of 16 bits: long sums of them hold for 2^47 rows, and no row needs a decimal
        x = F.col(f"p{start}")
        high, low = (F.coalesce(F.sum(h), F.lit(0)) for h in (F.shiftright(x, 16), x.bitwiseAND(F.lit(65535))))
        return (high.cast("decimal(20,0)") * F.lit(65536) + low).cast("decimal(38,0)")
    return digest.agg(F.count(F.lit(1)).alias("rows"), part(1).cast("string").alias("checksum_1"), part(9).cast("string").alias("checksum_2"))


@star_query("profile_row_checksum")
def profile_row_checksum(st):
    """Checksum over every column of every row of every table."""
    return functools.reduce(DataFrame.unionByName, [row_checksum(st[t]).select(F.lit(t).alias("table_name"), "*") for t in TABLES])
