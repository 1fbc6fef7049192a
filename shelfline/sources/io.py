"""Sources and sinks (survey section 2.1).

* Pipe-delimited flat files: ``|`` between fields and after the last one,
  empty field = NULL, no escaping, typed by an explicit schema.
* Full-refresh loads (overwrite), date-bucket partitioned fact writes with
  pruned reads, CSV report export/import.
* Run-log timing extraction and run-history maintenance (append history,
  overwrite latest summary).

Every writer targets a folder under the session's shared scratch location
(``spark.checkpoint.dir``), never a machine-local path on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.registry import star_query
from shelfline.session import scratch_dir

_TRAIL = "_trailing_"


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_dir(spark)}/io/{kind}-{uuid.uuid4().hex[:12]}"


def write_delimited(df: DataFrame, path: str) -> None:
    """Write ``a|b|c|`` lines; NULL becomes an empty field."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.lit(None).cast("string").alias(_TRAIL))
    (out.write.mode("overwrite").option("sep", "|").option("nullValue", "").option("emptyValue", "")
        .option("quote", "\u0000").option("escapeQuotes", "false").option("header", "false").csv(path))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read pipe-delimited text into ``schema``: every field arrives as a
    string (so a malformed value fails loudly on the typed cast), trailing
    blanks are trimmed (fixed-width ``char(n)`` semantics) and the empty
    field after the trailing delimiter is dropped."""
    raw_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                              + [T.StructField(_TRAIL, T.StringType(), True)])
    raw = (spark.read.schema(raw_schema).option("sep", "|").option("nullValue", "").option("quote", "\u0000")
           .option("mode", "FAILFAST").csv(path))
    return raw.select(*[F.rtrim(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Full-refresh load: truncate-and-insert as an overwrite of the table folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def date_bucket(col: str, width_days: int, origin: int = 2450815) -> F.Column:
    """Range bucket of a date key (the fact's partition column)."""
    return F.floor((F.col(col) - F.lit(origin)) / F.lit(width_days)).cast("int")


def write_date_partitioned(df: DataFrame, path: str, date_col: str, width_days: int) -> None:
    """Fact write partitioned by a date-key bucket; rows are range-partitioned
    on the date first so each task writes few bucket directories."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn("date_bucket", date_bucket(date_col, width_days))
       .repartitionByRange(n, F.col(date_col).asc_nulls_last())
       .write.mode("overwrite").partitionBy("date_bucket").parquet(path))


def read_pruned(spark: SparkSession, path: str, date_col: str, width_days: int, lo: int, hi: int,
                origin: int = 2450815) -> DataFrame:
    """Read only the buckets overlapping [lo, hi] (partition pruning), then
    filter exactly on the date key (Parquet row-group pruning)."""
    b_lo, b_hi = (lo - origin) // width_days, (hi - origin) // width_days
    df = spark.read.parquet(path)
    return df.filter(F.col("date_bucket").between(b_lo, b_hi) & F.col(date_col).between(lo, hi))


def export_csv(df: DataFrame, path: str, order_cols: list[str]) -> None:
    """Report export: header line, rows in report order over the files' names (a small report is one file)."""
    df.orderBy(*order_cols).write.mode("overwrite").option("header", "true").csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


# --------------------------------------------------------------------------- run logs and run history
_EXEC_TIME = r"Execution Time: ([0-9]+(?:\.[0-9]+)?) ms"


def log_timings(spark: SparkSession, log_glob: str) -> DataFrame:
    """Last ``Execution Time: x ms`` of each plan-log file; query id from the
    file name (``.../q42.log`` -> 42); status ERROR when no timing exists."""
    txt = spark.read.option("wholetext", "true").text(log_glob).withColumn("file", F.input_file_name())
    times = F.regexp_extract_all(F.col("value"), F.lit(_EXEC_TIME), 1)
    last = F.element_at(times, -1)
    qid = F.regexp_extract(F.col("file"), r"([0-9]+)[^/0-9]*$", 1).cast("int")
    return txt.select(qid.alias("query_id"),
                      F.when(F.size(times) > 0, last.cast("double")).alias("duration_ms"),
                      F.when(F.size(times) > 0, F.lit("OK")).otherwise(F.lit("ERROR")).alias("status"))


def append_history(runs: DataFrame, history_path: str, summary_path: str) -> None:
    """Append a run to the history table and overwrite the latest-run summary."""
    runs.write.mode("append").parquet(history_path)
    hist = runs.sparkSession.read.parquet(history_path)
    latest = hist.agg(F.max("run_ts").alias("latest_ts"))
    summary = hist.join(F.broadcast(latest), hist.run_ts == latest.latest_ts).drop("latest_ts")
    summary.write.mode("overwrite").parquet(summary_path)


def latest_per_query(history: DataFrame) -> DataFrame:
    """Latest run per query id from the history (row_number per query)."""
    w = Window.partitionBy("query_id").orderBy(F.desc("run_ts"))
    return history.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# --------------------------------------------------------------------------- registered IO jobs


def _schema_of(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


def _returns_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("sr_reason_sk")).agg(
        F.count(F.lit(1)).alias("returns"), (F.count(F.lit(1)) - F.count("sr_customer_sk")).alias("null_customers"),
        F.sum("sr_return_amt").cast("double").alias("return_amt"), F.sum("sr_net_loss").cast("double").alias("net_loss"))


@star_query("src_delimited")
def src_delimited(st):
    """Round trip of a fact through pipe-delimited text (NULLs as empty fields)."""
    path = scratch_path(st.spark, "delimited")
    src = st.store_returns
    write_delimited(src, path)
    back = read_delimited(st.spark, path, _schema_of(src))
    return _returns_profile(back)


@star_query("load_overwrite")
def load_overwrite_job(st):
    """Full-refresh load of a dimension from flat text into Parquet (run twice:
    the second load replaces the first, it does not append)."""
    flat = scratch_path(st.spark, "flat")
    table = scratch_path(st.spark, "table")
    src = st.customer
    write_delimited(src, flat)
    typed = read_delimited(st.spark, flat, _schema_of(src))
    load_overwrite(typed, table)
    loaded = load_overwrite(typed, table)
    return loaded.groupBy("c_preferred_cust_flag", "c_birth_country").agg(F.count(F.lit(1)).alias("customers"))


@star_query("scan_partition_pruned")
def scan_partition_pruned(st, lo=2451180, hi=2451269, width_days=10):
    """Date-bucket partitioned fact write and a pruned read of one quarter."""
    path = scratch_path(st.spark, "partitioned")
    write_date_partitioned(st.store_sales, path, "ss_sold_date_sk", width_days)
    df = read_pruned(st.spark, path, "ss_sold_date_sk", width_days, lo, hi)
    return df.groupBy("ss_store_sk").agg(F.count(F.lit(1)).alias("lines"),
                                         F.sum("ss_net_paid").cast("double").alias("net_paid"))


@star_query("csv_roundtrip")
def csv_roundtrip(st):
    """Export an ordered report as CSV with a header and read it back typed."""
    from shelfline.plans.catalog.star_topk import q42
    report = q42(st)
    path = scratch_path(st.spark, "csv")
    export_csv(report, path, ["d_year", "i_category_id"])
    schema = T.StructType([T.StructField("d_year", T.IntegerType()), T.StructField("i_category_id", T.IntegerType()),
                           T.StructField("i_category", T.StringType()), T.StructField("sum_sales", T.DoubleType())])
    return import_csv(st.spark, path, schema)
