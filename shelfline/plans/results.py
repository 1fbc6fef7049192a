"""Analytics over query-run results (survey section 2.11).

Input: a run-history DataFrame with columns ``run_ts, query_id, status,
duration_ms, rows_returned`` (what :func:`shelfline.sources.io.append_history`
maintains from bench runs). These functions are reports over that table;
they are not registered queries because run histories are produced by our
own runs rather than derived from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.sources.io import latest_per_query

# Fixed thresholds of the comparison report (faster/slower and improved/regressed).
FASTER, SLOWER = 0.95, 1.05
IMPROVED, REGRESSED = 0.67, 1.5


def res_latest(history: DataFrame) -> DataFrame:
    """Latest run of every query."""
    return latest_per_query(history)


def res_status(runs: DataFrame) -> DataFrame:
    """OK / ERROR / TIMEOUT / SKIP counts, total and average OK duration."""
    s = F.col("status")
    return runs.agg(
        F.sum(F.when(s == "OK", 1).otherwise(0)).alias("ok"),
        F.sum(F.when(s.startswith("ERROR"), 1).otherwise(0)).alias("errors"),
        F.sum(F.when(s.startswith("TIMEOUT"), 1).otherwise(0)).alias("timeouts"),
        F.sum(F.when(s == "SKIP", 1).otherwise(0)).alias("skipped"),
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(s == "OK", F.col("duration_ms"))).cast("double").alias("total_ms"),
        F.avg(F.when(s == "OK", F.col("duration_ms"))).cast("double").alias("avg_ms"))


def res_slowest(runs: DataFrame, k: int = 10) -> DataFrame:
    """Top-k slowest successful queries."""
    return runs.filter(F.col("status") == "OK").orderBy(F.desc("duration_ms"), "query_id").limit(k)


def res_failed(runs: DataFrame) -> DataFrame:
    """Queries that did not finish OK."""
    return runs.filter(F.col("status") != "OK").orderBy("query_id")


def res_stats(runs: DataFrame) -> DataFrame:
    """min / max / median duration with the fastest and slowest query ids."""
    ok = runs.filter(F.col("status") == "OK")
    return ok.agg(F.min("duration_ms").alias("min_ms"), F.max("duration_ms").alias("max_ms"),
                  F.median("duration_ms").alias("median_ms"),
                  F.min_by("query_id", "duration_ms").alias("fastest"),
                  F.max_by("query_id", "duration_ms").alias("slowest"))


def res_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """A/B comparison per query: ratio b/a and a verdict, only when both OK."""
    x = a.select("query_id", F.col("status").alias("a_status"), F.col("duration_ms").alias("a_ms"))
    y = b.select(F.col("query_id").alias("qid_b"), F.col("status").alias("b_status"), F.col("duration_ms").alias("b_ms"))
    j = x.join(y, x.query_id == y.qid_b, "full").select(
        F.coalesce("query_id", "qid_b").alias("query_id"), "a_status", "a_ms", "b_status", "b_ms")
    both = (F.col("a_status") == "OK") & (F.col("b_status") == "OK") & (F.col("a_ms") > 0)
    ratio = F.when(both, F.col("b_ms") / F.col("a_ms"))
    verdict = (F.when(~both | ratio.isNull(), "n/a").when(ratio < FASTER, "faster")
               .when(ratio > SLOWER, "slower").otherwise("same"))
    return j.select("*", ratio.alias("ratio"), verdict.alias("verdict"),
                    F.when(ratio <= IMPROVED, 1).otherwise(0).alias("improved"),
                    F.when(ratio >= REGRESSED, 1).otherwise(0).alias("regressed"))


def res_validate(actual: DataFrame, expected: DataFrame, digits: int = 2) -> DataFrame:
    """Order-insensitive answer validation with numeric tolerance: rows
    missing from either side after rounding numeric columns (multiset)."""
    def norm(df: DataFrame) -> DataFrame:
        cols = []
        for f in df.schema.fields:
            if f.dataType.typeName() in ("double", "float", "decimal"):
                cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
            else:
                cols.append(F.col(f.name))
        return df.select(*cols)
    a, e = norm(actual), norm(expected.select(*actual.columns))
    missing = e.exceptAll(a).withColumn("side", F.lit("missing"))
    extra = a.exceptAll(e).withColumn("side", F.lit("unexpected"))
    return missing.unionByName(extra)


