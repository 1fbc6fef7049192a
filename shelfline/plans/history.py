"""Type-2 histories built from keep-or-change proposals.

A proposal row states, for an id and a day, a new value for each column or that
the column keeps what it had. :func:`history` carries kept values forward,
merges neighbouring revisions that do not differ (gaps and islands) and derives
the validity ranges, which then neither overlap nor leave a gap.

An id has at most one state a day (several proposals of one day are folded
first, before the shuffle by id), so the length of the calendar bounds what a
window holds of one id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.plans.registry import star_query


def proposal(value: Column, keeps: Column, order: Column | None = None) -> Column:
    """A new value (null is one too), or null where the column keeps its value.

    Of several new values of one id and day that with the largest ``order`` counts.
    """
    return F.when(~keeps, F.struct((F.lit(0) if order is None else order).alias("o"), value.alias("v")))


def history(proposals: DataFrame, id: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """(id, start, end, columns, revision): the states of every id, each different from the one before.

    ``columns`` hold proposals. A column that nothing was proposed for yet is
    null. Rows without id or day are left out; an open range ends in null.
    """
    w = Window.partitionBy(id).orderBy(start)
    days = proposals.filter(F.col(id).isNotNull() & F.col(start).isNotNull()).groupBy(id, start).agg(
        *[F.max(c).alias(c) for c in columns])
    carried = days.select(id, start, *[F.last(c, ignorenulls=True).over(w)["v"].alias(c) for c in columns])
    state = F.struct(*columns)
    islands = carried.withColumn("_before", F.lag(state).over(w)).filter(
        F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before")))
    return islands.select(id, start, F.date_sub(F.lead(start).over(w), 1).alias(end), *columns,
                          F.row_number().over(w).cast("int").alias("revision"))


def audit(rows: DataFrame, id: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """One row: ids by number of revisions, and what a history must not have (gaps, overlaps, equal neighbours)."""
    w = Window.partitionBy(id).orderBy(start)
    state = F.struct(*columns)
    due = F.date_add(F.lag(end).over(w), 1)
    later = F.row_number().over(w) > 1
    j = rows.select(id, (later & (F.col(start) > due)).alias("gap"),
                    (later & (due.isNull() | (F.col(start) < due))).alias("overlap"),
                    (later & state.eqNullSafe(F.lag(state).over(w))).alias("repeat"), F.col(end).isNull().alias("open"))
    count = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(c)
    ids = j.groupBy(id).agg(F.count(F.lit(1)).alias("n"), *[count(c) for c in ("gap", "overlap", "repeat", "open")])
    return ids.agg(F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("revisions"),
                   *[F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)).alias(f"ids_{k}") for k in (1, 2, 3)],
                   *[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}s") for c in ("gap", "overlap", "repeat")],
                   F.coalesce(F.sum((F.col("open") != 1).cast("long")), F.lit(0)).alias("ids_without_one_open"))


# --------------------------------------------------------------------------- histories of the star's dimensions
# table: surrogate key, business id, end of validity, first day, number columns, text columns
DIMENSIONS = {
    "item": ("i_item_sk", "i_item_id", "i_rec_end_date", "1997-10-27",
             ("i_current_price", "i_wholesale_cost", "i_manager_id"), ("i_color", "i_size")),
    "store": ("s_store_sk", "s_store_id", "s_rec_end_date", "1997-03-13",
              ("s_number_employees", "s_floor_space"), ("s_hours", "s_manager")),
    "call_center": ("cc_call_center_sk", "cc_call_center_id", "cc_rec_end_date", "1998-01-01",
                    ("cc_employees", "cc_sq_ft"), ("cc_manager",)),
    "web_site": ("web_site_sk", "web_site_id", "web_rec_end_date", "1997-08-16",
                 ("web_tax_percentage",), ("web_manager", "web_market_manager")),
    "web_page": ("wp_web_page_sk", "wp_web_page_id", "wp_rec_end_date", "1997-09-03",
                 ("wp_char_count", "wp_link_count"), ("wp_type",)),
}
SPAN_DAYS = 1826        # the days that the revisions of an id are spread over


def drawn_proposals(rows: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """One, two or three proposals for every current id (by its number modulo 3: 1, 2, 0), and the column names.

    Two begin at the halves of the span, three at its thirds. In a later one
    each column has a bit of the proposal's own number that says keep or change.
    """
    sk, bid, end, first, numbers, texts = DIMENSIONS[table]
    n = F.col(sk).cast("long")
    of = F.when(n % 3 == 0, 3).otherwise(n % 3).cast("int")
    x = rows.filter(F.col(end).isNull()).select(
        F.col(bid).alias("business_id"), n.alias("_n"), of.alias("_of"), *numbers, *texts,
        F.explode(F.sequence(F.lit(0), of - 1)).alias("_r"))
    after = F.floor(F.col("_r") * SPAN_DAYS / F.col("_of")).cast("int")
    x = x.withColumn("start_date", F.date_add(F.lit(first).cast("date"), after))
    drawn = F.col("_n") * 7919 + F.col("_r") * 104729
    out = []
    for k, c in enumerate([*numbers, *texts]):
        keeps = (F.col("_r") > 0) & (F.floor(drawn / 2 ** k).cast("long") % 2 == 1)
        if c in numbers:
            value = (F.col(c).cast("decimal(12,2)") + (F.col("_r") * (F.col("_n") % 5)).cast("decimal(12,0)")).cast("decimal(12,2)")
        else:
            value = F.when((F.col("_r") == 0) | (F.col("_n") % 5 == 0), F.col(c)).otherwise(
                F.concat(F.col(c), F.lit(" "), F.col("_r").cast("string")))
        out.append(proposal(value, keeps).alias(c))
    return x.select("business_id", "start_date", *out), [*numbers, *texts]


def _histories(st):
    for table in DIMENSIONS:
        proposals, columns = drawn_proposals(st[table], table)
        yield table, history(proposals, "business_id", "start_date", "end_date", columns), columns


@star_query("dim_history")
def dim_history(st):
    """Every revision of the five type-2 dimensions; tracked columns as one text."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(t).alias("table_name"), "business_id", "revision", day("start_date"), day("end_date"),
                    F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("tracked"))
        for t, rows, columns in _histories(st)])


@star_query("dim_history_audit")
def dim_history_audit(st):
    """Ids by number of revisions in each type-2 dimension; gaps, overlaps and equal neighbours."""
    return reduce(DataFrame.unionByName, [
        audit(rows, "business_id", "start_date", "end_date", columns).select(F.lit(t).alias("table_name"), "*")
        for t, rows, columns in _histories(st)])
