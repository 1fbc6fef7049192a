"""Distributions with several value and weight sets, and row counts by scale.

A distribution is a small table whose entries carry values (any columns) and
weights (one column for each weight set). It becomes one row of arrays, the
cumulative weights of a set among them, and a draw is a binary search in that
array: no range join, and one copy of the values for all weight sets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.search import places_up_to
from shelfline.plans.registry import star_query

MOST_ENTRIES = 1 << 16      # entries of a distribution; more are an error, not a cut


@dataclass(frozen=True)
class Distribution:
    """Entries in the order of ``values``; ``weights`` are whole numbers, null or below 0 counts as 0."""

    entries: DataFrame
    values: tuple[str, ...]
    weights: tuple[str, ...]

    def packed(self) -> DataFrame:
        """One row: ``d_entries`` (values in order) and for each weight set ``d_<set>``, its cumulative weights."""
        weights = [F.greatest(F.coalesce(F.col(w), F.lit(0)), F.lit(0)).cast("long").alias(f"w_{w}") for w in self.weights]
        one = self.entries.select(*self.values, *weights).agg(
            F.sort_array(F.collect_list(F.struct(*self.values, *[f"w_{w}" for w in self.weights]))).alias("d_entries"))
        size = F.size("d_entries")
        checked = F.when(size > MOST_ENTRIES, F.raise_error(F.lit(f"a distribution of over {MOST_ENTRIES} entries"))).otherwise(F.col("d_entries"))
        one = one.select(checked.alias("d_entries"))

        def cumulative(w: str) -> Column:
            step = lambda sums, e: F.concat(sums, F.array(F.get(sums, F.size(sums) - 1) + e[f"w_{w}"]))
            return F.aggregate("d_entries", F.array(F.lit(0).cast("long")), step, lambda sums: F.slice(sums, 2, MOST_ENTRIES))
        return one.select("d_entries", *[cumulative(w).alias(f"d_{w}") for w in self.weights])


def draw(df: DataFrame, dist: Distribution, place: Column, out: str = "drawn") -> DataFrame:
    """``df`` with one struct a weight set, ``<out>_<set>``: the entry that the set draws at ``place``.

    ``place`` is any whole number; its remainder by a set's total weight says
    where in the cumulative weights it falls. An entry of weight 0 is never
    drawn; a null place and a set without weight draw null.
    """
    names = [c for c in df.columns]
    j = df.withColumn("_place", place).crossJoin(F.broadcast(dist.packed()))         # one row of at most MOST_ENTRIES entries

    def entry(w: str) -> Column:
        cum = F.col(f"d_{w}")
        total = F.get(cum, F.size(cum) - 1)
        at = places_up_to(cum, F.pmod(F.col("_place"), F.when(total > 0, total)), MOST_ENTRIES)
        found = F.get("d_entries", at)
        return F.when((total > 0) & F.col("_place").isNotNull(), F.struct(*[found[v].alias(v) for v in dist.values]))
    return j.select(*names, *[entry(w).alias(f"{out}_{w}") for w in dist.weights])


@star_query("sample_value_sets")
def sample_value_sets(st):
    """Customers draw a (category, class) by three weight sets of one distribution: items, their value, current items."""
    price = F.coalesce((F.col("i_current_price") * 100).cast("long"), F.lit(0))
    entries = (st.item.filter(F.col("i_category").isNotNull() & F.col("i_class").isNotNull()).groupBy("i_category", "i_class")
               .agg(F.count(F.lit(1)).alias("items"), F.sum(price).alias("value"),
                    F.sum(F.col("i_rec_end_date").isNull().cast("long")).alias("current_items")))
    dist = Distribution(entries, ("i_category", "i_class"), ("items", "value", "current_items"))
    place = F.pmod(F.col("c_customer_sk").cast("long"), F.lit(1000003)) * 2654435761 + 13
    drawn = draw(st.customer.select("c_customer_sk"), dist, place)
    out = []
    for w in dist.weights:
        n = drawn.groupBy(F.col(f"drawn_{w}.i_category").alias("_cat"), F.col(f"drawn_{w}.i_class").alias("_cls")).agg(
            F.count(F.lit(1)).alias("customers"))
        out.append(entries.select("i_category", "i_class", F.col(w).cast("long").alias("weight"))
                   .join(n, (F.col("i_category") == F.col("_cat")) & (F.col("i_class") == F.col("_cls")), "left")
                   .select(F.lit(w).alias("weight_set"), "i_category", "i_class", "weight",
                           F.coalesce("customers", F.lit(0)).alias("customers")))
    return reduce(DataFrame.unionByName, out)


# --------------------------------------------------------------------------- row counts by scale
# fixed values: scales (GB) that counts are listed for, and relative counts at them of the tables that grow slowly
LISTED_SCALES = (1, 10, 100, 300, 1000, 3000, 10000, 30000, 100000)
LISTED_COUNTS = {
    "call_center": (3, 12, 15, 18, 21, 24, 27, 30, 30),
    "customer": (100, 500, 2000, 5000, 12000, 30000, 65000, 80000, 100000),
    "customer_address": (50, 250, 1000, 2500, 6000, 15000, 32500, 40000, 50000),
    "item": (9, 51, 102, 132, 150, 180, 201, 231, 251),
    "promotion": (300, 500, 1000, 1300, 1500, 1800, 2000, 2300, 2500),
    "store": (6, 51, 201, 402, 501, 675, 750, 852, 951),
    "warehouse": (5, 10, 15, 17, 20, 22, 25, 27, 30),
    "web_page": (30, 100, 1020, 1302, 1500, 1800, 2001, 2301, 2502),
    "web_site": (15, 21, 12, 21, 27, 33, 39, 42, 48),
}
LINEAR = ("store_sales", "store_returns", "catalog_sales", "catalog_returns", "web_sales", "web_returns")
STATIC = ("customer_demographics", "household_demographics", "income_band", "ship_mode", "time_dim", "reason")


def listed_count(scale: Column, counts: Column, scales: tuple[int, ...] = LISTED_SCALES) -> Column:
    """The count at a scale: on the line between the listed scales around it (``counts``: an array, one for each scale).

    Below the first scale in proportion to it; beyond the last on the last line.
    """
    listed = F.array(*[F.lit(float(s)) for s in scales])
    at = places_up_to(listed, scale, len(scales))
    i = F.least(at, F.lit(len(scales) - 1))
    lo, hi, a, b = F.get(listed, i - 1), F.get(listed, i), F.get(counts, i - 1), F.get(counts, i)
    return F.when(at == 0, scale / scales[0] * F.get(counts, F.lit(0))).otherwise(a + (scale - lo) * (b - a) / (hi - lo))


@star_query("scale_projection")
def scale_projection(st, targets=(1, 5, 100, 200, 2000, 100000)):
    """Rows of the loaded tables, projected to other scales by each table's model.

    The scale of what is loaded is that of its store sales (2,880,404 lines at 1).
    """
    scale = st.store_sales.agg((F.count(F.lit(1)) / F.lit(2880404.0)).alias("loaded_scale"))
    def counted(t):
        counts = F.array(*[F.lit(float(n)) for n in LISTED_COUNTS[t]]) if t in LISTED_COUNTS else F.lit(None).cast("array<double>")
        return st[t].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows", counts.alias("counts"))
    rows = reduce(DataFrame.unionByName, [counted(t) for t in (*STATIC, *LINEAR, *LISTED_COUNTS)]).crossJoin(F.broadcast(scale))   # one row
    name, at, counts = F.col("table_name"), F.col("loaded_scale"), F.col("counts")
    rows = rows.withColumn("loaded_count", listed_count(at, counts))

    def grown(target: int) -> Column:
        factor = F.when(name.isin(*LINEAR), F.lit(float(target)) / at).otherwise(
            listed_count(F.lit(float(target)), counts) / F.col("loaded_count"))
        return F.when(name.isin(*STATIC), F.col("rows")).otherwise(F.floor(F.col("rows") * factor + 0.5)).cast("long")
    model = F.when(name.isin(*STATIC), "static").when(name.isin(*LINEAR), "linear").otherwise("logarithmic")
    return rows.select("table_name", model.alias("model"), "rows", *[grown(t).alias(f"rows_{t}") for t in targets])
