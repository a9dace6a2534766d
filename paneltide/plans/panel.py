"""The reference's panel re-created on the driver tables.

entity ("county") = nation, agency ("ORI") = customer, month/year from
``o_orderdate``, incident types = the five ``o_orderpriority`` values, count =
orders, "officers" = mean ``c_acctbal`` over agency-months, population =
customers per nation, regime ``post`` = year >= 1998.

Plan shape at scale: orders are first aggregated to agency x month (partial
aggregation shrinks the largest table before any shuffle, so a hot customer
is harmless), then joined to customer (sort-merge or AQE broadcast, decided
on measured size) and to the 25-row nation table (fixed size: broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import pivot_wide, safe_name
from ..functions.expr import cents, exact_sum_int, mean_cents, month_start
from ..sources.tables import Tables

# The incident types (order priorities) and their column names.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPE_COLS = [safe_name(p) for p in PRIORITIES]  # urgent high medium not_specified low
POST_YEAR = 1998
# Panel doubles computed order-independently (left unrounded in results).
EXACT = ("officers", "crime_rate", "homicide_rate")


def nation_dim(t: Tables) -> DataFrame:
    """25-row nation dimension; broadcast is bounded by the TPC-H definition."""
    return F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("county")))


def year_ranges(col: str, years) -> "F.Column":
    """``col`` within any of the calendar years, as plain range predicates
    (pushed into the parquet scan; ``year(col) IN (...)`` would not be)."""
    cond = None
    for y in sorted(set(years)):
        c = (F.col(col) >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & \
            (F.col(col) < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        cond = c if cond is None else (cond | c)
    return cond


def monthly_counts(t: Tables, years=None) -> DataFrame:
    """Agency x month wide table of incident counts (the ingest's crime_data).

    Absent types become 0 at this step (quirk Q1: NULL at pivot, zero-fill at
    merge).  ``years`` restricts the scan to those calendar years.
    """
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderpriority")
    if years:
        o = o.filter(year_ranges("o_orderdate", years))
    o = o.select(F.col("o_custkey").alias("agency"),
                 month_start("o_orderdate").alias("month"),
                 F.year("o_orderdate").alias("year"),
                 "o_orderpriority")
    wide = pivot_wide(o, ["agency", "month", "year"], "o_orderpriority", PRIORITIES)
    return wide.fillna(0, subset=TYPE_COLS)


def monthly_with_county(t: Tables, years=None) -> DataFrame:
    """Monthly agency rows with county and the agency's "officers" value."""
    cust = t.customer.select(F.col("c_custkey").alias("agency"), "c_nationkey",
                             F.col("c_acctbal").alias("officers"))
    return (monthly_counts(t, years)
            .join(cust, on="agency", how="left")
            .join(nation_dim(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .drop("c_nationkey", "n_nationkey"))


def county_population(t: Tables) -> DataFrame:
    return (t.customer.select("c_nationkey")
            .join(nation_dim(t), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("county").agg(F.count(F.lit(1)).alias("population")))


def with_rates(df: DataFrame, pop: str = "population") -> DataFrame:
    total = sum((F.col(c) for c in TYPE_COLS[1:]), F.col(TYPE_COLS[0]))
    return df.withColumns({
        "crime_rate": F.try_divide(total, F.col(pop)),
        "homicide_rate": F.try_divide(F.col("urgent"), F.col(pop)),
    })


def panel_yearly(t: Tables, years=None) -> DataFrame:
    """(county, year) panel: type sums, mean officers, population, rates (A4).

    ``years`` keeps only those years, filtered at the orders scan."""
    yearly = (monthly_with_county(t, years).groupBy("county", "year")
              .agg(*[F.sum(c).alias(c) for c in TYPE_COLS],
                   mean_cents("officers").alias("officers")))
    return with_rates(yearly.join(county_population(t), on="county", how="left"))


def with_post(df: DataFrame, year: str = "year") -> DataFrame:
    """Regime indicator."""
    return df.withColumn("post", F.when(F.col(year) >= POST_YEAR, 1).otherwise(0))


def regime_means(df: DataFrame, cols, keys=("county", "post")) -> DataFrame:
    """One row per county and regime: the mean of each measure over the
    regime's years, summed in year order so that the last bits are fixed."""
    lists = [F.array_sort(F.collect_list(F.struct("year", F.col(c).cast("double").alias("v")))).alias(c) for c in cols]
    mean = lambda c: F.try_divide(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x["v"]), F.size(c))
    return df.groupBy(*keys).agg(*lists).select(*keys, *[mean(c).alias(c) for c in cols])


def orders_by_county_year(t: Tables, where=None) -> DataFrame:
    """Orders pre-aggregated to (customer, year) before the customer join,
    then rolled to (county, year): the join sees one row per customer-year
    instead of one per order."""
    o = t.orders
    if where is not None:
        o = o.filter(where)
    per_cust = (o.groupBy(F.col("o_custkey").alias("agency"),
                          F.year("o_orderdate").alias("year"))
                  .agg(F.count(F.lit(1)).alias("n"),
                       exact_sum_int(cents("o_totalprice")).alias("price_cents")))
    cust = t.customer.select(F.col("c_custkey").alias("agency"), "c_nationkey")
    return (per_cust.join(cust, "agency", "left")
            .join(nation_dim(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .groupBy("county", "year")
            .agg(F.sum("n").alias("population"),
                 F.try_divide(F.sum("price_cents"), F.sum("n") * F.lit(100.0)).alias("income")))


def derived_measures(df: DataFrame, suffix: str = "") -> DataFrame:
    """Table of named derived measures (E14), built once per suffix.

    ``suffix`` selects the source columns (``population{suffix}`` ...), as the
    reference builds the same measures for its two survey variants.
    """
    s = suffix
    total = sum((F.col(c + s) for c in TYPE_COLS[1:]), F.col(TYPE_COLS[0] + s))
    pct = lambda num: F.try_divide(num, total) * F.lit(100.0)
    exprs = {
        "pct_urgent": pct(F.col("urgent" + s)),
        "pct_high_or_greater": pct(F.col("urgent" + s) + F.col("high" + s)),
        "pct_routine": pct(F.col("medium" + s) + F.col("not_specified" + s) + F.col("low" + s)),
        "orders_per_customer": F.try_divide(total, F.col("population" + s)),
        "log_officers": F.ln(F.col("officers" + s)),
        "sqrt_urgent": F.sqrt(F.col("urgent" + s)),
        "log10_population": F.log10(F.col("population" + s)),
        "urgent_sq": F.pow(F.col("urgent" + s), F.lit(2)),
    }
    return df.withColumns(exprs)
