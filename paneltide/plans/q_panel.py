"""Panel queries (A*, W*, J*, U*, reshaping) on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expr import cents, flag, flag_in, mean_cents, month_start, year_start
from ..operators import panel as ops
from ..operators.joins import scalar, suffix_join
from ..operators.reshape import pivot_wide, unpivot
from ..session import cut_lineage
from . import panel as P
from .catalogue import finish, query, tables

# County lists for the membership flags.
TOP_COUNTIES = ["NATION_2", "NATION_5", "NATION_11", "NATION_17", "NATION_23"]
RESERVATION_COUNTIES = ["NATION_1", "NATION_4", "NATION_6", "NATION_9",
                        "NATION_13", "NATION_16", "NATION_19", "NATION_22"]
METRO_COUNTIES = ["NATION_2", "NATION_5"]

# Years blanked before interpolation (interior gaps and one leading edge).
GAP_YEARS = [1995, 1996, 2000]


@query("panel_yearly")
def panel_yearly(spark, sf_dir):
    return finish(P.panel_yearly(tables(spark, sf_dir)), exact=P.EXACT)


@query("monthly_type_long")
def monthly_type_long(spark, sf_dir):
    """Agency-month wide counts -> long by type -> monthly totals."""
    m = P.monthly_counts(tables(spark, sf_dir))
    long = unpivot(m, ["agency", "month", "year"], P.TYPE_COLS, "crime_type", "n")
    return long.groupBy("month", "year", "crime_type").agg(F.sum("n").alias("n_orders"))


@query("type_pivot_wide")
def type_pivot_wide(spark, sf_dir):
    """Long (agency, month, type, n) -> wide, absent types zero-filled."""
    t = tables(spark, sf_dir)
    long = (t.orders.select(F.col("o_custkey").alias("agency"),
                            month_start("o_orderdate").alias("month"),
                            "o_orderpriority")
            .groupBy("agency", "month", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")))
    wide = pivot_wide(long, None, "o_orderpriority", P.PRIORITIES, value_col="n")
    return wide.fillna(0, subset=P.TYPE_COLS)


@query("set_flags")
def set_flags(spark, sf_dir):
    """F3/F4/F9 on the panel."""
    p = P.panel_yearly(tables(spark, sf_dir))
    return p.select("county", "year",
                    flag_in("county", TOP_COUNTIES).alias("top_cities"),
                    flag_in("county", RESERVATION_COUNTIES).alias("reservations"),
                    flag_in("county", METRO_COUNTIES).alias("msp_main_counties"),
                    flag(F.col("year") >= P.POST_YEAR).alias("post"))


@query("left_join_fan_out")
def left_join_fan_out(spark, sf_dir):
    """J1 (agency, year) fan-in, J2 many-to-many mapping, J3 (geo, year).

    One orders scan: the agency x month aggregate (with exact cents sums) is
    checkpointed and feeds the monthly rows, the yearly "officers" and the
    geo-year counts.
    """
    t = tables(spark, sf_dir)
    o = t.orders.select(F.col("o_custkey").alias("agency"), "o_orderdate", "o_totalprice")
    monthly_full = (o.groupBy("agency", month_start("o_orderdate").alias("month"),
                              F.year("o_orderdate").alias("year"))
                     .agg(F.count(F.lit(1)).alias("n_orders"),
                          F.sum(cents("o_totalprice")).alias("_cents"),
                          F.count("o_totalprice").alias("_nprice")))
    monthly_full = cut_lineage(monthly_full)
    monthly = monthly_full.select("agency", "month", "year", "n_orders")
    yearly = (monthly_full.groupBy("agency", "year")
              .agg(F.try_divide(F.sum("_cents"), F.sum("_nprice") * F.lit(100.0)).alias("officers")))
    cust = t.customer.select(F.col("c_custkey").alias("agency"), "c_nationkey")
    nat = F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))
    cn = cust.join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
    mapping = (cn.select("agency", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("geo"),
                         F.lit("nation").alias("kind"))
               .unionByName(cn.select("agency",
                                      F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("geo"),
                                      F.lit("region").alias("kind"))))
    geo_yearly = (monthly.join(cust, "agency")
                  .groupBy(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("geo"), "year")
                  .agg(F.sum("n_orders").alias("geo_orders")))
    return (monthly.join(yearly, ["agency", "year"], "left")
                   .join(mapping, "agency", "left")
                   .join(geo_yearly, ["geo", "year"], "left")
                   .select("agency", "month", "year", "n_orders", "officers", "geo", "kind", "geo_orders"))


@query("suffix_join")
def suffix_join_q(spark, sf_dir):
    """Two yearly county tables with clashing non-key names."""
    t = tables(spark, sf_dir)
    a = P.orders_by_county_year(t)
    b = P.orders_by_county_year(t, F.col("o_orderstatus") == "F")
    return suffix_join(a, b, ["county", "year"], "left", ("_acs1", "_acs5"))


@query("scalar_offset")
def scalar_offset(spark, sf_dir):
    """Year - min(year) of the whole table, as a scalar subquery."""
    o = tables(spark, sf_dir).orders
    y = F.year("o_orderdate")
    first = scalar(o.select(F.min(y)))
    return o.select("o_orderkey", y.alias("year"), (y - first).alias("periods"))


@query("two_level_population")
def two_level_population(spark, sf_dir):
    """A2: (year, county) first population + sum, then yearly sums."""
    t = tables(spark, sf_dir)
    rows = P.monthly_with_county(t).join(P.county_population(t), "county", "left")
    lvl1 = rows.groupBy("year", "county").agg(F.max("population").alias("population"),
                                              F.sum("urgent").alias("homicides"))
    lvl2 = lvl1.groupBy("year").agg(F.sum("population").alias("population"),
                                    F.sum("homicides").alias("homicides"))
    return lvl2.select(year_start("year").alias("month"), "homicides", "population",
                       F.lit("Yearly").alias("type"))


@query("panel_window_distinct")
def panel_window_distinct(spark, sf_dir):
    """Group totals kept on each row, then distinct (quirk Q11)."""
    t = tables(spark, sf_dir)
    cols = P.TYPE_COLS + ["officers"]
    rows = P.monthly_with_county(t).select("county", "year",
                                           *[F.col(c).alias("_" + c) for c in cols])
    aggs = {c: F.sum("_" + c) for c in P.TYPE_COLS}
    aggs["officers"] = mean_cents("_officers")
    tot = ops.partition_totals(rows, ["county", "year"], aggs)
    yearly = tot.select("county", "year", *P.TYPE_COLS, "officers").distinct()
    out = P.with_rates(yearly.join(P.county_population(t), "county", "left"))
    return finish(out, exact=P.EXACT)


@query("count_per_key_filter")
def count_per_key_filter(spark, sf_dir):
    """A5/F2: count per key kept on each row, keep keys seen more than once."""
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority",
                                            F.year("o_orderdate").alias("year"))
    return ops.count_per_key(o, ["o_custkey", "o_orderpriority", "year"]).filter(F.col("n") > 1)


@query("null_key_totals")
def null_key_totals(spark, sf_dir):
    """W4/A5 with NULL keys: they are one group of their own."""
    o = tables(spark, sf_dir).orders.select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("agency"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    return ops.count_per_key(o, ["agency", "status"]).filter(F.col("n") > 1)


@query("dedup_keep_first")
def dedup_keep_first(spark, sf_dir):
    """First order per (customer, year) by (date, key)."""
    o = tables(spark, sf_dir).orders.withColumn("year", F.year("o_orderdate"))
    return ops.dedup_keep_first(o, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"])


@query("rolling5_complete")
def rolling5_complete(spark, sf_dir):
    """5-row trailing means per county, NULL until complete; rates from them."""
    p = P.panel_yearly(tables(spark, sf_dir)).drop("crime_rate", "homicide_rate")
    rolled = ops.rolling_complete(p, "county", "year", P.TYPE_COLS, n=5)
    return P.with_rates(rolled).select("county", "year", *P.TYPE_COLS, "population",
                                       "crime_rate", "homicide_rate")


@query("lag_rate")
def lag_rate(spark, sf_dir):
    """Previous year's crime rate per county."""
    p = P.panel_yearly(tables(spark, sf_dir))
    return ops.lag_within(p, "county", "year", ["crime_rate"]) \
              .select("county", "year", "crime_rate", "crime_rate_lag1")


@query("interpolate_gaps")
def interpolate_gaps(spark, sf_dir):
    """Interior linear interpolation; the blanked first year stays NULL."""
    p = P.panel_yearly(tables(spark, sf_dir)).select("county", "year", "officers")
    p = p.withColumn("officers_gap", F.when(~F.col("year").isin(GAP_YEARS), F.col("officers")))
    out = ops.interpolate_linear(p, "county", "year", ["officers_gap"], suffix="_interp")
    return out.select("county", "year", "officers_gap", F.col("officers_gap_interp").alias("officers_interp"))


@query("scale_factor_series")
def scale_factor_series(spark, sf_dir):
    """Ratio of two maxima as a scale factor, series rescaled by it."""
    p = P.panel_yearly(tables(spark, sf_dir))
    total = sum((F.col(c) for c in P.TYPE_COLS[1:]), F.col(P.TYPE_COLS[0]))
    yearly = (p.groupBy("year").agg(F.sum("population").alias("population"),
                                    F.sum(total).alias("total"))
               .withColumn("crime_rate", F.try_divide(F.col("total"), F.col("population"))))
    # The maxima range over the aggregated yearly table (one row per year,
    # bounded by the date span), so one small window computes them from the
    # same pass; a scalar subquery would re-run the whole panel computation.
    w = Window.partitionBy()
    sf = F.try_divide(F.max("crime_rate").over(w), F.max("population").over(w))
    return (yearly.withColumn("scale_factor", sf)
                  .select("year", "population", "crime_rate", "scale_factor",
                          F.try_divide(F.col("crime_rate"), F.col("scale_factor")).alias("crime_rate_scaled")))


@query("regime_diff")
def regime_diff(spark, sf_dir):
    """A10: post-minus-pre difference per county of the mean over each
    regime's years (all years of the table)."""
    cols = ["crime_rate", "officers", *P.TYPE_COLS]
    p = P.regime_means(P.with_post(P.panel_yearly(tables(spark, sf_dir))), cols)
    return finish(ops.regime_diff(p, "county", "post", cols), 8)


@query("group_row_ranges")
def group_row_ranges(spark, sf_dir):
    """first/last row of each county in the (county, year)-ordered panel."""
    return ops.group_row_ranges(P.panel_yearly(tables(spark, sf_dir)), "county")


@query("union_missing_columns")
def union_missing_columns(spark, sf_dir):
    """Monthly and yearly series bound by name; missing columns NULL.
    Both come from the one agency x month aggregate of orders."""
    t = tables(spark, sf_dir)
    m = P.monthly_counts(t)
    total = sum((F.col(c) for c in P.TYPE_COLS[1:]), F.col(P.TYPE_COLS[0]))
    monthly = (m.groupBy("month").agg(F.sum(total).alias("n_orders"))
                .withColumn("type", F.lit("Monthly")))
    p = P.panel_yearly(t)
    yearly = (p.groupBy("year").agg(F.sum(total).alias("n_orders"), F.sum("population").alias("population"))
               .select(year_start("year").alias("month"), "n_orders", "population",
                       F.lit("Yearly").alias("type")))
    return monthly.unionByName(yearly, allowMissingColumns=True)


@query("derived_measures")
def derived_measures(spark, sf_dir):
    """Table of named derived measures on the panel."""
    p = P.panel_yearly(tables(spark, sf_dir))
    out = P.derived_measures(p).select("county", "year", "pct_urgent", "pct_high_or_greater",
                                       "pct_routine", "orders_per_customer", "log_officers",
                                       "sqrt_urgent", "log10_population", "urgent_sq")
    return finish(out, 9, exact=("pct_urgent", "pct_high_or_greater", "pct_routine",
                                 "orders_per_customer", "urgent_sq"))
