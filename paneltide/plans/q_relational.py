"""Scalar, reshape and set queries on lineitem, events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import (cents, exact_sum_int, flag, hour_start, mean_cents, month_label,
                              parse_month_label, split_piece, strip_prefix, sum_cents,
                              year_start, zero_to_null)
from ..operators.joins import natural_join
from ..operators.reshape import columns_of_type, pivot_multi, unpivot
from .catalogue import finish, query, tables
from .panel import POST_YEAR

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]  # unique row key of lineitem
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Friendly names for event codes ('error' deliberately absent).
EVENT_LABELS = [("view", "Page view"), ("click", "Click"),
                ("purchase", "Purchase"), ("signup", "Sign-up")]


def post_of(ts: str):
    return flag(F.year(F.col(ts)) >= POST_YEAR)


@query("unpivot_measures")
def unpivot_measures(spark, sf_dir):
    """Every DOUBLE column of lineitem to (variable, value) rows."""
    li = tables(spark, sf_dir).lineitem
    doubles = columns_of_type(li, T.DoubleType)
    return unpivot(li.select(*LINE_KEY, *doubles), LINE_KEY, None, "variable", "value")


@query("multi_value_pivot")
def multi_value_pivot(spark, sf_dir):
    """Mean and sd of each measure per regime, in one pass, then
    reshaped to variable x {mean,sd}_{pre,post}."""
    li = tables(spark, sf_dir).lineitem.withColumn("post", post_of("l_shipdate"))
    stats = li.groupBy("post").agg(
        *[mean_cents(c).alias(f"mean__{c}") for c in MEASURES],
        *[F.stddev_samp(c).alias(f"sd__{c}") for c in MEASURES])
    regime = F.when(F.col("post") == 1, "post").otherwise("pre").alias("regime")
    long = stats.select(regime, F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"mean__{c}").alias("mean"), F.col(f"sd__{c}").alias("sd")) for c in MEASURES])).alias("s"))
    out = pivot_multi(long.select("regime", "s.*"), ["variable"], "regime", ["pre", "post"], ["mean", "sd"])
    return finish(out, 5, exact=("mean_pre", "mean_post"))


@query("event_code_lookup")
def event_code_lookup(spark, sf_dir):
    """Code -> friendly name through a literal dimension (natural join)."""
    ev = tables(spark, sf_dir).events.select("event_id", "event_type", "value")
    dim = spark.createDataFrame(EVENT_LABELS, "event_type string, event_label string")
    return natural_join(ev, F.broadcast(dim), "left")


@query("path_key_split")
def path_key_split(spark, sf_dir):
    """Keys cut out of a path-like string."""
    pg = tables(spark, sf_dir).pages.select("page_id", "url")
    rest = strip_prefix("url", "[a-z]+://")
    return pg.select(
        "page_id",
        F.regexp_extract("url", r"^([a-z]+)://", 1).alias("scheme"),
        F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"),
        split_piece(rest, "[/._]", 2).alias("piece2"),
        F.upper(F.split_part(rest, F.lit("/"), F.lit(2))).alias("lang"),
        F.regexp_extract("url", r"/([0-9]+)", 1).alias("page_key"),
        F.col("url").rlike(r"\?").cast("int").alias("has_query"))


@query("month_label_parse")
def month_label_parse(spark, sf_dir):
    """E5/E6/E8/E3/P12: 'MM-yyyy' labels made from dates and parsed back."""
    o = tables(spark, sf_dir).orders.select(month_label("o_orderdate").alias("label"))
    g = o.groupBy("label").agg(F.count(F.lit(1)).alias("n_orders"))
    month = parse_month_label("label")
    return g.select("label", "n_orders", month.alias("month"),
                    F.year(month).alias("year"),
                    year_start(F.year(month)).alias("year_start"),
                    flag(F.col("label").rlike("^0[1-6]-")).alias("first_half"),
                    F.substring("label", 1, 2).cast("int").alias("mm"),
                    F.concat(F.lit("m"), F.col("label")).alias("header"))


@query("zero_to_null_and_back")
def zero_to_null_and_back(spark, sf_dir):
    """0 -> NULL, NULL -> 0, drop rows missing a column."""
    li = tables(spark, sf_dir).lineitem.select(
        *LINE_KEY, zero_to_null("l_discount").alias("disc_na"), zero_to_null("l_tax").alias("tax_na"))
    li = li.dropna(subset=["tax_na"]).withColumn("disc_filled", F.col("disc_na"))
    return li.fillna(0.0, subset=["disc_filled"])


@query("ratio_of_sums")
def ratio_of_sums(spark, sf_dir):
    """Yearly exact sums, ratio of sums, rate of counts."""
    li = tables(spark, sf_dir).lineitem
    g = li.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("sum_qty"),
        sum_cents("l_extendedprice").alias("sum_price"),
        (exact_sum_int(cents("l_extendedprice") * cents("l_discount")) / F.lit(10000.0)).alias("sum_disc_amount"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return g.select("year", "n", "sum_qty", "sum_price", "sum_disc_amount",
                    F.try_divide(F.col("sum_price"), F.col("sum_qty")).alias("price_per_qty"),
                    F.try_divide(F.col("n_returned"), F.col("n")).alias("return_rate"))


@query("range_except")
def range_except(spark, sf_dir):
    """U4: the hours of the event span minus the hours that saw an error."""
    ev = tables(spark, sf_dir).events
    hour = hour_start("ts")
    span = ev.agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"))
    hours = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    seen = ev.filter(F.col("event_type") == "error").select(hour.alias("hour"))
    return hours.subtract(seen)


@query("complete_case_counts")
def complete_case_counts(spark, sf_dir):
    """Complete cases of a model's variables, per regime."""
    li = tables(spark, sf_dir).lineitem.select(
        post_of("l_shipdate").alias("post"), "l_extendedprice", "l_quantity",
        zero_to_null("l_discount").alias("disc_na"), zero_to_null("l_tax").alias("tax_na"))
    vars_ = ["l_extendedprice", "l_quantity", "disc_na", "tax_na"]
    complete = F.lit(True)
    for v in vars_:
        complete = complete & F.col(v).isNotNull()
    return li.groupBy("post").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(complete).alias("n_complete"),
        F.count_if(F.col("disc_na").isNull()).alias("n_disc_missing"),
        F.count_if(F.col("tax_na").isNull()).alias("n_tax_missing"))
