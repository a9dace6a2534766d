"""Two-sample and correlation tests.

Each is one grouped aggregation to sufficient statistics (counts, means,
variances, co-moments) -- partial aggregation on every executor, a few rows
after the shuffle -- then Column arithmetic and a CDF on those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.expr import mean_cents, present
from ..session import ship_package
from .quantile import at_rank, grouped_brackets, interpolated


def _mean(c: Column, exact_cents: bool) -> Column:
    return mean_cents(c) if exact_cents else F.avg(c)


def group_moments(df: DataFrame, group: str, cols: Sequence[str],
                  levels=(0, 1), exact_cents: bool = False) -> DataFrame:
    """One row per variable: n, mean, var for each of two groups (wide).

    One ``groupBy(group)`` pass over the wide table; the 2-row result is
    folded into one row and exploded to one row per variable.
    """
    g = df.groupBy(group).agg(*[x for c in cols for x in (
        F.count(present(c)).alias(f"n__{c}"), _mean(present(c), exact_cents).alias(f"m__{c}"),
        F.var_samp(present(c)).alias(f"v__{c}"))])
    g0, g1 = levels
    pick = lambda s, lvl, c: F.max(F.when(F.col(group) == F.lit(lvl), F.col(f"{s}__{c}")))
    folded = g.agg(*[pick(s, lvl, c).alias(f"{s}{i}__{c}")
                     for c in cols for s in ("n", "m", "v") for i, lvl in enumerate((g0, g1))])
    return folded.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"),
                 *[F.col(f"{s}{i}__{c}").alias(f"{s}{i}") for s in ("n", "m", "v") for i in (0, 1)])
        for c in cols])).alias("r")).select("r.*")


def welch_from_moments(m: DataFrame) -> DataFrame:
    """Welch t (group0 - group1), Satterthwaite df, two-sided p."""
    ship_package(m.sparkSession)
    td = F.try_divide          # a one-value group or zero variances give NULL, never an error
    a = td(F.col("v0"), F.col("n0"))
    b = td(F.col("v1"), F.col("n1"))
    t = td(F.col("m0") - F.col("m1"), F.sqrt(a + b))
    df_ = td((a + b) * (a + b), td(a * a, F.col("n0") - 1) + td(b * b, F.col("n1") - 1))
    out = m.withColumns({"t_stat": t, "df": df_})
    out = out.withColumn("p_value", dist.t_pvalue_col(F.col("t_stat"), F.col("df")))
    # The test result also travels as one nested value (P15): ttest.p_value.
    return out.withColumn("ttest", F.struct(F.col("t_stat").alias("statistic"), "df", "p_value"))


def welch_t(df: DataFrame, group: str, cols: Sequence[str], levels=(0, 1),
            exact_cents: bool = False) -> DataFrame:
    return welch_from_moments(group_moments(df, group, cols, levels, exact_cents))


def pearson_tests(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson r of ``target`` with each column, t = r sqrt((n-2)/(1-r^2))."""
    ship_package(df.sparkSession)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.corr(present(target), present(c)).alias(f"r{i}"),
                 F.regr_count(present(target), present(c)).alias(f"n{i}")]
    one = df.agg(*aggs)
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"r{i}").alias("estimate"), F.col(f"n{i}").alias("n"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    t = F.col("estimate") * F.sqrt(F.try_divide(F.col("n") - 2,
                                                F.lit(1.0) - F.col("estimate") * F.col("estimate")))
    long = long.withColumns({"t_stat": t, "df": (F.col("n") - 2).cast("double")})
    return long.withColumn("p_value", dist.t_pvalue_col(F.col("t_stat"), F.col("df")))


def variance_f_test(df: DataFrame, value: Column, group: str, levels=(0, 1)) -> DataFrame:
    """F test of equal variances, var(g0)/var(g1), two-sided."""
    ship_package(df.sparkSession)
    g0, g1 = levels
    v = present(value)
    one = df.agg(F.var_samp(F.when(F.col(group) == g0, v)).alias("v0"),
                 F.count(F.when(F.col(group) == g0, v)).alias("n0"),
                 F.var_samp(F.when(F.col(group) == g1, v)).alias("v1"),
                 F.count(F.when(F.col(group) == g1, v)).alias("n1"))
    out = one.select(F.try_divide(F.col("v0"), F.col("v1")).alias("statistic"),
                     (F.col("n0") - 1).alias("df1"), (F.col("n1") - 1).alias("df2"))
    cdf = dist.f_cdf_col(F.col("statistic"), F.col("df1"), F.col("df2"))
    sf = dist.f_sf_col(F.col("statistic"), F.col("df1"), F.col("df2"))
    return out.withColumn("p_value", F.least(F.lit(1.0), F.lit(2.0) * F.least(cdf, sf)))


def levene_median(df: DataFrame, value: Column, group: str) -> DataFrame:
    """Brown-Forsythe/Levene test centred on exact group medians.

    Rows without a group or a value are left out.  Two scans: the first brackets
    each group's median by a sketch; the second keeps the distinct values inside
    the bracket and, for all others, the count, sum and sum of squares to either
    side, from which the deviations from any point inside follow.
    """
    ship_package(df.sparkSession)
    d = df.select(F.col(group).alias("g"), present(value).cast("double").alias("v")).filter(F.col("g").isNotNull() & F.col("v").isNotNull())
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    centre = (F.col("lo") + F.col("hi")) / 2
    names = ["_g", "n", "k", "frac", "centre"]
    near = d.join(grouped_brackets(d, [0.5]), F.col("g") == F.col("_g")).withColumns({"side": side, "centre": centre})
    u = F.col("v") - F.col("centre")
    cells = near.groupBy(*names, "side", F.when(F.col("side") == 0, F.col("v")).alias("x")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(u).alias("s1"), F.sum(u * u).alias("s2"))
    # below the bracket first, above it last
    place = F.when(F.col("side") > 0, F.lit(float("inf"))).otherwise(F.col("x"))
    own = Window.partitionBy("_g")
    ranked = cells.select("*", *[at_rank(place, F.col("c"), r, ["_g"]).alias(a) for a, r in
                                 (("lower", F.col("k")), ("upper", F.least(F.col("k") + 1, F.col("n") - 1)))])
    med = interpolated(F.max("lower").over(own), F.max("upper").over(own), F.col("frac"))
    m = F.col("med") - F.col("centre")
    c, s1, s2 = F.col("c"), F.col("s1"), F.col("s2")
    z1 = F.when(F.col("side") == 0, F.abs(F.col("x") - F.col("med")) * c).otherwise(F.col("side") * (s1 - c * m))
    z2 = s2 - 2 * m * s1 + c * m * m
    per = (ranked.withColumn("med", med).groupBy("_g", "n").agg(F.sum(z1).alias("z1"), F.sum(z2).alias("z2"))
           .select("n", (F.col("z1") / F.col("n")).alias("zm"),
                   F.try_divide(F.col("z2") - F.col("z1") * F.col("z1") / F.col("n"), F.col("n") - 1).alias("zv")))
    tot = per.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"), (F.sum(F.col("n") * F.col("zm")) / F.sum("n")).alias("zbar"))
    off = F.col("zm") - F.col("zbar")
    one = per.crossJoin(tot).groupBy("total", "k").agg(F.sum(F.col("n") * off * off).alias("between"),
                                                   F.sum((F.col("n") - 1) * F.coalesce("zv", F.lit(0.0))).alias("within"))
    k = F.col("k")
    out = one.select(F.try_divide(F.try_divide(F.col("between"), k - 1), F.try_divide(F.col("within"), F.col("total") - k)).alias("statistic"),
                     (k - 1).cast("int").alias("df1"), (F.col("total") - k).alias("df2"))
    return out.withColumn("p_value", dist.f_sf_col(F.col("statistic"), F.col("df1"), F.col("df2")))
