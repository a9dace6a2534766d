"""Statistical queries (T1-T19) on lineitem, events and the panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.expr import flag, zero_to_null
from ..operators import kde as K
from ..operators import linmodel as L
from ..operators import panel as ops
from ..operators import stats as S
from ..operators.joins import scalar
from ..operators.reshape import columns_with_prefix
from . import panel as P
from .catalogue import finish, query, tables
from .panel import POST_YEAR

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
ORDER = ["l_shipdate", *LINE_KEY]           # full, unique order of the sample
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
Y = "l_extendedprice"
XS = ["l_quantity", "l_discount", "l_tax"]
XS_FULL = XS + ["post"]                      # full model adds the regime dummy


def model_frame(spark, sf_dir):
    li = tables(spark, sf_dir).lineitem
    return li.select(*ORDER, *[c for c in MEASURES if c not in ORDER],
                     flag(F.year("l_shipdate") >= POST_YEAR).alias("post"))


def _tidy_df(spark, rows, cols):
    def py(c, v):
        return v if c in ("term", "model", "variable") or v is None else float(v)
    return spark.createDataFrame([tuple(py(c, r[c]) for c in cols) for r in rows],
                                 ", ".join(f"{c} {'string' if c in ('term', 'model', 'variable') else 'double'}"
                                           for c in cols))


@query("welch_t")
def welch_t(spark, sf_dir):
    """Welch t per measure between regimes, with the descriptive table."""
    d = model_frame(spark, sf_dir)
    return _welch_table(S.welch_t(d, "post", MEASURES, exact_cents=True))


def _welch_table(w):
    out = w.select("variable", F.col("m0").alias("mean_pre"), F.col("m1").alias("mean_post"),
                   F.sqrt("v0").alias("sd_pre"), F.sqrt("v1").alias("sd_post"),
                   F.col("ttest.statistic").alias("t_stat"), F.col("ttest.df").alias("df"),
                   F.col("ttest.p_value").alias("p_value"))
    return finish(out, 6, overrides={"df": 4, "sd_pre": 5, "sd_post": 5}, exact=("mean_pre", "mean_post"))


@query("missing_value_tests")
def missing_value_tests(spark, sf_dir):
    """Welch t on measures that are partly NULL, partly NaN, with
    rows of unknown regime; columns chosen by prefix."""
    n, nan = F.col("l_linenumber"), F.lit(float("nan"))
    li = tables(spark, sf_dir).lineitem.select(
        F.when((F.col("l_returnflag") != "N") | (n > 2), flag(F.year("l_shipdate") >= POST_YEAR)).alias("post"),
        F.when(n == 3, nan).when(n != 1, F.col("l_quantity")).alias("na_quantity"),
        F.when(n == 2, nan).otherwise(F.col("l_extendedprice")).alias("na_price"),
        zero_to_null("l_discount").alias("na_discount"))
    return _welch_table(S.welch_t(li, "post", columns_with_prefix(li, "na_"), exact_cents=True))


@query("sorted_top_p")
def sorted_top_p(spark, sf_dir):
    """O1/O2: the t-test table ordered by p-value (NULLs last), with ranks."""
    w = welch_t(spark, sf_dir)
    r = F.row_number().over(Window.orderBy(F.col("p_value").asc_nulls_last(), "variable"))
    return w.select("variable", "p_value", r.alias("rank"))


@query("pearson_test")
def pearson_test(spark, sf_dir):
    """Correlation of price with each regressor, t test of r."""
    d = model_frame(spark, sf_dir)
    out = S.pearson_tests(d, Y, XS).select("variable", "estimate", "n", "t_stat", "df", "p_value")
    return finish(out, 9, overrides={"t_stat": 6, "p_value": 6})


@query("ols_coefs")
def ols_coefs(spark, sf_dir):
    """T4/T5: classical coefficient table (lazy: one aggregate, one k x k solve)."""
    out = L.ols_tidy_lazy(model_frame(spark, sf_dir), Y, XS)
    return finish(out, 6, overrides={"estimate": 4, "std_error": 4})


@query("ols_hc3")
def ols_hc3(spark, sf_dir):
    """HC3 heteroskedasticity-robust coefficient table (two scans; the
    second carries the pass-1 coefficients as literals)."""
    fit = L.ols(model_frame(spark, sf_dir), Y, XS)
    rows = [{"term": r["term"], "estimate": r["estimate"], "std_error_hc3": r["std_error"],
             "statistic_hc3": r["statistic"], "p_value_hc3": r["p_value"]} for r in fit.tidy(robust=True)]
    return finish(_tidy_df(spark, rows, ["term", "estimate", "std_error_hc3", "statistic_hc3",
                                         "p_value_hc3"]), 6, overrides={"estimate": 4, "std_error_hc3": 4})


@query("fit_metrics")
def fit_metrics(spark, sf_dir):
    """R^2, adjusted R^2 and RMSE (divisor n) per model."""
    out = L.fit_metrics_lazy(model_frame(spark, sf_dir),
                             {"Pre": (Y, XS, F.col("post") == 0), "Post": (Y, XS, F.col("post") == 1),
                              "Full": (Y, XS_FULL, None)})
    return finish(out, 6, overrides={"rmse": 4})


@query("model_table")
def model_table(spark, sf_dir):
    """Classical and HC3 tables of three models
    (two scans for all three), bound per model, joined by term, rounded."""
    d = model_frame(spark, sf_dir)
    fits = L.fit_many(d, {"Pre": (Y, XS, F.col("post") == 0), "Post": (Y, XS, F.col("post") == 1),
                          "Full": (Y, XS_FULL, None)})
    normal, robust = None, None
    for m, f in fits.items():
        n = _tidy_df(spark, f.tidy(), ["term", "estimate", "std_error"]) \
            .select(F.lit(m).alias("model"), "term", "estimate", F.col("std_error").alias("std_error_normal"))
        r = _tidy_df(spark, f.tidy(robust=True), ["term", "std_error", "p_value"]) \
            .select(F.lit(m).alias("model"), "term", F.col("std_error").alias("std_error_robust"), "p_value")
        normal = n if normal is None else normal.unionByName(n)        # U3
        robust = r if robust is None else robust.unionByName(r)
    out = normal.join(robust, ["model", "term"], "left")                # J7
    out = out.select("model", "term", "estimate", "std_error_normal", "std_error_robust", "p_value")
    return finish(out, 3, overrides={"estimate": 4})


@query("chow_test")
def chow_test(spark, sf_dir):
    """Chow F test at the regime break (lazy: one aggregate)."""
    out = L.chow_test(model_frame(spark, sf_dir), Y, XS, "post")
    return finish(out, 6, overrides={"rss_pooled": -4, "rss_pre": -4, "rss_post": -4})


def _cusum(spark, sf_dir):
    d = model_frame(spark, sf_dir)
    fit = L.ols(d, Y, XS_FULL, second_pass=False)   # sigma from the co-moments: one scan
    return L.cusum_process(d, fit, ORDER)


@query("cusum_process")
def cusum_process(spark, sf_dir):
    """The OLS-CUSUM process over the ordered sample."""
    c = _cusum(spark, sf_dir)
    return finish(c.select("idx", *LINE_KEY, "process"), 6)


@query("cusum_test")
def cusum_test(spark, sf_dir):
    """Sup |process| (from per-partition prefix extremes, one pass) and its
    Brownian-bridge p-value."""
    d = model_frame(spark, sf_dir)
    fit = L.ols(d, Y, XS_FULL, second_pass=False)
    stat = L.cusum_sup(d, fit, ORDER)
    return finish(_tidy_df(spark, [{"statistic": stat, "p_value": dist.bridge_sup_sf(stat)}],
                           ["statistic", "p_value"]), 6)


@query("boxcox_profile")
def boxcox_profile(spark, sf_dir):
    """Box-Cox profile log-likelihood, lambda in -2..2 by 0.1."""
    out = L.boxcox_profile(model_frame(spark, sf_dir), Y, XS_FULL)
    return finish(out, 3, overrides={"lambda": 1})


@query("variance_f")
def variance_f(spark, sf_dir):
    """F test of equal variances of sqrt(price) between regimes."""
    d = model_frame(spark, sf_dir)
    return finish(S.variance_f_test(d, F.sqrt(Y), "post"), 6)


@query("levene_median")
def levene_median(spark, sf_dir):
    """Levene test centred on exact regime medians of sqrt(price)."""
    d = model_frame(spark, sf_dir)
    return finish(S.levene_median(d, F.sqrt(Y), "post"), 6)


@query("facet_lm_band")
def facet_lm_band(spark, sf_dir):
    """Per-regressor line of price with a 95% band on an 80-point grid."""
    d = model_frame(spark, sf_dir)
    return finish(L.facet_lines(d, Y, XS), 4)


@query("kde_density")
def kde_density(spark, sf_dir):
    """Gaussian KDE of event values, 512 points, nrd0 bandwidth."""
    ev = tables(spark, sf_dir).events
    return finish(K.kde(ev, "value"), 9, exact=("x",))


@query("residual_fitted")
def residual_fitted(spark, sf_dir):
    """Fitted values and residuals of the full model, plus the
    1-based position of the first post-regime row in the sample order."""
    d = model_frame(spark, sf_dir)
    key = F.struct(*ORDER)
    first_post = scalar(d.filter(F.col("post") == 1).select(F.min(key)))
    brk = scalar(d.select(F.count_if(key < first_post) + F.lit(1)))
    # Coefficients as literals: constant-folded into the generated code of the
    # per-row pass (a lazy struct lookup would cost a field access per term).
    fit = L.ols(d, Y, XS_FULL, second_pass=False)
    out = d.select(*LINE_KEY, fit.fitted_col().alias("fitted"), fit.resid_col().alias("resid"),
                   brk.alias("break_index"))
    return finish(out, 4)


@query("diff_regression")
def diff_regression(spark, sf_dir):
    """First-difference regression on the per-county regime differences."""
    p = P.regime_means(P.with_post(P.panel_yearly(tables(spark, sf_dir))), ["crime_rate", "officers", "urgent"])
    diff = ops.regime_diff(p, "county", "post", ["crime_rate", "officers", "urgent"])
    return finish(L.ols_tidy_lazy(diff, "crime_rate_diff", ["officers_diff", "urgent_diff"]), 6)
