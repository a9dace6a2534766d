import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneltide.functions import dist
from paneltide.operators import kde as K
from paneltide.operators import linmodel as L
from paneltide.operators import stats as S
from paneltide.operators.prefix import prefix_extremes, prefix_sum
from paneltide.operators.quantile import quantile_table


def test_distribution_check_values():
    assert dist.t_sf2(2.0, 10.5) == pytest.approx(0.0720338, abs=1e-7)
    assert dist.f_cdf(2.0, 3, 20) == pytest.approx(0.8535612, abs=1e-7)
    assert dist.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert dist.f_cdf(1.0, 30000, 30000) == pytest.approx(0.5, abs=1e-3)
    assert dist.f_cdf(3.0, 4, 60) + dist.f_sf(3.0, 4, 60) == pytest.approx(1.0, abs=1e-12)
    assert dist.bridge_sup_sf(1.358) == pytest.approx(0.05, abs=1e-3)


def _data(spark, n=2000, seed=3, parts=7):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(10, 3, n)
    x2 = rng.uniform(0, 1, n)
    g = (rng.uniform(0, 1, n) > 0.5).astype(int)
    y = 2 + 1.5 * x1 - 3 * x2 + 0.8 * g + rng.normal(0, 1 + x2 * 2, n)
    rows = [(i, float(a), float(b), int(c), float(d)) for i, (a, b, c, d) in enumerate(zip(x1, x2, g, y))]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, g int, y double").repartition(parts)
    return df, x1, x2, g, y


def test_ols_matches_numpy_and_hc3(spark):
    df, x1, x2, g, y = _data(spark)
    fit = L.ols(df, "y", ["x1", "x2"])
    X = np.column_stack([np.ones_like(x1), x1, x2])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose(fit.coef, beta, rtol=1e-9)
    e = y - X @ beta
    assert fit.rss == pytest.approx(float(e @ e), rel=1e-9)
    xtxi = np.linalg.inv(X.T @ X)
    h = np.einsum("ij,jk,ik->i", X, xtxi, X)
    meat = (X * (e ** 2 / (1 - h) ** 2)[:, None]).T @ X
    hc3 = xtxi @ meat @ xtxi
    assert np.allclose(fit.cov_hc3(), hc3, rtol=1e-7)
    cls = xtxi * (e @ e) / (len(y) - 3)
    assert np.allclose(fit.cov_classical(), cls, rtol=1e-8)
    assert 0 <= fit.r2() <= 1
    resid_sum = df.select(F.sum(fit.resid_col())).first()[0]
    assert abs(resid_sum) < 1e-6 * len(y)


def test_cusum_ends_near_zero_and_is_partition_invariant(spark):
    df, *_ = _data(spark)
    fit = L.ols(df, "y", ["x1", "x2", "g"], hc3=False)
    a = {r.idx: r.process for r in L.cusum_process(df, fit, ["id"], partitions=1).collect()}
    b = {r.idx: r.process for r in L.cusum_process(df, fit, ["id"], partitions=13).collect()}
    assert len(a) == 2000 and set(a) == set(range(1, 2001))
    assert abs(a[2000]) < 1e-8
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_prefix_sum_matches_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=5000)
    keys = rng.permutation(5000)
    df = spark.createDataFrame([(int(k), float(v)) for k, v in zip(keys, vals)], "k long, v double")
    out = prefix_sum(df, ["k"], "v", partitions=9).orderBy("k").collect()
    order = np.argsort(keys)
    expect = np.cumsum(vals[order])
    assert [r.idx for r in out] == list(range(1, 5001))
    assert np.allclose([r.cumsum for r in out], expect)


def test_welch_equal_groups(spark):
    rows = [(0, float(x)) for x in range(10)] + [(1, float(x)) for x in range(10)]
    df = spark.createDataFrame(rows, "g int, x double")
    r = S.welch_t(df, "g", ["x"]).first()
    assert r.t_stat == 0.0 and r.p_value == pytest.approx(1.0)


def test_kde_integrates_to_about_one(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(0, 1, 4000)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    d = K.kde(df, "v").orderBy("i").collect()
    xs = np.array([r.x for r in d])
    ys = np.array([r.density for r in d])
    assert 0.95 < np.trapezoid(ys, xs) <= 1.0


def test_levene_and_variance_tests_run(spark):
    df, *_ = _data(spark)
    lv = S.levene_median(df, F.col("y"), "g").first()
    vf = S.variance_f_test(df, F.col("y"), "g").first()
    assert 0 <= lv.p_value <= 1 and 0 <= vf.p_value <= 1


def test_boxcox_profile_peaks_inside_grid(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(1, 5, 3000)
    y = (1 + 0.5 * x + rng.normal(0, 0.05, 3000)) ** 2      # sqrt(y) is linear in x
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    prof = {r["lambda"]: r.loglik for r in L.boxcox_profile(df, "y", ["x"]).collect()}
    best = max(prof, key=prof.get)
    assert abs(best - 0.5) <= 0.1


def test_distributions_at_huge_degrees_of_freedom():
    # t -> normal, F(4, inf) -> chi2(4)/4, F(d, d) -> lognormal; continuity at the switch
    assert dist.t_sf2(1.96, 1e12) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), abs=1e-12)
    assert abs(dist.t_sf2(1.96, 0.9999999e8) - dist.t_sf2(1.96, 1.0000001e8)) < 1e-8
    assert dist.f_sf(2.5, 4, 1e12) == pytest.approx(math.exp(-5.0) * 6.0, abs=1e-12)
    assert abs(dist.f_sf(2.5, 4, 0.9999999e8) - dist.f_sf(2.5, 4, 1.0000001e8)) < 1e-8
    f = 1 + 3.0 / math.sqrt(1e8)
    assert abs(dist.f_sf(f, 0.9999999e8, 0.9999999e8) - dist.f_sf(f, 1.0000001e8, 1.0000001e8)) < 1e-7
    assert dist.f_cdf(1.0003, 1e12, 1e12) + dist.f_sf(1.0003, 1e12, 1e12) == pytest.approx(1.0, abs=1e-14)
    # moderate df keeps the exact path: symmetric identity I_x(a,b) = 1 - I_(1-x)(b,a)
    assert dist.betainc(3.0, 7.0, 0.3) == pytest.approx(1 - dist.betainc(7.0, 3.0, 0.7), abs=1e-14)
    assert dist.betainc(2e5, 3e5, 0.4) + dist.betainc(3e5, 2e5, 0.6) == pytest.approx(1.0, abs=1e-12)


def test_kde_repeated_values_match_numpy(spark):
    rng = np.random.default_rng(21)
    v = np.round(rng.normal(0, 1, 3000), 1)                 # heavy repetition -> compressed path
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    out = K.kde(df, "v", points=64).orderBy("i").collect()
    bw = out[0].bw
    xs = np.array([r.x for r in out])
    expect = np.exp(-0.5 * ((xs[:, None] - v[None, :]) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in out], expect, atol=1e-4 * expect.max())   # binning error


@pytest.mark.parametrize("points", [2, 65])
def test_kde_far_outlier_and_heavy_ties_match_numpy(spark, points):
    """Bins follow the bandwidth: one far value changes nothing for the others,
    and the error stays below 3.1e-5 of the kernel's peak per value."""
    rng = np.random.default_rng(8)
    for v in (np.append(rng.normal(0, 1, 3000), 1e7), np.append(np.repeat(3.0, 2000), rng.lognormal(0, 3, 1000))):
        df = spark.createDataFrame([(float(x),) for x in v], "v double").repartition(3)
        out = K.kde(df, "v", points=points).orderBy("i").collect()
        sd, (a, b) = np.std(v, ddof=1), np.quantile(v, [0.25, 0.75])
        bw = 0.9 * (min(sd, (b - a) / 1.34) or sd) * len(v) ** -0.2
        assert all(r.bw == pytest.approx(bw, rel=1e-12) for r in out) and len(out) == points
        xs = np.array([r.x for r in out])
        want = np.exp(-0.5 * ((xs[:, None] - v[None, :]) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
        assert np.abs([r.density for r in out] - want).max() <= 3.1e-5 / (bw * math.sqrt(2 * math.pi))


def test_kde_given_bandwidth_and_no_values(spark):
    v = np.random.default_rng(4).uniform(0, 10, 500)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    out = K.kde(df, "v", points=16, bw=0.7).orderBy("i").collect()
    xs = np.array([r.x for r in out])
    want = np.exp(-0.5 * ((xs[:, None] - v[None, :]) / 0.7) ** 2).sum(1) / (500 * 0.7 * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in out], want, atol=3.1e-5 / 0.7)
    assert K.kde(df.filter("v < 0"), "v").count() == 0


def test_levene_matches_deviations_from_exact_medians(spark):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.normal(1e6, 1, 9000), rng.lognormal(3, 2, 12000), np.repeat(7.0, 500)])
    g = np.concatenate([np.zeros(9000, int), np.ones(12000, int), np.full(500, 2)])
    got = S.levene_median(spark.createDataFrame(list(zip(g.tolist(), v.tolist())), "g int, v double").repartition(4), F.col("v"), "g").first()
    z = [np.abs(v[g == i] - np.median(v[g == i])) for i in range(3)]
    n, mean = np.array([len(x) for x in z]), np.array([x.mean() for x in z])
    all_ = (n * mean).sum() / n.sum()
    want = ((n * (mean - all_) ** 2).sum() / 2) / (sum(((x - m) ** 2).sum() for x, m in zip(z, mean)) / (n.sum() - 3))
    assert got.statistic == pytest.approx(want, rel=1e-9) and (got.df1, got.df2) == (2, n.sum() - 3)


def test_many_ranges_in_a_plan_of_one_size(spark):
    """Bounds are data: the plan for 4,096 ranges is as large as for 16."""
    df = spark.range(40_000).select(F.xxhash64("id").alias("k"), F.lit(1).alias("v"))
    size = {}
    for n in (16, 4096):
        out = prefix_sum(df, ["k"], "v", partitions=n)
        assert out.filter("cumsum <> idx").count() == 0 and out.agg(F.max("idx"), F.countDistinct("idx")).first() == (40_000, 40_000)
        size[n] = len(out._jdf.queryExecution().optimizedPlan().toString())
    assert size[4096] < 1.2 * size[16]


def test_range_index_deals_evenly(spark):
    from paneltide.operators.prefix import RangeIndex
    df = spark.range(60_000).select((F.col("id") % 7).alias("a"), F.xxhash64("id").alias("k"))
    per = RangeIndex(df, ["a", "k"], 100).deal(df).groupBy("_b").count().collect()
    assert len(per) == 100 and max(r["count"] for r in per) < 2 * 600
    empty = df.filter("a > 9")
    assert RangeIndex(empty, ["a", "k"], 100).deal(empty).count() == 0


def test_badly_conditioned_design_matches_orthogonal_solve(spark):
    """Regressors that differ by one part in 10^5 and lie far from zero."""
    rng = np.random.default_rng(12)
    n = 4000
    a = rng.normal(1e3, 1, n)
    x = np.stack([a, a + 1e-5 * rng.normal(size=n), 1e6 * (a + 2e-5 * rng.normal(size=n)), rng.normal(size=n)])
    y = 3 + x[0] - 2 * x[1] + 1e-6 * x[2] + 0.5 * x[3] + 1e-3 * rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.vstack([y[None], x]).T], "y double, a double, b double, c double, d double").repartition(4)
    fit = L.ols(df, "y", ["a", "b", "c", "d"])
    centred = (x - x.mean(axis=1, keepdims=True)).T
    q, r = np.linalg.qr(centred)
    want = np.linalg.solve(r, q.T @ (y - y.mean()))
    assert np.linalg.cond(centred / centred.std(axis=0)) > 1e5 and not fit.aliased.any()
    assert np.allclose(fit.beta, want, rtol=1e-8)
    resid = y - y.mean() - centred @ want
    se = np.sqrt((np.linalg.inv(r) ** 2).sum(axis=1) * (resid @ resid) / (n - 5))
    assert np.allclose([t["std_error"] for t in fit.tidy()][1:], se, rtol=1e-6)
    both = L.fit_many(df, {"all": ("y", ["a", "b", "c", "d"], None), "half": ("y", ["a", "d"], F.col("d") > 0)})
    assert np.allclose(both["all"].beta, want, rtol=1e-8)
    assert both["half"].beta == pytest.approx(L.ols(df.filter("d > 0"), "y", ["a", "d"]).beta)


def test_chow_counts_what_each_regime_can_estimate(spark):
    rng = np.random.default_rng(13)
    rows = [(float(rng.normal()), float(rng.normal()), float(g * rng.normal()), g) for g in (0, 1) for _ in range(50)]
    t = L.chow_test(spark.createDataFrame(rows, "y double, x double, z double, g int"), "y", ["x", "z"], "g").first()
    assert (t["df1"], t["df2"]) == (2, 95)                   # z is 0 throughout in regime 0: 2 + 3 coefficients against 3


def test_ols_needs_more_rows_than_coefficients(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, None)], "y double, a double, b double")
    with pytest.raises(ValueError, match="complete cases"):
        L.ols(df, "y", ["a", "b"])


def test_degenerate_inputs_give_nulls_not_errors(spark):
    const = spark.createDataFrame([(2.0,)] * 50, "v double")
    d = K.kde(const, "v", points=8).collect()
    assert len(d) == 8 and all(r.density == pytest.approx(d[0].density) for r in d)
    one = spark.createDataFrame([(0, 1.0), (1, 2.0), (1, 3.0)], "g int, x double")
    r = S.welch_t(one, "g", ["x"]).first()
    assert r.t_stat is None
    perfect = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "a double, b double")
    p = S.pearson_tests(perfect, "a", ["b"]).first()
    assert p.estimate == pytest.approx(1.0)


def quantiles(df, probs, group=None, **options):
    out = {}
    for r in quantile_table(df, "v", probs, group, **options).collect():
        out.setdefault(r["g"] if group else None, {})[r["p"]] = r["q"]
    return out


@pytest.mark.parametrize("skew", [False, True])
@pytest.mark.parametrize("groups", [1, 2, 40])
def test_quantiles_match_numpy(spark, skew, groups):
    rng = np.random.default_rng(5)
    v = rng.lognormal(0, 2, 30001)
    if skew:
        v[:12000] = 1.5                                    # a third of the rows share a value
    g = rng.integers(0, groups, len(v))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = quantiles(df, probs, "g")
    for grp in range(groups):
        assert np.allclose([got[grp][p] for p in probs], np.quantile(v[g == grp], probs), rtol=0, atol=1e-12)


def test_quantiles_ignore_nan_and_null(spark):
    rows = [(1, 1.0), (1, 2.0), (1, float("nan")), (1, None), (1, 3.0), (1, 4.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    assert quantiles(df.filter("g = 1"), [0.5]) == {None: {0.5: 2.5}}
    assert quantiles(df, [0.5], "g") == {1: {0.5: 2.5}, None: {0.5: 9.0}}


def test_prefix_extremes_match_numpy(spark):
    rng = np.random.default_rng(9)
    vals = rng.normal(0.1, 1, 3000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "k long, v double").repartition(5)
    r = prefix_extremes(df, ["k"], "v", partitions=7).first()
    cs = np.cumsum(vals)
    assert r.n == 3000 and r.hi == pytest.approx(cs.max()) and r.lo == pytest.approx(cs.min())


def test_prefix_sum_hot_date_and_nulls(spark):
    """A third of the rows share the first key column; whole sums stay LONG."""
    rows = [(None if i % 50 == 0 else (7 if i % 3 else i % 11), i, (1 << 53) + 1) for i in range(600)]
    df = spark.createDataFrame(rows, "d int, k long, v long").repartition(4)
    out = prefix_sum(df, ["d", "k"], "v", partitions=8)
    assert out.schema["cumsum"].dataType.simpleString() == "bigint"
    got = out.collect()
    assert all(r.cumsum == r.idx * ((1 << 53) + 1) for r in got)
    want = sorted(((d is not None, d or 0, k) for d, k, _ in rows))
    assert [(r.d is not None, r.d or 0, r.k) for r in sorted(got, key=lambda r: r.idx)] == want


def test_chow_uses_only_its_levels(spark):
    df, *_ = _data(spark)
    r = L.chow_test(df, "y", ["x1", "x2"], "g").first()
    assert r["rss_pooled"] >= r["rss_pre"] + r["rss_post"] and 0.0 <= r["p_value"] <= 1.0
    other = df.withColumn("g", F.when(F.col("id") % 2 == 0, 2)).withColumn("y", F.col("y") * 100)
    mixed = df.unionByName(other)                            # a third level and NULL regimes
    assert L.chow_test(mixed, "y", ["x1", "x2"], "g").first() == pytest.approx(r, rel=1e-9)
    three = df.withColumn("g", (F.col("id") % 3).cast("int"))
    t = L.chow_test(three, "y", ["x1", "x2"], "g", (0, 1, 2), ("a", "b", "c")).first()
    assert (t["df1"], t["df2"]) == (6, df.count() - 9)


def test_missing_values_are_left_out_everywhere(spark):
    rng = np.random.default_rng(3)
    full = [(int(i % 2), float(rng.normal(10 + i % 2, 2))) for i in range(60)]
    odd = full + [(0, float("nan")), (1, float("nan")), (0, None), (None, 5.0), (None, float("nan"))]
    a, b = (spark.createDataFrame(r, "g int, v double") for r in (full, odd))
    for test in (lambda d: S.welch_t(d, "g", ["v"]).drop("ttest"), lambda d: S.variance_f_test(d, F.col("v"), "g"),
                 lambda d: S.levene_median(d, F.col("v"), "g")):
        assert [x if isinstance(x, str) else pytest.approx(x) for x in test(a).first()] == list(test(b).first())
    x = b.withColumn("x", F.when(F.col("g") == 0, float("nan")).otherwise(F.col("v") * 2))
    assert L.facet_lines(x, "v", ["x"]).filter("isnan(fit) or fit is null").count() == 0


def test_boxcox_rejects_non_positive_response(spark):
    df = spark.createDataFrame([(float(i), float(i - 3)) for i in range(20)], "x double, y double")
    with pytest.raises(ValueError, match="4 rows"):
        L.boxcox_profile(df, "y", ["x"])


def test_leverage_one_row_leaves_no_robust_errors(spark):
    rows = [(float(i % 5) + 0.1 * i, float(i), 0.0) for i in range(20)] + [(3.0, 2.0, 1.0)]
    fit = L.ols(spark.createDataFrame(rows, "y double, x double, d double"), "y", ["x", "d"])
    assert all(r["std_error"] is None and r["p_value"] is None and r["estimate"] is not None for r in fit.tidy(robust=True))
    assert all(r["std_error"] > 0 for r in fit.tidy())


def test_aliased_terms_are_null_and_scales_may_differ(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(6e4, 2e4, 300), rng.normal(1e-4, 3e-5, 300)
    y = 2e-5 * a + 3e3 * b + rng.normal(0, 0.1, 300)
    rows = [(float(p), float(q), float(2 * p - 1), float(r)) for p, q, r in zip(a, b, y)]
    df = spark.createDataFrame(rows, "a double, b double, twice double, y double")
    plain = {r["term"]: r for r in L.ols(df, "y", ["a", "b"]).tidy()}
    more = {r["term"]: r for r in L.ols(df, "y", ["a", "b", "twice"]).tidy()}
    assert more["twice"]["estimate"] is None and more["twice"]["std_error"] is None
    for t in ("(Intercept)", "a", "b"):
        assert more[t]["estimate"] == pytest.approx(plain[t]["estimate"]) and more[t]["std_error"] == pytest.approx(plain[t]["std_error"])
    x = np.column_stack([np.ones(300), a, b])
    assert plain["b"]["estimate"] == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0][2], rel=1e-6)


def test_exact_sums_beyond_double_precision(spark):
    from paneltide.functions.expr import exact_sum_int
    big = (1 << 62) + 1
    df = spark.createDataFrame([(big,), (big,), (big,), (-5,)], "v long")
    assert int(df.agg(exact_sum_int(F.col("v")).alias("s")).first().s) == 3 * big - 5


def test_ring_roles_and_the_180th_meridian(spark):
    """Holes subtract in whatever direction they are written, islands in them add,
    and parts on both sides of 180 degrees are one polygon."""
    from paneltide.functions import geo

    def box(x, y, size, clockwise=False):
        c = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
        return c[::-1] if clockwise else c
    polygons = {
        "plain": [box(10, 0, 4)], "hole": [box(10, 0, 4), box(11, 1, 2, True)], "same way": [box(10, 0, 4), box(11, 1, 2)],
        "clockwise": [box(10, 0, 4, True), box(11, 1, 2, True)], "island": [box(11.5, 1.5, 1), box(11, 1, 2), box(10, 0, 4)],
        "two": [box(10, 0, 4), box(20, 0, 4, True)], "small": [box(11.5, 1.5, 1)], "square": [box(11, 1, 2)],
        "across": [box(178, 0, 4)], "parts": [box(178, 0, 2), box(180, 0, 2, True)], "holed across": [box(178, 0, 4), box(179, 1, 2)]}
    rows = [(g, k, s, float((x + 180) % 360 - 180), float(y)) for g, rings in polygons.items() for k, r in enumerate(rings) for s, (x, y) in enumerate(r)]
    v = spark.createDataFrame(rows, "geoid string, ring_id int, seq int, lon double, lat double").repartition(3)
    area = {r.geoid: r.area_m2 for r in geo.polygon_area(v).collect()}
    at = {r.geoid: (r.cx, r.cy) for r in geo.polygon_centroid(v).collect()}
    for g in ("hole", "same way", "clockwise", "holed across"):
        assert area[g] == pytest.approx(area["plain"] - area["square"], rel=1e-12)
    assert area["island"] == pytest.approx(area["hole"] + area["small"], rel=1e-12) and area["two"] == pytest.approx(2 * area["plain"], rel=1e-12)
    assert area["across"] == pytest.approx(area["plain"], rel=1e-12)
    assert at["same way"] == at["hole"] == pytest.approx((12, 2)) and at["two"] == pytest.approx((17, 2)) and at["island"] == pytest.approx((12, 2))
    assert abs(at["across"][0]) == pytest.approx(180) and abs(at["holed across"][0]) == pytest.approx(180) and abs(at["parts"][0]) == pytest.approx(180)
    assert at["parts"][1] == pytest.approx(1)


def test_ring_gaps_and_holes(spark):
    from paneltide.functions import geo
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    hole = [(0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25)]
    rows = [("a", 0, s, x, y) for s, (x, y) in enumerate(square)]
    rows += [("gap", 0, s, x, y) for s, (x, y) in zip((0, 1, 2, 4), square)]
    rows += [("holed", 0, s, x, y) for s, (x, y) in enumerate(square)] + [("holed", 1, s, x, y) for s, (x, y) in enumerate(hole)]
    v = spark.createDataFrame(rows, "geoid string, ring_id int, seq int, lon double, lat double")
    area = {r.geoid: r.area_m2 for r in geo.polygon_area(v).collect()}
    assert area["gap"] == pytest.approx(area["a"]) and area["holed"] == pytest.approx(0.75 * area["a"], rel=1e-3)
    rings = {r.geoid: r.geometry for r in geo.polygon_rings(v).collect()}
    assert [p.seq for p in rings["gap"]] == [0, 1, 2, 4] and len(rings["holed"]) == 8
