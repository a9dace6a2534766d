"""Least squares on Spark: sufficient statistics by aggregation, k x k maths
on the driver, per-row passes with the coefficients as literals (T4-T12,
T15, T17-T19).

Pass 1 is a single aggregation of means and centred co-moments
(``covar_samp``, numerically stable merges); several fits share one scan.  The
k x k system is solved in numpy on the correlation scale.  Co-moments square the
condition number of the regressors, so where that is over ``REFINE_CONDITION`` a
further aggregation takes the co-moments of the regressors that a Cholesky factor
of the first makes nearly orthogonal (Cholesky QR, done twice): both factors
together are as accurate as an orthogonal factorisation of the rows.  Pass 2 (residuals, leverages, HC3 meat, RSS) is another aggregation
whose expressions carry the coefficients as literals: nothing but the
(k+2)^2 numbers per fit ever reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.expr import present

INTERCEPT = "(Intercept)"


@dataclass
class OLSFit:
    y: str
    xs: list[str]
    n: int
    xbar: np.ndarray
    ybar: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float
    beta: np.ndarray = field(init=False)
    b0: float = field(init=False)
    sinv: np.ndarray = field(init=False)
    rss: float | None = None
    meat_c: np.ndarray | None = None
    aliased: np.ndarray = field(init=False)
    refined: bool = False

    def __post_init__(self):
        self.aliased, self.sinv = _solve_scaled(self.sxx)
        self.beta = self.sinv @ self.sxy if len(self.xs) else np.zeros(0)
        self.b0 = float(self.ybar - self.beta @ self.xbar)

    # ---- shape
    @property
    def p(self) -> int:
        """Coefficients that can be estimated, intercept included."""
        return len(self.xs) + 1 - int(self.aliased.sum())

    @property
    def df_resid(self) -> int:
        return self.n - self.p

    @property
    def terms(self) -> list[str]:
        return [INTERCEPT, *self.xs]

    @property
    def coef(self) -> np.ndarray:
        return np.concatenate([[self.b0], self.beta])

    # ---- per-row expressions (coefficients as literals)
    def fitted_col(self) -> Column:
        # around the means where large terms would cancel
        out = F.lit(float(self.ybar if self.refined else self.b0))
        for b, x, m in zip(self.beta, self.xs, self.xbar):
            out = out + F.lit(float(b)) * (F.col(x) - F.lit(float(m)) if self.refined else F.col(x))
        return out

    def resid_col(self) -> Column:
        return F.col(self.y) - self.fitted_col()

    def leverage_col(self) -> Column:
        xc = [F.col(x) - F.lit(float(m)) for x, m in zip(self.xs, self.xbar)]
        h = F.lit(1.0 / self.n)
        for i in range(len(xc)):
            for j in range(len(xc)):
                h = h + F.lit(float(self.sinv[i, j])) * xc[i] * xc[j]
        return h

    # ---- inference
    def rss_value(self) -> float:
        if self.rss is not None:
            return self.rss
        return float(self.syy - self.beta @ self.sxy)

    def sigma2(self) -> float:
        return self.rss_value() / self.df_resid

    def xtx_inv(self) -> np.ndarray:
        k = len(self.xs)
        m = np.zeros((k + 1, k + 1))
        sx = self.sinv @ self.xbar
        m[0, 0] = 1.0 / self.n + float(self.xbar @ sx)
        m[0, 1:] = -sx
        m[1:, 0] = -sx
        m[1:, 1:] = self.sinv
        return m

    def cov_classical(self) -> np.ndarray:
        return self.sigma2() * self.xtx_inv()

    def cov_hc3(self) -> np.ndarray:
        if self.meat_c is None:
            raise ValueError("run hc3_pass first")
        k = len(self.xs)
        bread = np.zeros((k + 1, k + 1))
        bread[0, 0] = 1.0 / self.n
        bread[1:, 1:] = self.sinv
        vc = bread @ self.meat_c @ bread
        a = np.eye(k + 1)
        a[0, 1:] = -self.xbar
        return a @ vc @ a.T

    def r2(self) -> float:
        return 1.0 - self.rss_value() / self.syy

    def adj_r2(self) -> float:
        return 1.0 - (1.0 - self.r2()) * (self.n - 1) / self.df_resid

    def rmse(self) -> float:
        return math.sqrt(self.rss_value() / self.n)

    def tidy(self, robust: bool = False) -> list[dict]:
        """Coefficient table.  An aliased term (a combination of earlier ones)
        has no numbers; without finite robust errors only estimates remain."""
        cov = self.cov_hc3() if robust else self.cov_classical()
        out = []
        for term, est, var, gone in zip(self.terms, self.coef, np.diag(cov), [False, *self.aliased]):
            row = dict.fromkeys(("estimate", "std_error", "statistic", "p_value"))
            if not gone:
                row["estimate"] = float(est)
                if var >= 0:
                    row["std_error"] = se = math.sqrt(var)
                    if se > 0:
                        row["statistic"] = t = est / se
                        row["p_value"] = dist.t_sf2(t, self.df_resid)
            out.append({"term": term, **row})
        return out


#: Share of a regressor's variance that earlier ones must leave unexplained.
ALIAS_TOLERANCE = 1e-11
#: Condition number of the correlations (that of the scaled regressors, squared)
#: from which a fit by ``ols`` and ``fit_many`` takes a second factor.
REFINE_CONDITION = 1e6


def _solve_scaled(sxx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(aliased, inverse) of centred cross products, solved on the correlation
    scale so that units of 1e5 and 1e-4 can meet in one model.  A regressor
    that the ones before it explain is aliased: its row and column are zero."""
    k = len(sxx)
    scale = np.sqrt(np.diag(sxx))
    aliased = ~(scale > 0)
    safe = np.where(aliased, 1.0, scale)
    corr = sxx / np.outer(safe, safe)
    kept: list[int] = []
    for j in range(k):
        if aliased[j]:
            continue
        r = corr[np.ix_(kept, [j])][:, 0]
        left = 1.0 - r @ np.linalg.solve(corr[np.ix_(kept, kept)], r) if kept else 1.0
        if left > ALIAS_TOLERANCE:
            kept.append(j)
        else:
            aliased[j] = True
    inverse = np.zeros((k, k))
    if kept:
        inverse[np.ix_(kept, kept)] = np.linalg.inv(corr[np.ix_(kept, kept)])
    return aliased, inverse / np.outer(safe, safe)


def _first_factor(fit: OLSFit) -> np.ndarray | None:
    """T with nearly uncorrelated (x - mean) T of unit variance, if the fit needs a
    second factor; rows and columns of aliased terms are zero."""
    kept = np.flatnonzero(~fit.aliased)
    if len(kept) < 2:
        return None
    scale = np.sqrt(np.diag(fit.sxx)[kept])
    corr = fit.sxx[np.ix_(kept, kept)] / np.outer(scale, scale)
    if np.linalg.cond(corr) < REFINE_CONDITION:
        return None
    factor = np.zeros_like(fit.sxx)
    factor[np.ix_(kept, kept)] = np.linalg.inv(np.linalg.cholesky(corr)).T / scale[:, None] * math.sqrt(fit.n - 1)
    return factor


def _refined(d: DataFrame, fit: OLSFit, cond: Column | None = None) -> None:
    """Solve a badly conditioned fit again in nearly orthogonal regressors: one
    more scan, and only for such a fit."""
    factor = _first_factor(fit)
    if factor is None:
        return
    rows = d if cond is None else d.filter(cond)
    kept = np.flatnonzero(~fit.aliased)
    centred = [F.col(x) - F.lit(float(m)) for x, m in zip(fit.xs, fit.xbar)]
    names = [f"_q{j}" for j in kept]
    q = [sum((F.lit(float(factor[i, j])) * centred[i] for i in kept if factor[i, j]), F.lit(0.0)).alias(n) for j, n in zip(kept, names)]
    row = rows.select(fit.y, *q).agg(*_moment_aggs(fit.y, names)).first()
    again = _fit_from_row(row, fit.y, names)
    own = factor[:, kept]
    fit.beta = own @ again.beta
    fit.sinv = own @ again.sinv @ own.T
    fit.b0 = float(fit.ybar - fit.beta @ fit.xbar)
    fit.rss, fit.refined = again.rss_value(), True


def _moment_aggs(y: str, xs: Sequence[str], cond: Column | None = None, tag: str = "") -> list[Column]:
    """Count, means and centred co-moments of (xs, y); rows outside ``cond``
    are masked to NULL, which every aggregate skips."""
    cols = list(xs) + [y]
    c = (lambda name: F.when(cond, F.col(name))) if cond is not None else F.col
    aggs = [(F.count_if(cond) if cond is not None else F.count(F.lit(1))).alias(f"{tag}n")]
    aggs += [F.avg(c(x)).alias(f"{tag}m_{i}") for i, x in enumerate(cols)]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            expr = F.var_samp(c(a)) if i == j else F.covar_samp(c(a), c(cols[j]))
            aggs.append(expr.alias(f"{tag}c_{i}_{j}"))
    return aggs


def _fit_from_row(row, y: str, xs: Sequence[str], tag: str = "") -> OLSFit:
    k = len(xs)
    n = row[f"{tag}n"]
    if n is None or n <= k + 1:
        raise ValueError(f"{y} ~ {list(xs)}: {n} complete cases for {k + 1} coefficients")
    cov = np.zeros((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i, k + 1):
            cov[i, j] = cov[j, i] = row[f"{tag}c_{i}_{j}"]
    s = cov * (n - 1)
    means = np.array([row[f"{tag}m_{i}"] for i in range(k + 1)], dtype=float)
    return OLSFit(y, list(xs), n, means[:k], float(means[k]), s[:k, :k], s[:k, k], float(s[k, k]))


def complete_case_cond(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return cond


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F8: rows with every model variable present (NaN counts as missing)."""
    return df.filter(complete_case_cond(cols))


#: 1 - leverage at or below which a row determines its own fitted value.
LEVERAGE_TOLERANCE = 1e-10


def _projected_pass2(d: DataFrame, parts, hc3: bool):
    """Pass 2 for several fits: residual, leverage and HC3 weight are projected
    once per row and fit (two chained selects), so every aggregate is a
    product of columns -- plan size O(models * k^2) instead of O(k^4)."""
    s1, s2, aggs = [], [], []
    for fit, cond, tag in parts:
        e = fit.resid_col()
        e = F.when(cond, e) if cond is not None else e
        s1.append(e.alias(f"{tag}e"))
        s2.append(F.col(f"{tag}e"))
        aggs.append(F.sum(F.col(f"{tag}e") * F.col(f"{tag}e")).alias(f"{tag}rss"))
        if hc3:
            k = len(fit.xs)
            s1.append(fit.leverage_col().alias(f"{tag}h"))
            for j, (x, m) in enumerate(zip(fit.xs, fit.xbar)):
                s1.append((F.col(x) - F.lit(float(m))).alias(f"{tag}z{j + 1}"))
                s2.append(F.col(f"{tag}z{j + 1}"))
            one_h = F.lit(1.0) - F.col(f"{tag}h")
            # A leverage-1 row has no finite HC3 weight: it is counted, and the
            # fit then has no robust errors.
            full = one_h <= F.lit(LEVERAGE_TOLERANCE)
            s2.append(F.when(~full, F.col(f"{tag}e") * F.col(f"{tag}e") / (one_h * one_h)).alias(f"{tag}w"))
            s2.append((full & F.col(f"{tag}e").isNotNull()).alias(f"{tag}full"))
            aggs.append(F.count_if(F.col(f"{tag}full")).alias(f"{tag}n_full"))
            w = F.col(f"{tag}w")
            z = [None] + [F.col(f"{tag}z{j}") for j in range(1, k + 1)]
            for i in range(k + 1):
                for j in range(i, k + 1):
                    t = w if i == 0 and j == 0 else (w * z[j] if i == 0 else w * z[i] * z[j])
                    aggs.append(F.sum(t).alias(f"{tag}w_{i}_{j}"))
    return d.select(*s1).select(*s2).agg(*aggs).collect()[0]


def _run_pass2(d: DataFrame, parts: list[tuple[OLSFit, Column | None, str]], hc3: bool):
    """One scan computing pass 2 for every (fit, row mask, tag) in ``parts``."""
    r = _projected_pass2(d, parts, hc3)
    for fit, _cond, tag in parts:
        _apply_pass2(fit, r, hc3, tag)


def _apply_pass2(fit: OLSFit, r, hc3: bool, tag: str) -> None:
    fit.rss = float(r[f"{tag}rss"])
    if hc3:
        k = len(fit.xs)
        m = np.full((k + 1, k + 1), np.nan)
        if not r[f"{tag}n_full"]:
            for i in range(k + 1):
                for j in range(i, k + 1):
                    m[i, j] = m[j, i] = r[f"{tag}w_{i}_{j}"]
        fit.meat_c = m


def fit_many(df: DataFrame, specs: dict, hc3: bool = True, second_pass: bool = True) -> dict[str, OLSFit]:
    """Fit several models in exactly two scans, whatever their number.

    ``specs``: ``{name: (y, xs, condition-or-None)}``.  Each model's rows are
    its condition AND its own complete cases; other rows are masked to NULL
    inside that model's aggregates, so one aggregation serves every model.
    """
    conds, aggs = {}, []
    for i, (name, (y, xs, cond)) in enumerate(specs.items()):
        cc = complete_case_cond([y, *xs])
        conds[name] = cc if cond is None else (cond & cc)
        aggs += _moment_aggs(y, xs, conds[name], tag=f"f{i}_")
    row = df.agg(*aggs).collect()[0]
    fits = {name: _fit_from_row(row, y, xs, tag=f"f{i}_")
            for i, (name, (y, xs, _c)) in enumerate(specs.items())}
    for name in specs:
        _refined(df, fits[name], conds[name])
    if second_pass:
        _run_pass2(df, [(fits[name], conds[name], f"f{i}_") for i, name in enumerate(specs)], hc3)
    return fits


def ols(df: DataFrame, y: str, xs: Sequence[str], second_pass: bool = True, hc3: bool = True) -> OLSFit:
    """Fit ``y ~ xs`` (with intercept) on complete cases."""
    d = complete_cases(df, [y, *xs])
    fit = _fit_from_row(d.agg(*_moment_aggs(y, xs)).collect()[0], y, xs)
    _refined(d, fit)
    if second_pass:
        residual_pass(d, fit, hc3)
    return fit


def residual_pass(d: DataFrame, fit: OLSFit, hc3: bool = True) -> OLSFit:
    """Pass 2: exact RSS and (optionally) the HC3 meat in centred coordinates."""
    _run_pass2(d, [(fit, None, "")], hc3)
    return fit


def cusum_process(df: DataFrame, fit: OLSFit, order: Sequence[str], keep: Sequence[str] = (),
                  partitions: int | None = None) -> DataFrame:
    """OLS-CUSUM process cumsum(e) / (sigma * sqrt(n)) over an ordered sample
    (T10), with the distributed prefix sum."""
    from .prefix import prefix_sum
    d = complete_cases(df, [fit.y, *fit.xs]).select(*order, *keep, fit.resid_col().alias("_e"))
    scale = math.sqrt(fit.sigma2()) * math.sqrt(fit.n)
    cs = prefix_sum(d, order, "_e", out="_cs", index="idx", partitions=partitions, rows=fit.n)
    return cs.select("idx", *order, *keep, (F.col("_cs") / F.lit(scale)).alias("process"))


def cusum_sup(df: DataFrame, fit: OLSFit, order: Sequence[str], partitions: int | None = None) -> float:
    """sup |OLS-CUSUM process| (T11) from the extremes of key ranges: one row
    reaches the driver."""
    from .prefix import prefix_extremes
    d = complete_cases(df, [fit.y, *fit.xs]).select(*order, fit.resid_col().alias("_e"))
    r = prefix_extremes(d, order, "_e", partitions, rows=fit.n).first()
    return max(abs(r["hi"]), abs(r["lo"])) / (math.sqrt(fit.sigma2()) * math.sqrt(fit.n))


def boxcox_profile(df: DataFrame, y: str, xs: Sequence[str],
                   lambdas: Sequence[float] | None = None) -> DataFrame:
    """Box-Cox profile log-likelihood over a lambda grid.

    y is scaled by its geometric mean; z = (y^l - 1)/l (log y at l=0);
    loglik(l) = -n/2 * log(RSS(z ~ xs)).  Two scans whatever the grid size:
    pass 1 gives n, mean(log y), the regressors' means and co-moments (shared
    by every lambda); pass 2 is one wide aggregate of sum z, sum z^2 and
    sum (x - xbar) z per lambda -- no row is replicated per lambda.

    The response must be positive: complete cases with y <= 0 are an error.
    """
    lambdas = [round(-2 + 0.1 * i, 10) for i in range(41)] if lambdas is None else list(lambdas)
    d = complete_cases(df, [y, *xs])
    k = len(xs)
    p1 = d.agg(F.avg(F.ln(y)).alias("lm"), F.count_if(F.col(y) <= 0).alias("low"), *_moment_aggs(y, xs)).collect()[0]
    if p1["low"]:
        raise ValueError(f"Box-Cox needs a positive response: {y} <= 0 in {p1['low']} rows")
    base = _fit_from_row(p1, y, xs)
    n = base.n
    ly = F.ln(F.col(y)) - F.lit(float(p1["lm"]))          # log of y / geometric mean
    xc = [F.col(x) - F.lit(float(m)) for x, m in zip(xs, base.xbar)]
    # Lambdas are batched so one aggregate stays around 300 buffer fields
    # (inside whole-stage codegen, bounded generated code); usually 1 batch.
    per = max(1, 300 // (k + 2))
    r = {}
    for start in range(0, len(lambdas), per):
        aggs = [F.sum(c).alias(f"sx_{j}") for j, c in enumerate(xc)]
        for i in range(start, min(start + per, len(lambdas))):
            lam = lambdas[i]
            z = ly if abs(lam) < 1e-12 else (F.exp(F.lit(float(lam)) * ly) - F.lit(1.0)) / F.lit(float(lam))
            aggs += [F.sum(z).alias(f"z_{i}"), F.sum(z * z).alias(f"zz_{i}")]
            aggs += [F.sum(c * z).alias(f"xz_{i}_{j}") for j, c in enumerate(xc)]
        r.update(d.agg(*aggs).collect()[0].asDict())
    sx = np.array([r[f"sx_{j}"] for j in range(k)], dtype=float)
    out = []
    for i, lam in enumerate(lambdas):
        sz = r[f"z_{i}"]
        szz = r[f"zz_{i}"] - sz * sz / n
        sxz = np.array([r[f"xz_{i}_{j}"] for j in range(k)], dtype=float) - sx * sz / n
        rss = szz - float(sxz @ base.sinv @ sxz) if k else szz
        out.append((float(lam), float(-n / 2.0 * math.log(rss))))
    return df.sparkSession.createDataFrame(out, "lambda double, loglik double")


def facet_lines(df: DataFrame, y: str, xs: Sequence[str], points: int = 80,
                level: float = 0.95) -> DataFrame:
    """Per-variable simple regression line with a confidence band.

    One scan computes every facet's ``regr_*`` statistics; an ``points``-row
    grid per facet (fixed size) carries fit and band.
    """
    aggs = []
    for i, name in enumerate(xs):
        v, x = present(y), present(name)
        aggs += [F.regr_count(v, x).alias(f"n{i}"), F.regr_slope(v, x).alias(f"b{i}"),
                 F.regr_intercept(v, x).alias(f"a{i}"), F.regr_avgx(v, x).alias(f"mx{i}"),
                 F.regr_sxx(v, x).alias(f"sxx{i}"), F.regr_syy(v, x).alias(f"syy{i}"),
                 F.regr_sxy(v, x).alias(f"sxy{i}"),
                 F.min(F.when(v.isNotNull(), x)).alias(f"lo{i}"),
                 F.max(F.when(v.isNotNull(), x)).alias(f"hi{i}")]
    from ..session import ship_package
    ship_package(df.sparkSession)
    one = df.agg(*aggs)
    facets = one.select(F.explode(F.array(*[
        F.struct(F.lit(x).alias("variable"), *[F.col(f"{k}{i}").alias(k) for k in
                                              ("n", "b", "a", "mx", "sxx", "syy", "sxy", "lo", "hi")])
        for i, x in enumerate(xs)])).alias("f")).select("f.*")
    facets = facets.withColumns({
        "sigma": F.sqrt(F.try_divide(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")),
                                     F.col("n") - 2)),
        "tq": dist.t_quantile_col(F.lit(0.5 + level / 2.0), F.col("n") - 2)})
    g = facets.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x0 = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i").cast("double") / F.lit(float(points - 1))
    g = g.withColumn("x", x0).withColumn("fit", F.col("a") + F.col("b") * F.col("x"))
    se = F.col("sigma") * F.sqrt(F.try_divide(F.lit(1.0), F.col("n"))
                                 + F.try_divide((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")),
                                                F.col("sxx")))
    return g.select("variable", "i", "x", "fit", (F.col("fit") - F.col("tq") * se).alias("lower"),
                    (F.col("fit") + F.col("tq") * se).alias("upper"))


TIDY_SCHEMA = "term string, estimate double, std_error double, statistic double, p_value double"
METRICS_SCHEMA = "model string, n double, r2 double, adj_r2 double, rmse double"


def _moments_frame(df: DataFrame, specs: dict) -> DataFrame:
    """One-row DataFrame of every spec's masked co-moments (lazy)."""
    aggs = []
    for i, (_name, (y, xs, cond)) in enumerate(specs.items()):
        cc = complete_case_cond([y, *xs])
        aggs += _moment_aggs(y, xs, cc if cond is None else (cond & cc), tag=f"f{i}_")
    return df.agg(*aggs)


def ols_tidy_lazy(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Classical coefficient table as a lazy DataFrame: the co-moment
    aggregate (one row) feeds a ``mapInPandas`` that solves the k x k system.
    No job runs until the result is used."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    specs = {"m": (y, list(xs), None)}
    xs = list(xs)

    def solve(batches):
        import pandas as pd
        for pdf in batches:
            for _, row in pdf.iterrows():
                fit = _fit_from_row(row, y, xs, tag="f0_")
                yield pd.DataFrame(fit.tidy(), columns=["term", "estimate", "std_error", "statistic", "p_value"])

    return _moments_frame(df, specs).mapInPandas(solve, TIDY_SCHEMA)


def fit_metrics_lazy(df: DataFrame, specs: dict) -> DataFrame:
    """R^2, adjusted R^2 and RMSE of several fits from one aggregate (lazy)."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    names = list(specs)
    shapes = [(y, list(xs)) for y, xs, _c in specs.values()]

    def solve(batches):
        import pandas as pd
        for pdf in batches:
            for _, row in pdf.iterrows():
                out = []
                for i, (name, (y, xs)) in enumerate(zip(names, shapes)):
                    f = _fit_from_row(row, y, xs, tag=f"f{i}_")
                    out.append((name, float(f.n), f.r2(), f.adj_r2(), f.rmse()))
                yield pd.DataFrame(out, columns=["model", "n", "r2", "adj_r2", "rmse"])

    return _moments_frame(df, specs).mapInPandas(solve, METRICS_SCHEMA)


def chow_test(df: DataFrame, y: str, xs: Sequence[str], regime: str, levels=(0, 1),
              names: Sequence[str] = ("pre", "post")) -> DataFrame:
    """Chow F test at known breaks (T9, quirk Q6) as a lazy one-row DataFrame:
    one fit per regime level against one over the rows of those levels, rows of
    any other level (or none) left out; regressors without the regime.  With p
    the coefficients that a fit can estimate, intercept included,
    df = (sum of p over the levels - p of the pooled fit, n - sum of p)."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    xs, levels, names = list(xs), list(levels), list(names)
    inside = F.col(regime).isin(levels)
    specs = {"pooled": (y, xs, inside), **{n: (y, xs, inside & (F.col(regime) == F.lit(v))) for n, v in zip(names, levels, strict=True)}}
    columns = ["statistic", "df1", "df2", "p_value", "rss_pooled", *[f"rss_{n}" for n in names]]
    n_fits = len(specs)

    def solve(batches):
        import pandas as pd
        for pdf in batches:
            for _, row in pdf.iterrows():
                pooled, *own = (_fit_from_row(row, y, xs, tag=f"f{i}_") for i in range(n_fits))
                rss, free = sum(f.rss_value() for f in own), sum(f.p for f in own)
                df1, df2 = free - pooled.p, pooled.n - free
                f = ((pooled.rss_value() - rss) / df1) / (rss / df2)
                yield pd.DataFrame([(f, float(df1), float(df2), dist.f_sf(f, df1, df2), pooled.rss_value(),
                                     *[x.rss_value() for x in own])], columns=columns)

    return _moments_frame(df, specs).mapInPandas(solve, ", ".join(f"{c} double" for c in columns))
