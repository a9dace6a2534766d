"""DuckDB oracle SQL for the statistical queries.

Independent route: normal equations solved by cofactors (Cramer) in SQL,
leverages and HC3 meat in a second SQL pass, t and F tail probabilities by
composite Simpson quadrature (20,000 intervals) after the usual angle
substitutions, medians and quartiles by DuckDB's own exact quantiles.
"""

from __future__ import annotations

from .oracle import ORACLE, PANEL_CTE

NQ = 20000
_W = f"CASE WHEN q.k = 0 OR q.k = {NQ} THEN 1 WHEN q.k % 2 = 1 THEN 4 ELSE 2 END"

_POST = "CASE WHEN year(l_shipdate) >= 1998 THEN 1 ELSE 0 END"
MODEL_SRC = f"""SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
  l_discount, l_tax, {_POST} AS post FROM lineitem"""
XS = ["l_quantity", "l_discount", "l_tax"]
XS_FULL = XS + ["post"]
Y = "l_extendedprice"
ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey"


def t_pvalue(src: str, keys: list[str], name: str) -> str:
    """CTEs: {name} = keys + p_value, two-sided t tail of (t_stat, df) in src."""
    k = ", ".join(keys)
    return f"""{name}_th AS (SELECT {k}, df, atan(abs(t_stat) / sqrt(df)) AS th FROM {src}),
{name}_in AS (
  SELECT {k}, any_value(df) AS df,
         sum({_W} * pow(cos(th * q.k / {NQ}), df - 1)) * any_value(th) / {NQ} / 3 AS integral
  FROM {name}_th, range(0, {NQ + 1}) q(k) GROUP BY {k}),
{name} AS (
  SELECT {k}, greatest(0.0, 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * integral) AS p_value
  FROM {name}_in)"""


def f_cdf(src: str, keys: list[str], name: str) -> str:
    """CTEs: {name} = keys + cdf, P(F_{df1,df2} <= statistic) for rows of src."""
    k = ", ".join(keys)
    return f"""{name}_th AS (
  SELECT {k}, df1 / 2.0 AS a, df2 / 2.0 AS b,
         asin(sqrt(df1 * statistic / (df1 * statistic + df2))) AS th,
         lgamma(df1 / 2.0) + lgamma(df2 / 2.0) - lgamma(df1 / 2.0 + df2 / 2.0) AS lbeta
  FROM {src}),
{name} AS (
  SELECT {k}, least(1.0, greatest(0.0, sum({_W} * CASE WHEN q.k = 0 THEN
           CASE WHEN a = 0.5 THEN 2 * exp(-lbeta) ELSE 0.0 END
         ELSE 2 * exp((2 * a - 1) * ln(sin(th * q.k / {NQ})) + (2 * b - 1) * ln(cos(th * q.k / {NQ})) - lbeta)
         END) * any_value(th) / {NQ} / 3)) AS cdf
  FROM {name}_th, range(0, {NQ + 1}) q(k) GROUP BY {k})"""


def _ent(i: int, j: int) -> str:
    return f"s_{min(i, j)}_{max(i, j)}"


def _det(rows: list[int], cols: list[int]) -> str:
    if not rows:
        return "1.0"
    if len(rows) == 1:
        return _ent(rows[0], cols[0])
    terms = []
    for j, c in enumerate(cols):
        sub = _det(rows[1:], cols[:j] + cols[j + 1:])
        terms.append(("+ " if j % 2 == 0 else "- ") + f"{_ent(rows[0], c)} * {sub}")
    return "(" + " ".join(terms) + ")"


def ols(p: str, src: str, y: str, xs: list[str]) -> str:
    """CTEs for an OLS fit per ``seg`` of ``src`` (which must carry ``seg``).

    Defines {p}_fit with: seg, n, k, rss, sigma2, b_0..b_k (b_0 intercept),
    se_j (classical) and hc_j (HC3) for j = 0..k.
    """
    k = len(xs)
    cols = xs + [y]
    m = [f"count(*) AS n"] + [f"avg({c}) AS mx_{i}" for i, c in enumerate(cols)]
    for i in range(k + 1):
        for j in range(i, k + 1):
            agg = f"var_samp({cols[i]})" if i == j else f"covar_samp({cols[i]}, {cols[j]})"
            m.append(f"{agg} * (count(*) - 1) AS s_{i}_{j}")
    idx = list(range(k))
    det = _det(idx, idx)
    inv = []
    for i in range(k):
        for j in range(k):
            ri = [r for r in idx if r != j]
            ci = [c for c in idx if c != i]
            sign = "" if (i + j) % 2 == 0 else "-"
            inv.append(f"{sign}{_det(ri, ci)} / det AS inv_{i}_{j}")
    beta = [f"({' + '.join(f'inv_{j}_{l} * s_{l}_{k}' for l in range(k))}) AS b_{j + 1}" for j in range(k)]
    b0 = f"mx_{k} - ({' + '.join(f'b_{j + 1} * mx_{j}' for j in range(k))}) AS b_0"
    fitted = "b_0 + " + " + ".join(f"b_{j + 1} * r.{xs[j]}" for j in range(k))
    lev = "1.0 / n + " + " + ".join(f"inv_{i}_{j} * (r.{xs[i]} - mx_{i}) * (r.{xs[j]} - mx_{j})"
                                    for i in range(k) for j in range(k))
    z = ["1.0"] + [f"(r.{xs[i]} - mx_{i})" for i in range(k)]
    w = "e * e / ((1.0 - h) * (1.0 - h))"
    meat = [f"sum({w} * {z[i]} * {z[j]}) AS w_{i}_{j}" for i in range(k + 1) for j in range(i, k + 1)]

    def W(i, j):
        return f"w_{min(i, j)}_{max(i, j)}"

    def B(i, j):  # bread: blockdiag(1/n, S)
        if i == 0 and j == 0:
            return "(1.0 / n)"
        if i == 0 or j == 0:
            return None
        return f"inv_{i - 1}_{j - 1}"

    def Vc(a, b):
        terms = []
        for c in range(k + 1):
            for d in range(k + 1):
                ba, bb = B(a, c), B(d, b)
                if ba is None or bb is None:
                    continue
                terms.append(f"{ba} * {W(c, d)} * {bb}")
        return "(" + " + ".join(terms) + ")"

    v00 = Vc(0, 0) + "".join(f" - 2 * mx_{j} * {Vc(0, j + 1)}" for j in range(k)) + \
        "".join(f" + mx_{i} * mx_{j} * {Vc(i + 1, j + 1)}" for i in range(k) for j in range(k))
    xsx = " + ".join(f"mx_{i} * inv_{i}_{j} * mx_{j}" for i in range(k) for j in range(k))
    se = [f"sqrt(rss / (n - {k + 1}) * (1.0 / n + {xsx})) AS se_0"] + \
         [f"sqrt(rss / (n - {k + 1}) * inv_{j}_{j}) AS se_{j + 1}" for j in range(k)]
    hc = [f"sqrt({v00}) AS hc_0"] + [f"sqrt({Vc(j + 1, j + 1)}) AS hc_{j + 1}" for j in range(k)]
    return f"""{p}_m AS (SELECT seg, {", ".join(m)} FROM ({src}) GROUP BY seg),
{p}_d AS (SELECT *, {det} AS det FROM {p}_m),
{p}_i AS (SELECT *, {", ".join(inv)} FROM {p}_d),
{p}_b1 AS (SELECT *, {", ".join(beta)} FROM {p}_i),
{p}_b AS (SELECT *, {b0} FROM {p}_b1),
{p}_r AS (
  SELECT b.seg, r.{y} - ({fitted}) AS e, {lev} AS h, {", ".join(f"r.{x}" for x in xs)},
         {", ".join(f"b.mx_{i}" for i in range(k))}
  FROM ({src}) r JOIN {p}_b b ON r.seg = b.seg),
{p}_p2 AS (SELECT seg, sum(e * e) AS rss, {", ".join(meat).replace("r.", "")} FROM {p}_r GROUP BY seg),
{p}_fit AS (
  SELECT b.*, p2.*, {k} AS k, p2.rss / (b.n - {k + 1}) AS sigma2, {", ".join(se + hc)}
  FROM {p}_b b JOIN {p}_p2 p2 USING (seg))"""


def _model_src(seg: str = "'all'") -> str:
    """Model rows with the segment label the generated OLS CTEs group by."""
    return f"SELECT *, {seg} AS seg FROM ({MODEL_SRC})"


def _tidy(p: str, terms: list[str], cols: dict) -> str:
    """UNION ALL of one row per term from {p}_fit; cols maps out -> template with {j}."""
    parts = []
    for j, t in enumerate(terms):
        sel = ", ".join(f"{tmpl.format(j=j)} AS {name}" for name, tmpl in cols.items())
        parts.append(f"SELECT seg, '{t}' AS term, {sel} FROM {p}_fit")
    return "\nUNION ALL\n".join(parts)


TERMS = ["(Intercept)"] + XS
TERMS_FULL = ["(Intercept)"] + XS_FULL


def _r(x, d=6):
    return f"round({x}, {d})"


# ---- T1/T2 Welch t
_MEAS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _mc(x):
    return f"CAST(sum(CAST(round({x} * 100) AS HUGEINT)) AS DOUBLE) / nullif(count({x}) * 100.0, 0)"


def welch_cte(source: str, measures) -> str:
    mom = "\nUNION ALL\n".join(f"""SELECT '{m}' AS variable,
  count({m}) FILTER (WHERE post = 0) AS n0, {_mc(f"CASE WHEN post = 0 THEN {m} END")} AS m0,
  var_samp({m}) FILTER (WHERE post = 0) AS v0,
  count({m}) FILTER (WHERE post = 1) AS n1, {_mc(f"CASE WHEN post = 1 THEN {m} END")} AS m1,
  var_samp({m}) FILTER (WHERE post = 1) AS v1
FROM ({source})""" for m in measures)
    return f"""mom AS ({mom}),
wt AS (
  SELECT *, (m0 - m1) / sqrt(v0 / n0 + v1 / n1) AS t_stat,
         (v0 / n0 + v1 / n1) * (v0 / n0 + v1 / n1)
           / ((v0 / n0) * (v0 / n0) / (n0 - 1) + (v1 / n1) * (v1 / n1) / (n1 - 1)) AS df
  FROM mom),
{t_pvalue("wt", ["variable"], "wp")}"""


def _welch_table(cte: str) -> str:
    return f"""
WITH {cte}
SELECT variable, m0 AS mean_pre, m1 AS mean_post, {_r("sqrt(v0)", 5)} AS sd_pre, {_r("sqrt(v1)", 5)} AS sd_post,
       {_r("t_stat")} AS t_stat, {_r("df", 4)} AS df, {_r("p_value")} AS p_value
FROM wt JOIN wp USING (variable)"""


WELCH_CTE = welch_cte(MODEL_SRC, _MEAS)
ORACLE["welch_t"] = _welch_table(WELCH_CTE)

# Measures and regimes blanked by rule: the SQL side only knows NULL.
_MISSING_SRC = """SELECT
  CASE WHEN l_returnflag <> 'N' OR l_linenumber > 2 THEN CASE WHEN year(l_shipdate) >= 1998 THEN 1 ELSE 0 END END AS post,
  CASE WHEN l_linenumber NOT IN (1, 3) THEN l_quantity END AS na_quantity,
  CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS na_price,
  CASE WHEN l_discount <> 0 THEN l_discount END AS na_discount
FROM lineitem"""
ORACLE["missing_value_tests"] = _welch_table(welch_cte(_MISSING_SRC, ["na_quantity", "na_price", "na_discount"]))

ORACLE["sorted_top_p"] = f"""
WITH {WELCH_CTE}
SELECT variable, {_r("p_value")} AS p_value,
       CAST(row_number() OVER (ORDER BY round(p_value, 6) ASC NULLS LAST, variable) AS INTEGER) AS rank
FROM wp"""

# ---- T3 Pearson
_pear = "\nUNION ALL\n".join(f"""SELECT '{x}' AS variable, corr({Y}, {x}) AS estimate,
  CAST(regr_count({Y}, {x}) AS BIGINT) AS n FROM lineitem""" for x in XS)
ORACLE["pearson_test"] = f"""
WITH pr AS ({_pear}),
pt AS (SELECT *, estimate * sqrt((n - 2) / (1 - estimate * estimate)) AS t_stat, CAST(n - 2 AS DOUBLE) AS df FROM pr),
{t_pvalue("pt", ["variable"], "pp")}
SELECT variable, {_r("estimate", 9)} AS estimate, n, {_r("t_stat")} AS t_stat, df, {_r("p_value")} AS p_value
FROM pt JOIN pp USING (variable)"""

# ---- T4/T5 classical, T6 HC3 (price ~ qty + discount + tax, all rows)
_OLS3 = ols("o", _model_src(), Y, XS)
ORACLE["ols_coefs"] = f"""
WITH {_OLS3},
tt AS ({_tidy("o", TERMS, {"estimate": "b_{j}", "std_error": "se_{j}", "t_stat": "b_{j} / se_{j}",
                         "df": "CAST(n - k - 1 AS DOUBLE)"})}),
{t_pvalue("tt", ["term"], "tp")}
SELECT term, {_r("estimate", 4)} AS estimate, {_r("std_error", 4)} AS std_error, {_r("t_stat")} AS statistic,
       {_r("p_value")} AS p_value
FROM tt JOIN tp USING (term)"""

ORACLE["ols_hc3"] = f"""
WITH {_OLS3},
tt AS ({_tidy("o", TERMS, {"estimate": "b_{j}", "std_error": "hc_{j}", "t_stat": "b_{j} / hc_{j}",
                         "df": "CAST(n - k - 1 AS DOUBLE)"})}),
{t_pvalue("tt", ["term"], "tp")}
SELECT term, {_r("estimate", 4)} AS estimate, {_r("std_error", 4)} AS std_error_hc3, {_r("t_stat")} AS statistic_hc3,
       {_r("p_value")} AS p_value_hc3
FROM tt JOIN tp USING (term)"""

# ---- T8 fit metrics and T7 model table over three models
_SEG = ols("sg", _model_src(seg="CASE WHEN post = 1 THEN 'Post' ELSE 'Pre' END"), Y, XS)
_FULL = ols("fu", _model_src(seg="'Full'"), Y, XS_FULL)
ORACLE["fit_metrics"] = f"""
WITH {_SEG}, {_FULL},
f AS (SELECT seg, n, k, rss, s_{3}_{3} AS syy FROM sg_fit
      UNION ALL SELECT seg, n, k, rss, s_{4}_{4} FROM fu_fit)
SELECT seg AS model, CAST(n AS DOUBLE) AS n, {_r("1 - rss / syy")} AS r2,
       {_r("1 - (rss / syy) * (n - 1) / (n - k - 1)")} AS adj_r2, {_r("sqrt(rss / n)", 4)} AS rmse
FROM f"""

_TIDY_COLS = {"estimate": "b_{j}", "std_error_normal": "se_{j}", "std_error_robust": "hc_{j}",
              "t_stat": "b_{j} / hc_{j}", "df": "CAST(n - k - 1 AS DOUBLE)"}
ORACLE["model_table"] = f"""
WITH {_SEG}, {_FULL},
tt AS ({_tidy("sg", TERMS, _TIDY_COLS)}
       UNION ALL
       {_tidy("fu", TERMS_FULL, _TIDY_COLS)}),
{t_pvalue("tt", ["seg", "term"], "tp")}
SELECT seg AS model, term, {_r("estimate", 4)} AS estimate, {_r("std_error_normal", 3)} AS std_error_normal,
       {_r("std_error_robust", 3)} AS std_error_robust, {_r("p_value", 3)} AS p_value
FROM tt JOIN tp USING (seg, term)"""

# ---- T9 Chow
_POOL = ols("pl", _model_src(seg="'all'"), Y, XS)
_SEG01 = ols("sx", _model_src(seg="post"), Y, XS)
ORACLE["chow_test"] = f"""
WITH {_POOL}, {_SEG01},
c AS (
  SELECT ((p.rss - s0.rss - s1.rss) / 4) / ((s0.rss + s1.rss) / (p.n - 8)) AS statistic,
         CAST(4 AS DOUBLE) AS df1, CAST(p.n - 8 AS DOUBLE) AS df2, p.rss AS rss_pooled, s0.rss AS rss_pre, s1.rss AS rss_post,
         1 AS id
  FROM pl_fit p, sx_fit s0, sx_fit s1 WHERE s0.seg = 0 AND s1.seg = 1),
{f_cdf("c", ["id"], "cf")}
SELECT {_r("statistic")} AS statistic, df1, df2, {_r("1 - cdf")} AS p_value, {_r("rss_pooled", -4)} AS rss_pooled,
       {_r("rss_pre", -4)} AS rss_pre, {_r("rss_post", -4)} AS rss_post
FROM c JOIN cf USING (id)"""

# ---- T10/T11 CUSUM (full model)
_CU = ols("cu", _model_src(seg="'all'"), Y, XS_FULL)
_fitted_full = "b.b_0 + " + " + ".join(f"b.b_{j + 1} * r.{x}" for j, x in enumerate(XS_FULL))
CUSUM_CTE = f"""{_CU},
cp AS (
  SELECT row_number() OVER (ORDER BY {ORDER}) AS idx, r.l_orderkey, r.l_linenumber, r.l_partkey,
         sum(r.{Y} - ({_fitted_full})) OVER (ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING)
           / (sqrt(b.rss / (b.n - 5)) * sqrt(b.n)) AS process
  FROM ({_model_src()}) r, cu_fit b)"""
ORACLE["cusum_process"] = f"""
WITH {CUSUM_CTE}
SELECT idx, l_orderkey, l_linenumber, l_partkey, {_r("process")} AS process FROM cp"""

ORACLE["cusum_test"] = f"""
WITH {CUSUM_CTE},
s AS (SELECT max(abs(process)) AS statistic FROM cp)
SELECT {_r("statistic")} AS statistic,
       {_r("least(1.0, greatest(0.0, 2 * sum(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * j * j * statistic * statistic))))")} AS p_value
FROM s, range(1, 101) t(j) GROUP BY statistic"""

# ---- T12 Box-Cox
_BC_Z = ("CASE WHEN abs(lam.lam) < 1e-12 THEN ln(l_extendedprice / gm) "
         "ELSE (pow(l_extendedprice / gm, lam.lam) - 1.0) / lam.lam END")
_BC_SRC = f"""SELECT r.*, lam.lam AS seg, {_BC_Z} AS z
  FROM ({MODEL_SRC}) r, (SELECT exp(avg(ln(l_extendedprice))) AS gm FROM lineitem WHERE l_extendedprice > 0) g,
       (SELECT round(CAST(-2 + 0.1 * i AS DOUBLE), 10) AS lam FROM range(0, 41) t(i)) lam
  WHERE r.l_extendedprice > 0"""


def _bc_cte() -> str:
    k = len(XS_FULL)
    cols = XS_FULL + ["z"]
    m = ["count(*) AS n"]
    for i in range(k + 1):
        for j in range(i, k + 1):
            agg = f"var_samp({cols[i]})" if i == j else f"covar_samp({cols[i]}, {cols[j]})"
            m.append(f"{agg} * (count(*) - 1) AS s_{i}_{j}")
    idx = list(range(k))
    inv = []
    for i in range(k):
        for j in range(k):
            ri = [r for r in idx if r != j]
            ci = [c for c in idx if c != i]
            sign = "" if (i + j) % 2 == 0 else "-"
            inv.append(f"{sign}{_det(ri, ci)} / det AS inv_{i}_{j}")
    beta = [f"({' + '.join(f'inv_{j}_{l} * s_{l}_{k}' for l in range(k))}) AS b_{j}" for j in range(k)]
    rss = f"s_{k}_{k} - (" + " + ".join(f"b_{j} * s_{j}_{k}" for j in range(k)) + ")"
    return f"""bm AS (SELECT seg AS lam, {", ".join(m)} FROM ({_BC_SRC}) GROUP BY seg),
bd AS (SELECT *, {_det(idx, idx)} AS det FROM bm),
bi AS (SELECT *, {", ".join(inv)} FROM bd),
bb AS (SELECT *, {", ".join(beta)} FROM bi),
br AS (SELECT lam, n, {rss} AS rss FROM bb)"""


ORACLE["boxcox_profile"] = f"""
WITH {_bc_cte()}
SELECT round(CAST(lam AS DOUBLE), 1) AS "lambda", round(-n / 2.0 * ln(rss), 3) AS loglik FROM br"""

# ---- T13 variance F, T14 Levene (sqrt(price) by regime)
ORACLE["variance_f"] = f"""
WITH v AS (
  SELECT var_samp(sqrt({Y})) FILTER (WHERE post = 0) / var_samp(sqrt({Y})) FILTER (WHERE post = 1) AS statistic,
         count(*) FILTER (WHERE post = 0) - 1 AS df1, count(*) FILTER (WHERE post = 1) - 1 AS df2, 1 AS id
  FROM ({MODEL_SRC})),
{f_cdf("v", ["id"], "vf")}
SELECT {_r("statistic")} AS statistic, df1, df2, {_r("least(1.0, 2 * least(cdf, 1 - cdf))")} AS p_value
FROM v JOIN vf USING (id)"""

ORACLE["levene_median"] = f"""
WITH d AS (SELECT post AS g, sqrt({Y}) AS v FROM ({MODEL_SRC})),
md AS (SELECT g, median(v) AS med FROM d GROUP BY g),
z AS (SELECT d.g, abs(d.v - md.med) AS z FROM d JOIN md USING (g)),
per AS (SELECT g, count(*) AS n, avg(z) AS zm, var_samp(z) AS zv FROM z GROUP BY g),
tot AS (SELECT sum(n) AS nn, sum(n * zm) / sum(n) AS zbar FROM per),
l AS (
  SELECT (sum(per.n * (per.zm - tot.zbar) * (per.zm - tot.zbar)) / 1.0)
           / (sum((per.n - 1) * per.zv) / (any_value(tot.nn) - 2)) AS statistic,
         1 AS df1, CAST(any_value(tot.nn) - 2 AS BIGINT) AS df2, 1 AS id
  FROM per, tot),
{f_cdf("l", ["id"], "lf")}
SELECT {_r("statistic")} AS statistic, df1, df2, {_r("1 - cdf")} AS p_value FROM l JOIN lf USING (id)"""

# ---- T15 per-regressor line with 95% band (t quantile by Cornish-Fisher series)
_z975 = "CAST(1.959963984540054 AS DOUBLE)"


def _tq(df: str) -> str:
    z = _z975
    g1 = f"(pow({z},3) + {z}) / 4"
    g2 = f"(5*pow({z},5) + 16*pow({z},3) + 3*{z}) / 96"
    g3 = f"(3*pow({z},7) + 19*pow({z},5) + 17*pow({z},3) - 15*{z}) / 384"
    g4 = f"(79*pow({z},9) + 776*pow({z},7) + 1482*pow({z},5) - 1920*pow({z},3) - 945*{z}) / 92160"
    return f"({z} + ({g1}) / {df} + ({g2}) / pow({df},2) + ({g3}) / pow({df},3) + ({g4}) / pow({df},4))"


_fac = "\nUNION ALL\n".join(f"""SELECT '{x}' AS variable, regr_count({Y}, {x}) AS n, regr_slope({Y}, {x}) AS b,
  regr_intercept({Y}, {x}) AS a, regr_avgx({Y}, {x}) AS mx, regr_sxx({Y}, {x}) AS sxx,
  regr_syy({Y}, {x}) AS syy, regr_sxy({Y}, {x}) AS sxy, min({x}) AS lo, max({x}) AS hi FROM lineitem"""
                            for x in XS)
ORACLE["facet_lm_band"] = f"""
WITH fc AS ({_fac}),
f2 AS (SELECT *, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS sigma, {_tq("(n - 2)")} AS tq FROM fc),
g AS (SELECT f2.*, i, lo + (hi - lo) * CAST(i AS DOUBLE) / 79.0 AS x FROM f2, range(0, 80) t(i)),
h AS (SELECT *, a + b * x AS fit, sigma * sqrt(1.0 / n + (x - mx) * (x - mx) / sxx) AS se FROM g)
SELECT variable, CAST(i AS INTEGER) AS i, {_r("x", 4)} AS x, {_r("fit", 4)} AS fit,
       {_r("fit - tq * se", 4)} AS lower, {_r("fit + tq * se", 4)} AS upper
FROM h"""

# ---- T16 KDE (linear binning to multiples of a power of two below bw / 64)
ORACLE["kde_density"] = """
WITH v AS (SELECT value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
s AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM v),
b0 AS (SELECT *, 0.9 * least(sd, (q3 - q1) / 1.34) * pow(n, -0.2) AS bw FROM s),
b AS (SELECT *, pow(2.0, floor(log2(bw / 64.0))) AS w FROM b0),
cell AS (SELECT CAST(floor(v.v / b.w) AS BIGINT) AS k, v.v / b.w AS p FROM v, b),
half AS (SELECT k, count(*) AS c, sum(p - k) AS f FROM cell GROUP BY k),
nodes AS (SELECT k, sum(w) AS weight FROM (SELECT k, c - f AS w FROM half UNION ALL SELECT k + 1, f FROM half) GROUP BY k),
g AS (SELECT CAST(i AS INTEGER) AS i, lo + (hi - lo) * CAST(i AS DOUBLE) / 511.0 AS x FROM b, range(0, 512) t(i)),
u AS (SELECT g.i, g.x, nodes.weight, (g.x - nodes.k * b.w) / b.bw AS u FROM g, nodes, b),
d AS (SELECT i, any_value(x) AS x, sum(weight * exp(-0.5 * u * u)) AS s FROM u GROUP BY i)
SELECT i, x, round(s / (n * bw * sqrt(2 * pi())), 9) AS density, round(bw, 9) AS bw FROM d, b"""

# ---- T17/W6 residuals vs fitted of the full model
ORACLE["residual_fitted"] = f"""
WITH {_CU},
o AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) AS rn FROM ({MODEL_SRC})),
brk AS (SELECT min(rn) AS break_index FROM o WHERE post = 1)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, {_r(f"({_fitted_full})", 4)} AS fitted,
       {_r(f"r.{Y} - ({_fitted_full})", 4)} AS resid, brk.break_index
FROM ({MODEL_SRC}) r, cu_fit b, brk"""

# ---- T18 first-difference regression on the panel
_DIFF_SRC = f"""WITH {PANEL_CTE},
p AS (SELECT county, CASE WHEN year >= 1998 THEN 1 ELSE 0 END AS post,
  {", ".join(f"list_sum(list(CAST({c} AS DOUBLE) ORDER BY year)) / count(*) AS {c}" for c in ("crime_rate", "officers", "urgent"))}
  FROM panel GROUP BY ALL),
dd AS (
  SELECT county,
    max(CASE WHEN post = 1 THEN crime_rate END) - max(CASE WHEN post = 0 THEN crime_rate END) AS crime_rate_diff,
    max(CASE WHEN post = 1 THEN officers END) - max(CASE WHEN post = 0 THEN officers END) AS officers_diff,
    max(CASE WHEN post = 1 THEN urgent END) - max(CASE WHEN post = 0 THEN urgent END) AS urgent_diff
  FROM p GROUP BY county
  HAVING count(*) FILTER (WHERE post = 1) = 1 AND count(*) FILTER (WHERE post = 0) = 1)
SELECT *, 'all' AS seg FROM dd"""
_DR = ols("dr", _DIFF_SRC, "crime_rate_diff", ["officers_diff", "urgent_diff"])
ORACLE["diff_regression"] = f"""
WITH {_DR},
tt AS ({_tidy("dr", ["(Intercept)", "officers_diff", "urgent_diff"],
               {"estimate": "b_{j}", "std_error": "se_{j}", "t_stat": "b_{j} / se_{j}",
                "df": "CAST(n - k - 1 AS DOUBLE)"})}),
{t_pvalue("tt", ["term"], "tp")}
SELECT term, {_r("estimate")} AS estimate, {_r("std_error")} AS std_error, {_r("t_stat")} AS statistic,
       {_r("p_value")} AS p_value
FROM tt JOIN tp USING (term)"""

# ---- G1-G4 spherical polygons on supplier cells
_RINGS = """rings AS (
  SELECT s_suppkey AS geoid, 0 AS ring_id, c.seq,
         -180.0 + CAST(s_suppkey % 360 AS DOUBLE) + CASE WHEN c.seq IN (1, 2) THEN 0.5 + CAST(s_suppkey % 5 AS DOUBLE) * 0.25 ELSE 0.0 END AS lon,
         -60.0 + CAST((s_suppkey // 360) % 120 AS DOUBLE) + CASE WHEN c.seq IN (2, 3) THEN 0.5 + CAST(s_suppkey % 3 AS DOUBLE) * 0.25 ELSE 0.0 END AS lat
  FROM supplier, (SELECT unnest([0, 1, 2, 3]) AS seq) c),
edges AS (
  SELECT *,
    coalesce(lead(lon) OVER w, first_value(lon) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS lon2,
    coalesce(lead(lat) OVER w, first_value(lat) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS lat2
  FROM rings WINDOW w AS (PARTITION BY geoid, ring_id ORDER BY seq)),
area AS (
  SELECT geoid, abs(sum(2 * atan2(tan(radians(lon2 - lon) / 2) * (tan(radians(lat) / 2) + tan(radians(lat2) / 2)),
                                   1 + tan(radians(lat) / 2) * tan(radians(lat2) / 2)))) * 6371010.0 * 6371010.0 AS area_m2
  FROM edges GROUP BY geoid)"""

ORACLE["polygon_area"] = f"""
WITH {_RINGS}
SELECT geoid, round(area_m2, 0) AS area_m2 FROM area"""

ORACLE["polygon_centroid"] = f"""
WITH {_RINGS},
c AS (
  SELECT geoid, sum(lon * lat2 - lon2 * lat) AS a2, sum((lon + lon2) * (lon * lat2 - lon2 * lat)) AS sx,
         sum((lat + lat2) * (lon * lat2 - lon2 * lat)) AS sy
  FROM edges WHERE geoid IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY geoid)
SELECT geoid, round(sx / (3.0 * a2), 9) AS cx, round(sy / (3.0 * a2), 9) AS cy FROM c"""

ORACLE["polygon_density"] = f"""
WITH {_RINGS},
l AS (SELECT l_suppkey AS geoid, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT l.geoid, l.n_lines, round(a.area_m2, 0) AS area_m2, round(l.n_lines / (a.area_m2 / 1e6), 9) AS lines_per_km2
FROM l LEFT JOIN area a USING (geoid)"""
