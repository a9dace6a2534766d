"""DuckDB SQL oracle, one statement per catalogue query.

Independent formulations of the same semantics, run by the driver on the
same parquet tables.  Rounding mirrors ``catalogue.finish``.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

TYPES = [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"),
         ("4-NOT SPECIFIED", "not_specified"), ("5-LOW", "low")]
TYPE_COLS = [c for _, c in TYPES]
TOTAL = "(" + " + ".join(TYPE_COLS) + ")"


def mean_cents(x: str) -> str:
    return f"CAST(sum(CAST(round({x} * 100) AS HUGEINT)) AS DOUBLE) / nullif(count({x}) * 100.0, 0)"


def sum_cents(x: str) -> str:
    return f"CAST(sum(CAST(round({x} * 100) AS HUGEINT)) AS DOUBLE) / 100.0"


def _counts(prefix: str = "") -> str:
    return ",\n  ".join(f"count(*) FILTER (WHERE {prefix}o_orderpriority = '{v}') AS {c}"
                        for v, c in TYPES)


MONTHLY_CTE = f"""monthly AS (
  SELECT o_custkey AS agency, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(year(o_orderdate) AS INTEGER) AS year,
  {_counts()}
  FROM orders GROUP BY ALL)"""

PANEL_CTE = MONTHLY_CTE + f""",
pop AS (
  SELECT n.n_name AS county, count(*) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name),
yearly AS (
  SELECT n.n_name AS county, m.year,
         {", ".join(f"CAST(sum(m.{c}) AS BIGINT) AS {c}" for c in TYPE_COLS)},
         {mean_cents('c.c_acctbal')} AS officers
  FROM monthly m LEFT JOIN customer c ON m.agency = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name, m.year),
panel AS (
  SELECT y.*, p.population,
         {TOTAL} / p.population AS crime_rate,
         urgent / p.population AS homicide_rate
  FROM yearly y LEFT JOIN pop p USING (county))"""


def zero_safe(sql: str) -> str:
    """DuckDB's round() keeps the sign of a rounded-away negative (-0.0);
    Spark's round() always returns +0.0.  ``0.0 + round(...)`` normalises the
    sign so both engines print identical values."""
    import re
    return re.sub(r"\bround\(", "0.0 + round(", sql)


def r(expr: str, d: int = 6) -> str:
    return f"round({expr}, {d})"


ORACLE["panel_yearly"] = f"""
WITH {PANEL_CTE}
SELECT county, year, {", ".join(TYPE_COLS)}, officers, population,
       crime_rate, homicide_rate
FROM panel"""


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


TOP = ["NATION_2", "NATION_5", "NATION_11", "NATION_17", "NATION_23"]
RES = ["NATION_1", "NATION_4", "NATION_6", "NATION_9", "NATION_13", "NATION_16", "NATION_19", "NATION_22"]
METRO = ["NATION_2", "NATION_5"]

ORACLE["monthly_type_long"] = f"""
WITH {MONTHLY_CTE},
long AS (UNPIVOT monthly ON {", ".join(TYPE_COLS)} INTO NAME crime_type VALUE n)
SELECT month, year, crime_type, CAST(sum(n) AS BIGINT) AS n_orders FROM long GROUP BY ALL"""

ORACLE["type_pivot_wide"] = f"""
WITH {MONTHLY_CTE}
SELECT agency, month, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in TYPE_COLS)} FROM monthly"""

ORACLE["set_flags"] = f"""
WITH {PANEL_CTE}
SELECT county, year,
  CASE WHEN county IN {_in(TOP)} THEN 1 ELSE 0 END AS top_cities,
  CASE WHEN county IN {_in(RES)} THEN 1 ELSE 0 END AS reservations,
  CASE WHEN county IN {_in(METRO)} THEN 1 ELSE 0 END AS msp_main_counties,
  CASE WHEN year >= 1998 THEN 1 ELSE 0 END AS post
FROM panel"""

ORACLE["left_join_fan_out"] = f"""
WITH monthly AS (
  SELECT o_custkey AS agency, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
  FROM orders GROUP BY ALL),
yearly AS (
  SELECT o_custkey AS agency, CAST(year(o_orderdate) AS INTEGER) AS year,
         {mean_cents('o_totalprice')} AS officers
  FROM orders GROUP BY ALL),
mapping AS (
  SELECT c_custkey AS agency, 'N' || c_nationkey AS geo, 'nation' AS kind
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL
  SELECT c_custkey, 'R' || n_regionkey, 'region'
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
geo_yearly AS (
  SELECT 'N' || c.c_nationkey AS geo, CAST(year(o.o_orderdate) AS INTEGER) AS year, count(*) AS geo_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL)
SELECT m.agency, m.month, m.year, m.n_orders, y.officers, mp.geo, mp.kind, g.geo_orders
FROM monthly m
LEFT JOIN yearly y ON m.agency = y.agency AND m.year = y.year
LEFT JOIN mapping mp ON m.agency = mp.agency
LEFT JOIN geo_yearly g ON mp.geo = g.geo AND m.year = g.year"""


def _county_year(where: str = "") -> str:
    return f"""(
  SELECT n.n_name AS county, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         count(*) AS population, {mean_cents('o.o_totalprice')} AS income
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  {where} GROUP BY ALL)"""


ORACLE["suffix_join"] = f"""
SELECT a.county, a.year, a.population AS population_acs1, a.income AS income_acs1,
       b.population AS population_acs5, b.income AS income_acs5
FROM {_county_year()} a LEFT JOIN {_county_year("WHERE o.o_orderstatus = 'F'")} b
  ON a.county = b.county AND a.year = b.year"""

ORACLE["scalar_offset"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) AS INTEGER) AS periods
FROM orders"""

ORACLE["two_level_population"] = f"""
WITH {PANEL_CTE},
lvl1 AS (SELECT year, county, max(population) AS population, sum(urgent) AS homicides FROM panel GROUP BY ALL)
SELECT make_date(year, 1, 1) AS month, CAST(sum(homicides) AS BIGINT) AS homicides,
       CAST(sum(population) AS BIGINT) AS population, 'Yearly' AS type
FROM lvl1 GROUP BY year"""

ORACLE["panel_window_distinct"] = f"""
WITH {MONTHLY_CTE},
rows AS (
  SELECT n.n_name AS county, m.year, {", ".join(f"m.{c}" for c in TYPE_COLS)}, c.c_acctbal
  FROM monthly m LEFT JOIN customer c ON m.agency = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
win AS (
  SELECT DISTINCT county, year,
    {", ".join(f"CAST(sum({c}) OVER (PARTITION BY county, year) AS BIGINT) AS {c}" for c in TYPE_COLS)},
    CAST(sum(CAST(round(c_acctbal * 100) AS HUGEINT)) OVER (PARTITION BY county, year) AS DOUBLE)
      / nullif(count(c_acctbal) OVER (PARTITION BY county, year) * 100.0, 0) AS officers
  FROM rows),
pop AS (
  SELECT n.n_name AS county, count(*) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name)
SELECT w.*, p.population, {TOTAL} / p.population AS crime_rate, urgent / p.population AS homicide_rate
FROM win w LEFT JOIN pop p USING (county)"""

ORACLE["count_per_key_filter"] = """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(*) OVER (PARTITION BY o_custkey, o_orderpriority, year(o_orderdate)) AS n
FROM orders
QUALIFY n > 1"""

ORACLE["dedup_keep_first"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                           ORDER BY o_orderdate, o_orderkey) = 1"""

_W5 = "OVER (PARTITION BY county ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
ORACLE["rolling5_complete"] = f"""
WITH {PANEL_CTE},
rolled AS (
  SELECT county, year, population,
    {", ".join(f"CASE WHEN count({c}) {_W5} = 5 THEN avg({c}) {_W5} END AS {c}" for c in TYPE_COLS)}
  FROM panel)
SELECT county, year, {", ".join(TYPE_COLS)}, population,
       {TOTAL} / population AS crime_rate, urgent / population AS homicide_rate
FROM rolled"""

ORACLE["lag_rate"] = f"""
WITH {PANEL_CTE}
SELECT county, year, crime_rate, lag(crime_rate, 1) OVER (PARTITION BY county ORDER BY year) AS crime_rate_lag1
FROM panel"""

_BACK = "OVER (PARTITION BY county ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FWD = "OVER (PARTITION BY county ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
ORACLE["interpolate_gaps"] = f"""
WITH {PANEL_CTE},
g AS (SELECT county, year, CASE WHEN year NOT IN (1995, 1996, 2000) THEN officers END AS officers_gap FROM panel),
nb AS (
  SELECT *,
    last_value(CASE WHEN officers_gap IS NOT NULL THEN CAST(year AS DOUBLE) END IGNORE NULLS) {_BACK} AS px,
    last_value(officers_gap IGNORE NULLS) {_BACK} AS pv,
    first_value(CASE WHEN officers_gap IS NOT NULL THEN CAST(year AS DOUBLE) END IGNORE NULLS) {_FWD} AS qx,
    first_value(officers_gap IGNORE NULLS) {_FWD} AS qv
  FROM g)
SELECT county, year, officers_gap,
       coalesce(officers_gap, pv + (qv - pv) * ((CAST(year AS DOUBLE) - px) / nullif(qx - px, 0))) AS officers_interp
FROM nb"""

ORACLE["scale_factor_series"] = f"""
WITH {PANEL_CTE},
y AS (SELECT year, CAST(sum(population) AS BIGINT) AS population, sum({TOTAL}) AS total FROM panel GROUP BY year),
y2 AS (SELECT year, population, total / population AS crime_rate FROM y),
s AS (SELECT max(crime_rate) / max(population) AS scale_factor FROM y2)
SELECT year, population, crime_rate, scale_factor, crime_rate / scale_factor AS crime_rate_scaled
FROM y2, s"""

_DIFF_COLS = ["crime_rate", "officers"] + TYPE_COLS
ORACLE["regime_diff"] = f"""
WITH {PANEL_CTE},
p AS (SELECT county, CASE WHEN year >= 1998 THEN 1 ELSE 0 END AS post,
  {", ".join(f"list_sum(list(CAST({c} AS DOUBLE) ORDER BY year)) / count(*) AS {c}" for c in _DIFF_COLS)}
  FROM panel GROUP BY ALL)
SELECT county,
  {", ".join(f"round(max(CASE WHEN post = 1 THEN {c} END) - max(CASE WHEN post = 0 THEN {c} END), 8) AS {c}_diff" for c in _DIFF_COLS)}
FROM p GROUP BY county
HAVING count(*) FILTER (WHERE post = 1) = 1 AND count(*) FILTER (WHERE post = 0) = 1"""

ORACLE["group_row_ranges"] = f"""
WITH {PANEL_CTE},
n AS (SELECT county, row_number() OVER (ORDER BY county, year) AS rn FROM panel)
SELECT county, min(rn) AS first_row, max(rn) AS last_row FROM n GROUP BY county"""

ORACLE["union_missing_columns"] = f"""
WITH {PANEL_CTE}
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders, 'Monthly' AS type
FROM orders GROUP BY 1
UNION ALL BY NAME
SELECT make_date(year, 1, 1) AS month, CAST(sum({TOTAL}) AS BIGINT) AS n_orders,
       CAST(sum(population) AS BIGINT) AS population, 'Yearly' AS type
FROM panel GROUP BY year"""

ORACLE["derived_measures"] = f"""
WITH {PANEL_CTE}
SELECT county, year,
  urgent / nullif({TOTAL}, 0) * 100.0 AS pct_urgent,
  (urgent + high) / nullif({TOTAL}, 0) * 100.0 AS pct_high_or_greater,
  (medium + not_specified + low) / nullif({TOTAL}, 0) * 100.0 AS pct_routine,
  {TOTAL} / population AS orders_per_customer,
  round(CASE WHEN officers > 0 THEN ln(officers) END, 9) AS log_officers,
  round(sqrt(urgent), 9) AS sqrt_urgent,
  round(log10(population), 9) AS log10_population,
  pow(urgent, 2) AS urgent_sq
FROM panel"""

_KEY = "l_orderkey, l_linenumber, l_partkey"
_MEAS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_POST = "CASE WHEN year(l_shipdate) >= 1998 THEN 1 ELSE 0 END"

ORACLE["unpivot_measures"] = f"""
SELECT {_KEY}, variable, value
FROM (UNPIVOT (SELECT {_KEY}, {", ".join(_MEAS)} FROM lineitem)
      ON {", ".join(_MEAS)} INTO NAME variable VALUE value)"""

ORACLE["multi_value_pivot"] = "\nUNION ALL\n".join(f"""
SELECT '{m}' AS variable,
  {mean_cents(f"CASE WHEN {_POST} = 0 THEN {m} END")} AS mean_pre,
  {mean_cents(f"CASE WHEN {_POST} = 1 THEN {m} END")} AS mean_post,
  round(stddev_samp({m}) FILTER (WHERE {_POST} = 0), 5) AS sd_pre,
  round(stddev_samp({m}) FILTER (WHERE {_POST} = 1), 5) AS sd_post
FROM lineitem""" for m in _MEAS)

ORACLE["event_code_lookup"] = """
SELECT event_id, event_type, value, d.event_label
FROM events NATURAL LEFT JOIN (VALUES ('view', 'Page view'), ('click', 'Click'),
  ('purchase', 'Purchase'), ('signup', 'Sign-up')) d(event_type, event_label)"""

ORACLE["path_key_split"] = r"""
SELECT page_id,
  regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
  regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host,
  string_split_regex(regexp_replace(url, '^(?:[a-z]+://)', ''), '[/._]')[2] AS piece2,
  upper(split_part(regexp_replace(url, '^(?:[a-z]+://)', ''), '/', 2)) AS lang,
  regexp_extract(url, '/([0-9]+)', 1) AS page_key,
  CAST(regexp_matches(url, '\?') AS INTEGER) AS has_query
FROM pages"""

ORACLE["month_label_parse"] = """
WITH g AS (SELECT strftime(o_orderdate, '%m-%Y') AS label, count(*) AS n_orders FROM orders GROUP BY 1),
p AS (SELECT *, CAST(strptime(label, '%m-%Y') AS DATE) AS month FROM g)
SELECT label, n_orders, month, CAST(year(month) AS INTEGER) AS year,
       make_date(CAST(year(month) AS INTEGER), 1, 1) AS year_start,
       CASE WHEN regexp_matches(label, '^0[1-6]-') THEN 1 ELSE 0 END AS first_half,
       CAST(substr(label, 1, 2) AS INTEGER) AS mm, 'm' || label AS header
FROM p"""

ORACLE["zero_to_null_and_back"] = f"""
SELECT {_KEY}, nullif(l_discount, 0) AS disc_na, nullif(l_tax, 0) AS tax_na,
       coalesce(nullif(l_discount, 0), 0.0) AS disc_filled
FROM lineitem WHERE nullif(l_tax, 0) IS NOT NULL"""

ORACLE["ratio_of_sums"] = f"""
WITH g AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, sum(l_quantity) AS sum_qty,
    {sum_cents('l_extendedprice')} AS sum_price,
    CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(round(l_discount * 100) AS HUGEINT)) AS DOUBLE)
      / 10000.0 AS sum_disc_amount,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY 1)
SELECT year, n, sum_qty, sum_price, sum_disc_amount, sum_price / sum_qty AS price_per_qty,
       n_returned / n AS return_rate
FROM g"""

ORACLE["range_except"] = """
SELECT * FROM (
  SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS hour
  FROM events)
EXCEPT
SELECT date_trunc('hour', ts) AS hour FROM events WHERE event_type = 'error'"""

ORACLE["complete_case_counts"] = f"""
SELECT {_POST} AS post, count(*) AS n_total,
  count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL
                   AND nullif(l_discount, 0) IS NOT NULL AND nullif(l_tax, 0) IS NOT NULL) AS n_complete,
  count(*) FILTER (WHERE nullif(l_discount, 0) IS NULL) AS n_disc_missing,
  count(*) FILTER (WHERE nullif(l_tax, 0) IS NULL) AS n_tax_missing
FROM lineitem GROUP BY 1"""

ORACLE["null_key_totals"] = """
SELECT o_orderkey, agency, status, n FROM (
  SELECT *, count(*) OVER (PARTITION BY agency, status) AS n FROM (
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS agency,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders))
WHERE n > 1"""
