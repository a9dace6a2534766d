"""The reference's three entry points, on landing files (section 3 of the survey).

Entry 1  crime ingest      landing CSVs -> crime_data            (sources.landing)
Entry 2  census + merge    extracts -> mapping/acs tables -> merged crime table
                           -> one shared yearly rollup -> map / acs1 / acs5 panels
Entry 3  analysis          tests and models on the panels and the merged table

Plan notes: stages are written once and read back, the yearly rollup is
checkpointed for the three branches that read it; dimension tables (mapping, survey panels, attributes)
are joined without hints so AQE picks broadcast joins from measured sizes;
windows are partitioned by county (a county's years, never the table).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dist, geo
from ..functions.expr import flag, flag_in, year_start
from ..operators import kde as K
from ..operators import linmodel as L
from ..operators import panel as ops
from ..operators import stats as S
from ..operators.joins import natural_join, scalar, suffix_join
from ..sources import census as C
from ..sources import landing as LD
from ..session import cut_lineage
from ..sources.sinks import StageStore, source_version

TYPES = LD.CRIME_TYPES
POST_YEAR = 2020

# County name lists behind the 0/1 indicators.
TOP_CITY_COUNTIES = ["RAMSEY", "HENNEPIN", "OLMSTED", "ST. LOUIS", "STEARNS"]
RESERVATION_COUNTIES = ["ITASCA", "KOOCHICHING", "ST. LOUIS", "CARLTON", "COOK",
                        "BELTRAMI", "CASS", "HUBBARD", "REDWOOD", "MILLE LACS",
                        "GOODHUE", "SCOTT", "YELLOW MEDICINE", "BECKER", "CLEARWATER", "MAHNOMEN",
                        "LAKE OF THE WOODS", "MARSHALL", "PENNINGTON", "POLK", "RED LAKE"]
MSP_COUNTIES = ["RAMSEY", "HENNEPIN"]


@dataclass
class CensusTables:
    mapping: DataFrame      # ori, GEOID, county, type, area_m2, attributes...
    acs1: DataFrame         # GEOID, year, survey variables (decennial year appended)
    acs5: DataFrame         # GEOID, year, survey variables
    geometry: DataFrame     # GEOID, geometry (ring vertices)


def census_tables(spark: SparkSession, census_dir: str) -> CensusTables:
    """Entry 2, first half: survey panels, mapping with area and attributes."""
    d = census_dir.rstrip("/")
    acs5 = C.survey_wide(C.survey_long(spark, f"{d}/acs5"))
    acs1 = C.survey_wide(C.survey_long(spark, f"{d}/acs1"))
    dec = C.survey_wide(C.decennial_long(spark, f"{d}/decennial"), C.DECENNIAL_VARIABLES)
    acs1 = C.acs1_with_decennial(acs1, dec)
    mapping = C.county_mapping(spark, f"{d}/mapping")
    area = C.county_area(spark, f"{d}/rings")                  # geometry dropped: area only
    attrs = C.county_attributes(spark, f"{d}/attributes")
    mapping = natural_join(natural_join(mapping, area), attrs)  # J5 twice
    return CensusTables(mapping, acs1, acs5, C.county_geometry(spark, f"{d}/rings"))


def merge(crime: DataFrame, ct: CensusTables, dedup_order: Sequence[str] = ("ori", "GEOID"),
          zero_fill: bool = True) -> DataFrame:
    """Merged monthly table: zero-fill, mapping fan-out, both surveys with
    suffixes, dedup per (series, month) in an explicit order (quirk Q4)."""
    c = crime.fillna(0, subset=TYPES) if zero_fill else crime          # F6 (Q1)
    # Mapping and survey panels are dimensions: adaptive execution broadcasts
    # them by their measured bytes, and splits a county that holds a third of
    # the monthly rows where they are too large for that.
    c = c.join(ct.mapping, "ori", "left")                               # J2
    c = c.join(ct.acs1, ["GEOID", "year"], "left")                      # J3
    c = suffix_join(c, ct.acs5, ["GEOID", "year"], "left", ("_acs1", "_acs5"))  # J4
    c = ops.dedup_keep_first(c, ["series", "month"], list(dedup_order))  # A8
    return c.dropna(subset=["homicides"])                               # F7 (Q3)


def yearly_rollup(merged: DataFrame) -> DataFrame:
    """A4 (quirk Q11): county x year sums and mean officers; every other
    column depends on (county, year) and passes through."""
    drop = {"series", "month", "ori", "type", "county", "year", "officers", *TYPES}
    constants = [c for c in merged.columns if c not in drop]
    return ops.rollup(merged, ["county", "year"], sums=TYPES, means=["officers"], constants=constants)


def _rates(df: DataFrame, pop: str) -> DataFrame:
    total = sum((F.col(t) for t in TYPES[1:]), F.col(TYPES[0]))
    return df.withColumns({"crime_rate": F.try_divide(total, F.col(pop)),
                           "homicide_rate": F.try_divide(F.col("homicides"), F.col(pop))})


def derived(df: DataFrame, s: str) -> DataFrame:
    """Derived census measures for one survey suffix."""
    c = lambda n: F.col(n + s)
    pct = lambda num, den: F.try_divide(num, den) * F.lit(100.0)
    # The levels that count as high school or more, and the
    # family situations that count as a missing parent.
    edu = [c(n) for n in ("edu_hs_grad", "edu_some_college_lt1yr", "edu_some_college_gt1yr",
                          "edu_assoc_degree", "edu_bachelors", "edu_masters",
                          "edu_professional_degree", "edu_doctorate")]
    kids = [c(n) for n in ("children_w_mother_only", "children_w_father_only", "children_no_parents")]
    return df.withColumns({
        "pct_lessthan_5kincome": pct(c("households_income_lt5k"), c("households_total")),
        "pct_highschool_or_greater": pct(sum(edu[1:], edu[0]), c("edu_total_25plus")),
        "pct_children_missing_parents": pct(sum(kids[1:], kids[0]), c("children_total")),
        "pct_non_white": (F.lit(1.0) - F.try_divide(c("white_population"), c("total_population"))) * 100.0,
        "pct_young_males": pct(c("male_15_19") + c("male_20_24"), c("total_population")),
        "persons_per_household": F.try_divide(c("total_population"), c("households_total")),
        "persons_per_m2": F.try_divide(c("total_population"), F.col("area_m2")),
    })


def map_yearly(rolled: DataFrame, geometry: DataFrame) -> DataFrame:
    """Map branch: 5-year complete rolling means, rates on acs5 population,
    flags, and each county's rings (G3)."""
    r = ops.rolling_complete(rolled, "county", "year", TYPES, n=5)
    r = _rates(r, "total_population_acs5")
    r = r.withColumns({"top_cities": flag_in("county", TOP_CITY_COUNTIES),
                       "reservations": flag_in("county", RESERVATION_COUNTIES)})
    return r.join(geometry, "GEOID", "left")


def acs1_yearly(rolled: DataFrame, acs1: DataFrame, interpolate: Sequence[str] = (),
                exclude_counties: Sequence[str] = ("CLAY",)) -> DataFrame:
    """1-year branch: optional interior interpolation (quirk Q2, opt-in),
    rates, lagged rate, derived measures, periods since the first survey year."""
    r = rolled
    if interpolate:
        r = ops.interpolate_linear(r, "county", "year", list(interpolate))
    r = _rates(r, "total_population_acs1")
    r = ops.lag_within(r, "county", "year", ["crime_rate"])
    r = derived(r, "_acs1")
    first_year = scalar(acs1.select(F.min("year")))                     # J6
    r = r.withColumns({"periods": F.col("year") - first_year,
                       "post_covid": flag(F.col("year") >= POST_YEAR),
                       "msp_main_counties": flag_in("county", MSP_COUNTIES)})
    if exclude_counties:
        r = r.filter(~F.col("county").isin(list(exclude_counties)))    # Q12
    r = r.dropna(subset=["total_population_acs1"])
    return r.drop(*[c for c in r.columns if c.endswith("_acs5")])


def acs5_yearly(rolled: DataFrame) -> DataFrame:
    """5-year branch: rolling means, rates, derived measures, flags."""
    r = ops.rolling_complete(rolled, "county", "year", TYPES, n=5)
    r = _rates(r, "total_population_acs5")
    r = derived(r, "_acs5")
    r = r.withColumns({"post_covid": flag(F.col("year") >= POST_YEAR),
                       "top_cities": flag_in("county", TOP_CITY_COUNTIES),
                       "reservations": flag_in("county", RESERVATION_COUNTIES)})
    r = r.dropna(subset=["total_population_acs5"])
    return r.drop(*[c for c in r.columns if c.endswith("_acs1")])


def run_merge(spark: SparkSession, landing_dir: str, census_dir: str, out_dir: str,
              interpolate: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Entries 1 and 2 end to end: nine parquet stages below ``out_dir``.

    Every stage is written once and later steps read it back: the landing files
    are parsed once, and the yearly rollup reads the merged stage.  A stage that
    is there for the same inputs is not made again (``sources.sinks``).  Monthly
    and yearly stages are partitioned by year, so year filters prune files.
    """
    store = StageStore(spark, out_dir)
    landed, surveyed = source_version(spark, landing_dir), source_version(spark, census_dir)
    ct = census_tables(spark, census_dir)

    def stage(name, make, made_from, by_year=True):
        known = [store.versions.get(x, x) for x in made_from]
        return store.stage(name, make, known, ["year"] if by_year else None)

    names = lambda: spark.createDataFrame(C.SURVEY_VARIABLES, "name string, code string")
    out = {"crime_data": stage("crime_data", lambda: LD.crime_data(spark, landing_dir), [landed]),
           "vars": stage("vars", names, [], by_year=False),
           "mapping": stage("mapping", lambda: ct.mapping, [surveyed], by_year=False),
           "acs_1yr_ts": stage("acs_1yr_ts", lambda: ct.acs1, [surveyed]), "acs_5yr_ts": stage("acs_5yr_ts", lambda: ct.acs5, [surveyed])}
    known = CensusTables(out["mapping"], out["acs_1yr_ts"], out["acs_5yr_ts"], ct.geometry)
    merged = out["crime_data_merged"] = stage("crime_data_merged", lambda: merge(out["crime_data"], known),
                                              ["crime_data", "mapping", "acs_1yr_ts", "acs_5yr_ts"])

    @cache
    def rolled():                                          # a row per county and year, read by three branches
        return cut_lineage(yearly_rollup(merged))

    out["mapping_yearly_data"] = stage("mapping_yearly_data", lambda: map_yearly(rolled(), known.geometry), ["crime_data_merged", surveyed])
    out["acs_1_yearly_data"] = stage("acs_1_yearly_data", lambda: acs1_yearly(rolled(), known.acs1, interpolate),
                                     ["crime_data_merged", "acs_1yr_ts", *interpolate])
    out["acs_5_yearly_data"] = stage("acs_5_yearly_data", lambda: acs5_yearly(rolled()), ["crime_data_merged"])
    return out


# ---- Entry 3: analysis on the 5-year panel

# Fixed value: the year of the map.
MAP_YEAR = 2023

# The variables of the models, the descriptive tables and the
# difference model, in the order of their tables.
MODEL_VARS = ["log_officers", "median_household_income_acs5", "pct_highschool_or_greater",
              "log_pct_non_white", "log_persons_per_m2", "reservations", "top_cities"]
DESCRIBE_VARS = ["crime_rate", "officers", "median_household_income_acs5", "pct_lessthan_5kincome",
                 "pct_highschool_or_greater", "pct_children_missing_parents", "pct_non_white",
                 "Binge drinking prevalence", "pct_young_males", "persons_per_household", "persons_per_m2"]
DIFF_VARS = ["crime_rate", "log_officers", "median_household_income_acs5", "pct_lessthan_5kincome",
             "pct_highschool_or_greater", "log_pct_non_white", "log_persons_per_m2"]


def with_logs(acs5: DataFrame) -> DataFrame:
    """Log transforms (E10); the crime-rate log is log(crime_rate) (quirk Q5)."""
    return acs5.withColumns({"log_pct_non_white": F.ln("pct_non_white"),
                             "log_persons_per_m2": F.ln("persons_per_m2"),
                             "log_officers": F.ln("officers"),
                             "log_crime_rate": F.ln("crime_rate")})


def map_table(mapping_yearly: DataFrame, year: int = MAP_YEAR) -> DataFrame:
    """The map of one year: population, rates and flags of each county, and the
    centroid of those flagged as top cities (F1, G2)."""
    d = mapping_yearly.filter(F.col("year") == year)
    rings = d.filter("top_cities = 1").select("GEOID", F.explode("geometry").alias("v")).select("GEOID", "v.*")
    return (d.select("GEOID", "county", "year", "total_population_acs5", "crime_rate", "homicide_rate", "reservations", "top_cities")
            .join(geo.polygon_centroid(rings, "GEOID"), "GEOID", "left"))


def time_series(merged: DataFrame) -> DataFrame:
    """Monthly and yearly homicides (A1/A2/U2): the yearly rows count each
    county's population once."""
    monthly = merged.groupBy("month").agg(F.sum("homicides").alias("homicides")).withColumn("type", F.lit("Monthly"))
    county = merged.groupBy("year", "county").agg(F.max("total_population_acs1").alias("population"),
                                                  F.sum("homicides").alias("homicides"))
    yearly = (county.groupBy("year").agg(F.sum("population").alias("population"), F.sum("homicides").alias("homicides"))
              .select(year_start("year").alias("month"), "homicides", "population", F.lit("Yearly").alias("type")))
    return monthly.unionByName(yearly, allowMissingColumns=True)


def yearly_rates(acs1: DataFrame) -> DataFrame:
    """Yearly population, totals and rates of the 1-year panel (A3) with the
    scale factor between the two series (A9); one row per year."""
    y = acs1.groupBy("year").agg(F.sum("total_population_acs1").alias("population"), *[F.sum(t).alias(t) for t in TYPES])
    y = _rates(y, "population").withColumnRenamed("homicide_rate", "homicides_pc")
    whole = Window.partitionBy()
    factor = F.try_divide(F.max("crime_rate").over(whole), F.max("population").over(whole))
    return (y.withColumn("scale_factor", factor)
            .withColumn("crime_rate_scaled", F.try_divide(F.col("crime_rate"), F.col("scale_factor"))))


def _by_p(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("p_value").asc_nulls_last(), "variable")


def _numbers(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-made table of a few model numbers."""
    plain = [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows]
    return spark.createDataFrame(plain, schema)


def analysis(acs5: DataFrame, acs1: DataFrame, merged: DataFrame, mapping_yearly: DataFrame | None = None) -> dict[str, DataFrame]:
    """Entry 3: every table, test and model of the notebook, on the 5-year
    panel, the 1-year panel, the merged monthly table and, for the map, the
    mapping panel."""
    spark = acs5.sparkSession
    d = with_logs(acs5).withColumn("post_covid", F.col("post_covid").cast("int"))
    needed = {*DESCRIBE_VARS, *MODEL_VARS, *DIFF_VARS, "county", "year"}
    if missing := sorted(needed - set(d.columns)):
        raise ValueError(f"the 5-year panel lacks {missing}")
    res: dict[str, DataFrame] = {"time_series": time_series(merged), "yearly_rates": yearly_rates(acs1)}

    welch = S.welch_t(d, "post_covid", DESCRIBE_VARS)
    res["welch"] = welch
    res["descriptive"] = _by_p(welch.select(
        "variable", F.col("m0").alias("mean_pre"), F.col("m1").alias("mean_post"),
        F.sqrt("v0").alias("sd_pre"), F.sqrt("v1").alias("sd_post"), "p_value"))
    others = [c for c in DESCRIBE_VARS if c != "crime_rate"]
    res["pearson"] = _by_p(S.pearson_tests(d, "crime_rate", others))
    res["facets"] = L.facet_lines(d, "crime_rate", MODEL_VARS)
    if mapping_yearly is not None:
        res["map"] = map_table(mapping_yearly)

    specs = {"Pre-COVID": ("crime_rate", MODEL_VARS, F.col("post_covid") == 0),
             "Post-COVID": ("crime_rate", MODEL_VARS, F.col("post_covid") == 1),
             "Full Model": ("crime_rate", MODEL_VARS + ["post_covid"], None)}
    fits = L.fit_many(d, specs)
    rows = []
    for i, (m, f) in enumerate(fits.items()):
        robust = {r["term"]: r for r in f.tidy(robust=True)}
        rows += [(i, m, r["term"], r["estimate"], r["std_error"], robust[r["term"]]["std_error"],
                  robust[r["term"]]["p_value"]) for r in f.tidy()]
    models = _numbers(spark, rows, "position int, model string, term string, estimate double, "
                                   "std_error_normal double, std_error_robust double, p_value double")
    res["models"] = models.select("model", "term", "estimate", *[
        F.round(c, 3).alias(c) for c in ("std_error_normal", "std_error_robust", "p_value")])
    ranges = ops.group_row_ranges(models, "position")
    res["model_rows"] = ranges.join(models.select("position", "model").distinct(), "position").select("model", "first_row", "last_row")
    metrics = _numbers(spark, [(m, f.r2(), f.adj_r2(), f.rmse()) for m, f in fits.items()], "model string, r2 double, adj_r2 double, rmse double")
    res["metrics"] = metrics.select("model", *[F.round(c, 3).alias(c) for c in ("r2", "adj_r2", "rmse")])
    parts = [L.complete_cases(d if cond is None else d.filter(cond), [y, *xs]).select(
        F.lit(m).alias("model"), "county", "year", fits[m].fitted_col().alias("fitted"), fits[m].resid_col().alias("resid"))
        for m, (y, xs, cond) in specs.items()]
    res["residuals"] = parts[0].unionByName(parts[1]).unionByName(parts[2])

    res["chow"] = L.chow_test(d, "crime_rate", MODEL_VARS, "post_covid")
    order = ["post_covid", "county", "year"]
    res["cusum"] = L.cusum_process(d, fits["Full Model"], order)
    sup = L.cusum_sup(d, fits["Full Model"], order)
    res["cusum_test"] = _numbers(spark, [(float(sup), float(dist.bridge_sup_sf(sup)))], "statistic double, p_value double")
    res["boxcox"] = L.boxcox_profile(d, "crime_rate", MODEL_VARS + ["post_covid"])
    res["variance_f"] = S.variance_f_test(d, F.sqrt("crime_rate"), "post_covid")
    res["levene"] = S.levene_median(d, F.sqrt("crime_rate"), "post_covid")
    res["density"] = K.kde(acs1, "crime_rate")

    diff = ops.regime_diff(d, "county", "post_covid", DIFF_VARS)
    fit = L.ols(diff, "crime_rate_diff", [f"{c}_diff" for c in DIFF_VARS[1:]])
    res["diff_model"] = _numbers(spark, [("Differenced Model", r["term"], r["estimate"], r["std_error"], r["p_value"]) for r in fit.tidy()],
                                 "model string, term string, estimate double, std_error double, p_value double").select(
        "model", "term", "estimate", F.round("std_error", 3).alias("std_error"), F.round("p_value", 3).alias("p_value"))
    return res
