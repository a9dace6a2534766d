import os

import pytest
from pyspark.sql import functions as F

from paneltide.plans import stages as PL
from paneltide.sources import census as C
from paneltide.sources import landing as LD

from .fixture_files import AGENCIES, MONTHS, write_census, write_landing


def test_crime_ingest_shapes(spark, scratch):
    land = os.path.join(scratch, "landing")
    info = write_landing(land)
    first = LD.agency_rows(LD.crime_files(spark.read, land))      # junk trailer and Clearances dropped
    assert first.count() == info["crime_files"]
    long = LD.crime_long(spark, land, validate=True)
    assert long.count() == info["crime_files"] * len(MONTHS)
    assert long.filter(F.col("month").isNull()).count() == 0
    wide = LD.crime_by_type(long, validate=True)
    assert wide.count() == len(AGENCIES) * len(MONTHS)
    lam = wide.filter(F.col("ori") == "MN0640400").select("assaults", "arson").collect()
    assert all(r.assaults is None for r in lam)             # absent type -> NULL column


def _write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_each_file_keeps_its_own_header(spark, scratch):
    land = os.path.join(scratch, "landing")
    _write(land, "A1_arson.csv", 'series,"01-2020","02-2020"', "Alpha,1,3.0", "Alpha Clearances,9,9")
    _write(land, "B2_arson.csv", "\ufeffseries,02-2020,03-2020", '"Beta, north",5,', "Beta Clearances,9,9")
    years = [str(y) for y in range(1985, 2026)]
    _write(land, "A1_officers.csv", "series," + ",".join(years), "Officers per 1000 People," + ",".join(["1.5"] * len(years)))
    got = {(r.ori, str(r.month), r.series): r["count"] for r in LD.crime_long(spark, land).collect()}
    assert got == {("A1", "2020-01-01", "Alpha"): 1, ("A1", "2020-02-01", "Alpha"): 3,
                   ("B2", "2020-02-01", "Beta, north"): 5, ("B2", "2020-03-01", "Beta, north"): None}
    assert LD.officers_long(spark, land).count() == len(years)


def test_rejected_cells_are_listed(spark, scratch):
    """Columns that are no month, texts that are no count and long quoted cells."""
    land = os.path.join(scratch, "landing")
    note = "said, \"so\" " * 700
    _write(land, "A1_arson.csv", "series,01-2020,02-2020,notes,13-2020", "Alpha,1,n/a,9,4", "Alpha Clearances,9,9,9,9")
    _write(land, "B2_arson.csv", 'series,remark,01-2020', 'Beta,"' + note.replace('"', '""') + '",2', "_type,,")
    _write(land, "C3_arson.csv", "series,01-2020", "Gamma,,", "Delta,8")
    got = {(r.ori, str(r.month)): r["count"] for r in LD.crime_long(spark, land, validate=False).collect()}
    assert got == {("A1", "2020-01-01"): 1, ("A1", "2020-02-01"): None, ("B2", "2020-01-01"): 2, ("C3", "2020-01-01"): None}
    rejects = {(r.file, r.reason, r.label, r.text) for r in LD.crime_rejects(spark, land).collect()}
    assert rejects == {("A1_arson.csv", "count", "02-2020", "n/a"), ("A1_arson.csv", "column", "notes", "9"), ("A1_arson.csv", "column", "13-2020", "4"),
                       ("B2_arson.csv", "column", "remark", note.strip()), ("C3_arson.csv", "agency rows", None, "2")}
    _write(land, "D4_arson.csv", "series,01-2020", "Wide" + ",1" * (LD.MAX_CELLS + 1))
    with pytest.raises(Exception, match="cells"):
        LD.crime_long(spark, land, validate=False).collect()


def test_rollup_fails_where_a_county_has_two_geoids(spark):
    cols = "series string, month date, ori string, type string, county string, year int, GEOID string, total_population_acs5 int, officers double, "
    df = spark.createDataFrame([("s", None, "o1", "t", "AITKIN", 2020, "27001", 10, 1.0, *([1] * 8)),
                                ("s", None, "o2", "t", "AITKIN", 2020, "27002", 99, 1.0, *([1] * 8))], cols + ", ".join(f"{t} int" for t in PL.TYPES))
    with pytest.raises(Exception, match="several values of"):
        PL.yearly_rollup(df).collect()
    assert PL.yearly_rollup(df.filter("GEOID = '27001'")).first().homicides == 1


@pytest.mark.parametrize("rows", [["Alpha Clearances,9"], [], ["Alpha,1", "Beta,2"]])
def test_file_without_exactly_one_agency_row_fails(spark, scratch, rows):
    land = os.path.join(scratch, "landing")
    _write(land, "A1_arson.csv", "series,01-2020", "Alpha,1")
    _write(land, "B2_arson.csv", "series,01-2020", *rows)
    with pytest.raises(Exception, match="B2_arson.csv has"):
        LD.crime_long(spark, land).collect()
    assert LD.crime_long(spark, land, validate=False).count() == (1 if len(rows) < 2 else 2)


def test_extract_columns_by_name(spark, scratch):
    _write(os.path.join(scratch, "x"), "part.csv", "year,estimate,GEOID,variable", "2020,7.5,27001,B01003_001", "2021,?,27001,B01003_001")
    got = C.survey_long(spark, os.path.join(scratch, "x")).orderBy("year").collect()
    assert [tuple(r) for r in got] == [("27001", "B01003_001", 7.5, 2020), ("27001", "B01003_001", None, 2021)]
    _write(os.path.join(scratch, "y"), "part.csv", "year,GEOID,variable", "2020,27001,B01003_001")
    with pytest.raises(ValueError, match="estimate"):
        C.survey_long(spark, os.path.join(scratch, "y"))


def test_officers_zero_and_blank_are_missing(spark, scratch):
    land = os.path.join(scratch, "landing")
    write_landing(land)
    off = LD.officers_long(spark, land)
    blank = off.filter(F.col("ori") == "MN0601300")
    assert blank.count() == 12 and blank.filter(F.col("officers").isNotNull()).count() == 0
    assert off.filter(F.col("officers") == 0).count() == 0
    assert off.filter((F.col("ori") == "MN0010000") & (F.col("year") == 2016)).first().officers is None


def test_census_tables(spark, scratch):
    cen = os.path.join(scratch, "census")
    write_census(cen)
    ct = PL.census_tables(spark, cen)
    acs1 = ct.acs1
    assert "total_population" in acs1.columns and "edu_doctorate" in acs1.columns
    y2020 = acs1.filter(F.col("year") == 2020)
    assert y2020.filter(F.col("white_population").isNotNull()).count() == 0   # decennial: population only
    assert acs1.filter(F.col("GEOID") == "27127").count() == 0               # seen once -> dropped
    m = ct.mapping.collect()
    assert all(r.area_m2 > 1e8 for r in m) and all(r["Binge drinking prevalence"] is not None for r in m)


def test_merge_and_yearly_branches(spark, scratch):
    land, cen = os.path.join(scratch, "landing"), os.path.join(scratch, "census")
    write_landing(land)
    write_census(cen)
    out = PL.run_merge(spark, land, cen, out_dir=os.path.join(scratch, "stages"),
                       interpolate=["total_population_acs1"])
    merged = out["crime_data_merged"]
    # Two agencies share the series "Alden": dedup on (series, month) keeps one (quirk Q4).
    alden = merged.filter(F.col("series") == "Alden")
    assert alden.count() == len(MONTHS) and {r.ori for r in alden.select("ori").distinct().collect()} == {"MN0240000"}
    assert merged.filter(F.col("homicides").isNull()).count() == 0
    acs5 = out["acs_5_yearly_data"]
    assert {r.year for r in acs5.select("year").distinct().collect()} <= {2018, 2023}
    assert not [c for c in acs5.columns if c.endswith("_acs1")]
    acs1 = out["acs_1_yearly_data"]
    assert acs1.filter(F.col("county") == "CLAY").count() == 0
    assert "crime_rate_lag1" in acs1.columns and "periods" in acs1.columns
    mp = out["mapping_yearly_data"].filter(F.col("county") == "RAMSEY").orderBy("year").collect()
    assert mp[0].homicides is None and mp[4].homicides is not None      # rolling mean NULL until 5 years
    assert all(r.top_cities == 1 and len(r.geometry) == 4 for r in mp)
    assert os.path.exists(os.path.join(scratch, "stages", "acs_5_yearly_data"))


PANEL = ("county string, year int, post_covid int, crime_rate double, officers double, "
         "median_household_income_acs5 double, pct_lessthan_5kincome double, pct_highschool_or_greater double, "
         "pct_children_missing_parents double, pct_non_white double, `Binge drinking prevalence` double, "
         "pct_young_males double, persons_per_household double, persons_per_m2 double, reservations int, "
         "top_cities int")


def panel_tables(spark, seed=4, n=80):
    """5-year panel, 1-year panel and merged monthly table (n counties)."""
    import datetime as dt
    import numpy as np
    rng = np.random.default_rng(seed)
    rows, yearly, monthly = [], [], []
    for i in range(n):
        base = rng.uniform(0.01, 0.05)
        for year in (2018, 2023):
            post = int(year >= 2020)
            rows.append((f"C{i:02d}", year, post, float(base * (1.2 if post else 1.0) + rng.uniform(0, 0.003)),
                         float(rng.uniform(1, 4)), float(rng.uniform(40000, 90000)), float(rng.uniform(1, 6)),
                         float(rng.uniform(80, 95)), float(rng.uniform(5, 20)), float(rng.uniform(2, 30)),
                         float(rng.uniform(15, 25)), float(rng.uniform(5, 9)), float(rng.uniform(2, 3)),
                         float(rng.uniform(1e-6, 1e-3)), int(i % 7 == 0), int(i % 11 == 0)))
            counts = [int(x) for x in rng.integers(0, 50, 8)]
            yearly.append((f"C{i:02d}", year, 1000 + i, sum(counts) / (1000 + i), *counts))
            monthly += [(f"C{i:02d}", year, dt.date(year, m, 1), m % 3, 1000 + i) for m in (1, 2)]
    acs1 = spark.createDataFrame(yearly, "county string, year int, total_population_acs1 long, crime_rate double, "
                                 + ", ".join(f"{t} long" for t in PL.TYPES))
    merged = spark.createDataFrame(monthly, "county string, year int, month date, homicides long, total_population_acs1 long")
    return spark.createDataFrame(rows, PANEL), acs1, merged


def map_panel(spark):
    """Mapping panel of three counties in two years, with rings; one lies across
    180 degrees."""
    def square(x, y):
        return [(0, s, float((x + a + 180) % 360 - 180), float(y + b)) for s, (a, b) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])]
    rows = [(f"g{i}", f"C{i:02d}", year, 1000 + i, 0.1, 0.01, int(i % 7 == 0), int(i % 11 == 0), square(i and 179.5, i))
            for i in (0, 1, 11) for year in (2022, 2023)]
    return spark.createDataFrame(rows, "GEOID string, county string, year int, total_population_acs5 int, crime_rate double, homicide_rate double, "
                                 "reservations int, top_cities int, geometry array<struct<ring_id:int,seq:int,lon:double,lat:double>>")


def test_analysis_entry_on_panel(spark):
    """Entry 3: every output, on 80 counties x 2 survey years."""
    panel, acs1, merged = panel_tables(spark)
    mapping = map_panel(spark)
    res = {k: v.collect() for k, v in PL.analysis(panel, acs1, merged, mapping).items()}
    at = {r.county: r for r in res["map"]}
    assert set(at) == {"C00", "C01", "C11"} and at["C01"].cx is None and at["C01"].reservations == 0
    assert [round(x, 9) for x in (at["C00"].cx, at["C00"].cy, at["C11"].cx, at["C11"].cy)] == [0.5, 0.5, 180.0, 11.5]
    assert len(res["metrics"]) == 3 and all(v == round(v, 3) for r in res["metrics"] for v in r[1:])
    series = {(r.type, str(r.month)): (r.homicides, r.population) for r in res["time_series"]}
    assert series["Monthly", "2018-02-01"] == (160, None) and series["Yearly", "2023-01-01"] == (240, sum(range(1000, 1080)))
    rates = {r.year: r for r in res["yearly_rates"]}
    totals = acs1.groupBy("year").agg(*[F.sum(t).alias(t) for t in PL.TYPES]).collect()
    for t in totals:
        r = rates[t.year]
        assert r.crime_rate == pytest.approx(sum(t[1:]) / r.population) and r.homicides_pc == pytest.approx(t.homicides / r.population)
        assert r.scale_factor == pytest.approx(max(x.crime_rate for x in rates.values()) / r.population)
    for name, n in (("descriptive", 11), ("pearson", 10)):
        p = [r.p_value for r in res[name]]
        assert len(p) == n and p == sorted(p)
    first = res["descriptive"][0]
    assert first.variable in PL.DESCRIBE_VARS and first.sd_pre > 0
    assert len(res["facets"]) == 7 * 80 and {r.variable for r in res["facets"]} == set(PL.MODEL_VARS) and all(r.lower <= r.fit <= r.upper for r in res["facets"])
    models = res["models"]
    assert [r.model for r in models] == ["Pre-COVID"] * 8 + ["Post-COVID"] * 8 + ["Full Model"] * 9
    assert {r.model: (r.first_row, r.last_row) for r in res["model_rows"]} == {
        "Pre-COVID": (1, 8), "Post-COVID": (9, 16), "Full Model": (17, 25)}
    assert all(r.p_value == round(r.p_value, 3) for r in models)
    resid = {}
    for r in res["residuals"]:
        resid.setdefault(r.model, []).append(r.resid)
    assert {m: len(v) for m, v in resid.items()} == {"Pre-COVID": 80, "Post-COVID": 80, "Full Model": 160}
    assert all(abs(sum(v)) < 1e-8 for v in resid.values())
    chow = res["chow"][0]
    assert chow.df1 == 8 and chow.df2 == 144 and 0 <= chow.p_value <= 1
    assert sorted(r.idx for r in res["cusum"]) == list(range(1, 161)) and len(res["boxcox"]) == 41
    assert 0 <= res["cusum_test"][0].p_value <= 1
    assert [r.model for r in res["diff_model"]] == ["Differenced Model"] * 7
    xs = [r.x for r in res["density"]]
    lo, hi = acs1.agg(F.min("crime_rate"), F.max("crime_rate")).first()
    assert len(xs) == 512 and min(xs) == pytest.approx(lo) and max(xs) == pytest.approx(hi)     # the 1-year panel
    with pytest.raises(ValueError, match="pct_young_males"):
        PL.analysis(panel.drop("pct_young_males"), acs1, merged)


def test_cli_ingest_and_merge(spark, scratch):
    from paneltide import cli
    land, cen, out = (os.path.join(scratch, d) for d in ("landing", "census", "out"))
    write_landing(land)
    write_census(cen)
    cli.main(["ingest", "--landing", land, "--out", out])
    assert spark.read.parquet(os.path.join(out, "crime_data")).count() == len(AGENCIES) * len(MONTHS)
    cli.main(["merge", "--landing", land, "--census", cen, "--out", out])
    for t in ("crime_data", "vars", "mapping", "acs_1yr_ts", "acs_5yr_ts", "crime_data_merged", "mapping_yearly_data",
              "acs_1_yearly_data", "acs_5_yearly_data"):
        assert spark.read.parquet(os.path.join(out, t)).count() > 0


def test_stopped_run_goes_on_after_its_last_whole_stage(spark, scratch, monkeypatch):
    import json
    land, cen, out = (os.path.join(scratch, d) for d in ("landing", "census", "stages"))
    write_landing(land)
    write_census(cen)
    versions = lambda name: sorted(os.listdir(os.path.join(out, name)))
    with monkeypatch.context() as m:
        m.setattr(PL, "yearly_rollup", lambda merged: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            PL.run_merge(spark, land, cen, out)
    assert os.path.exists(os.path.join(out, "_manifests", "crime_data_merged.json")) and not os.path.exists(os.path.join(out, "acs_5_yearly_data"))
    before = {n: versions(n) for n in ("crime_data", "crime_data_merged", "mapping")}
    with monkeypatch.context() as m:
        m.setattr(LD, "crime_data", lambda *a: 1 / 0)
        m.setattr(PL, "merge", lambda *a: 1 / 0)
        whole = PL.run_merge(spark, land, cen, out)
        again = {n: df.count() for n, df in PL.run_merge(spark, land, cen, out).items()}
    assert {n: versions(n) for n in before} == before and again == {n: df.count() for n, df in whole.items()} and len(again) == 9
    with open(os.path.join(out, "_manifests", "crime_data.json")) as f:
        assert json.load(f)["rows"] == again["crime_data"] == len(AGENCIES) * len(MONTHS)
    # a half-written version, and other inputs: old versions go, what does not depend on them stays
    os.makedirs(os.path.join(out, "crime_data", "version=half"))
    _write(land, "ZZ_arson.csv", "series,01-2020", "Zed,3")
    assert PL.run_merge(spark, land, cen, out)["crime_data"].filter("ori = 'ZZ'").count() == 1
    assert len(versions("crime_data")) == 1 and versions("crime_data") != before["crime_data"] and versions("mapping") == before["mapping"]
    only = PL.run_merge(spark, land, cen, out, interpolate=["total_population_acs1"])
    assert only["acs_1_yearly_data"].columns == whole["acs_1_yearly_data"].columns
    from paneltide.sources.sinks import read_stage
    assert "version" not in read_stage(spark, os.path.join(out, "mapping")).columns


def test_stage_partition_pruning(spark, scratch):
    land, cen, out = (os.path.join(scratch, d) for d in ("landing", "census", "stages"))
    write_landing(land)
    write_census(cen)
    PL.run_merge(spark, land, cen, out_dir=out)
    df = spark.read.parquet(os.path.join(out, "acs_5_yearly_data")).filter(F.col("year") == 2023)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and df.count() > 0


def test_name_contract_helpers(spark):
    from paneltide.operators.reshape import columns_of_type, columns_with_prefix
    from pyspark.sql import types as T
    df = spark.createDataFrame([("Aitkin ORI: MN0010000 ", "homicides")], "label string, t string")
    r = df.select(LD.ori_from_label("label").alias("ori")).first()
    assert r.ori == "MN0010000"
    name = df.select(LD.landing_name(LD.ori_from_label("label"), "t").alias("f")).first().f
    assert name == "MN0010000_homicides.csv"
    keyed = spark.createDataFrame([(name,)], "file string").select(
        F.regexp_extract("file", LD.FILE_KEY, 1).alias("ori"), F.regexp_extract("file", LD.FILE_KEY, 2).alias("t"))
    assert tuple(keyed.first()) == ("MN0010000", "homicides")
    w = spark.createDataFrame([(1, 2.0, "x", 3.0)], "id int, X1985 double, s string, X1986 double")
    assert columns_with_prefix(w, "X") == ["X1985", "X1986"]
    assert columns_of_type(w, T.DoubleType) == ["X1985", "X1986"]



def test_cli_analyze(spark, scratch):
    """Entry 3 through the command line on written stages."""
    from paneltide import cli
    stages, out = os.path.join(scratch, "stages"), os.path.join(scratch, "results")
    for name, df in zip(("acs_5_yearly_data", "acs_1_yearly_data", "crime_data_merged", "mapping_yearly_data"),
                        (*panel_tables(spark, 8, 60), map_panel(spark))):
        df.write.parquet(os.path.join(stages, name))
    cli.main(["analyze", "--stages", stages, "--out", out])
    assert spark.read.parquet(os.path.join(out, "models")).count() == 8 + 8 + 9
    assert spark.read.parquet(os.path.join(out, "boxcox")).count() == 41
    assert spark.read.parquet(os.path.join(out, "map")).count() == 3
