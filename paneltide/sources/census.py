"""Landed census extracts and county attribute tables.

The reference pulls these from a web API year by year; here they are landed
long files (GEOID, variable, estimate, year) read in one scan each, with an
explicit schema so GEOID stays a string key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators.panel import count_per_key
from ..operators.reshape import pivot_wide

# Survey variable codes and their friendly names, in order.
SURVEY_VARIABLES = [
    ("total_population", "B01003_001"),
    ("white_population", "B02001_002"),
    ("male_15_19", "B01001_006"),
    ("male_20_24", "B01001_007"),
    ("median_household_income", "B19013_001"),
    ("households_total", "B19001_001"),
    ("households_income_lt5k", "B19001_002"),
    ("edu_total_25plus", "B15003_001"),
    ("edu_hs_grad", "B15003_017"),
    ("edu_some_college_lt1yr", "B15003_018"),
    ("edu_some_college_gt1yr", "B15003_019"),
    ("edu_assoc_degree", "B15003_020"),
    ("edu_bachelors", "B15003_021"),
    ("edu_masters", "B15003_022"),
    ("edu_professional_degree", "B15003_023"),
    ("edu_doctorate", "B15003_024"),
    ("children_total", "B09001_001"),
    ("children_w_mother_only", "B09001_004"),
    ("children_w_father_only", "B09001_005"),
    ("children_no_parents", "B09001_006"),
]
# Decennial count variable.
DECENNIAL_VARIABLES = [("total_population", "P1_001N")]
VAR_NAMES = [n for n, _ in SURVEY_VARIABLES]

LONG_SCHEMA = "GEOID string, variable string, estimate double, year int"
DECENNIAL_SCHEMA = "GEOID string, variable string, value double, year int"
MAPPING_SCHEMA = "ori string, GEOID string, county string, type string"
RINGS_SCHEMA = "GEOID string, ring_id int, seq int, lon double, lat double"
ATTR_SCHEMA = ("Location string, `Binge drinking prevalence` double, `Cost per person` int, "
               "`Total cost` long, `Productivity loss costs` long, `Other societal costs` long, "
               "`Health care costs` long")


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns of ``schema`` by their header names, whatever their order.

    The names come from the files; a file whose header differs from the others'
    fails the read (``enforceSchema`` off) instead of shifting its columns.
    Cells that do not parse are NULL.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    named = {c.strip("\ufeff").strip(): c for c in raw.columns}
    wanted = T.StructType.fromDDL(schema)
    if missing := [f.name for f in wanted if f.name not in named]:
        raise ValueError(f"{path}: no column named {missing}")
    return raw.select(*[F.col(f"`{named[f.name]}`").try_cast(f.dataType).alias(f.name) for f in wanted])


def variable_dim(spark: SparkSession, pairs: Sequence[tuple[str, str]] = SURVEY_VARIABLES) -> DataFrame:
    """Code -> friendly-name dimension (fixed size: broadcast)."""
    return F.broadcast(spark.createDataFrame([(c, n) for n, c in pairs], "code string, name string"))


def survey_long(spark: SparkSession, path: str) -> DataFrame:
    """Landed survey extract, all years in one scan."""
    return _csv(spark, path, LONG_SCHEMA)


def decennial_long(spark: SparkSession, path: str) -> DataFrame:
    """Decennial extract; its value column is renamed to ``estimate``."""
    return _csv(spark, path, DECENNIAL_SCHEMA).withColumnRenamed("value", "estimate")


def survey_wide(long: DataFrame, pairs: Sequence[tuple[str, str]] = SURVEY_VARIABLES) -> DataFrame:
    """P13 + R6: codes to friendly names, then one column per variable."""
    spark = long.sparkSession
    named = long.join(variable_dim(spark, pairs), F.col("variable") == F.col("code"), "inner")
    return pivot_wide(named.select("GEOID", "year", "name", "estimate"), ["GEOID", "year"], "name",
                      [n for n, _ in pairs], value_col="estimate", agg=F.first, name=str, unique=True)


def acs1_with_decennial(acs1_wide: DataFrame, dec_wide: DataFrame) -> DataFrame:
    """U1/A5/F2 (quirk Q13): decennial year appended by name (other variables
    NULL), then counties seen only once dropped."""
    u = acs1_wide.unionByName(dec_wide, allowMissingColumns=True)
    return count_per_key(u, ["GEOID"]).filter(F.col("n") > 1).drop("n")


def county_mapping(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, MAPPING_SCHEMA)


def county_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Attribute table keyed by upper-case county name."""
    a = _csv(spark, path, ATTR_SCHEMA).withColumnRenamed("Location", "county")
    return a.withColumn("county", F.upper("county"))


def county_rings(spark: SparkSession, rings_path: str) -> DataFrame:
    return _csv(spark, rings_path, RINGS_SCHEMA)


def county_area(spark: SparkSession, rings_path: str) -> DataFrame:
    """G1 on landed county rings -> (GEOID, area_m2)."""
    return geo.polygon_area(county_rings(spark, rings_path), geoid="GEOID")


def county_geometry(spark: SparkSession, rings_path: str) -> DataFrame:
    """G3 on landed county rings -> (GEOID, geometry)."""
    return geo.polygon_rings(county_rings(spark, rings_path), geoid="GEOID")
