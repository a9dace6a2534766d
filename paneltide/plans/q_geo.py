"""Spatial queries: rings derived from supplier keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .catalogue import finish, query, tables


def supplier_rings(t, where=None) -> DataFrame:
    """One 4-corner cell per supplier (geoid = s_suppkey), counter-clockwise.

    lon0 = -180 + (key mod 360), lat0 = -60 + ((key div 360) mod 120),
    width 0.5 + 0.25 (key mod 5) deg, height 0.5 + 0.25 (key mod 3) deg.
    """
    s = t.supplier if where is None else t.supplier.filter(where)
    s = s.select(F.col("s_suppkey").alias("geoid"))
    k = F.col("geoid")
    lon0 = F.lit(-180.0) + (k % 360).cast("double")
    lat0 = F.lit(-60.0) + ((k / 360).cast("long") % 120).cast("double")
    w = F.lit(0.5) + (k % 5).cast("double") * 0.25
    h = F.lit(0.5) + (k % 3).cast("double") * 0.25
    corners = F.array(
        F.struct(F.lit(0).alias("seq"), lon0.alias("lon"), lat0.alias("lat")),
        F.struct(F.lit(1).alias("seq"), (lon0 + w).alias("lon"), lat0.alias("lat")),
        F.struct(F.lit(2).alias("seq"), (lon0 + w).alias("lon"), (lat0 + h).alias("lat")),
        F.struct(F.lit(3).alias("seq"), lon0.alias("lon"), (lat0 + h).alias("lat")))
    return s.select("geoid", F.lit(0).alias("ring_id"), F.explode(corners).alias("v")) \
            .select("geoid", "ring_id", "v.seq", "v.lon", "v.lat")


@query("polygon_area")
def polygon_area(spark, sf_dir):
    """G1: spherical area in m^2 of each supplier cell."""
    return finish(geo.polygon_area(supplier_rings(tables(spark, sf_dir))), 0)


@query("polygon_centroid")
def polygon_centroid(spark, sf_dir):
    """Centroid of the filtered cells (suppliers with positive balance)."""
    rings = supplier_rings(tables(spark, sf_dir), where=F.col("s_acctbal") > 0)
    return finish(geo.polygon_centroid(rings), 9)


@query("polygon_density")
def polygon_density(spark, sf_dir):
    """Attribute table joined to the area (geometry dropped), lines per km^2."""
    t = tables(spark, sf_dir)
    area = geo.polygon_area(supplier_rings(t))
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("geoid")).agg(F.count(F.lit(1)).alias("n_lines"))
    out = lines.join(area, "geoid", "left").select(
        "geoid", "n_lines", "area_m2",
        F.try_divide(F.col("n_lines"), F.col("area_m2") / F.lit(1e6)).alias("lines_per_km2"))
    return finish(out, 0, overrides={"lines_per_km2": 9})
