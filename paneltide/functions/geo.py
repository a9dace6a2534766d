"""Spherical polygon area and planar centroid over a ring-vertex table.

Vertex table: (geoid, ring_id, seq, lon, lat) in degrees; rings close by
wrap-around.

Longitudes are unwrapped along each ring: a step of more than 180 degrees goes the
other way round, and all rings of a polygon are shifted by whole turns next to its
first one.  A ring that goes round a pole has no planar centroid and is not meant
here.

A ring is a shell or a hole by how many larger rings of its polygon hold it: an
even number adds, an odd number subtracts, in whatever direction it is written.
Rings of one polygon touch at most; a ring lies inside another if the middle of its
first edge does.

Area of a ring with great-circle edges = |sum over edges of E| * R^2 with
E = 2 atan2(tan(dlon/2) (tan(lat1/2) + tan(lat2/2)), 1 + tan(lat1/2) tan(lat2/2)),
the signed excess between the edge and the equator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: sphere radius in metres.
EARTH_RADIUS_M = 6371010.0


def _turns(degrees: Column) -> Column:
    """Whole turns nearest to an angle."""
    return F.round(degrees / 360.0)


def ring_edges(v: DataFrame, keys: Sequence[str] = ("geoid", "ring_id"), seq: str = "seq") -> DataFrame:
    """Pair every vertex with the next one of its ring, the last with the first,
    with unwrapped longitudes.

    Windows in ``seq`` order: gaps in it do not matter.  All of them, and any
    grouping by polygon, share one shuffle by polygon; a window holds one
    polygon's vertices at most.
    """
    polygon, ring = Window.partitionBy(*keys[:-1]), Window.partitionBy(*keys).orderBy(seq)
    back = F.coalesce(_turns(F.lag("lon").over(ring) - F.col("lon")), F.lit(0.0))
    near = _turns(F.first("lon").over(polygon.orderBy(keys[-1], seq)) - F.first("lon").over(ring))
    out = v.withColumns({"_back": back, "_near": near})
    out = out.withColumn("_x", F.col("lon") + 360.0 * (F.col("_near") + F.sum("_back").over(ring)))
    out = out.withColumn("_next", F.coalesce(F.lead(F.struct("_x", "lat")).over(ring), F.first(F.struct("_x", "lat")).over(ring)))
    closing = F.col("_next._x") + 360.0 * _turns(F.col("_x") - F.col("_next._x"))
    return (out.withColumns({"lon2": closing, "lat2": F.col("_next.lat"), "lon": F.col("_x")}).drop("_back", "_near", "_x", "_next"))


def edge_excess(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    t1 = F.tan(F.radians(lat1) / 2)
    t2 = F.tan(F.radians(lat2) / 2)
    dl = F.radians(lon2 - lon1)
    return 2 * F.atan2(F.tan(dl / 2) * (t1 + t2), 1 + t1 * t2)


def _inside(x: Column, y: Column, edges: Column) -> Column:
    """Whether a point lies in a ring: an odd number of edges cross its parallel
    to the east."""
    def crosses(e):
        reach = (e["lon2"] - e["lon"]) * (y - e["lat"]) / (e["lat2"] - e["lat"]) + e["lon"]
        return F.when((e["lat"] > y) != (e["lat2"] > y), x < reach).otherwise(False)
    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def _role(ring: Column, rings: Column) -> Column:
    """1 for a shell, -1 for a hole."""
    def holds(o):
        box = (o["west"] <= ring["x"]) & (ring["x"] <= o["east"]) & (o["south"] <= ring["y"]) & (ring["y"] <= o["north"])
        return F.when(box & (F.abs(o["a2"]) > F.abs(ring["a2"])), _inside(ring["x"], ring["y"], o["edges"])).otherwise(False)
    return F.aggregate(rings, F.lit(1.0), lambda sign, o: F.when(holds(o), -sign).otherwise(sign))


def polygon_sums(v: DataFrame, geoid: str = "geoid") -> DataFrame:
    """(geoid, excess, a2, sx, sy): sums over a polygon's rings, shells positive
    and holes negative.  A row holds one polygon's vertices."""
    e = ring_edges(v, (geoid, "ring_id"))
    cross = F.col("lon") * F.col("lat2") - F.col("lon2") * F.col("lat")
    ex = edge_excess(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2"))
    first = F.min_by(F.struct(((F.col("lon") + F.col("lon2")) / 2).alias("x"), ((F.col("lat") + F.col("lat2")) / 2).alias("y")), "seq")
    rings = e.groupBy(geoid, "ring_id").agg(
        F.sum(ex).alias("excess"), F.sum(cross).alias("a2"), F.sum((F.col("lon") + F.col("lon2")) * cross).alias("sx"),
        F.sum((F.col("lat") + F.col("lat2")) * cross).alias("sy"), F.min("lon").alias("west"), F.max("lon").alias("east"),
        F.min("lat").alias("south"), F.max("lat").alias("north"), first.alias("p"),
        F.collect_list(F.struct("lon", "lat", "lon2", "lat2")).alias("edges"))
    ring = F.struct("ring_id", "excess", "a2", "sx", "sy", "west", "east", "south", "north", "p.x", "p.y", "edges")
    many = rings.groupBy(geoid).agg(F.array_sort(F.collect_list(ring)).alias("rings"))
    signed = F.transform("rings", lambda r: F.struct(
        *[(r[c] * F.when(F.size("rings") > 1, _role(r, F.col("rings"))).otherwise(1.0) * F.signum(r["a2"])).alias(c)
          for c in ("a2", "sx", "sy")], (F.abs(r["excess"]) * F.when(F.size("rings") > 1, _role(r, F.col("rings"))).otherwise(1.0)).alias("excess")))
    total = lambda c: F.aggregate("signed", F.lit(0.0), lambda s, r: s + r[c]).alias(c)
    return many.select(geoid, signed.alias("signed")).select(geoid, *[total(c) for c in ("excess", "a2", "sx", "sy")])


def polygon_area(v: DataFrame, geoid: str = "geoid") -> DataFrame:
    return polygon_sums(v, geoid).select(geoid, (F.col("excess") * F.lit(EARTH_RADIUS_M ** 2)).alias("area_m2"))


def polygon_centroid(v: DataFrame, geoid: str = "geoid") -> DataFrame:
    """Planar (lon/lat) area-weighted centroid, its longitude in -180 .. 180."""
    x = F.try_divide(F.col("sx"), F.lit(3.0) * F.col("a2"))
    turn = F.when((x < -180.0) | (x > 180.0), 360.0 * F.floor((x + 180.0) / 360.0)).otherwise(0.0)
    return polygon_sums(v, geoid).select(geoid, (x - turn).alias("cx"), F.try_divide(F.col("sy"), F.lit(3.0) * F.col("a2")).alias("cy"))


def polygon_rings(v: DataFrame, geoid: str = "geoid") -> DataFrame:
    """(geoid, geometry): the vertices of each polygon as one sorted array of
    (ring_id, seq, lon, lat); bounded by a polygon's vertices."""
    vertex = F.struct("ring_id", "seq", "lon", "lat")
    return v.groupBy(geoid).agg(F.array_sort(F.collect_list(vertex)).alias("geometry"))
