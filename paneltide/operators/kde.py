"""Gaussian kernel density on a fixed grid by linear binning.

Two scans.  The first gives n, sd, the extremes and a KLL sketch.  The second
shares every value between the two nearest of evenly spaced nodes, in proportion
to its distance from each, and picks out the values near the quartiles; one row
per occupied node and per distinct picked value leaves it.

Nodes lie at multiples of a power of two that is at most 1/``PER_BANDWIDTH`` of
the bandwidth, wherever the values are, so a far outlier neither widens the bins
nor adds more than its own.  Sharing a value between nodes that are w apart changes
its kernel by at most (w / bw)^2 / 8 of the kernel's peak: below 3.1e-5 of it.
Each node reaches the grid points within ``REACH`` bandwidths; beyond, the kernel
is below 3e-16 of its peak.

The bandwidth (nrd0) takes the exact quartiles.  The second scan bins by the
bandwidth that the sketch suggests, at half the width; nodes of a finer grid pass
their weight to a coarser one that holds every other node without any change, so
the result depends on the exact bandwidth alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import present
from ..session import cut_lineage
from .quantile import at_rank, brackets, interpolated, sketch

PER_BANDWIDTH, REACH = 64, 8.5
_QUARTILES = (0.25, 0.75)


def bw_nrd0(sd: float, iqr: float, n: int, any_value: float = 0.0) -> float:
    """Silverman's rule of thumb; degenerate spreads fall back to sd, then to
    |a data value|, then to 1."""
    lo = min(sd, iqr / 1.34)
    if not lo > 0:
        lo = sd if sd and sd > 0 else (abs(any_value) or 1.0)
    return 0.9 * lo * n ** (-0.2)


def node_width(bw: float) -> float:
    """The greatest power of two that is at most bw / PER_BANDWIDTH."""
    return 2.0 ** math.floor(math.log2(bw / PER_BANDWIDTH))


def _nodes(position: Column) -> Column:
    """(k, f): the node at or below a position counted in nodes, and the way on."""
    k = F.floor(position)
    return F.struct(k.alias("k"), (position - k).alias("f"))


def _binned(d: DataFrame, width: float, near: list) -> DataFrame:
    """(q, k, v, c, f, below): per node k the count and summed way on, with how
    many values lie below each bracket of ``near``; and per bracket q and value
    inside it its count."""
    node = _nodes(F.col("v") / F.lit(width))
    none = F.lit(None).cast("double")
    inside = [F.when((F.col("v") >= r["lo"]) & (F.col("v") <= r["hi"]), F.struct(
        F.lit(i).alias("q"), F.lit(None).cast("long").alias("k"), F.col("v").alias("v"), F.lit(0.0).alias("f"))) for i, r in enumerate(near)]
    rows = d.select("v", F.explode(F.array_compact(F.array(
        F.struct(F.lit(-1).alias("q"), node["k"].alias("k"), none.alias("v"), node["f"].alias("f")), *inside))).alias("e"))
    below = [F.count_if(F.col("v") < F.lit(r["lo"])).alias(f"below{i}") for i, r in enumerate(near)]
    return rows.groupBy(F.col("e.q").alias("q"), F.col("e.k").alias("k"), F.col("e.v").alias("x")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("e.f").alias("f"), *below)


def _quartiles(cells: DataFrame, near: list) -> list[float]:
    """Exact quartiles from the binned values."""
    parts = None
    for i, r in enumerate(near):
        own = cells.select(F.when(F.col("q") == i, F.col("x")).alias("x"), F.when(F.col("q") == i, F.col("c")).when(F.col("q") == -1, F.col(f"below{i}")).otherwise(0).alias("c"),
                           F.lit(i).alias("q")).filter("c > 0")
        own = own.groupBy("q", "x").agg(F.sum("c").alias("c"))
        ranks = (r["k"], min(r["k"] + 1, r["n"] - 1))
        own = own.select("q", *[at_rank(F.col("x"), F.col("c"), F.lit(k), ["q"]).alias(a) for a, k in zip(("lower", "upper"), ranks)])
        parts = own if parts is None else parts.unionByName(own)
    found = parts.groupBy("q").agg(F.max("lower").alias("lower"), F.max("upper").alias("upper")).orderBy("q")
    frac = F.element_at(F.array(*[F.lit(r["frac"]) for r in near]), F.col("q") + 1)
    return [x["v"] for x in found.select(interpolated(F.col("lower"), F.col("upper"), frac).alias("v")).collect()]


def kde(df: DataFrame, value: str, points: int = 512, bw: float | None = None) -> DataFrame:
    """(i, x, density, bw) at ``points`` grid points from the least to the
    greatest value; NULL and NaN values are left out."""
    d = df.select(present(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    first = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("least"), F.max("v").alias("most"),
                  sketch(F.col("v")).alias("s"))
    near = brackets(first, _QUARTILES).withColumn("rough", (F.col("lo") + F.col("hi")) / 2).orderBy("p").collect()
    spark = df.sparkSession
    if not near:
        return spark.createDataFrame([], "i int, x double, density double, bw double")
    n, sd, lo, hi = near[0]["n"], near[0]["sd"] or 0.0, near[0]["least"], near[0]["most"]
    if hi == lo:                     # all values equal: every grid point sits on them
        bw = bw or bw_nrd0(0.0, 0.0, n, lo)
        return spark.range(points).select(F.col("id").cast("int").alias("i"), F.lit(float(lo)).alias("x"),
                                          F.lit(n / (n * bw * math.sqrt(2.0 * math.pi))).alias("density"), F.lit(bw).alias("bw"))
    rough = bw or bw_nrd0(sd, near[1]["rough"] - near[0]["rough"], n, lo)
    width = node_width(rough) / 2.0
    cells = cut_lineage(_binned(d, width, [] if bw else near))
    if bw is None:
        q1, q3 = _quartiles(cells, near)
        bw = bw_nrd0(sd, q3 - q1, n, lo)
    final = node_width(bw)
    if final < width:                # the sketch's bandwidth was over twice the exact one
        cells, width = cut_lineage(_binned(d, final, [])), final
    half = cells.filter("q = -1")
    fine = (half.select(F.explode(F.array(F.struct("k", (F.col("c") - F.col("f")).alias("w")),
                                          F.struct((F.col("k") + 1).alias("k"), F.col("f").alias("w")))).alias("s")).select("s.*"))
    node = _nodes(F.col("k") / F.lit(final / width))
    weight = (fine.select(F.explode(F.array(F.struct(node["k"].alias("k"), (F.col("w") * (1 - node["f"])).alias("w")),
                                            F.struct((node["k"] + 1).alias("k"), (F.col("w") * node["f"]).alias("w")))).alias("s"))
              .groupBy("s.k").agg(F.sum("s.w").alias("w")).filter("w <> 0"))
    step = (hi - lo) / (points - 1) if points > 1 else hi - lo
    at = F.col("k") * F.lit(final)
    reach = REACH * bw
    low = F.greatest(F.lit(0), F.ceil((at - F.lit(reach) - F.lit(lo)) / F.lit(step)))
    high = F.least(F.lit(points - 1), F.floor((at + F.lit(reach) - F.lit(lo)) / F.lit(step)))
    x = F.lit(lo) + F.lit(hi - lo) * F.col("i").cast("double") / F.lit(float(max(1, points - 1)))
    u = (x - at) / F.lit(bw)
    parts = (weight.withColumns({"low": low, "high": high}).filter("low <= high")
             .select("k", "w", F.explode(F.sequence("low", "high")).alias("i")).select("i", (F.col("w") * F.exp(-0.5 * u * u)).alias("s")))
    norm = 1.0 / (n * bw * math.sqrt(2.0 * math.pi))
    grid = spark.range(points).select(F.col("id").alias("i"))
    return grid.join(parts.groupBy("i").agg(F.sum("s").alias("s")), "i", "left").select(
        F.col("i").cast("int").alias("i"), x.alias("x"), (F.coalesce("s", F.lit(0.0)) * F.lit(norm)).alias("density"), F.lit(bw).alias("bw"))
