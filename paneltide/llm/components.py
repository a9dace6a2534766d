"""Connected components of an edge table by alternating star contraction.

Each round links a node's neighbours to the least node around it (large star,
then small star), as two aggregations and two joins; the number of rounds grows
with the logarithm of the graph.  The rounds end as soon as the edges are stars
around least nodes.  Only that answer and the number of edges reach the driver;
every round is a table in the shared folder, in files of about ``FILE_ROWS``
edges: a round never has more edges than the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FILE_ROWS = 1 << 18


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges; whether each node has one neighbour below it, which
    has none below itself, or else none."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("low"), F.lit(1).alias("n")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("low"), F.lit(0).alias("n")))
    of_node = ends.groupBy("node").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.sum("n").alias("n"))
    n, more = of_node.agg(F.sum("n"), F.max(F.expr("least != most OR most > node"))).first()
    return n or 0, not more


def _few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` small rows, in as many partitions as these
    need, where a small table would be a file for each shuffle partition."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def components(edges: DataFrame, name: str = "components", most: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u and v; a
    component is named by its least node).  Loops and repeated edges are fine.
    ``most``: a bound of the number of edges, if known."""
    edges = edges.select("u", "v").filter("u != v").distinct()
    edges = stored(edges if most is None else _few_files(edges, most), name)
    while True:
        n, stars = _state(edges)
        if stars:
            break
        edges = stored(_few_files(_small_star(_large_star(edges)), n), name)
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(heads)
