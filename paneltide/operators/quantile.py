"""Exact quantiles from two scans.

``percentile`` and ``median`` merge a value -> count map per group in one task:
for a global or two-group quantile that is half the table in one place.  Here

1. one scan aggregates a mergeable KLL sketch per group (a few ten kB, whatever
   the data), which brackets each wanted rank between two of the group's values;
2. one scan counts the values below each bracket, collapses those inside to one
   row per distinct value, and drops the rest; running counts over a bracket's
   values find the wanted rank.

A bracket is ``MARGIN`` times the sketch's error wide, so about one value in a
hundred is inside; a rank that is not inside is an error, never a wrong value.
Result: type-7 (linear interpolation) quantiles, NULL and NaN left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import present
from ..session import cut_lineage

#: Size parameter of the sketches, their rank error as a share of the rows (99%
#: confidence) and how many times it a bracket reaches to either side.
SKETCH_K = 4096
RANK_ERROR = 2.296 / SKETCH_K ** 0.9021
MARGIN = 4
#: Values up to which a group's bracket is its whole range.
FEW = 1_000
#: Groups up to which their brackets are sent to every executor.
BROADCAST_GROUPS = 100_000


def sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, SKETCH_K)


def brackets(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(..., p, k, frac, lo, hi) for each row of (..., s: sketch, n: values): the
    lower of the two order statistics beside the wanted position h = (n - 1) p,
    the way to the next, and values that enclose both."""
    wide = MARGIN * RANK_ERROR + 2.0 / FEW
    shares = F.array(*[F.lit(x) for p in probs for x in (max(0.0, p - wide), min(1.0, p + wide))], F.lit(0.0), F.lit(1.0))
    found = sketches.withColumn("q", F.kll_sketch_get_quantile_double("s", shares)).drop("s")
    few, last = F.col("n") < FEW, 2 * len(probs)
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.when(few, F.col("q")[last]).otherwise(F.col("q")[2 * i]).alias("lo"),
                              F.when(few, F.col("q")[last + 1]).otherwise(F.col("q")[2 * i + 1]).alias("hi")) for i, p in enumerate(probs)])
    h = (F.col("n") - 1) * F.col("p")
    return (found.filter("n > 0").select(*[c for c in found.columns if c != "q"], F.explode(each).alias("e")).select("*", "e.*").drop("e")
            .withColumns({"k": F.floor(h).cast("long"), "frac": h - F.floor(h)}))


def at_rank(value: Column, count: Column, rank: Column, by: Sequence[str]) -> Column:
    """Value of 0-based ``rank`` among counted values, over the rows of ``by``
    in order of ``value``; rows without a value come first and count as below."""
    upto = F.sum(count).over(Window.partitionBy(*by).orderBy(value.asc_nulls_first()))
    return F.when((rank >= upto - count) & (rank < upto), value)


def interpolated(lower: Column, upper: Column, frac: Column) -> Column:
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    return F.when(lower.isNull() | upper.isNull(), missed).otherwise(lower + frac * (upper - lower))


def grouped_brackets(d: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Brackets of each group of (g, v), computed once; sent to every executor
    while their number is small."""
    found = cut_lineage(brackets(d.groupBy(F.col("g").alias("_g")).agg(sketch(F.col("v")).alias("s"), F.count(F.lit(1)).alias("n")), probs))
    return F.broadcast(found) if found.count() <= BROADCAST_GROUPS * len(probs) else found


def quantile_table(df: DataFrame, value: str, probs: Sequence[float], group: str | None = None) -> DataFrame:
    """(group, p, q): one row per group (NULL groups too) and probability."""
    g = F.col(group) if group else F.lit(0)
    d = df.select(g.alias("g"), present(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    near = d.join(grouped_brackets(d, probs), F.col("g").eqNullSafe(F.col("_g"))).filter(F.col("v") <= F.col("hi"))
    names = ["_g", "p", "k", "frac", "n"]
    cells = near.groupBy(*names, F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    ranked = cells.select(*names, *[at_rank(F.col("v"), F.col("c"), r, ["_g", "p"]).alias(a) for a, r in
                                    (("lower", F.col("k")), ("upper", F.least(F.col("k") + 1, F.col("n") - 1)))])
    both = ranked.groupBy("_g", "p").agg(F.max("frac").alias("frac"), F.max("lower").alias("lower"), F.max("upper").alias("upper"))
    out = both.select(F.col("_g").alias("g"), "p", interpolated(F.col("lower"), F.col("upper"), F.col("frac")).alias("q"))
    return out if group else out.drop("g")
