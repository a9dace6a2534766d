"""Distributed ordered running sums (the CUSUM process, W5/T10).

``sum(x).over(Window.orderBy(key))`` has no partition key, so Spark moves every
row into a single task.  Instead rows are dealt to key ranges:

  1. ``RangeIndex`` draws a sample of order keys and turns its quantiles into a
     two-level index: one array of coarse bounds, and for each coarse range an
     array of fine bounds.  A row's range is found by binary search in the two
     arrays, so the plan is the same for any number of ranges and the sample is
     sorted in parts of one coarse range.  Ranges cut the whole key, so one hot
     date spreads over several by the columns that follow it;
  2. one aggregate per range gives its total and count; their running sums (a
     row per range) are the offsets, joined back by range;
  3. a window per range gives the local running sum, inside the JVM.

The sample is chosen by the keys' hashes and checkpointed: a recomputed task finds
the same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Sampled keys per range: bounds are within a few per cent of even.
SAMPLE_PER_RANGE = 64
#: Bytes of a key up to which the index of all ranges is sent to every executor.
BROADCAST_BYTES = 64 << 20


def _at_or_below(bounds: Column, key: Column, most: int) -> Column:
    """How many of the sorted ``bounds`` (at most ``most``) are at or below
    ``key``: doubling steps from the largest power of two down."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(most.bit_length()))]) if most else F.array().cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(bounds, n + step - 1) <= key, n + step).otherwise(n))


def _even(keys: Column, parts: int) -> Column:
    """The parts - 1 keys that cut a list of keys evenly."""
    if parts < 2:
        return F.slice(keys, 1, 0)
    return F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.get(keys, F.floor(i * F.size(keys) / parts).cast("int")))


class RangeIndex:
    """Key ranges of a table in ``order``; equal keys share a range, NULLs come
    first.  ``rows`` is the table's row count where it is known."""

    def __init__(self, df: DataFrame, order: Sequence[str], ranges: int | None = None, rows: int | None = None):
        self.order = list(order)
        n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.coarse = math.isqrt(n - 1) + 1 if n > 1 else 1
        self.fine = -(-n // self.coarse)
        keys = df.select(self._key().alias("k"))
        rows = keys.count() if rows is None else rows
        sample = cut_lineage(self._share(keys, SAMPLE_PER_RANGE * n, rows).distinct())
        few = self._share(sample, SAMPLE_PER_RANGE * self.coarse, min(rows, SAMPLE_PER_RANGE * n), salt=1)
        # one row: coarse - 1 bounds out of some SAMPLE_PER_RANGE keys for each
        self.top = F.broadcast(few.agg(F.array_sort(F.collect_list("k")).alias("s")).select(_even(F.col("s"), self.coarse).alias("_top")))
        parts = sample.crossJoin(self.top).groupBy(_at_or_below(F.col("_top"), F.col("k"), self.coarse - 1).alias("_p"))
        index = parts.agg(F.array_sort(F.collect_list("k")).alias("s")).select("_p", _even(F.col("s"), self.fine).alias("_fine"))
        kinds = [df.schema[c].dataType for c in self.order]
        width = sum(_bytes(k) for k in kinds)
        self.index = F.broadcast(index) if n * width <= BROADCAST_BYTES else index

    def _key(self) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in self.order])

    @staticmethod
    def _share(keys: DataFrame, wanted: int, rows: int, salt: int = 0) -> DataFrame:
        """About ``wanted`` of ``rows`` keys, by hash."""
        share = min(1.0, wanted / rows) if rows else 1.0
        h = F.pmod(F.xxhash64("k", F.lit(salt)), F.lit(1 << 40))
        return keys.filter(h < int(share * (1 << 40)))

    def deal(self, df: DataFrame, out: str = "_b") -> DataFrame:
        """``df`` with each row's range number ``out``."""
        p = _at_or_below(F.col("_top"), self._key(), self.coarse - 1)
        found = df.crossJoin(self.top).withColumn("_p", p).drop("_top").join(self.index, "_p", "left")
        within = F.coalesce(_at_or_below(F.col("_fine"), self._key(), self.fine - 1), F.lit(0))
        return found.withColumn(out, F.col("_p") * F.lit(self.fine) + within).drop("_p", "_fine")


def _bytes(kind: T.DataType) -> int:
    """Bytes of one bound; those of text are taken as 64."""
    return 8 if isinstance(kind, (T.NumericType, T.DatetimeType, T.BooleanType)) else 64


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, out: str = "cumsum",
               index: str = "idx", partitions: int | None = None, rows: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` (NULL counts as 0; whole
    numbers stay LONG) and ``index`` = 1-based row position, both in ``order``
    (which must be unique)."""
    order = list(order)
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    d = RangeIndex(df, order, partitions, rows).deal(df).withColumn(
        "_x", F.coalesce(F.col(value).cast("long" if whole else "double"), F.lit(0 if whole else 0.0)))
    offs = _offsets(d.groupBy("_b").agg(F.sum("_x").alias("_t"), F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumns({"_lsum": F.sum("_x").over(w), "_lidx": F.row_number().over(Window.partitionBy("_b").orderBy(*order))})
    return (local.join(offs, "_b")
            .withColumns({out: F.col("_lsum") + F.col("_off"), index: F.col("_lidx") + F.col("_coff")})
            .select(*df.columns, out, index))


def _offsets(totals: DataFrame) -> DataFrame:
    """Exclusive running totals of the ranges: one row per range."""
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select(
        "*", F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_off"), F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_coff"))
        .drop("_t", "_c"))


def prefix_extremes(df: DataFrame, order: Sequence[str], value: str, partitions: int | None = None, rows: int | None = None) -> DataFrame:
    """One row (hi, lo, n): extremes of the inclusive running sum of ``value``
    in ``order``, and the row count.  Each range reports the extremes of its
    local running sum, to which its offset is added."""
    order = list(order)
    d = df.select(*order, value)
    d = RangeIndex(d, order, partitions, rows).deal(d).withColumn("_x", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = (d.withColumn("_s", F.sum("_x").over(w)).groupBy("_b")
             .agg(F.sum("_x").alias("_t"), F.count(F.lit(1)).alias("_c"), F.max("_s").alias("_hi"), F.min("_s").alias("_lo"),
                  F.count(F.lit(1)).alias("_n")))
    offs = _offsets(local)
    return offs.agg(F.max(F.col("_off") + F.col("_hi")).alias("hi"), F.min(F.col("_off") + F.col("_lo")).alias("lo"),
                    F.sum("_n").alias("n"))
