"""Panel (entity x period) operators: rollup, windows, dedup, differencing.

Windows are always partitioned by the entity, so each window task holds one
entity's periods (a handful of years), never the table.  Group-wise results
that the reference keeps on every row are computed as an aggregate joined
back on the keys, so a hot key is handled by partial aggregation and AQE's
skew-join split instead of one window task holding a third of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def only_value(c: str, kind) -> Column:
    """The one value of a column in a group; several, or a value beside NULLs, are
    an error of the same aggregation, named by the column."""
    one = F.min(c).eqNullSafe(F.max(c)) & F.count(c).isin(F.lit(0), F.count(F.lit(1)))
    return F.when(one, F.max(c)).otherwise(F.raise_error(F.lit(f"a group holds several values of {c}")).cast(kind))


def rollup(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (),
           means: Sequence[str] = (), constants: Sequence[str] = ()) -> DataFrame:
    """Group-wise sum/mean with pass-through columns (A4, quirk Q11).

    ``constants`` are columns that depend only on ``keys``, which is checked.
    Sums of integer counts are LONG.
    """
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [F.avg(c).alias(c) for c in means]
    aggs += [only_value(c, df.schema[c].dataType).alias(c) for c in constants]
    return df.groupBy(*keys).agg(*aggs)


def partition_totals(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group aggregate kept on every row (W4/A5), as aggregate + join back.

    Equivalent to ``agg.over(Window.partitionBy(keys))``, NULL keys included
    (they are a group of their own), but skew-safe.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    right = totals.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *aggs)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(right, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``add_count(keys)`` (A5)."""
    return partition_totals(df, keys, {name: F.count(F.lit(1))})


def rolling_complete(df: DataFrame, entity: Sequence[str] | str, order: str,
                     cols: Sequence[str], n: int = 5, suffix: str = "") -> DataFrame:
    """Trailing n-row mean that is NULL until the window is full.

    Row-based like the reference (not a period range); a NULL inside the
    window makes the result NULL, as a mean without na.rm does.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    w = Window.partitionBy(*entity).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumns({
        c + suffix: F.when(F.count(F.col(c)).over(w) == n, F.avg(F.col(c)).over(w))
        for c in cols})


def lag_within(df: DataFrame, entity: Sequence[str] | str, order: str,
               cols: Sequence[str], k: int = 1, suffix: str = "_lag1") -> DataFrame:
    """Per-entity lag."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    w = Window.partitionBy(*entity).orderBy(order)
    return df.withColumns({c + suffix: F.lag(F.col(c), k).over(w) for c in cols})


def interpolate_linear(df: DataFrame, entity: Sequence[str] | str, x: str,
                       cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Interior linear interpolation of NULLs along ``x``.

    Leading and trailing NULLs stay NULL; an entity with fewer than two known
    points is unchanged.  Two ignore-nulls frames find the known neighbours.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    w = Window.partitionBy(*entity).orderBy(x)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    out = {}
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(x).cast("double").alias("x"),
                                                     F.col(c).cast("double").alias("v")))
        p = F.last(known, ignorenulls=True).over(back)
        q = F.first(known, ignorenulls=True).over(fwd)
        est = p["v"] + (q["v"] - p["v"]) * F.try_divide(F.col(x).cast("double") - p["x"], q["x"] - p["x"])
        out[c + suffix] = F.coalesce(F.col(c).cast("double"), est)
    return df.withColumns(out)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key under an explicit order (A8, quirk Q4).

    ``row_number() = 1`` gets the engine's group limit: each task keeps one row
    per key before the shuffle, so a key holding a third of the rows costs no
    more than any other.  NULLs in ``order`` sort last; ties on ``order`` are
    broken by the remaining columns, so the result is deterministic.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order], *rest)
    return df.withColumn("_turn", F.row_number().over(w)).filter(F.col("_turn") == 1).select(*df.columns)


def regime_diff(df: DataFrame, entity: Sequence[str] | str, regime: str, cols: Sequence[str],
                post=1, pre=0, template: str = "{col}_diff") -> DataFrame:
    """Per-entity ``x[post] - x[pre]`` (A10, quirk Q10).

    Entities need exactly one row in each regime, else they drop out.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    r = F.col(regime)
    aggs = [(F.max(F.when(r == post, F.col(c))) - F.max(F.when(r == pre, F.col(c))))
            .alias(template.format(col=c)) for c in cols]
    aggs += [F.count_if(r == post).alias("_n_post"), F.count_if(r == pre).alias("_n_pre")]
    return (df.groupBy(*entity).agg(*aggs)
              .filter((F.col("_n_post") == 1) & (F.col("_n_pre") == 1))
              .drop("_n_post", "_n_pre"))


def group_row_ranges(df: DataFrame, group: str, first: str = "first_row",
                     last: str = "last_row", partitions: int | None = None) -> DataFrame:
    """First/last 1-based row number of each group in a table ordered by group.

    Only group sizes are aggregated, once; their running sum is the distributed
    one (LONG throughout), so a billion groups never meet in one task.
    """
    from .prefix import prefix_sum
    counts = cut_lineage(df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")))
    ends = prefix_sum(counts, [group], "_n", out="_end", index="_i", partitions=partitions)
    return ends.select(group, (F.col("_end") - F.col("_n") + 1).alias(first), F.col("_end").alias(last))
