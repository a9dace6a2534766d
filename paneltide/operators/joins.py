"""Join helpers the reference relies on (J4 suffixes, J5 natural, J6 scalar).

Size policy: tables with a bound that does not grow with the data (literal
dimensions, the 25-row nation table, 1-row scalars, grids, per-partition
offsets) are wrapped in ``broadcast``.  Everything whose size depends on the
data (agency mappings, county x year panels) is left to the planner: AQE measures the real shuffle output
and converts to a broadcast join only under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, else a sort-merge join
with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suffix_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                suffix: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join where non-key columns present on both sides get suffixes."""
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    l2 = left.select(*[F.col(c).alias(c + suffix[0]) if c in clash else F.col(c)
                       for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffix[1]) if c in clash else F.col(c)
                        for c in right.columns])
    return l2.join(r2, on=on, how=how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on every common column name."""
    on = [c for c in left.columns if c in set(right.columns)]
    if not on:
        raise ValueError("natural join without common columns")
    return left.join(right, on=on, how=how)


def scalar(agg: DataFrame) -> Column:
    """Scalar subquery over a global aggregate.

    ``agg`` must return exactly one row and one column (e.g. ``select(min(x))``
    or ``select(struct(...))``).  Spark runs it once and inlines the value as a
    literal: no cross join, nothing grows with the data.
    """
    return agg.scalar()
