"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per query.

Each query reads the driver tables at ``sf_dir`` (or data Spark derives from
them) and returns a DataFrame.  Plans are lazy but for what decides the plan:
fits whose coefficients enter a second pass as literals, key-range bounds, KDE
limits and one checkpoint run small jobs while the query is built.  Floating results are rounded at the very
end (``finish``) so that an independent engine summing in another order
yields identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None,
           exact: tuple[str, ...] = ()) -> DataFrame:
    """Round every DOUBLE column to ``digits`` (per-column ``overrides``).

    Columns in ``exact`` are computed order-independently (integer sums, one
    division) and are left unrounded.
    """
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exact:
            cols.append(F.round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    ship_package(spark)          # workers import the package for UDF steps
    return Tables(spark, sf_dir)


# Importing the modules registers their queries.
from . import q_geo, q_panel, q_relational, q_stats  # noqa: E402,F401
