"""Wide <-> long reshaping.

Long -> wide is written as *conditional aggregation* over an explicit value
list: one hash aggregate with map-side partial combine, one shuffle on the id
keys.  (``groupBy().pivot()`` plans two aggregates and, without a value list,
an extra job to discover the values.)
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    """Column names whose type is one of ``types`` (P5: select by type)."""
    types = types or NUMERIC_TYPES
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Column names starting with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
            variable: str = "variable", value: str = "value",
            cast: str | None = None) -> DataFrame:
    """Wide -> long (R1-R4).  ``values=None`` means every non-id column.

    Rows whose value is NULL are kept, like the reference's pivot.  The value
    columns must share a type; ``cast`` forces one.
    """
    ids = list(ids)
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    if cast:
        df = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in values])
    return df.unpivot(ids, values, variable, value)


def safe_name(v) -> str:
    """Column-name template for a pivoted value: '4-NOT SPECIFIED' -> 'not_specified'."""
    s = re.sub(r"^[0-9]+-", "", str(v)).strip().lower()
    return re.sub(r"[^0-9a-z]+", "_", s).strip("_")


def _masked(agg: Callable[[Column], Column], c: Column) -> Column:
    """Aggregate over a CASE-masked column: ``first``/``last`` must skip the
    masked-out NULLs explicitly; other aggregates skip NULLs anyway.  With
    unique keys (R8, ``assert_unique``) every choice gives the same value."""
    return agg(c, ignorenulls=True) if agg in (F.first, F.last) else agg(c)


def pivot_wide(df: DataFrame, ids: Sequence[str] | None, names_from: str,
               values: Sequence, value_col: str | None = None,
               agg: Callable[[Column], Column] = F.first,
               name: Callable = safe_name, unique: bool = False) -> DataFrame:
    """Long -> wide with an explicit value list.

    ``unique`` makes several rows for one cell an error of the same aggregation
    (R8), named by the cell's column.

    Every listed value yields a column even if absent from the data (NULL).
    ``ids=None`` takes every column except ``names_from``/``value_col`` (R6).
    ``value_col=None`` counts rows per value (NULL when absent).
    """
    ids = [c for c in df.columns if c not in (names_from, value_col)] if ids is None else list(ids)
    key = F.col(names_from)
    outs = []
    for v in values:
        hit = key == F.lit(v)
        if value_col is None:
            outs.append(F.sum(F.when(hit, F.lit(1))).alias(name(v)))
        else:
            cell = _masked(agg, F.when(hit, F.col(value_col)))
            if unique:
                again = F.raise_error(F.lit(f"several rows for one cell of pivot column {name(v)}")).cast(df.schema[value_col].dataType)
                cell = F.when(F.count_if(hit) > 1, again).otherwise(cell)
            outs.append(cell.alias(name(v)))
    return df.groupBy(*ids).agg(*outs)


def pivot_multi(df: DataFrame, ids: Sequence[str], names_from: str, values: Sequence,
                value_cols: Sequence[str], agg: Callable[[Column], Column] = F.first,
                template: str = "{value}_{name}") -> DataFrame:
    """Long -> wide over several value columns at once.

    Output names follow ``template`` (``mean_pre``), not Spark's ``pre_mean``.
    """
    outs = []
    for vc in value_cols:
        for v in values:
            picked = F.when(F.col(names_from) == F.lit(v), F.col(vc))
            outs.append(_masked(agg, picked).alias(template.format(value=vc, name=v)))
    return df.groupBy(*ids).agg(*outs)


def duplicate_pivot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``keys`` that occur more than once (R8: would become list cells)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` is not unique; one aggregation, returns 0/1 row."""
    dup = duplicate_pivot_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate pivot keys {list(keys)}: {dup[0].asDict()}")
