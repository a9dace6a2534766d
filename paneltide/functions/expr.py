"""Scalar Column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column) -> Column:
    """A measure with NaN as missing: NULL where the value is NULL or NaN."""
    return F.when(~F.isnan(col(c)), col(c))


def cents(c: str | Column) -> Column:
    """A 2-decimal money value as integer cents (integer-valued DOUBLE)."""
    return F.round(col(c) * 100)


def exact_sum_int(c: Column) -> Column:
    """Exact sum of integer-valued terms, independent of summation order.

    Terms are BIGINTs.  Their low 32 bits and the rest are summed apart as
    LONGs, each of which holds 2^31 full terms, and joined as DECIMAL(38, 0):
    the scan adds longs, only the group's result is a decimal.
    """
    n = c.cast("long")
    low, high = F.sum(n.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(n, 32))
    return high.cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(11,0)") + low.cast("decimal(38,0)")


def mean_cents(c: str | Column) -> Column:
    """Exact mean of 2-decimal values: integer sum, one IEEE division.

    A double ``avg`` depends on summation order in the last bits; this does
    not, so any engine computing it the same way gets the identical double.
    """
    return F.try_divide(exact_sum_int(cents(c)), F.count(col(c)) * F.lit(100.0))


def sum_cents(c: str | Column) -> Column:
    """Exact sum of 2-decimal values as a double."""
    return exact_sum_int(cents(c)) / F.lit(100.0)


def flag(cond: Column) -> Column:
    """0/1 indicator; NULL conditions give 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag_in(c: str | Column, values: Sequence) -> Column:
    """0/1 membership flag (F3): ``ifelse(x %in% values, 1, 0)``."""
    return flag(col(c).isin(list(values)))


def zero_to_null(c: str | Column) -> Column:
    """treat 0 as missing."""
    return F.nullif(col(c), F.lit(0))


def month_label(ts: str | Column) -> Column:
    """Timestamp -> 'MM-yyyy' column label (the landing files' month headers)."""
    return F.date_format(col(ts), "MM-yyyy")


def parse_month_label(label: str | Column) -> Column:
    """'MM-yyyy' -> first-of-month DATE (E6); unparsable -> NULL."""
    return F.try_to_date(col(label), "MM-yyyy")


def month_start(ts: str | Column) -> Column:
    """First day of the month as DATE, from calendar fields (no time-zone
    conversion, so TIMESTAMP_NTZ input gives the same answer in any session)."""
    return F.make_date(F.year(col(ts)), F.month(col(ts)), F.lit(1))


def hour_start(ts: str | Column) -> Column:
    """Timestamp truncated to the hour as TIMESTAMP_NTZ, from calendar fields."""
    t = col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def year_start(year: str | Column) -> Column:
    """``as.Date(paste0(year, '-01-01'))``."""
    return F.make_date(col(year), F.lit(1), F.lit(1))


def strip_prefix(c: str | Column, pattern: str) -> Column:
    """Anchored single replacement, ``sub('^X', '', s)``."""
    return F.regexp_replace(col(c), "^(?:" + pattern + ")", "")


def split_piece(c: str | Column, pattern: str, i: int) -> Column:
    """``str_split(s, regex)[[1]][i]`` with a 1-based index (E1); NULL past the end."""
    return F.get(F.split(col(c), pattern), F.lit(i - 1))
