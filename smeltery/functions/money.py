"""Exact sums and averages for amounts held as doubles.

Adding doubles depends on the order in which partitions arrive.  Decimal
addition does not, so totals are the same on every cluster and every run.
Amounts keep twelve fractional digits and sixteen before the point; their sums
have room for ten more.  What a decimal cannot hold (NaN, the infinities and
larger amounts) stays out of sums and averages and is counted by :func:`unfit`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT = "decimal(28,12)"


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def exact(column: Column | str) -> Column:
    return _column(column).try_cast(EXACT)


def unfit(column: Column | str) -> Column:
    """How many values are there but not among those added."""
    return F.count_if(_column(column).isNotNull() & exact(column).isNull())


def total(column: Column | str, digits: int = 2) -> Column:
    return F.round(F.sum(exact(column)), digits).cast("double")


def mean(column: Column | str, digits: int = 2) -> Column:
    return F.round(F.avg(exact(column)), digits).cast("double")


def lowest(column: Column | str, digits: int = 2) -> Column:
    return F.round(F.min(column), digits)


def highest(column: Column | str, digits: int = 2) -> Column:
    return F.round(F.max(column), digits)


def distinct(column: Column | str, approximate: bool = False) -> Column:
    """Distinct count; the approximate form keeps one small sketch per group."""
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)
