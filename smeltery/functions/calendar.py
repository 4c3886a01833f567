"""Calendar attributes and time shifts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sunday and Saturday in dayofweek numbering.
WEEKEND_DAYS = (1, 7)


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "order__year": F.year(ts),
        "order__month": F.month(ts),
        "order__day_of_week": F.date_format(ts, "EEEE"),
        "order__hour": F.hour(ts),
        "order__is_weekend": F.when(F.dayofweek(ts).isin(*WEEKEND_DAYS), "Y").otherwise("N"),
    }


def year_month(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def shift_back(ts: Column, *, days: int = 0, hours: int = 0, seconds: Column | int = 0) -> Column:
    """``ts`` moved into the past by a day-time interval."""
    amount = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts - F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(0), amount)


def since_yesterday(column: Column, as_of: Column) -> Column:
    """From 00:00 of the day before ``as_of``: between 24 and 48 hours back."""
    return column >= F.date_sub(as_of, 1)
