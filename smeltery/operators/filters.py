"""Row filters shared by loads, state and validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

Cursor = dt.datetime | int


def cursor_literal(df: DataFrame, column: str, value: Cursor) -> Column:
    """``value`` as a literal of the column's own type, so the comparison reaches the file scan.

    Datetimes are naive: wall clock for a column without time zone, UTC otherwise.
    """
    kind = df.schema[column].dataType
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
        if isinstance(kind, T.TimestampType):
            text += "Z"
        return F.lit(text).cast(kind)
    return F.lit(value).cast(kind)


def between_cursors(df: DataFrame, column: str, after: Cursor | None, upto: Cursor | None) -> DataFrame:
    """Rows with ``after < column <= upto``; an absent bound is open."""
    if after is not None:
        df = df.filter(F.col(column) > cursor_literal(df, column, after))
    if upto is not None:
        df = df.filter(F.col(column) <= cursor_literal(df, column, upto))
    return df


def since_partition(df: DataFrame, partition_column: str, after: Cursor | None) -> DataFrame:
    """The bound a timestamp cursor implies for a column that holds its date, so older folders are not listed.

    A day of slack covers session time zones: the mark is UTC, the date local.
    """
    if not isinstance(after, dt.datetime):
        return df
    return df.filter(F.col(partition_column) >= F.lit(after.date() - dt.timedelta(days=1)))


def highest_cursor(df: DataFrame, column: str) -> Cursor | None:
    """Highest value of the cursor column, a single scalar."""
    top = F.max(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        micros = df.agg(F.unix_micros(top)).first()[0]
        return None if micros is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    return df.agg(top).first()[0]


def without(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows a DELETE with ``condition`` would leave: those where it is false or unknown."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(test, F.lit(False)))
