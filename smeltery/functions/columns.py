"""Column-level building blocks of the silver layer."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    """The name as one part of a column path, whatever dots it holds."""
    return "`" + name.replace("`", "``") + "`"


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore every column name.

    Two headings that end up alike would make every later reference
    ambiguous, so that is an error here.
    """
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted(n for n, seen in Counter(names).items() if seen > 1)
    if clashes:
        raise ValueError(f"columns collide after normalisation: {clashes}")
    return df.toDF(*names)


def resolve_column(df: DataFrame, candidates: Sequence[str], dtype: T.DataType | str = "string") -> Column:
    """First candidate that exists in ``df``, or a null of ``dtype``.

    Presence decides, not the value: a null in the first candidate does not
    fall through to the second.
    """
    present = set(df.columns)
    for name in candidates:
        if name in present:
            return F.col(name)
    return F.lit(None).cast(dtype)


def type_of(df: DataFrame, column: Column) -> T.DataType:
    return df.select(column.alias("c")).schema["c"].dataType


def tolerant_date(df: DataFrame, column: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of a raw column; text that does not parse becomes null."""
    kind = type_of(df, column)
    if isinstance(kind, T.StringType):
        return F.try_to_date(column, fmt)
    return column.cast("date")


def tolerant_timestamp(df: DataFrame, column: Column) -> Column:
    kind = type_of(df, column)
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(column)
    return column.cast("timestamp")


def tolerant_number(column: Column, dtype: str) -> Column:
    return column.try_cast(dtype)


def tidy(column: Column) -> Column:
    return F.trim(column)


def tidy_upper(column: Column) -> Column:
    return F.upper(F.trim(column))


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def with_audit(df: DataFrame, stamps: Mapping[str, object], loaded_at: str | None = None,
               as_of: dt.datetime | None = None) -> DataFrame:
    """Add constant audit columns and, when named, a load timestamp."""
    added = {name: F.lit(value) for name, value in stamps.items()}
    if loaded_at:
        added[loaded_at] = F.current_timestamp() if as_of is None else instant(as_of)
    return df.withColumns(added) if added else df


def instant(moment: dt.datetime | None) -> Column:
    """Timestamp literal of a naive UTC datetime, whatever the session time zone."""
    if moment is None:
        return F.current_timestamp()
    return F.lit(moment.isoformat(sep=" ") + "Z").cast("timestamp")
