"""Measured bounds behind every broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

from smeltery.functions.columns import quoted

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 2_000_000

# Key types whose range is taken over as filter literals.
_RANGED = (T.IntegerType, T.LongType, T.ShortType, T.StringType)


@dataclass(frozen=True)
class BatchSize:
    rows: int
    max_copies: int
    key_ranges: Mapping[str, tuple[object, object]] = field(default_factory=dict)

    def within_range(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose keys lie where the batch has keys at all.

        The bounds reach the file scan, which skips row groups and files outside them.
        """
        for key, (low, high) in self.key_ranges.items():
            df = df.filter(F.col(key).between(F.lit(low), F.lit(high)))
        return df


def row_bytes(schema: T.StructType) -> Column:
    """Width of a row in memory: 8 bytes a column plus the length of its variable part."""
    widths = []
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.lit(16) + F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            text = F.to_json(F.struct(F.col(quoted(field.name))))
            widths.append(F.lit(64) + 2 * F.coalesce(F.octet_length(text), F.lit(0)))
        else:
            widths.append(F.lit(16))
    return reduce(add, widths, F.lit(8))


def fits_broadcast(df: DataFrame, rows: int, max_bytes: int = BROADCAST_BYTES,
                   max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame of ``rows`` rows is small enough to send to every executor.

    The width is measured only for frames that are short enough.
    """
    if rows > max_rows:
        return False
    return (df.agg(F.sum(row_bytes(df.schema).cast("long"))).first()[0] or 0) <= max_bytes


def measure(df: DataFrame, keys: Sequence[str]) -> BatchSize:
    """Rows, highest number of copies of one key and key ranges, from the key columns alone.

    Null keys match nothing in a join, so their copies do not count.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ranged = [k for k in keys if isinstance(df.schema[k].dataType, _RANGED)]
    bounds = [b for i, k in enumerate(ranged) for b in (F.min(k).alias(f"lo{i}"), F.max(k).alias(f"hi{i}"))]
    got = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("copies"),
        *bounds,
    ).first()
    ranges = {k: (got[f"lo{i}"], got[f"hi{i}"]) for i, k in enumerate(ranged) if got[f"lo{i}"] is not None}
    return BatchSize(got["rows"], got["copies"], ranges)
