"""One row per key, with a survivor that does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from smeltery.functions.columns import quoted
from smeltery.operators.sizing import BROADCAST_ROWS

# What identifies a claim.
CLAIM_KEYS = ("claim_id", "patient_id", "service_date", "procedure_code")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[str]:
    """``order_by`` and then all remaining columns that have an order, keys left out."""
    types = {f.name: f.dataType for f in df.schema.fields}
    ranked = [c for c in order_by if c not in keys]
    return ranked + [c for c in df.columns if c not in keys and c not in ranked and _orderable(types[c])]


def pick_one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), *,
                     latest: bool = False, keep: Sequence[str] | None = None) -> DataFrame:
    """The lowest (or, with ``latest``, the highest) row of every key.

    Rows compare by ``order_by`` first and then by all remaining columns that
    have an order, so only identical rows can tie.  ``keep`` names the columns
    that are wanted: no other is carried along, and rows that tie in
    ``order_by`` compare by these alone.  Null keys form a group of their own.

    With ``keep`` the survivor is a minimum over the few columns left; whole rows,
    and those with columns that have no order, are ranked.  Either way a map task
    reduces a key to one row before the shuffle, so a hot key is no burden.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("de-duplication needs at least one key column")
    wanted = [c for c in df.columns if keep is None or c in keep]
    if keep is not None:
        df = df.select(*[quoted(c) for c in df.columns if c in {*keys, *order_by, *keep}])
    ranked = total_order(df, keys, order_by)
    if not ranked:
        return df.dropDuplicates(keys).select(*[quoted(c) for c in wanted])
    # A hash of the key comes first: one comparison of numbers settles nearly all of a sort by key.
    df = df.withColumn("_key_hash", F.xxhash64(*[quoted(c) for c in keys]))
    if keep is not None and len(ranked) + len(keys) + 1 == len(df.columns):
        best = (F.max if latest else F.min)(F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(ranked)]))
        found = df.groupBy("_key_hash", *[quoted(c) for c in keys]).agg(best.alias("_row"))
        place = {c: F.col(f"_row.c{i}").alias(c) for i, c in enumerate(ranked)}
        return found.select(*[place.get(c, F.col(quoted(c))) for c in wanted])
    direction = [F.col(quoted(c)).desc_nulls_last() if latest else F.col(quoted(c)).asc_nulls_first() for c in ranked]
    rank = F.row_number().over(Window.partitionBy("_key_hash", *[quoted(c) for c in keys]).orderBy(*direction))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).select(*[quoted(c) for c in wanted])


def pick_one_of_stored(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), *, scratch: str,
                       keep: Sequence[str] | None = None, max_repeated: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of :func:`pick_one_per_key` for a frame that reads files, so that reading it again is cheap.

    Hashes of keys that occur more than once are found first and kept below
    ``scratch``.  Rows under any other hash are the only ones of their key and
    stay where they are; the rest is ranked.  Where more than ``max_repeated``
    hashes repeat, all rows are ranked.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("de-duplication needs at least one key column")
    hashed = df.withColumn("_key_hash", F.xxhash64(*[quoted(c) for c in keys]))
    repeated = hashed.groupBy("_key_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_key_hash")
    repeated.write.parquet(scratch)
    repeated = df.sparkSession.read.schema(repeated.schema).parquet(scratch)
    if repeated.count() > max_repeated:
        return pick_one_per_key(df, keys, order_by, keep=keep)
    single = hashed.join(F.broadcast(repeated), "_key_hash", "left_anti")
    others = hashed.join(F.broadcast(repeated), "_key_hash", "left_semi").select(*[quoted(c) for c in df.columns])
    wanted = [quoted(c) for c in df.columns if keep is None or c in keep]
    return single.select(*wanted).unionByName(pick_one_per_key(others, keys, order_by, keep=keep))


def dedupe_claims(df: DataFrame, order_by: Sequence[str] = (), keep: Sequence[str] | None = None,
                  scratch: str | None = None) -> DataFrame:
    """Keys are taken from the canonical columns, so alias-named sources keep theirs.

    With ``scratch`` the claims are taken to be stored (:func:`pick_one_of_stored`).
    """
    keys = [k for k in CLAIM_KEYS if k in df.columns]
    if scratch is not None:
        return pick_one_of_stored(df, keys, order_by, scratch=scratch, keep=keep)
    return pick_one_per_key(df, keys, order_by, keep=keep)
