"""Snapshot reads from a relational database.

The connection comes from the caller; no host or credential lives here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def key_range(spark: SparkSession, url: str, table: str, column: str,
              properties: Mapping[str, str]) -> tuple[int, int] | None:
    """Lowest and highest key, computed by the database; None for an empty table."""
    probe = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) key_range"
    got = spark.read.jdbc(url=url, table=probe, properties=dict(properties)).first()
    return None if got is None or got[0] is None else (int(got[0]), int(got[1]))


def spread_predicates(column: str, partitions: int) -> list[str]:
    """Partition filters for keys with gaps or hot ranges: by remainder, nulls in the first."""
    def remainder(i: int) -> str:
        return f"ABS(MOD({column}, {partitions})) = {i}"

    return [f"({remainder(0)} OR {column} IS NULL)"] + [remainder(i) for i in range(1, partitions)]


def read_snapshot(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], *,
                  partition_column: str | None = None, partitions: int = 1, spread: bool = False) -> DataFrame:
    """Whole table; with a numeric ``partition_column`` over several connections.

    Ranges are equal strides between the lowest and highest key; ``spread``
    splits by remainder instead, which stays even when keys are not.
    """
    properties = dict(properties)
    if partition_column is None or partitions <= 1:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    if spread:
        return spark.read.jdbc(url=url, table=table, properties=properties,
                               predicates=spread_predicates(partition_column, partitions))
    bounds = key_range(spark, url, table, partition_column, properties)
    if bounds is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    low, high = bounds
    return spark.read.jdbc(url=url, table=table, column=partition_column, lowerBound=low,
                           upperBound=high + 1, numPartitions=partitions, properties=properties)
