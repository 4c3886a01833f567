"""Physical layout: clustering, re-partitioning, partition sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T


def cluster_by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys`` so files carry narrow key ranges.

    A hash of the row is the last range column, so rows of one hot key may
    fill several neighbouring partitions instead of one.
    """
    spread = F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    by = [*[F.col(k) for k in keys], spread]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*keys)


def gather_by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Bring rows of a key together; adaptive execution splits a partition that grows too large."""
    return df.hint("rebalance", *([partitions] if partitions else []), *keys)


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per physical partition of the plan."""
    tagged = df.select(F.spark_partition_id().alias("partition_id"))
    return tagged.groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows"))


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """Per file of a frame read from files: its rows, and the lowest and highest key in it."""
    placed = df.select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
    return placed.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))


def lookup_cost(df: DataFrame, key: str) -> DataFrame:
    """What a lookup of one key opens: rows, files, files that meet the ranges before them, and a share of files.

    ``share`` is the mean over all rows of the files whose range meets that of
    the row's file, over all files: one over the files when ranges do not meet,
    one for a plain copy.  Only one line per file is sorted, not the rows.
    """
    ranges = file_ranges(df, key).where("low IS NOT NULL")

    def edge(key: str, kind: int, starts: int = 0, ends: int = 0, rows: str = "0L", sign: int = 0) -> DataFrame:
        return ranges.selectExpr(f"{key} AS key", f"{kind} AS kind", f"{starts} AS starts", f"{ends} AS ends",
                                 f"{rows} AS rows", f"{sign} AS sign")

    # In key order: a file meets those that start up to its end, less those that end before its start.
    walk = reduce(DataFrame.unionByName, [edge("low", 0, rows="rows", sign=-1), edge("low", 1, starts=1),
                                          edge("high", 2, rows="rows", sign=1), edge("high", 3, ends=1)])
    so_far = Window.orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = walk.select("rows", "sign", F.sum("starts").over(so_far).alias("started"), F.sum("ends").over(so_far).alias("ended"))
    met = F.when(F.col("sign") > 0, F.col("rows") * F.col("started")).when(F.col("sign") < 0, -F.col("rows") * F.col("ended"))
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    files = (ranges.withColumn("before", F.max("high").over(before))
             .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.count_if(F.col("low") <= F.col("before")).alias("meeting")))
    opened = walked.agg(F.sum(met).alias("opened"))
    return (files.withColumn("_one", F.lit(1)).join(opened.withColumn("_one", F.lit(1)), "_one")
            .select("rows", "files", "meeting", (F.col("opened") / F.col("rows") / F.col("files")).alias("share")))
