"""Session defaults for tests, the bench and stand-alone use.

On a cluster the caller's session is used as it is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle width that keeps a partition near 128 MB and every core busy."""
    by_size = -(-input_bytes // TARGET_PARTITION_BYTES)
    return max(cores, by_size)


def local_session(cores: int | str = "*", *, app: str = "smeltery", input_bytes: int = 0) -> SparkSession:
    width = shuffle_partitions_for(input_bytes, 8 if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
