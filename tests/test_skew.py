"""Hot keys: the plans that run must split or thin them, and results must stay whole."""

import contextlib

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from smeltery.operators import dedupe, merge as G
from smeltery.operators.layout import gather_by_key

EAGER_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def target(spark, folder):
    """A third of the rows on one key, another third without a key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)
    df = spark.range(0, 30_000, 1, 8).select(key.alias("k"), F.col("id").alias("n"), text.alias("v"))
    df.write.parquet(f"{folder}/target")
    return spark.read.parquet(f"{folder}/target")


def changes(spark):
    return spark.range(0, 2000).select(F.col("id").alias("k"), (-F.col("id")).alias("n"), F.lit("new").alias("v"))


def test_shuffled_merge_splits_a_hot_target_key(spark, target):
    with settings(spark, EAGER_SPLITS):
        merged = G.upsert(target, changes(spark), ["k"], strategy="shuffle")
        whole = merged.collect()
        assert "skew=true" in plan(merged)
    missing = changes(spark).join(target, "k", "left_anti").count()
    assert len(whole) == target.count() + missing
    assert sum(r.v == "new" for r in whole) == target.filter("k < 2000").count() + missing


def test_broadcast_and_shuffled_merge_agree_on_skewed_keys(spark, target):
    a, b = (G.upsert(target, changes(spark), ["k"], strategy=s) for s in ("broadcast", "shuffle"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_one_row_per_hot_key_and_for_missing_keys(spark, target):
    one = dedupe.pick_one_per_key(target, ["k"], ["n"])
    assert rows(one.filter("k = 7 OR k IS NULL"), "k", "n") == [(None, 2), (7, 0)]
    assert one.count() == target.select("k").distinct().count()


def test_hot_partition_value_fills_several_files(spark, target, folder):
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}):
        laid = target.withColumn("day", F.when(F.col("k") == 7, "hot").otherwise("cold"))
        gather_by_key(laid, "day", partitions=4).write.partitionBy("day").parquet(f"{folder}/out")
    out = spark.read.parquet(f"{folder}/out")
    assert sum("day=hot" in f for f in out.inputFiles()) > 1
    assert out.count() == target.count()
