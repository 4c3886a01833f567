"""Run metrics and drift events kept as tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from smeltery.functions.columns import instant
from smeltery.operators.drift import Drift, drift_report, repair_if_drifted, widen_types
from smeltery.operators.merge import ACTION
from smeltery.plans.snapshot import Snapshots, publish_verified, read_if_exists
from smeltery.plans.state import DriftReports, SavedSchemas

DRIFT_LOG = (
    "table_name string, column_name string, kind string, from_type string, to_type string, "
    "filled bigint, lost_values bigint, detected_at timestamp"
)


def publish_merge(sink: Snapshots, merged: DataFrame,
                  actions: Sequence[str] = ("insert", "update", "soft_delete", "keep")) -> int:
    """Publish a merge that kept its action column, with the rows per action as metrics.

    The counts are taken by the write itself, so the merge runs once.
    """
    seen = Observation()
    counted = merged.observe(seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in actions])
    earlier = sink.history(1).first()
    rows = sink.publish(counted.drop(ACTION), "MERGE", metrics=lambda total: _merge_metrics(seen, earlier, total))
    return rows


def _merge_metrics(seen: Observation, earlier, total: int) -> dict[str, int]:
    metrics = {action: int(n) for action, n in seen.get.items()}
    if earlier is not None:
        metrics["delete"] = earlier["row_count"] + metrics.get("insert", 0) - total
    return metrics


def log_drift(df: DataFrame, drift: Drift, path: str, at: dt.datetime | None = None) -> None:
    """Append every difference of one run to the drift log."""
    lines = drift_report(df, drift).withColumn("detected_at", instant(at))
    lines.coalesce(1).write.mode("append").parquet(path)


def drift_log(spark: SparkSession, path: str) -> DataFrame:
    lines = read_if_exists(spark, path, DRIFT_LOG)
    return lines if lines is not None else spark.createDataFrame([], DRIFT_LOG)


def snapshot_with_drift(df: DataFrame, table: str, name: str, root: str, *, keep_saved_types: bool = False,
                        at: dt.datetime | None = None) -> int:
    """One snapshot of a source table: compare with the schema before, log, repair, publish, remember.

    What arrives is compared with what arrived last, so a difference is logged
    in the run that brings it and not again.  The frame is repaired towards the
    columns and types that are published.  Every report is kept as JSON.  Small
    number types are widened first, in every run alike.
    """
    spark, df = df.sparkSession, widen_types(df)
    saved = SavedSchemas(spark, f"{root}/schemas", table)
    known = saved.get()
    drift = Drift(table, known if known is not None else df.schema, df.schema)
    if drift.has_drift:
        log_drift(df, drift, f"{root}/drift_log", at)
    DriftReports(spark, f"{root}/drift_reports", table).save(drift)
    folder = f"{root}/tables/{table}"
    sink = Snapshots(spark, folder)
    published = Drift(table, sink.read().schema if sink.exists() else df.schema, df.schema)
    repaired = repair_if_drifted(df, published, keep_saved_types=keep_saved_types, stamp=False)
    rows = publish_verified(repaired, name, folder)
    saved.save(df.schema)
    return rows


def snapshot_all(frames: Mapping[str, DataFrame], root: str, names: Mapping[str, str], **options) -> dict[str, int]:
    """Every configured table through :func:`snapshot_with_drift`; returns rows per table."""
    return {table: snapshot_with_drift(df, table, names[table], root, **options) for table, df in frames.items()}


def verify_tables(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """Rows and columns of each published table, as its readers see it."""
    checks = []
    for table, name in names.items():
        seen = spark.table(name)
        checks.append(seen.agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.lit(len(seen.columns)).alias("column_count")))
    return reduce(DataFrame.unionByName, checks)


def verify_sample(spark: SparkSession, names: Mapping[str, str], keys: Mapping[str, str], n: int = 3) -> DataFrame:
    """The ``n`` rows of each published table with the lowest keys, as JSON, the way its readers see them."""
    samples = []
    for table, name in names.items():
        seen = spark.table(name).orderBy(keys[table]).limit(n)
        samples.append(seen.select(F.lit(table).alias("table_name"), F.to_json(F.struct("*")).alias("sample")))
    return reduce(DataFrame.unionByName, samples)
