"""The customer dimension as a table in parts: first load, merges, validation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from smeltery.operators.merge import CUSTOMER_KEY, bootstrap_customers, merge_report, merge_scd1
from smeltery.plans.parted import PartedTable

ACTIONS = ("insert", "update", "soft_delete", "keep")


def bootstrap(table: PartedTable, customers: DataFrame, as_of: dt.datetime | None = None) -> int:
    """The first version of the dimension; a second one is refused."""
    return table.create(bootstrap_customers(customers, as_of), "BOOTSTRAP")


def apply_changes(table: PartedTable, changes: DataFrame, *, as_of: dt.datetime | None = None, **options) -> Mapping[str, int]:
    """Merge one batch of changes into the parts it touches; returns the rows per action.

    ``options`` are those of :func:`merge_scd1`.  ``keep`` counts the unchanged
    rows of the touched parts; rows of other parts are neither read nor counted.
    """
    def combine(present: DataFrame, batch: DataFrame) -> DataFrame:
        return merge_scd1(present, batch, as_of=as_of, with_action=True, **options)

    return table.merge(changes, [CUSTOMER_KEY], combine, actions=ACTIONS)


def updated_sample(dimension: DataFrame, since: dt.datetime, n: int, new_id_floor: int) -> DataFrame:
    """The ``n`` lowest existing keys whose row was loaded at ``since`` or later."""
    changed = (F.col("load_ts") >= F.lit(since)) & (F.col(CUSTOMER_KEY) <= new_id_floor)
    return dimension.where(changed).orderBy(CUSTOMER_KEY).limit(n)


def validation(dimension: DataFrame, since: dt.datetime, n: int, new_id_floor: int) -> DataFrame:
    """The counts of :func:`merge_report` beside each of the ``n`` sampled updated keys."""
    sample = updated_sample(dimension, since, n, new_id_floor).select(
        F.col(CUSTOMER_KEY).alias("sample_key"), F.col("email").alias("sample_email"),
        F.col("record_source").alias("sample_source"))
    report = merge_report(dimension, new_id_floor)
    # One row of counts and n sampled rows, both of a fixed size.
    keyed = report.withColumn("_one", F.lit(1)).join(sample.withColumn("_one", F.lit(1)), "_one", "left")
    return keyed.drop("_one")
