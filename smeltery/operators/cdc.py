"""Change batches and change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from smeltery.operators.merge import Matched, Missing, latest_by, merge

# Operation codes of a database change log.
OP_DELETE = 1
OP_INSERT = 2
OP_BEFORE_UPDATE = 3
OP_AFTER_UPDATE = 4
OP_COLUMN = "__$operation"


def cdc_batch(updates: DataFrame, inserts: DataFrame, soft_deletes: DataFrame) -> DataFrame:
    """One batch from three feeds, matched by column name."""
    return updates.unionByName(inserts).unionByName(soft_deletes)


def with_operation(batch: DataFrame, known_from: int) -> DataFrame:
    """Name each row's operation: inactive rows delete, keys above ``known_from`` insert."""
    kind = (
        F.when(~F.col("is_active"), "soft_delete")
        .when(F.col("customer_id") > known_from, "insert")
        .otherwise("update")
    )
    return batch.withColumn("operation", kind)


def apply_change_log(target: DataFrame, log: DataFrame, keys: Sequence[str], sequence: str,
                     strategy: str = "auto") -> DataFrame:
    """Replay a log: only the last operation of a key counts, before-images never do."""
    effective = log.filter(F.col(OP_COLUMN) != OP_BEFORE_UPDATE)
    last = latest_by(effective, keys, [sequence])
    values = {c: f"source.`{c}`" for c in target.columns}
    deleted = f"source.`{OP_COLUMN}` = {OP_DELETE}"
    return merge(
        target, last, keys,
        [Matched("delete", deleted, delete=True), Matched("update", None, values)],
        Missing(values, condition=f"NOT ({deleted})"),
        strategy=strategy,
    )
