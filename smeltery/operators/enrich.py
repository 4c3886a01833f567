"""Derived order columns and null repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smeltery.functions import columns as C
from smeltery.functions.calendar import calendar_parts
from smeltery.functions.masking import mask_email

# Price below which the discount flag is set, order tiers in
# cents, and the defaults used by null repair; the flags Y and N and the tier
# labels high, medium and low below are fixed as well.
DISCOUNT_BELOW = 50
TIER_HIGH = 500
TIER_MEDIUM = 100
REPAIR_DEFAULTS = {"payment__currency": "USD", "item__quantity": 1, "item__price": 0.0}


def standardize_contact(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "payment__currency": C.tidy_upper(F.col("payment__currency")),
        "customer__email_masked": mask_email("customer__email"),
    })


def line_values(df: DataFrame) -> DataFrame:
    """Line total, discount flag and value tier; a null price is no discount, a null amount is low."""
    cents = F.col("payment__amount_cents")
    return df.withColumns({
        "item__total": F.round(F.col("item__quantity") * F.col("item__price"), 2),
        "item__discount_applied": F.when(F.col("item__price") < DISCOUNT_BELOW, "Y").otherwise("N"),
        "order__value_tier": F.when(cents >= TIER_HIGH, "high").when(cents >= TIER_MEDIUM, "medium").otherwise("low"),
    })


def calendar_columns(df: DataFrame, ts_column: str) -> DataFrame:
    """Calendar attributes of ``ts_column``, with the timestamp itself as ``created_at``."""
    ts = F.col(ts_column)
    return df.withColumns({"created_at": C.tolerant_timestamp(df, ts)} | calendar_parts(ts))


def repair_nulls(df: DataFrame) -> DataFrame:
    filled = C.fill_nulls(df, REPAIR_DEFAULTS)
    return filled.withColumn("payment__amount", F.coalesce(F.col("payment__amount_cents"), F.lit(0.0)))


def totals_and_repair(df: DataFrame, repair_first: bool = False) -> DataFrame:
    """By default totals come first, so a line with a null price keeps a null total.

    With ``repair_first`` the defaults take part in the totals and flags.
    """
    if repair_first:
        return line_values(repair_nulls(df))
    return repair_nulls(line_values(df))
