"""Completeness scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

# Scored columns with their points, and the grade floors.
ORDER_WEIGHTS = {
    "order_id": 20,
    "customer__id": 20,
    "customer__email": 20,
    "payment__amount_cents": 20,
    "item__sku": 20,
}
GRADE_FLOORS = ((100, "A"), (80, "B"), (60, "C"))
LOWEST_GRADE = "F"


def completeness(weights: Mapping[str, int]) -> Column:
    parts = [F.when(F.col(name).isNotNull(), points).otherwise(0) for name, points in weights.items()]
    return reduce(add, parts)


def grade(score: Column, floors: Sequence[tuple[int, str]] = GRADE_FLOORS, lowest: str = LOWEST_GRADE) -> Column:
    """Bands from the highest floor down; below the last floor is ``lowest``."""
    band = F.lit(lowest)
    for floor, name in sorted(floors):
        band = F.when(score >= floor, name).otherwise(band)
    return band


def score_quality(df: DataFrame, weights: Mapping[str, int] = ORDER_WEIGHTS) -> DataFrame:
    scored = df.withColumn("_quality_score", completeness(weights))
    return scored.withColumn("_quality_grade", grade(F.col("_quality_score")))
