"""Gold roll-ups.

Every aggregate is partial on the map side.  Distinct counts first reduce to
(group, value) pairs, so a hot group is spread over many reducers before its
pairs are counted.

The ``stored_`` forms give the same rows from a silver table that is kept in
files: they read it more than once and move less.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.functions import money as M
from smeltery.functions.calendar import year_month


# The silver columns each roll-up reads.
PROFILE_INPUTS = ("patient_id", "procedure_code", "paid_amount", "service_date")
PATIENT_INPUTS = ("patient_id", "procedure_code", "diagnosis_code", "provider_id", "paid_amount", "allowed_amount", "service_date")
MONTHLY_INPUTS = ("service_date", "claim_type", "patient_id", "paid_amount", "allowed_amount")
PROCEDURE_INPUTS = ("procedure_code", "patient_id", "paid_amount")


# A patient's claims are gathered in one task where the patients that share its hash bucket have no more than this.
PATIENT_BUCKETS = 8192
GATHERED_ROWS = 2_000_000


def row_total() -> Column:
    return F.count(F.lit(1))


def claims_profile(silver: DataFrame, approximate: bool = False) -> DataFrame:
    return silver.agg(
        row_total().alias("total_records"),
        M.distinct("patient_id", approximate).alias("unique_patients"),
        M.distinct("procedure_code", approximate).alias("unique_procedures"),
        M.mean("paid_amount").alias("avg_paid_amount"),
        F.min("service_date").alias("earliest_service"),
        F.max("service_date").alias("latest_service"),
    )


def _patient_columns(distinct: Callable[[str], Column]) -> list[Column]:
    first, last = F.min("service_date"), F.max("service_date")
    return [
        row_total().alias("total_claims"),
        distinct("procedure_code").alias("distinct_procedures"),
        distinct("diagnosis_code").alias("distinct_diagnoses"),
        distinct("provider_id").alias("distinct_providers"),
        M.total("paid_amount").alias("total_paid"),
        M.mean("paid_amount").alias("avg_paid_per_claim"),
        M.total("allowed_amount").alias("total_allowed"),
        first.alias("first_service_date"),
        last.alias("last_service_date"),
        F.datediff(last, first).alias("patient_tenure_days"),
    ]


def patient_summary(silver: DataFrame, approximate: bool = False) -> DataFrame:
    return silver.groupBy("patient_id").agg(*_patient_columns(lambda c: M.distinct(c, approximate)))


def stored_patient_summary(silver: DataFrame, gathered_rows: int = GATHERED_ROWS,
                           sized_by: DataFrame | None = None) -> DataFrame:
    """Every claim moves once, to its patient, instead of once per distinct count.

    Patients are dealt to hash buckets and those counted first, in ``silver`` or in
    rows that hold every claim of it; the patients of a bucket with more than
    ``gathered_rows`` claims are counted by pairs.
    """
    narrow = silver.select(*PATIENT_INPUTS)
    bucket = F.pmod(F.xxhash64("patient_id"), F.lit(PATIENT_BUCKETS))
    sizes = (narrow if sized_by is None else sized_by).groupBy(bucket.alias("bucket")).agg(row_total().alias("n"))
    full = [r.bucket for r in sizes.filter(F.col("n") > gathered_rows).collect()]
    few = narrow.filter(~bucket.isin(full)) if full else narrow
    found = few.repartition("patient_id").groupBy("patient_id").agg(
        *_patient_columns(lambda c: F.size(F.collect_set(c)).cast("bigint")))
    return found.unionByName(patient_summary(narrow.filter(bucket.isin(full)))) if full else found


def _with_patients(rows: DataFrame, by: Sequence[str], alias: str, totals: Sequence[Column], approximate: bool,
                   stored: bool) -> DataFrame:
    """``totals`` per group and how many patients it has, after the row count.

    Of stored rows the pairs of group and patient are counted by themselves, so
    that they do not carry the sums along.
    """
    if not stored:
        return rows.groupBy(*by).agg(totals[0], M.distinct("patient_id", approximate).alias(alias), *totals[1:])
    sums = rows.groupBy(*by).agg(*totals)
    counts = rows.select(*by, "patient_id").distinct().groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.count("patient_id").alias(alias))
    met = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    columns = sums.columns
    return sums.join(counts, met).select(*columns[:len(by) + 1], alias, *columns[len(by) + 1:])


def monthly_spend(silver: DataFrame, approximate: bool = False, stored: bool = False) -> DataFrame:
    dated = silver.filter(F.col("service_date").isNotNull()).withColumn("year_month", year_month("service_date"))
    return _with_patients(dated, ["year_month", "claim_type"], "unique_patients", [
        row_total().alias("claim_count"),
        M.total("paid_amount").alias("total_paid"),
        M.mean("paid_amount").alias("avg_paid"),
        M.total("allowed_amount").alias("total_allowed"),
    ], approximate, stored)


def procedure_cost(silver: DataFrame, approximate: bool = False, stored: bool = False) -> DataFrame:
    coded = silver.filter(F.col("procedure_code").isNotNull())
    return _with_patients(coded, ["procedure_code"], "patients_affected", [
        row_total().alias("usage_count"),
        M.total("paid_amount").alias("total_paid"),
        M.mean("paid_amount").alias("avg_paid"),
        M.lowest("paid_amount").alias("min_paid"),
        M.highest("paid_amount").alias("max_paid"),
    ], approximate, stored)


def top_by(df: DataFrame, metric: str, n: int, *tie_break: str) -> DataFrame:
    """The n rows with the highest metric; ties resolve by ``tie_break``."""
    return df.orderBy(F.col(metric).desc(), *tie_break).limit(n)


def country_orders(lines: DataFrame, approximate: bool = False) -> DataFrame:
    """Revenue per country; the average runs over lines, so orders weigh by their line count."""
    return lines.groupBy("customer__address__country_code").agg(
        M.distinct("order_id", approximate).alias("total_orders"),
        F.sum(M.exact("item__total")).cast("double").alias("total_revenue"),
        M.mean("payment__amount").alias("avg_order_value"),
    )


def country_orders_by_order(lines: DataFrame) -> DataFrame:
    """Same figures with every order counted once in the average."""
    orders = lines.groupBy("customer__address__country_code", "order_id").agg(
        F.sum(M.exact("item__total")).alias("revenue"),
        F.max("payment__amount").alias("amount"),
    )
    return orders.groupBy("customer__address__country_code").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        M.mean("amount").alias("avg_order_value"),
    )


def money_check(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Exact total of an amount per group, unrounded, with the values added and those no total can hold."""
    return df.groupBy(*by).agg(
        F.sum(M.exact(column)).cast("double").alias("total"),
        F.count(M.exact(column)).alias("added"),
        M.unfit(column).alias("unfit"),
    )
