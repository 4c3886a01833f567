"""Claims conforming: aliases, tolerant types, tidy strings, record rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from smeltery.functions import columns as C

# Canonical claim columns and the source names that may carry them.
CLAIM_DATES = {
    "service_date": ("service_date", "date_of_service"),
    "claim_date": ("claim_date", "adjudication_date"),
}
CLAIM_NUMBERS = {
    "paid_amount": "double",
    "allowed_amount": "double",
    "quantity": "int",
}
CLAIM_CODES = {
    "diagnosis_code": ("diagnosis_code", "icd_code"),
    "procedure_code": ("procedure_code", "cpt_code"),
    "patient_id": ("patient_id", "member_id"),
    "provider_id": ("provider_id", "npi"),
}
CLAIM_UPPER = ("claim_type",)


def date_columns(df: DataFrame) -> dict[str, Column]:
    return {
        name: C.tolerant_date(df, C.resolve_column(df, sources))
        for name, sources in CLAIM_DATES.items()
    }


def number_columns(df: DataFrame) -> dict[str, Column]:
    return {
        name: C.tolerant_number(C.resolve_column(df, [name], dtype), dtype)
        for name, dtype in CLAIM_NUMBERS.items()
    }


def text_columns(df: DataFrame) -> dict[str, Column]:
    upper = {name: C.tidy_upper(C.resolve_column(df, [name])) for name in CLAIM_UPPER}
    codes = {name: C.tidy(C.resolve_column(df, sources)) for name, sources in CLAIM_CODES.items()}
    return upper | codes


def conform_claims(df: DataFrame) -> DataFrame:
    """Canonical claim columns beside the source columns, in one projection."""
    df = C.normalize_columns(df)
    return df.withColumns(date_columns(df) | number_columns(df) | text_columns(df))


def tag_failed_rules(df: DataFrame, rules: Mapping[str, Column], into: str = "_failed_rules") -> DataFrame:
    """Names of the rules a row does not meet, comma separated; empty when it meets all.

    A rule that evaluates to null counts as not met.
    """
    checks = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(into, F.concat_ws(",", *checks))


def split_invalid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, rejected rows with the names of the failed rules)."""
    tagged = tag_failed_rules(df, rules)
    return (
        tagged.filter(F.col("_failed_rules") == "").drop("_failed_rules"),
        tagged.filter(F.col("_failed_rules") != ""),
    )


def publish_split(df: DataFrame, rules: Mapping[str, Column], folder: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Accepted and rejected rows as two outputs of one evaluation.

    The frame is evaluated and its rules tested once, while both outputs are
    written; rejected rows carry the names of the rules they break.  Returns
    both as read back, and their counts, which add up to the input.
    """
    seen = Observation()
    accepted = F.col("_failed_rules") == ""
    tagged = tag_failed_rules(df, rules).withColumn("_accepted", accepted)
    counted = tagged.observe(seen, F.count_if("_accepted").alias("accepted"), F.count_if(~F.col("_accepted")).alias("rejected"))
    counted.write.partitionBy("_accepted").parquet(folder)
    both = df.sparkSession.read.schema(tagged.schema).parquet(folder)
    return (both.where("_accepted").drop("_failed_rules", "_accepted"), both.where("NOT _accepted").drop("_accepted"),
            {name: int(n) for name, n in seen.get.items()})


def claim_rules() -> dict[str, Column]:
    return {
        "claim_id": F.col("claim_id").isNotNull(),
        "patient_id": F.col("patient_id").isNotNull(),
        "service_date": F.col("service_date").isNotNull(),
        "procedure_code": F.col("procedure_code").isNotNull(),
        "paid_amount": F.col("paid_amount").isNotNull() & (F.col("paid_amount") >= 0),
    }
