"""Bronze to gold, end to end."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.functions.columns import instant, quoted
from smeltery.functions.money import EXACT
from smeltery.operators import conform, dedupe, enrich, nested, quality, rollup
from smeltery.plans.snapshot import delete_folder, ensure_database, publish_verified

# Names of the layer tables and views.
BRONZE_CLAIMS = "bronze_claims"
SILVER_CLAIMS = "silver_claims"
GOLD_PATIENT = "gold_patient_summary"
GOLD_MONTHLY = "gold_monthly_spend"
GOLD_PROCEDURE = "gold_procedure_cost"
TOP_PROCEDURES = 50


def claims_silver(bronze: DataFrame, order_by: Sequence[str] = (), columns: Sequence[str] | None = None,
                  scratch: str | None = None) -> DataFrame:
    """One conformed row per claim; ``columns`` names those a single roll-up needs, so no others are computed or moved.

    ``scratch`` is a fresh folder for a bronze that is stored; claims without a duplicate are not moved then.
    """
    return dedupe.dedupe_claims(conform.conform_claims(bronze), order_by, columns, scratch)


def stamp_silver(silver: DataFrame, source_table: str, as_of: dt.datetime | None = None) -> DataFrame:
    return silver.withColumns({"silver_load_ts": instant(as_of), "source_table": F.lit(source_table)})


def claims_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """The roll-ups of a stored silver table."""
    return {
        GOLD_PATIENT: rollup.stored_patient_summary(silver),
        GOLD_MONTHLY: rollup.monthly_spend(silver, stored=True),
        GOLD_PROCEDURE: rollup.procedure_cost(silver, stored=True),
    }


def patient_gold(bronze: DataFrame, folder: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The patient summary alone: of the conformed claims, what it needs is stored below ``folder`` and read from there."""
    conformed = conform.conform_claims(bronze)
    needed = {*dedupe.CLAIM_KEYS, *order_by, *rollup.PATIENT_INPUTS}
    narrow = conformed.select(*[quoted(c) for c in conformed.columns if c in needed])
    narrow.write.parquet(f"{folder}/conformed")
    stored = bronze.sparkSession.read.schema(narrow.schema).parquet(f"{folder}/conformed")
    silver = dedupe.dedupe_claims(stored, order_by, rollup.PATIENT_INPUTS, f"{folder}/repeated")
    return rollup.stored_patient_summary(silver, sized_by=stored)


def view_statements(database: str) -> list[str]:
    """Views over the layer tables; an ORDER BY binds where the view is read last."""
    def view(name: str, table: str, tail: str) -> str:
        return f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{table} {tail}"

    return [
        view("vw_silver_claims", SILVER_CLAIMS, "WHERE silver_load_ts IS NOT NULL"),
        view("vw_gold_patient_summary", GOLD_PATIENT, "ORDER BY total_paid DESC"),
        view("vw_gold_monthly_spend", GOLD_MONTHLY, "ORDER BY year_month, claim_type"),
        view("vw_gold_procedure_cost", GOLD_PROCEDURE,
             f"ORDER BY total_paid DESC, procedure_code LIMIT {TOP_PROCEDURES}"),
    ]


def build_claims(source: DataFrame, database: str, root: str, *, source_table: str = "claims",
                 order_by: Sequence[str] = (), as_of: dt.datetime | None = None) -> None:
    """Publish bronze, silver and gold under ``root`` and create the views.

    Each layer reads the one published before it, so nothing is computed
    twice, and readers see the old content until the new one is complete.
    """
    spark = source.sparkSession
    ensure_database(spark, database, f"{root}/database")

    def put(df: DataFrame, name: str) -> DataFrame:
        publish_verified(df, f"{database}.{name}", f"{root}/{name}")
        return spark.table(f"{database}.{name}")

    bronze = put(source, BRONZE_CLAIMS)
    scratch = f"{root}/repeated-{uuid.uuid4().hex}"
    silver = put(stamp_silver(claims_silver(bronze, order_by, scratch=scratch), source_table, as_of), SILVER_CLAIMS)
    delete_folder(spark, scratch)
    for name, gold in claims_gold(silver).items():
        put(gold, name)
    for statement in view_statements(database):
        spark.sql(statement)


def orders_silver(documents: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    return nested.flatten_orders(documents).withColumn("_transformed_at", instant(loaded_at))


def orders_modified(lines: DataFrame, ts_column: str = "_transformed_at", repair_first: bool = False) -> DataFrame:
    """Scored, masked, valued, dated and repaired order lines."""
    scored = quality.score_quality(lines)
    contact = enrich.standardize_contact(scored)
    if repair_first:
        return enrich.calendar_columns(enrich.totals_and_repair(contact, repair_first=True), ts_column)
    return enrich.repair_nulls(enrich.calendar_columns(enrich.line_values(contact), ts_column))


def country_view(database: str, table: str) -> str:
    return f"""
        CREATE OR REPLACE VIEW {database}.gold_country_orders AS
        SELECT customer__address__country_code,
               COUNT(DISTINCT order_id) AS total_orders,
               CAST(SUM(TRY_CAST(item__total AS {EXACT})) AS DOUBLE) AS total_revenue,
               CAST(ROUND(AVG(TRY_CAST(payment__amount AS {EXACT})), 2) AS DOUBLE) AS avg_order_value
        FROM {database}.{table}
        GROUP BY ALL
        ORDER BY total_revenue DESC"""


def build_orders(spark: SparkSession, documents: DataFrame, database: str, root: str,
                 loaded_at: dt.datetime | None = None) -> None:
    ensure_database(spark, database, f"{root}/database")

    def put(df: DataFrame, name: str) -> DataFrame:
        publish_verified(df, f"{database}.{name}", f"{root}/{name}", schema="same")
        return spark.table(f"{database}.{name}")

    bronze = put(documents, "bronze_orders")
    silver = put(orders_silver(bronze, loaded_at), "silver_orders")
    put(orders_modified(silver), "silver_mdf_orders")
    spark.sql(country_view(database, "silver_mdf_orders"))


def country_gold(documents: DataFrame) -> DataFrame:
    return rollup.country_orders(orders_modified(orders_silver(documents)))
