"""Every operator as a named query over the given tables, with its oracle where SQL can say it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.functions import columns as C
from smeltery.functions.calendar import shift_back, since_yesterday
from smeltery.functions.masking import mask_email
from smeltery.operators import (
    cdc, conform, dedupe, drift, enrich, filters, layout, merge, nested, quality, rollup,
)
from smeltery.plans import audit, dimension, fixtures as X, loads, medallion, oracle as O, parted, snapshot, state
from smeltery.plans.versions import VersionTakenError
from smeltery.sources import readers, rescue
from smeltery.streaming import flows
from smeltery.workspace import new_folder

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}

SPLIT = dt.datetime(2024, 1, 15)
MERGED_AT = dt.datetime(2024, 1, 3)
TIES = ("tie_part", "tie_supp", "quantity")


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, oracle)
        return run

    return add


# ---- silver: conforming ---------------------------------------------------

@query(O.over("claims_raw", "SELECT * FROM claims_raw"))
def normalize_columns(spark, sf):
    return C.normalize_columns(X.claims_untidy(spark, sf))


@query(O.over("claims_raw", """
SELECT claim_id, date_of_service AS service_date, claim_date, icd_code AS diagnosis_code,
       cpt_code AS procedure_code, member_id AS patient_id, npi AS provider_id, CAST(NULL AS VARCHAR) AS referral
FROM claims_raw"""))
def resolve_alias_columns(spark, sf):
    raw = X.claims_raw(spark, sf)
    aliases = conform.CLAIM_DATES | conform.CLAIM_CODES | {"referral": ("referral", "referral_id")}
    resolved = [C.resolve_column(raw, sources).alias(name) for name, sources in aliases.items()]
    return raw.select("claim_id", *resolved)


@query(O.over("conformed", "SELECT claim_id, tie_part, tie_supp, service_date, claim_date FROM conformed"))
def cast_dates_tolerant(spark, sf):
    raw = X.claims_raw(spark, sf)
    return raw.select("claim_id", "tie_part", "tie_supp",
                      *[c.alias(n) for n, c in conform.date_columns(raw).items()])


@query(O.over("conformed", "SELECT claim_id, tie_part, tie_supp, paid_amount, allowed_amount, quantity FROM conformed"))
def cast_numbers_tolerant(spark, sf):
    raw = X.claims_raw(spark, sf)
    return raw.select("claim_id", "tie_part", "tie_supp",
                      *[c.alias(n) for n, c in conform.number_columns(raw).items()])


@query(O.over("conformed", """
SELECT claim_id, tie_part, tie_supp, claim_type, diagnosis_code, procedure_code, patient_id, provider_id
FROM conformed"""))
def standardize_strings(spark, sf):
    raw = X.claims_raw(spark, sf)
    return raw.select("claim_id", "tie_part", "tie_supp",
                      *[c.alias(n) for n, c in conform.text_columns(raw).items()])


@query(O.over("conformed", """
SELECT claim_id, tie_part, tie_supp, service_date, procedure_code, paid_amount,
       concat_ws(',', CASE WHEN claim_id IS NULL THEN 'claim_id' END, CASE WHEN patient_id IS NULL THEN 'patient_id' END,
                 CASE WHEN service_date IS NULL THEN 'service_date' END,
                 CASE WHEN procedure_code IS NULL THEN 'procedure_code' END,
                 CASE WHEN paid_amount IS NULL OR paid_amount < 0 THEN 'paid_amount' END) AS failed_rules
FROM conformed"""))
def invalid_record_split(spark, sf):
    silver = conform.conform_claims(X.claims_raw(spark, sf))
    tagged = conform.tag_failed_rules(silver, conform.claim_rules(), into="failed_rules")
    return tagged.select("claim_id", "tie_part", "tie_supp", "service_date", "procedure_code", "paid_amount",
                         "failed_rules")


FAILED = """concat_ws(',', CASE WHEN claim_id IS NULL THEN 'claim_id' END, CASE WHEN patient_id IS NULL THEN 'patient_id' END,
  CASE WHEN service_date IS NULL THEN 'service_date' END, CASE WHEN procedure_code IS NULL THEN 'procedure_code' END,
  CASE WHEN paid_amount IS NULL OR paid_amount < 0 THEN 'paid_amount' END)"""


@query(O.over("conformed", f"""
SELECT claim_id, tie_part, tie_supp, paid_amount, nullif(failed, '') AS failed_rules,
       CASE WHEN failed = '' THEN 'accepted' ELSE 'rejected' END AS output,
       count(*) OVER (PARTITION BY failed = '') AS counted FROM (SELECT *, {FAILED} AS failed FROM conformed)"""))
def claims_accepted_rejected(spark, sf):
    """Both outputs of one evaluation, each row with the count its output was given while it was written."""
    silver = conform.conform_claims(X.claims_raw(spark, sf))
    accepted, rejected, counts = conform.publish_split(silver, conform.claim_rules(), new_folder(spark, "claims-split"))
    parts = []
    for name, df, failed in (("accepted", accepted, F.lit(None).cast("string")), ("rejected", rejected, F.col("_failed_rules"))):
        parts.append(df.select("claim_id", "tie_part", "tie_supp", "paid_amount", failed.alias("failed_rules"),
                               F.lit(name).alias("output"), F.lit(counts[name]).cast("bigint").alias("counted")))
    return parts[0].unionByName(parts[1])


@query("""
SELECT l_returnflag, CAST(CAST(4 * sum(l_linenumber) FILTER (l_orderkey % 10 <> 3 AND l_orderkey % 10 <> 7) AS DECIMAL(28,8)) / 10000000 AS DOUBLE)
         AS total, count(*) FILTER (l_orderkey % 10 <> 3 AND l_orderkey % 10 <> 7) AS added,
       count(*) FILTER (l_orderkey % 10 = 3 OR l_orderkey % 10 = 7) AS unfit
FROM lineitem GROUP BY l_returnflag""")
def money_exact_totals(spark, sf):
    """Amounts far below a cent, among them some that are no numbers and some beyond any amount."""
    line, order = F.col("l_linenumber"), F.col("l_orderkey") % 10
    tiny = F.when(order == 3, F.lit(float("nan"))).when(order == 7, F.lit(1e30)).otherwise(line * F.lit(4e-7))
    return rollup.money_check(X.table(spark, sf, "lineitem").withColumn("amount", tiny), "amount", "l_returnflag")


def silver_claims(spark, sf, columns=None):
    return medallion.claims_silver(X.claims_raw(spark, sf), TIES, columns)


@query(O.over("silver", "SELECT * FROM silver"))
def dedupe_claims(spark, sf):
    return silver_claims(spark, sf)


# ---- gold: claims ---------------------------------------------------------

@query(O.over("silver", f"""
SELECT count(*) AS total_records, count(DISTINCT patient_id) AS unique_patients,
       count(DISTINCT procedure_code) AS unique_procedures, {O.mean('paid_amount')} AS avg_paid_amount,
       min(service_date) AS earliest_service, max(service_date) AS latest_service
FROM silver"""))
def silver_profile(spark, sf):
    return rollup.claims_profile(silver_claims(spark, sf, rollup.PROFILE_INPUTS))


@query(O.over("silver", f"""
SELECT patient_id, count(*) AS total_claims, count(DISTINCT procedure_code) AS distinct_procedures,
       count(DISTINCT diagnosis_code) AS distinct_diagnoses, count(DISTINCT provider_id) AS distinct_providers,
       {O.total('paid_amount')} AS total_paid, {O.mean('paid_amount')} AS avg_paid_per_claim,
       {O.total('allowed_amount')} AS total_allowed, min(service_date) AS first_service_date,
       max(service_date) AS last_service_date,
       CAST(datediff('day', min(service_date), max(service_date)) AS INTEGER) AS patient_tenure_days
FROM silver GROUP BY patient_id"""))
def gold_patient_summary(spark, sf):
    return medallion.patient_gold(X.claims_raw(spark, sf), new_folder(spark, "claims-patients"), TIES)


@query(O.over("silver", f"""
SELECT strftime(service_date, '%Y-%m') AS year_month, claim_type, count(*) AS claim_count,
       count(DISTINCT patient_id) AS unique_patients, {O.total('paid_amount')} AS total_paid,
       {O.mean('paid_amount')} AS avg_paid, {O.total('allowed_amount')} AS total_allowed
FROM silver WHERE service_date IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2"""))
def gold_monthly_spend(spark, sf):
    return rollup.monthly_spend(silver_claims(spark, sf, rollup.MONTHLY_INPUTS)).orderBy("year_month", "claim_type")


PROCEDURES = f"""
SELECT procedure_code, count(*) AS usage_count, count(DISTINCT patient_id) AS patients_affected,
       {O.total('paid_amount')} AS total_paid, {O.mean('paid_amount')} AS avg_paid,
       round(min(paid_amount), 2) AS min_paid, round(max(paid_amount), 2) AS max_paid
FROM silver WHERE procedure_code IS NOT NULL GROUP BY procedure_code
ORDER BY total_paid DESC, procedure_code"""


@query(O.over("silver", PROCEDURES))
def gold_procedure_cost(spark, sf):
    costs = rollup.procedure_cost(silver_claims(spark, sf, rollup.PROCEDURE_INPUTS))
    return costs.orderBy(F.desc("total_paid"), "procedure_code")


@query(O.over("silver", PROCEDURES + " LIMIT 50"))
def gold_procedure_top50(spark, sf):
    costs = rollup.procedure_cost(silver_claims(spark, sf, rollup.PROCEDURE_INPUTS))
    return rollup.top_by(costs, "total_paid", medallion.TOP_PROCEDURES, "procedure_code")


@query(O.over("silver", PROCEDURES + " LIMIT 50"))
def claims_bronze_to_gold(spark, sf):
    """Every claims step from untidy headings to the ranked view."""
    bronze = X.claims_untidy(spark, sf)
    silver = medallion.stamp_silver(medallion.claims_silver(bronze, TIES, rollup.PROCEDURE_INPUTS), "claims")
    costs = rollup.procedure_cost(silver.filter(F.col("silver_load_ts").isNotNull()))
    return rollup.top_by(costs, "total_paid", medallion.TOP_PROCEDURES, "procedure_code")


def _database(folder):
    return f"layers_{folder.rsplit('-', 1)[1]}"


@query(O.over("silver", PROCEDURES + " LIMIT 50"))
def claims_layers_published(spark, sf):
    """Bronze, silver and gold published one after the other, read through the ranked view."""
    folder = new_folder(spark, "claims-layers")
    medallion.build_claims(X.claims_untidy(spark, sf), _database(folder), folder, order_by=TIES)
    return spark.table(f"{_database(folder)}.vw_gold_procedure_cost")


@query(O.over("silver", f"""
SELECT 'silver' AS name, count(*) AS rows, CAST(NULL AS DOUBLE) AS first_value, TRUE AS there FROM silver
UNION ALL SELECT 'patients', count(*), max(total), TRUE FROM (SELECT {O.total('paid_amount')} AS total FROM silver GROUP BY patient_id)
UNION ALL SELECT 'months', count(*), (SELECT {O.total('paid_amount')} FROM silver WHERE service_date IS NOT NULL
    GROUP BY strftime(service_date, '%Y-%m'), claim_type ORDER BY strftime(service_date, '%Y-%m'), claim_type LIMIT 1), TRUE
  FROM (SELECT DISTINCT strftime(service_date, '%Y-%m'), claim_type FROM silver WHERE service_date IS NOT NULL)
UNION ALL SELECT 'dropped', 0, NULL, FALSE"""))
def claims_views_read(spark, sf):
    """The silver, patient and month views of published layers, and a table that is dropped twice."""
    folder = new_folder(spark, "claims-views")
    database = _database(folder)
    medallion.build_claims(X.claims_untidy(spark, sf), database, folder, order_by=TIES)

    def line(name, df, first, there):
        return df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), first.cast("double").alias("first_value"),
                      F.lit(there).alias("there"))

    silver = spark.table(f"{database}.vw_silver_claims")
    patients, months = (spark.table(f"{database}.vw_gold_{n}") for n in ("patient_summary", "monthly_spend"))
    earliest = F.min_by("total_paid", F.struct("year_month", "claim_type"))
    snapshot.save_table(patients.limit(5), f"{database}.short", path=f"{folder}/short")
    for _ in range(2):
        snapshot.drop_table(spark, f"{database}.short")
    gone = spark.catalog.tableExists(f"{database}.short")
    return reduce(DataFrame.union, [
        line("silver", silver, F.lit(None), True), line("patients", patients, F.max("total_paid"), True),
        line("months", months, earliest, True), line("dropped", silver.limit(0), F.lit(None), gone)])


@query("""
SELECT o_orderdate, o_orderstatus, o_orderpriority, count(*) AS n FROM orders
GROUP BY ALL ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC LIMIT 100""")
def group_by_all_counts(spark, sf):
    return spark.sql("""
        SELECT o_orderdate, o_orderstatus, o_orderpriority, count(*) AS n FROM {orders}
        GROUP BY ALL ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC LIMIT 100
    """, orders=X.table(spark, sf, "orders"))


# ---- nested orders --------------------------------------------------------

ALL_LINES = O.over("order_lines", "SELECT * FROM order_lines")


@query(ALL_LINES)
def flatten_orders(spark, sf):
    return nested.flatten_orders(X.order_documents(spark, sf))


@query(ALL_LINES)
def json_documents_scan(spark, sf):
    """Documents as JSON files, read back under the declared schema and flattened."""
    folder = new_folder(spark, "order-documents")
    X.order_documents(spark, sf).write.json(folder)
    return nested.flatten_orders(readers.read_json_documents(spark, folder))


@query(O.over("order_lines", """
SELECT * EXCLUDE (score), score AS _quality_score,
       CASE WHEN score = 100 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 60 THEN 'C' ELSE 'F' END
          AS _quality_grade
FROM (SELECT order_id, item__name, item__sku, customer__email,
        CASE WHEN order_id IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN customer__id IS NOT NULL THEN 20 ELSE 0 END
        + CASE WHEN customer__email IS NOT NULL THEN 20 ELSE 0 END
        + CASE WHEN payment__amount_cents IS NOT NULL THEN 20 ELSE 0 END
        + CASE WHEN item__sku IS NOT NULL THEN 20 ELSE 0 END AS score FROM order_lines)"""))
def quality_score_grade(spark, sf):
    scored = quality.score_quality(X.order_lines(spark, sf))
    return scored.select("order_id", "item__name", "item__sku", "customer__email", "_quality_score", "_quality_grade")


@query("""
SELECT order_id, email AS customer__email,
       left(email, 1) || repeat('*', position('@' in email) - 2) || substr(email, position('@' in email))
         AS customer__email_masked
FROM (SELECT o_orderkey AS order_id, CASE WHEN c_custkey % 7 = 0 THEN NULL
             ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email
      FROM orders JOIN customer ON o_custkey = c_custkey)""")
def mask_customer_email(spark, sf):
    contact = X.order_headers(spark, sf).select("order_id", F.col("customer.email").alias("customer__email"))
    return contact.withColumn("customer__email_masked", mask_email("customer__email"))


@query(O.over("lines_valued", """
SELECT order_id, item__sku, item__quantity, item__price, payment__amount_cents, item__total,
       item__discount_applied, order__value_tier FROM lines_valued"""))
def order_tiers_totals(spark, sf):
    return enrich.line_values(X.order_lines(spark, sf)).select(
        "order_id", "item__sku", "item__quantity", "item__price", "payment__amount_cents", "item__total",
        "item__discount_applied", "order__value_tier")


@query("""
SELECT o_orderkey, o_orderdate AS created_at, CAST(year(o_orderdate) AS INTEGER) AS order__year,
       CAST(month(o_orderdate) AS INTEGER) AS order__month, dayname(o_orderdate) AS order__day_of_week,
       CAST(hour(o_orderdate) AS INTEGER) AS order__hour,
       CASE WHEN dayofweek(o_orderdate) + 1 IN (1, 7) THEN 'Y' ELSE 'N' END AS order__is_weekend
FROM orders""")
def calendar_enrich(spark, sf):
    orders = X.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return enrich.calendar_columns(orders, "o_orderdate").drop("o_orderdate")


REPAIRED = ("order_id", "item__sku", "payment__currency", "item__quantity", "item__price", "item__total",
            "item__discount_applied", "payment__amount")


@query(O.over("lines_valued", """
SELECT order_id, item__sku, coalesce(upper(trim(payment__currency)), 'USD') AS payment__currency,
       coalesce(item__quantity, 1) AS item__quantity, coalesce(item__price, 0.0) AS item__price, item__total,
       item__discount_applied, payment__amount
FROM lines_valued"""))
def null_repair_after_totals(spark, sf):
    lines = enrich.standardize_contact(X.order_lines(spark, sf))
    return enrich.totals_and_repair(lines).select(*REPAIRED)


@query(O.over("order_lines", """
SELECT *, round(item__quantity * item__price, 2) AS item__total,
       CASE WHEN item__price < 50 THEN 'Y' ELSE 'N' END AS item__discount_applied
FROM (SELECT order_id, item__sku, coalesce(upper(trim(payment__currency)), 'USD') AS payment__currency,
             coalesce(item__quantity, 1) AS item__quantity, coalesce(item__price, 0.0) AS item__price,
             CAST(coalesce(payment__amount_cents, 0) AS DOUBLE) AS payment__amount FROM order_lines)"""))
def null_repair_before_totals(spark, sf):
    lines = enrich.standardize_contact(X.order_lines(spark, sf))
    return enrich.totals_and_repair(lines, repair_first=True).select(*REPAIRED)


COUNTRY = O.over("lines_valued", f"""
SELECT customer__address__country_code, count(DISTINCT order_id) AS total_orders,
       CAST(CAST(sum(CAST(item__total AS DECIMAL(24,6))) AS DECIMAL(38,2)) AS DOUBLE) AS total_revenue,
       {O.mean('payment__amount')} AS avg_order_value
FROM lines_valued GROUP BY 1 ORDER BY total_revenue DESC""")


@query(COUNTRY)
def gold_country_orders(spark, sf):
    lines = enrich.totals_and_repair(X.order_lines(spark, sf))
    return rollup.country_orders(lines).orderBy(F.desc("total_revenue"))


@query(COUNTRY)
def orders_bronze_to_gold(spark, sf):
    """Every order step from nested documents to revenue per country."""
    return medallion.country_gold(X.order_documents(spark, sf))


@query(COUNTRY)
def orders_layers_published(spark, sf):
    """Document, silver and repaired order tables published, read through the country view."""
    folder = new_folder(spark, "orders-layers")
    medallion.build_orders(spark, X.order_documents(spark, sf), _database(folder), folder)
    return spark.table(f"{_database(folder)}.gold_country_orders")


@query(O.over("lines_valued", f"""
SELECT customer__address__country_code, count(order_id) AS total_orders,
       CAST(CAST(sum(revenue) AS DECIMAL(38,2)) AS DOUBLE) AS total_revenue, {O.mean('amount')} AS avg_order_value
FROM (SELECT customer__address__country_code, order_id, sum(CAST(item__total AS DECIMAL(24,6))) AS revenue,
             max(payment__amount) AS amount FROM lines_valued GROUP BY 1, 2)
GROUP BY 1"""))
def gold_country_orders_order_grain(spark, sf):
    return rollup.country_orders_by_order(enrich.totals_and_repair(X.order_lines(spark, sf)))


# ---- full and incremental loads -------------------------------------------

@query(O.over("events_feed", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id, event_type, product_id, amount,
       event_ts FROM events_feed"""))
def declared_schema_scan(spark, sf):
    """Event files read under the declared schema."""
    folder, form = new_folder(spark, "event-files"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    feed = X.events_feed(spark, sf).withColumn("event_id", F.col("event_id").cast("string"))
    feed.write.option("timestampNTZFormat", form).json(folder)
    return readers.read_files(spark, folder, "json", readers.EVENT_SCHEMA, timestampFormat=form)


EVENT_COLUMNS = "event_id, user_id, event_type, product_id, event_ts, event_date, amount AS amount_usd"


def loaded_events(strategy: str, where: str = "TRUE") -> str:
    return O.over("events_feed", f"""
SELECT {EVENT_COLUMNS}, '{strategy}' AS load_strategy FROM events_feed
WHERE event_type IS NOT NULL AND {where}""")


def _load_events(spark, sf, lookback_seconds):
    """Two runs: the first sees the feed up to the split, the second sees all of it."""
    folder = new_folder(spark, "events-incremental")
    sink = f"{folder}/silver"
    marks = state.TimestampWatermark(spark, f"{folder}/marks", "events", lookback_seconds)
    feed = X.events_feed(spark, sf)
    transform = loads.events_transform("INCREMENTAL")
    for upto in (SPLIT, None):
        loads.incremental_load(feed, sink, marks, "event_ts", transform, keys=["event_id"],
                               partition_column="event_date", upto=upto,
                               partition_is_cursor_date=True)
    return loads.read_sink(spark, sink, transform(feed).schema).drop("load_ts")


@query(loaded_events("FULL_OVERWRITE"))
def full_load_events(spark, sf):
    sink = snapshot.Snapshots(spark, new_folder(spark, "events-full"))
    loads.full_load(X.events_feed(spark, sf), sink, loads.events_transform("FULL_OVERWRITE"),
                    partition_by=["event_date"])
    return sink.read().drop("load_ts")


@query(loaded_events("INCREMENTAL"))
def incremental_load_events(spark, sf):
    return _load_events(spark, sf, 0)


@query(loaded_events("INCREMENTAL", """TRUE
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC NULLS LAST, user_id DESC NULLS LAST,
  event_type DESC NULLS LAST, product_id DESC NULLS LAST, amount DESC NULLS LAST) = 1"""))
def incremental_lookback_upsert(spark, sf):
    return _load_events(spark, sf, 86_400)


DAY_BEFORE = "event_ts > TIMESTAMP '2024-01-14' AND event_ts <= TIMESTAMP '2024-01-15'"
PLAIN_EVENTS = "event_id, user_id, event_type, product_id, amount, event_ts, event_date"


@query(O.over("events_feed", f"""
SELECT 'killed' AS seen, {PLAIN_EVENTS}, FALSE AS rewritten FROM events_feed WHERE event_ts <= TIMESTAMP '2024-01-15'
UNION ALL
SELECT 'switched', event_id, user_id, CASE WHEN {DAY_BEFORE} THEN 'late' ELSE event_type END, product_id, amount, event_ts,
       event_date, event_date IN (SELECT event_date FROM events_feed WHERE {DAY_BEFORE})
FROM events_feed WHERE event_ts <= TIMESTAMP '2024-01-15'"""))
def upsert_killed_before_switch(spark, sf):
    """An upsert that dies once its rows are written, what readers see then, and the same upsert run to its end."""
    feed = X.events_feed(spark, sf)
    table = parted.PartedTable(spark, new_folder(spark, "events-parted"), parted.ByValue("event_date", fixed=True))
    table.create(feed.where(F.col("event_ts") <= F.lit(SPLIT)))
    late = feed.where(DAY_BEFORE).withColumn("event_type", F.lit("late"))
    table.prepare_merge(late, ["event_id"], lambda present, new: merge.upsert(present, new, ["event_id"]))
    killed = table.read()
    table.upsert(late, ["event_id"])
    first = next(iter(table.parts(0).values()))["folders"][0].rsplit("/", 2)[1]
    seen = table.read().select("*", ~F.col("_metadata.file_path").contains(first)).toDF(*killed.columns, "rewritten")
    return (killed.withColumn("rewritten", F.lit(False)).withColumn("seen", F.lit("killed"))
            .unionByName(seen.withColumn("seen", F.lit("switched"))))


@query(O.over("events_feed", f"""
SELECT {EVENT_COLUMNS.replace("event_date", "CAST(event_date AS DATE) - CAST(CASE WHEN event_ts > TIMESTAMP '2024-01-15' THEN 10 ELSE 0 END AS INTEGER) AS event_date")},
       'INCREMENTAL' AS load_strategy FROM events_feed WHERE event_type IS NOT NULL"""))
def incremental_late_partition(spark, sf):
    """The second run delivers into partitions that lie before the mark."""
    folder = new_folder(spark, "events-late")
    marks = state.TimestampWatermark(spark, f"{folder}/marks", "events", 0)
    days = F.when(F.col("event_ts") > F.lit(SPLIT), 10).otherwise(0)
    feed = X.events_feed(spark, sf).withColumn("event_date", F.date_sub("event_date", days))
    transform = loads.events_transform("INCREMENTAL")
    for upto in (SPLIT, None):
        loads.incremental_load(feed, f"{folder}/silver", marks, "event_ts", transform, keys=["event_id"],
                               partition_column="event_date", upto=upto)
    return loads.read_sink(spark, f"{folder}/silver", transform(feed).schema).drop("load_ts")


@query(loaded_events("INCREMENTAL"))
def incremental_after_crash(spark, sf):
    """A run dies after its rows are written and before the mark moves; the next one delivers the rest once."""
    folder = new_folder(spark, "events-crashed")
    marks = state.TimestampWatermark(spark, f"{folder}/marks", "events", 0)
    feed, transform = X.events_feed(spark, sf), loads.events_transform("INCREMENTAL")

    def load(upto):
        loads.incremental_load(feed, f"{folder}/silver", marks, "event_ts", transform, keys=["event_id"],
                               partition_column="event_date", upto=upto)

    load(SPLIT - dt.timedelta(days=5))
    written = transform(filters.between_cursors(feed, "event_ts", SPLIT - dt.timedelta(days=5), SPLIT))
    loads.append_new(spark, f"{folder}/silver", written, ["event_id"], "event_ts", SPLIT - dt.timedelta(days=5), "event_date")
    load(None)
    return loads.read_sink(spark, f"{folder}/silver", transform(feed).schema).drop("load_ts")


@query(loaded_events("INCREMENTAL", """TRUE
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC NULLS LAST, user_id DESC NULLS LAST,
  event_type DESC NULLS LAST, product_id DESC NULLS LAST, amount DESC NULLS LAST) = 1"""))
def incremental_after_reset(spark, sf):
    """The mark is reset after two runs; the third reads everything again and leaves one row per event."""
    folder = new_folder(spark, "events-reset")
    marks = state.TimestampWatermark(spark, f"{folder}/marks", "events", 3600)
    feed, transform = X.events_feed(spark, sf), loads.events_transform("INCREMENTAL")
    for upto in (SPLIT, None, None):
        loads.incremental_load(feed, f"{folder}/silver", marks, "event_ts", transform, keys=["event_id"],
                               partition_column="event_date", upto=upto)
        if upto is None:
            marks.reset()
    return loads.read_sink(spark, f"{folder}/silver").drop("load_ts")


class _Died(RuntimeError):
    pass


@query(O.over("orders_feed", """
SELECT *, order_amount AS order_amount_usd, 'TIMESTAMP' AS wm_strategy, (SELECT max(created_ts) FROM orders_feed) AS mark
FROM orders_feed"""))
def orders_merged_after_crashes(spark, sf):
    """Orders by timestamp into a table that holds its own mark; runs die while rows are written and before the switch."""
    feed = X.orders_feed(spark, sf)
    table = parted.PartedTable(spark, new_folder(spark, "orders-merged"), parted.HashBuckets(("order_id",), 16))
    transform = loads.orders_transform("TIMESTAMP")
    low, high = feed.agg(F.min("created_ts"), F.max("created_ts")).first()
    put, write = table.versions.put, table._write

    def die(*_):
        raise _Died

    middle = None if low is None else low + (high - low) / 2
    for step in ("put", "write", None):
        table.versions.put, table._write = (die if step == "put" else put), (die if step == "write" else write)
        for upto in (middle, None):
            try:
                loads.incremental_merge(feed, table, "created_ts", transform, keys=["order_id"], name="orders",
                                        lookback_seconds=300, upto=upto)
            except _Died:
                pass
    return table.read().drop("load_ts").withColumn("mark", F.lit(table.mark("orders")).cast("timestamp_ntz"))


@query("""
SELECT CAST(s AS INTEGER) AS lookback_seconds,
       (SELECT count(*) FROM events WHERE ts > (SELECT max(ts) FROM events) - to_seconds(s)) AS repeated_rows
FROM (VALUES (0), (300), (86400)) v(s)""")
def lookback_duplicate_count(spark, sf):
    return loads.lookback_overlap(X.table(spark, sf, "events"), "ts", (0, 300, 86_400))


@query("""
SELECT count(*) AS full_rows, count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15') AS incremental_rows,
       1 - count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15') / count(*) AS saved_share
FROM events""")
def incremental_saving(spark, sf):
    return loads.run_size(X.table(spark, sf, "events"), "ts", SPLIT)


def _load_orders_by_id(spark, sf, folder):
    feed = X.orders_feed(spark, sf)
    marks = state.SequenceWatermark(spark, f"{folder}/marks", "orders")
    low, high = feed.agg(F.min("order_id"), F.max("order_id")).first()
    transform = loads.orders_transform("SEQUENCE")
    middle = None if low is None else (low + high) // 2
    for upto in (middle, None):
        loads.incremental_load(feed, f"{folder}/silver", marks, "order_id", transform, keys=["order_id"], upto=upto)
    return readers.read_files(spark, f"{folder}/silver", schema=transform(feed).schema).drop("load_ts")


@query(O.over("orders_feed", """
SELECT *, order_amount AS order_amount_usd, 'SEQUENCE' AS wm_strategy FROM orders_feed"""))
def incremental_by_id(spark, sf):
    return _load_orders_by_id(spark, sf, new_folder(spark, "orders-by-id"))


def _saved_marks(spark, sf, folder):
    events, orders = X.table(spark, sf, "events"), X.table(spark, sf, "orders")
    by_time = state.TimestampWatermark(spark, f"{folder}/marks", "events", 0)
    by_time.save(SPLIT)
    by_time.save(filters.highest_cursor(events, "ts"))
    state.TimestampWatermark(spark, f"{folder}/marks", "orders", 0).save(
        filters.highest_cursor(orders, "o_orderdate"))
    state.SequenceWatermark(spark, f"{folder}/marks", "orders_by_id").save(
        filters.highest_cursor(orders, "o_orderkey"))
    return by_time


MARKS = """
SELECT 'events' AS table_name, (SELECT max(ts) FROM events) AS watermark_ts, CAST(NULL AS BIGINT) AS last_id
UNION ALL SELECT 'orders', (SELECT max(o_orderdate) FROM orders), NULL
UNION ALL SELECT 'orders_by_id', NULL, (SELECT max(o_orderkey) FROM orders)"""


@query(MARKS)
def watermark_state(spark, sf):
    folder = new_folder(spark, "marks")
    _saved_marks(spark, sf, folder)
    return state.current_marks(spark, f"{folder}/marks").drop("updated_at")


@query(f"SELECT * FROM ({MARKS}) WHERE table_name <> 'events'")
def watermark_reset(spark, sf):
    folder = new_folder(spark, "marks")
    _saved_marks(spark, sf, folder).reset()
    return state.current_marks(spark, f"{folder}/marks").drop("updated_at")


@query(O.over("events_feed", "SELECT * FROM events_feed WHERE NOT coalesce(event_type = 'error', FALSE)"))
def predicate_delete(spark, sf):
    """Rows a DELETE leaves, rows with an unknown condition among them, published as the new content."""
    table = snapshot.Snapshots(spark, new_folder(spark, "events-deleted"))
    table.publish(filters.without(X.events_feed(spark, sf), "event_type = 'error'"), "DELETE")
    return table.read()


@query(O.over("events_feed", "SELECT * FROM events_feed WHERE event_ts > TIMESTAMP '2024-01-15'"))
def partitioned_events_pruned(spark, sf):
    folder = new_folder(spark, "events-by-date")
    feed = X.events_feed(spark, sf)
    snapshot.write_counted(layout.gather_by_key(feed, "event_date"), folder, partition_by=["event_date"])
    stored = readers.read_files(spark, folder, schema=feed.schema)
    recent = filters.between_cursors(stored, "event_ts", SPLIT, None)
    return filters.since_partition(recent, "event_date", SPLIT)


# ---- change batches and merges --------------------------------------------

def _source(spark, sf):
    return X.customer_changes(spark, sf)


def _merge(spark, sf, **options):
    return merge.merge_scd1(X.customer_target(spark, sf), _source(spark, sf), as_of=MERGED_AT, **options)


MERGED_COLUMNS = "* EXCLUDE (action)"
FEEDS = ("update", "insert", "soft_delete")


@query(O.over("target", f"""
SELECT *, CASE WHEN NOT is_active THEN 'soft_delete' WHEN customer_id > {X.NEW_ID_FLOOR} THEN 'insert' ELSE 'update' END
          AS operation
FROM ({X.branches_sql('target', {k: X.CHANGES[k] for k in FEEDS})})"""))
def cdc_batch(spark, sf):
    feeds = [X.customer_changes(spark, sf, kind) for kind in FEEDS]
    return cdc.with_operation(cdc.cdc_batch(*feeds), X.NEW_ID_FLOOR)


@query(O.over("target source", O.merged(null_safe=False, columns=MERGED_COLUMNS)))
def merge_scd1(spark, sf):
    """Plain SQL comparison, shuffled joins."""
    return _merge(spark, sf, null_safe=False, strategy="shuffle")


@query(O.over("target source", O.merged(null_safe=False, columns=MERGED_COLUMNS)))
def merge_scd1_broadcast(spark, sf):
    """The same merge with the change batch broadcast while it is small enough."""
    return _merge(spark, sf, null_safe=False, strategy="broadcast")


@query(O.over("target source", O.merged(columns=MERGED_COLUMNS)))
def merge_null_safe(spark, sf):
    return _merge(spark, sf)


@query(O.over("target source", f"SELECT action, count(*) AS rows FROM ({O.merged(null_safe=False)}) GROUP BY action"))
def merge_action_counts(spark, sf):
    return merge.action_counts(_merge(spark, sf, null_safe=False, with_action=True))


@query(O.over("target source", f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT is_active) AS inactive_rows,
       count(*) FILTER (WHERE customer_id > {X.NEW_ID_FLOOR}) AS new_rows FROM ({O.merged()})"""))
def merge_validation(spark, sf):
    return merge.merge_report(_merge(spark, sf), X.NEW_ID_FLOOR)


@query(O.over("target source", O.merged(delete=True, columns=MERGED_COLUMNS)))
def merge_with_delete(spark, sf):
    return _merge(spark, sf, delete_inactive=True)


@query(O.over("target source", O.merged(
    source=f"(SELECT *, {X.LOYALTY_TIER} AS loyalty_tier FROM source)", extra="loyalty_tier",
    columns=MERGED_COLUMNS)))
def merge_schema_evolution(spark, sf):
    evolved = _source(spark, sf).withColumn("loyalty_tier", F.expr(X.LOYALTY_TIER))
    return merge.merge_scd1(X.customer_target(spark, sf), evolved, as_of=MERGED_AT, evolve=True)


LATEST = """(SELECT * EXCLUDE (pick, order_key) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY updated_ts DESC, order_key DESC, country DESC, lifetime_value DESC) AS pick FROM orders_as_source)
  WHERE pick = 1)"""


@query(O.over("target orders_as_source", O.merged(source=LATEST, columns=MERGED_COLUMNS)))
def merge_latest_source(spark, sf):
    """Many source rows per key, reduced to the newest before the merge."""
    newest = merge.latest_by(X.orders_as_source(spark, sf), ["customer_id"], ["updated_ts", "order_key"])
    return merge.merge_scd1(X.customer_target(spark, sf), newest.drop("order_key"), as_of=MERGED_AT)


@query(O.over("target change_log", """
SELECT coalesce(l.customer_id, t.customer_id) AS customer_id,
       CASE WHEN l.op IS NULL THEN t.full_name ELSE l.full_name END AS full_name,
       CASE WHEN l.op IS NULL THEN t.email ELSE l.email END AS email,
       CASE WHEN l.op IS NULL THEN t.country ELSE l.country END AS country,
       CASE WHEN l.op IS NULL THEN t.lifetime_value ELSE l.lifetime_value END AS lifetime_value
FROM target t FULL OUTER JOIN (
  SELECT * FROM change_log WHERE op <> 3 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq DESC) = 1) l
  ON t.customer_id = l.customer_id
WHERE l.op IS NULL OR l.op <> 1"""))
def apply_cdc_ops(spark, sf):
    target = X.customer_target(spark, sf).select("customer_id", "full_name", "email", "country", "lifetime_value")
    return cdc.apply_change_log(target, X.change_log(spark, sf), ["customer_id"], "seq")


@query(O.over("target source", O.merged(
    source="(SELECT * FROM source WHERE updated_ts >= DATE '2024-01-02')", columns=MERGED_COLUMNS)))
def merge_source_window(spark, sf):
    """Only source rows changed since the day before take part."""
    recent = _source(spark, sf).filter(since_yesterday(F.col("updated_ts"), F.lit(MERGED_AT.date())))
    return merge.merge_scd1(X.customer_target(spark, sf), recent, as_of=MERGED_AT)


@query(O.over("target source", f"""
SELECT 'MERGE' AS operation, (SELECT count(*) FROM ({O.merged()})) AS row_count,
       (SELECT count(*) FROM ({O.merged()}) WHERE action = 'insert') AS inserted,
       (SELECT count(*) FROM ({O.merged()}) WHERE action = 'update') AS updated,
       (SELECT count(*) FROM ({O.merged()}) WHERE action = 'soft_delete') AS soft_deleted
UNION ALL SELECT 'WRITE', count(*), NULL, NULL, NULL FROM target"""))
def merge_history(spark, sf):
    """Operation metrics of a published merge, newest first."""
    table = snapshot.Snapshots(spark, new_folder(spark, "customers"))
    table.publish(X.customer_target(spark, sf), "WRITE")
    audit.publish_merge(table, merge.merge_scd1(table.read(), _source(spark, sf), as_of=MERGED_AT, with_action=True))
    noted = F.col("metrics")
    return table.history(2).select("operation", "row_count", noted["insert"].alias("inserted"),
                                   noted["update"].alias("updated"), noted["soft_delete"].alias("soft_deleted"))


TOP = "(SELECT max(c_custkey) FROM customer)"
RANGES = 8
RANGE_OF = f"(SELECT count(*) FROM range(1, {RANGES}) r(i) WHERE {{0}} >= {TOP} * i // {RANGES})"
NARROW = f"(customer_id <= {TOP} // 4 OR customer_id > {X.NEW_ID_FLOOR})"


def _customer_table(spark, sf, label):
    """The customers in key ranges, and the highest key of the base table."""
    customers = X.customer_target(spark, sf)
    top = customers.agg(F.max("customer_id")).first()[0] or 0
    bounds = sorted({top * i // RANGES for i in range(1, RANGES)})
    return parted.PartedTable(spark, new_folder(spark, label), parted.KeyRanges("customer_id", tuple(bounds))), top


def _carried(table, df=None):
    """The rows of the table, and whether they still lie in the files of its first version."""
    run = next(iter(table.parts(0).values()))["folders"][0].rsplit("/", 2)[1]
    rows = table.read()
    return rows.select("*", F.col("_metadata.file_path").contains(run).alias("carried"))


@query(O.over("target source", f"""
SELECT {MERGED_COLUMNS}, {RANGE_OF.format('customer_id')} NOT IN (SELECT DISTINCT {RANGE_OF.format('customer_id')} FROM source
  WHERE {NARROW}) AS carried
FROM ({O.merged(source=f"(SELECT * FROM source WHERE {NARROW})")})"""))
def merge_touched_ranges(spark, sf):
    """A change batch over a quarter of the keys and new ones: other key ranges keep their files."""
    table, top = _customer_table(spark, sf, "customers-parted")
    dimension.bootstrap(table, X.customer_target(spark, sf).drop("load_ts", "record_source"), dt.datetime(2024, 1, 1))
    narrow = (F.col("customer_id") <= top // 4) | (F.col("customer_id") > X.NEW_ID_FLOOR)
    dimension.apply_changes(table, _source(spark, sf).where(narrow), as_of=MERGED_AT)
    return _carried(table)


@query(O.over("target source", f"""
SELECT * FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT is_active) AS inactive_rows,
         count(*) FILTER (WHERE customer_id > {X.NEW_ID_FLOOR}) AS new_rows FROM ({O.merged()})),
     (SELECT customer_id AS sample_key, email AS sample_email, record_source AS sample_source FROM ({O.merged()})
      WHERE load_ts >= TIMESTAMP '2024-01-03' AND customer_id <= {X.NEW_ID_FLOOR} ORDER BY customer_id LIMIT 5)"""))
def merge_validated_sample(spark, sf):
    """First load through its own operator, merge, then counts and a sample of the updated keys."""
    table, _ = _customer_table(spark, sf, "customers-validated")
    dimension.bootstrap(table, X.customer_target(spark, sf).drop("load_ts", "record_source"), dt.datetime(2024, 1, 1))
    dimension.apply_changes(table, _source(spark, sf), as_of=MERGED_AT)
    return dimension.validation(table.read(), MERGED_AT, 5, X.NEW_ID_FLOOR)


@query("""
SELECT v.version, v.operation, v.row_count, v.inserted FROM (
  SELECT CAST(0 AS BIGINT) AS version, 'FIRST' AS operation, (SELECT count(*) FROM customer) AS row_count, CAST(NULL AS BIGINT) AS inserted
  UNION ALL SELECT 1, 'FASTER', (SELECT count(*) FROM customer WHERE c_acctbal > 0), 1
  UNION ALL SELECT 2, 'AGAIN', (SELECT count(*) FROM customer WHERE c_acctbal <= 0), 3) v""")
def publish_two_writers(spark, sf):
    """Two writers publish the same version: one fails, and succeeds with the next number when told to try again."""
    customers, folder = X.table(spark, sf, "customer"), new_folder(spark, "two-writers")
    slow, fast = snapshot.Snapshots(spark, folder), snapshot.Snapshots(spark, folder)
    slow.publish(customers, "FIRST")

    def overtaken(_):
        fast.publish(customers.where("c_acctbal > 0"), "FASTER", metrics={"insert": 1})
        return {"insert": 2}

    failed = False
    try:
        slow.publish(customers.where("c_acctbal <= 0"), "SLOWER", metrics=overtaken)
    except VersionTakenError:
        failed = True
    if failed:
        slow.publish(customers.where("c_acctbal <= 0"), "AGAIN", metrics={"insert": 3}, retries=1)
    return slow.history(9).select("version", "operation", "row_count", F.col("metrics")["insert"].alias("inserted"))


# ---- snapshots, layout, schema --------------------------------------------

@query("""
SELECT c_custkey, c_name, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS zone, CAST(NULL AS BIGINT) AS visits FROM customer
WHERE c_nationkey < 7
UNION ALL SELECT c_custkey, c_name, lpad(CAST(c_nationkey AS VARCHAR), 3, '0'), c_custkey FROM customer WHERE c_nationkey >= 7""")
def view_keeps_partition_types(spark, sf):
    """Publications of an added and of an equal schema behind one name, partitioned by a text of digits."""
    folder = new_folder(spark, "zones")
    name = f"zones_{folder.rsplit('-', 1)[1]}"
    zone = F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("zone")
    customers = X.table(spark, sf, "customer").select("c_custkey", "c_name", zone, "c_nationkey")
    low = customers.where("c_nationkey < 7").drop("c_nationkey")
    high = customers.where("c_nationkey >= 7").drop("c_nationkey").withColumn("visits", F.col("c_custkey"))
    snapshot.publish_verified(low, name, folder, partition_by=["zone"])
    both = spark.table(name).unionByName(high, allowMissingColumns=True)
    snapshot.publish_verified(both, name, folder, schema="union", partition_by=["zone"])
    again = snapshot.Snapshots(spark, folder).read()
    snapshot.publish_verified(again, name, folder, schema="same", partition_by=["zone"])
    return spark.table(name)


@query("""
SELECT 'union' AS rule, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS note FROM orders
UNION ALL SELECT 'replace', o_orderstatus || CAST(o_orderkey AS VARCHAR), NULL, o_orderpriority FROM orders""")
def publications_of_other_schemas(spark, sf):
    """The second publication lacks a column, which stays as nulls; the third has other columns and types."""
    table = snapshot.Snapshots(spark, new_folder(spark, "schemas"))
    orders = X.table(spark, sf, "orders")
    table.publish(orders.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("note")))
    table.publish(orders.select("o_orderkey", "o_totalprice"), schema="union")
    added = table.read().withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    key = F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))
    table.publish(orders.select(key.alias("o_orderkey"), F.col("o_orderpriority").alias("note")), schema="replace")
    replaced = table.read().withColumn("o_totalprice", F.lit(None).cast("double"))
    return (added.withColumn("rule", F.lit("union"))
            .unionByName(replaced.withColumn("rule", F.lit("replace"))).select("rule", "o_orderkey", "o_totalprice", "note"))


@query("SELECT * FROM customer")
def snapshot_publish(spark, sf):
    folder = new_folder(spark, "published")
    name = f"customer_{folder.rsplit('-', 1)[1]}"
    snapshot.publish_verified(X.table(spark, sf, "customer"), name, folder)
    return spark.table(name)


@query("SELECT * FROM customer")
def catalog_table_overwrite(spark, sf):
    """A catalog table created, then overwritten under the same schema."""
    folder = new_folder(spark, "catalog")
    name = f"customer_{folder.rsplit('-', 1)[1]}"
    for same_schema in (False, True):
        snapshot.save_table(X.table(spark, sf, "customer"), name, path=folder, same_schema=same_schema)
    return spark.table(name)


@query("SELECT c_custkey, c_name, c_acctbal * 2 AS doubled FROM customer WHERE c_acctbal > 0")
def catalog_table_replaced(spark, sf):
    """A catalog table written three times: other rows under the same schema, then another schema."""
    folder = new_folder(spark, "catalog-replaced")
    name = f"customer_{folder.rsplit('-', 1)[1]}"
    customers = X.table(spark, sf, "customer")
    snapshot.save_table(customers, name, path=folder)
    snapshot.save_table(customers.where("c_acctbal <= 0"), name, path=folder, same_schema=True)
    positive = customers.where("c_acctbal > 0")
    snapshot.save_table(positive.select("c_custkey", "c_name", (F.col("c_acctbal") * 2).alias("doubled")), name, path=folder)
    return spark.table(name)


@query("""
SELECT 0 AS version, count(*) AS row_count, TRUE AS by_me, TRUE AS in_time, count(*) AS stamped_in_time FROM customer""")
def publication_stamps(spark, sf):
    """Who published and when, and the load time of every row, held against this session's user and clock."""
    table = snapshot.Snapshots(spark, new_folder(spark, "stamps"))
    started = dt.datetime.now(dt.UTC)
    table.publish(C.with_audit(X.table(spark, sf, "customer"), {}, loaded_at="load_ts"))
    inside = lambda c: c.between(F.lit(started - dt.timedelta(seconds=1)), F.lit(dt.datetime.now(dt.UTC)))
    stamped = table.read().agg(F.count_if(inside(F.col("load_ts"))).alias("stamped_in_time"))
    return table.history(1).select(
        F.col("version").cast("int").alias("version"), "row_count", (F.col("published_by") == F.current_user()).alias("by_me"),
        inside(F.col("published_at")).alias("in_time")).join(stamped, F.lit(True))


@query(O.over("target orders_as_source", f"""
SELECT TRUE AS refused, count(*) AS merged_rows, count(*) FILTER (WHERE load_ts > TIMESTAMP '2024-01-02') AS changed
FROM ({O.merged(source=LATEST)})"""))
def merge_refuses_copies(spark, sf):
    """Several source rows for one target row are an error; reduced to the newest they merge."""
    target, source = X.customer_target(spark, sf), X.orders_as_source(spark, sf)
    refused = False
    try:
        merge.merge_scd1(target, source.drop("order_key"), as_of=MERGED_AT)
    except merge.AmbiguousMatchError:
        refused = True
    newest = merge.latest_by(source, ["customer_id"], ["updated_ts", "order_key"]).drop("order_key")
    return merge.merge_scd1(target, newest, as_of=MERGED_AT).agg(
        F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("merged_rows"),
        F.count_if(F.col("load_ts") > F.lit(MERGED_AT - dt.timedelta(days=1))).alias("changed"))


SNAPSHOT_TABLES = ("orders", "customer")


@query("""
SELECT 'orders' AS table_name, count(*) AS row_count, CAST(6 AS INTEGER) AS column_count FROM orders
UNION ALL SELECT 'customer', count(*), 5 FROM customer""")
def snapshot_configured_tables(spark, sf):
    """Each configured table through drift check, publication and verification."""
    folder = new_folder(spark, "silver")
    names = {t: f"silver_{t}_{folder.rsplit('-', 1)[1]}" for t in SNAPSHOT_TABLES}
    audit.snapshot_all({t: X.table(spark, sf, t) for t in SNAPSHOT_TABLES}, folder, names)
    return audit.verify_tables(spark, names)


@query("""
SELECT position, column_name, data_type, filled FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'),
  (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string'))
  v(position, column_name, data_type)
JOIN (SELECT 1 AS p, count(o_orderkey) AS filled FROM orders UNION ALL SELECT 2, count(o_custkey) FROM orders
      UNION ALL SELECT 3, count(o_orderstatus) FROM orders UNION ALL SELECT 4, count(o_totalprice) FROM orders
      UNION ALL SELECT 5, count(o_orderdate) FROM orders UNION ALL SELECT 6, count(o_orderpriority) FROM orders)
  ON p = position""")
def schema_rows(spark, sf):
    return drift.schema_rows(X.table(spark, sf, "orders"))


def _drift(spark, sf):
    incoming = X.orders_v2(spark, sf)
    return incoming, drift.detect_drift("orders", X.table(spark, sf, "orders").schema, incoming)


DRIFT_ROWS = O.over("orders_v2", """
SELECT 'orders' AS table_name, 'discount_pct' AS column_name, 'new' AS kind, CAST(NULL AS VARCHAR) AS from_type,
       'decimal(5,2)' AS to_type, count(discount_pct) AS filled, 0 AS lost_values FROM orders_v2
UNION ALL SELECT 'orders', 'o_orderpriority', 'dropped', 'string', NULL, 0, 0
UNION ALL SELECT 'orders', 'o_totalprice', 'type_changed', 'double', 'string', count(o_totalprice),
       count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NULL) FROM orders_v2""")


@query(DRIFT_ROWS)
def drift_report(spark, sf):
    return drift.drift_report(*_drift(spark, sf))


@query(DRIFT_ROWS)
def drift_audit_log(spark, sf):
    folder = new_folder(spark, "drift-log")
    audit.log_drift(*_drift(spark, sf), folder)
    return audit.drift_log(spark, folder).drop("detected_at")


FINGERPRINT = ("'orders_v' || left(sha256('o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,"
               "o_totalprice:string,o_orderdate:timestamp_ntz,discount_pct:decimal(5,2)'), 12) AS _schema_version")


@query(O.over("orders_v2", f"SELECT *, CAST(NULL AS VARCHAR) AS o_orderpriority, {FINGERPRINT} FROM orders_v2"))
def drift_apply(spark, sf):
    incoming, found = _drift(spark, sf)
    return drift.repair_if_drifted(incoming, found).drop("_processed_at")


@query(O.over("orders_v2", f"""
SELECT * REPLACE (TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice), CAST(NULL AS VARCHAR) AS o_orderpriority,
       {FINGERPRINT} FROM orders_v2"""))
def drift_apply_saved_types(spark, sf):
    """Changed columns go back to the saved type; what does not fit becomes null."""
    incoming, found = _drift(spark, sf)
    return drift.repair_if_drifted(incoming, found, keep_saved_types=True).drop("_processed_at")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, o_totalprice,
       CAST(NULL AS DECIMAL(5,2)) AS discount_pct FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, NULL, o_totalprice,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 30 END AS DECIMAL(5,2)) FROM orders""")
def union_evolved_schemas(spark, sf):
    """Two generations of a table under the union of their columns."""
    old = X.table(spark, sf, "orders")
    new = X.table(spark, sf, "orders").drop("o_orderpriority").withColumn(
        "discount_pct", F.when(F.col("o_orderkey") % 4 == 0, None)
        .otherwise((F.col("o_orderkey") % 30).cast("decimal(5,2)")))
    return old.unionByName(new, allowMissingColumns=True)


@query("SELECT * FROM customer")
def cluster_by_key(spark, sf):
    """Written in key order over ranges, then read back through a SQL path scan."""
    folder = new_folder(spark, "customer-clustered")
    snapshot.write_counted(layout.cluster_by_key(X.table(spark, sf, "customer"), "c_custkey"), folder)
    return readers.scan_path(spark, folder)


@query()
def partition_report(spark, sf):
    return layout.partition_report(layout.gather_by_key(X.table(spark, sf, "customer"), "c_custkey"))


@query("SELECT count(*) AS rows, CAST(8 AS BIGINT) AS files, CAST(0 AS BIGINT) AS meeting, 0.125 AS share FROM customer")
def clustered_file_ranges(spark, sf):
    """Clustered into eight files: no two ranges meet, and a lookup opens one of them."""
    folder = new_folder(spark, "customer-ranges")
    snapshot.write_counted(layout.cluster_by_key(X.table(spark, sf, "customer"), "c_custkey", partitions=8), folder)
    return layout.lookup_cost(readers.read_files(spark, folder), "c_custkey")


@query("SELECT CAST(8 AS BIGINT) AS partitions, count(*) AS rows FROM customer")
def repartition_report(spark, sf):
    """Dealt by hash of the key to a given number of partitions, and counted per partition."""
    dealt = X.table(spark, sf, "customer").repartition(8, "c_custkey")
    return layout.partition_report(dealt).agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))


@query("SELECT least(100, count(*)) AS sampled, least(100, count(*)) AS known FROM orders")
def sample_limit_known(spark, sf):
    """An unordered sample: as many rows as asked for, all of them rows of the table."""
    orders = X.table(spark, sf, "orders")
    known = orders.limit(100).join(orders, orders.columns, "left_semi")
    return orders.limit(100).agg(F.count(F.lit(1)).alias("sampled")).join(
        known.agg(F.count(F.lit(1)).alias("known")), F.lit(True))


@query("""
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, CAST(floor(-o_totalprice / 7) AS BIGINT) AS below,
       o_totalprice - floor(o_totalprice) AS rest FROM orders""")
def floor_amounts(spark, sf):
    price = F.col("o_totalprice")
    return X.table(spark, sf, "orders").select("o_orderkey", F.floor(price).alias("whole"), F.floor(-price / 7).alias("below"),
                                               (price - F.floor(price)).alias("rest"))


@query("""
SELECT 'added' AS side, 'discount_pct' AS column_name UNION ALL SELECT 'dropped', 'o_orderpriority'""")
def columns_added_and_dropped(spark, sf):
    old, new = X.table(spark, sf, "orders"), X.orders_v2(spark, sf)
    found = [("added", c) for c in drift.columns_only_in(new, old)] + [("dropped", c) for c in drift.columns_only_in(old, new)]
    return spark.createDataFrame(found, "side string, column_name string")


SHAPES = """SELECT *, CAST(o_orderkey % 100 AS SMALLINT) AS grade, CAST(o_orderkey % 8 AS FLOAT) / 4 AS ratio FROM orders_v2"""


@query(O.over("orders_v2", f"""
SELECT * FROM (WITH v AS ({SHAPES})
SELECT 'report' AS line, 1 AS run, column_name, kind, from_type, to_type, filled, lost_values FROM (
  SELECT 'discount_pct' AS column_name, 'new' AS kind, CAST(NULL AS VARCHAR) AS from_type, 'decimal(5,2)' AS to_type,
         count(discount_pct) AS filled, 0 AS lost_values FROM v
  UNION ALL SELECT 'grade', 'new', NULL, 'int', count(grade), 0 FROM v
  UNION ALL SELECT 'ratio', 'new', NULL, 'double', count(ratio), 0 FROM v
  UNION ALL SELECT 'o_orderpriority', 'dropped', 'string', NULL, 0, 0
  UNION ALL SELECT 'o_totalprice', 'type_changed', 'double', 'string', count(o_totalprice),
         count(*) FILTER (o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NULL) FROM v)
UNION ALL
SELECT 'column', CAST(position AS INTEGER), column_name, data_type, NULL, NULL, filled, NULL FROM (
  SELECT 1 AS position, 'o_orderkey' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS filled FROM v
  UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM v
  UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM v
  UNION ALL SELECT 4, 'o_totalprice', 'double', count(TRY_CAST(o_totalprice AS DOUBLE)) FROM v
  UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM v
  UNION ALL SELECT 6, 'discount_pct', 'decimal(5,2)', count(discount_pct) FROM v
  UNION ALL SELECT 7, 'grade', 'int', count(grade) FROM v
  UNION ALL SELECT 8, 'ratio', 'double', count(ratio) FROM v
  UNION ALL SELECT 9, 'o_orderpriority', 'string', 0)
UNION ALL
SELECT 'sample', 0, CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, grade, NULL FROM (SELECT * FROM v ORDER BY o_orderkey LIMIT 3))"""))
def snapshot_drift_over_runs(spark, sf):
    """Three runs of a table: the second brings new, dropped, changed and small columns, the third the same again."""
    folder = new_folder(spark, "drift-runs")
    name = f"drift_{folder.rsplit('-', 1)[1]}"
    second = X.orders_v2(spark, sf).withColumns({
        "grade": (F.col("o_orderkey") % 100).cast("smallint"),
        "ratio": ((F.col("o_orderkey") % 8).cast("float") / F.lit(4).cast("float")).cast("float")})
    for df in (X.table(spark, sf, "orders"), second, second):
        audit.snapshot_with_drift(df, "orders", name, folder, keep_saved_types=True)
    kept = state.DriftReports(spark, f"{folder}/drift_reports", "orders").replay()
    logged = audit.drift_log(spark, f"{folder}/drift_log").select("column_name", "filled", "lost_values")
    nothing = F.lit(None).cast("string")
    report = kept.join(logged, "column_name").select(
        F.lit("report").alias("line"), F.col("run").cast("int").alias("run"), "column_name", "kind", "from_type", "to_type",
        "filled", "lost_values")
    columns = drift.schema_rows(spark.table(name)).select(
        F.lit("column"), "position", "column_name", "data_type", nothing, nothing, "filled", F.lit(None).cast("bigint"))
    sample = audit.verify_sample(spark, {"orders": name}, {"orders": "o_orderkey"}).select(
        F.lit("sample"), F.lit(0), F.get_json_object("sample", "$.o_orderkey"), nothing, nothing, nothing,
        F.get_json_object("sample", "$.grade").cast("bigint"), F.lit(None).cast("bigint"))
    return report.union(columns).union(sample)


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS amount,
       o_orderstatus AS status, CAST(NULL AS VARCHAR) AS note,
       CASE WHEN o_orderkey % 5 = 0 THEN '{"amount":"n/a"}' END AS _rescued FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT), o_orderstatus, o_orderpriority,
       NULL
FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 7 <> 0
UNION ALL
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT), o_orderstatus, o_orderpriority, '{"extra":"' || o_orderkey % 100 || '"}'
FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 7 = 0""")
def json_shapes_rescued(spark, sf):
    """Two batches of JSON: amounts that turn to text, a new field, and one that only some lines hold."""
    folder, orders = new_folder(spark, "json-shapes"), X.table(spark, sf, "orders")
    key, whole = F.col("o_orderkey"), F.floor("o_totalprice")
    plain = F.struct(key.alias("id"), whole.alias("amount"), F.col("o_orderstatus").alias("status"))
    text = F.struct(key.alias("id"), F.lit("n/a").alias("amount"), F.col("o_orderstatus").alias("status"))
    first = orders.where(key % 2 == 0).select(F.when(key % 5 == 0, F.to_json(text)).otherwise(F.to_json(plain)).alias("value"))
    noted = F.struct(key.alias("id"), whole.alias("amount"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note"))
    more = F.struct(noted["id"].alias("id"), noted["amount"].alias("amount"), noted["status"].alias("status"),
                    noted["note"].alias("note"), (key % 100).alias("extra"))
    second = orders.where(key % 2 == 1).select(F.when(key % 7 == 0, F.to_json(more)).otherwise(F.to_json(noted)).alias("value"))
    saved, out = None, []
    for i, (batch, seen) in enumerate(((first, first.where("value NOT LIKE '%n/a%'")), (second, second.where("value NOT LIKE '%extra%'")))):
        batch.write.text(f"{folder}/{i}")
        # What the sample happens to hold is fixed here, so that the columns do not depend on file order.
        saved = rescue.merged_schema(saved, rescue.infer_schema(seen))
        out.append(rescue.typed_and_rescued(spark.read.text(f"{folder}/{i}"), saved))
    return out[0].unionByName(out[1], allowMissingColumns=True).select("id", "amount", "status", "note", "_rescued")


@query()
def sample_limit(spark, sf):
    return X.table(spark, sf, "orders").limit(100)


@query("""
SELECT event_id, 'User_' || CAST(user_id AS VARCHAR) AS user_label, user_id % 10000 AS bucket,
       ts - INTERVAL 3 DAY - to_seconds(user_id % 86400) AS shifted_days, ts - INTERVAL 72 HOUR AS shifted_hours
FROM events""")
def interval_shift(spark, sf):
    user, ts = F.col("user_id"), F.col("ts")
    return X.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("User_"), user.cast("string")).alias("user_label"),
        (user % 10_000).alias("bucket"),
        shift_back(ts, days=3, seconds=user % 86_400).alias("shifted_days"),
        shift_back(ts, hours=72).alias("shifted_hours"))


# ---- streams --------------------------------------------------------------

def _stream(spark, sf, name):
    return flows.stream_files(spark, f"{sf}/{name}.parquet", X.table(spark, sf, name).schema)


@query("SELECT * FROM events")
def stream_file_ingest(spark, sf):
    """Two runs over the same files; the second one finds nothing new."""
    folder = new_folder(spark, "stream-ingest")
    for _ in range(2):
        flows.ingest_files(_stream(spark, sf, "events"), f"{folder}/silver", f"{folder}/checkpoint")
    return readers.read_files(spark, f"{folder}/silver")


NEWEST_ORDERS = """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC,
  o_totalprice DESC, o_orderpriority DESC) = 1"""


@query(NEWEST_ORDERS)
def stream_upsert(spark, sf):
    """Newest order per customer, kept by a merge in every micro-batch."""
    folder = new_folder(spark, "stream-upsert")
    sink = snapshot.Snapshots(spark, f"{folder}/silver")
    flows.upsert_stream(_stream(spark, sf, "orders"), sink, f"{folder}/checkpoint", ["o_custkey"],
                        ["o_orderdate", "o_orderkey"])
    return sink.read()


@query(NEWEST_ORDERS)
def stream_upsert_two_sources(spark, sf):
    """The same from two sources of several files each, a file in every micro-batch."""
    folder = new_folder(spark, "stream-sources")
    orders = X.table(spark, sf, "orders")
    sink = snapshot.Snapshots(spark, f"{folder}/silver")
    for i, part in enumerate(("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0")):
        orders.where(part).repartition(2, "o_orderkey").write.parquet(f"{folder}/in{i}")
        files = flows.stream_files(spark, f"{folder}/in{i}", orders.schema, files_per_trigger=1)
        flows.upsert_stream(files, sink, f"{folder}/checkpoint{i}", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return sink.read()


@query(f"""
WITH newest AS ({NEWEST_ORDERS}), old AS ({NEWEST_ORDERS.replace("FROM orders", "FROM orders WHERE o_orderkey % 3 <> 0")})
SELECT newest.*, {RANGE_OF.format('o_custkey')} NOT IN (SELECT {RANGE_OF.format('o_custkey')} FROM orders
         WHERE o_orderkey % 3 = 0 AND o_custkey <= {TOP} // 4) AS carried
FROM newest WHERE o_custkey <= {TOP} // 4
UNION ALL SELECT old.*, {RANGE_OF.format('o_custkey')} NOT IN (SELECT {RANGE_OF.format('o_custkey')} FROM orders
         WHERE o_orderkey % 3 = 0 AND o_custkey <= {TOP} // 4) FROM old WHERE o_custkey > {TOP} // 4""")
def stream_upsert_touched(spark, sf):
    """A second stream brings news of a quarter of the customers; files of other key ranges stay."""
    folder = new_folder(spark, "stream-touched")
    orders = X.table(spark, sf, "orders")
    top = X.table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0] or 0
    bounds = sorted({top * i // RANGES for i in range(1, RANGES)})
    sink = parted.PartedTable(spark, f"{folder}/silver", parted.KeyRanges("o_custkey", tuple(bounds)))
    news = (F.col("o_orderkey") % 3 == 0) & (F.col("o_custkey") <= top // 4)
    for i, part in enumerate((F.col("o_orderkey") % 3 != 0, news)):
        orders.where(part).write.parquet(f"{folder}/in{i}")
        files = flows.stream_files(spark, f"{folder}/in{i}", orders.schema)
        flows.upsert_stream(files, sink, f"{folder}/checkpoint{i}", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return _carried(sink)


LATE = "ts <= TIMESTAMP '2024-01-05'"


@query(f"""
WITH e AS (SELECT DISTINCT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-31')
SELECT 'kept' AS output, event_id, ts FROM e UNION ALL SELECT 'late', event_id, ts FROM e WHERE {LATE}
UNION ALL SELECT 'remembered', event_id, ts FROM e WHERE ts >= (SELECT max(ts) FROM e) - INTERVAL 2 DAY
UNION ALL SELECT 'dropped', count(*), NULL FROM e WHERE ts > TIMESTAMP '2024-01-09' AND ts <= TIMESTAMP '2024-01-10'""")
def stream_dedupe_late(spark, sf):
    """Three batches two days apart in their watermark: copies are dropped, old rows come late, old keys are forgotten."""
    folder = new_folder(spark, "stream-late")
    events = X.table(spark, sf, "events").where("ts <= TIMESTAMP '2024-01-31'").select("event_id", "ts").distinct()
    batches = ("ts <= TIMESTAMP '2024-01-10'", "ts > TIMESTAMP '2024-01-09' AND ts <= TIMESTAMP '2024-01-20'",
               f"ts > TIMESTAMP '2024-01-20' OR {LATE}")
    for rows in batches:
        events.where(rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        files = flows.stream_files(spark, f"{folder}/in/", events.schema, files_per_trigger=1)
        flows.dedupe_with_late_rows(files, folder, f"{folder}/checkpoint", ["event_id"], "ts", 2 * 86_400)
    keys = snapshot.Snapshots(spark, f"{folder}/keys")
    outputs = [readers.read_files(spark, f"{folder}/{name}").select(F.lit(name).alias("output"), "event_id", "ts")
               for name in ("kept", "late")]
    dropped = keys.history(9).agg(F.sum(F.col("metrics")["dropped"]).alias("event_id"))
    return (outputs[0].union(outputs[1]).union(keys.read().select(F.lit("remembered"), "event_id", "ts"))
            .union(dropped.select(F.lit("dropped"), "event_id", F.lit(None).cast(events.schema["ts"].dataType))))


@query("SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events")
def stream_dedupe(spark, sf):
    """Every file arrives twice; each event stays once."""
    folder = new_folder(spark, "stream-dedupe")
    twice = _stream(spark, sf, "events").unionByName(_stream(spark, sf, "events"))
    flows.dedupe_stream(twice, f"{folder}/silver", f"{folder}/checkpoint", ["event_id"], "ts", "3650 days")
    return readers.read_files(spark, f"{folder}/silver")
