"""The given tables reshaped into the inputs the operators expect.

The SQL templates read the same in Spark and in the oracle; placeholders name
the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.operators.nested import flatten_structs

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLAIMS_RAW = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS claim_id,
       '  ' || CAST(o_custkey AS STRING) || ' ' AS member_id,
       CAST(l_suppkey AS STRING) AS npi,
       CASE WHEN l_orderkey % 50 = 0 THEN '2024-13-45' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date_of_service,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS claim_date,
       CASE WHEN l_partkey % 11 = 0 THEN 'n/a'
            ELSE CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS STRING) END AS paid_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS allowed_amount,
       CAST(CAST(l_quantity AS INT) AS STRING) AS quantity,
       ' ' || lower(l_returnflag) || ' ' AS claim_type,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE ' P' || CAST(l_partkey % 97 AS STRING) END AS cpt_code,
       l_linestatus || CAST(l_suppkey % 13 AS STRING) AS icd_code,
       l_partkey AS tie_part, l_suppkey AS tie_supp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

EVENTS_FEED = """
SELECT event_id, user_id,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type,
       'PROD_' || CAST(user_id % 500 AS STRING) AS product_id,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS amount,
       ts AS event_ts,
       CAST(ts AS DATE) AS event_date
FROM {events}
"""

ORDERS_FEED = """
SELECT o_orderkey AS order_id, 'CUST_' || CAST(o_custkey AS STRING) AS customer_id,
       CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'SHIPPED' ELSE 'DELIVERED' END AS status,
       o_totalprice AS order_amount, o_orderdate AS created_ts
FROM {orders}
"""

ORDERS_V2 = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS DECIMAL(5,2)) END AS discount_pct
FROM {orders}
"""

CUSTOMER_TARGET = """
SELECT c_custkey AS customer_id, c_name AS full_name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       CAST(c_nationkey AS STRING) AS country, TRUE AS is_active, c_acctbal AS lifetime_value,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_ts, TIMESTAMP '2024-01-01 00:00:00' AS load_ts,
       'CRM_INITIAL' AS record_source
FROM {customer}
"""

# Inserted ids start far above every key of the base table.
NEW_ID_FLOOR = 1_000_000_000_000

_KEPT = {c: c for c in ("customer_id", "full_name", "email", "country", "lifetime_value")}
_LATER = {"is_active": "TRUE", "updated_ts": "TIMESTAMP '2024-01-02 00:00:00'"}

# Kind of change -> (target rows it comes from, changed columns).
CHANGES = {
    "update": ("customer_id % 5 = 0", _KEPT | _LATER | {
        "email": "'updated.' || CAST(customer_id AS STRING) || '@newdomain.com'",
        "country": "CASE WHEN customer_id % 2 = 0 THEN 'CA' ELSE 'DE' END"}),
    "soft_delete": ("customer_id % 50 = 3", _KEPT | _LATER | {
        "is_active": "FALSE", "lifetime_value": "CAST(0.0 AS DOUBLE)"}),
    "name_only": ("customer_id % 50 = 4", _KEPT | _LATER | {"full_name": "'Renamed ' || full_name"}),
    "unchanged": ("customer_id % 5 = 1", _KEPT | _LATER | {"updated_ts": "TIMESTAMP '2024-01-01 00:00:00'"}),
    "email_fill": ("customer_id % 5 = 2 AND email IS NULL", _KEPT | _LATER | {
        "email": "'filled.' || CAST(customer_id AS STRING) || '@example.com'"}),
    "insert": ("customer_id % 20 = 0", _KEPT | _LATER | {
        "customer_id": f"customer_id + {NEW_ID_FLOOR}", "full_name": "'NewUser_' || CAST(customer_id AS STRING)",
        "email": "'new.' || CAST(customer_id AS STRING) || '@example.com'", "country": "'SG'",
        "is_active": "customer_id % 100 <> 0", "lifetime_value": "CAST(10.0 AS DOUBLE)"}),
}

LOYALTY_TIER = "CASE customer_id % 3 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' ELSE 'GOLD' END"

def _logged(op: int, seq: int, **changed: str) -> dict[str, str]:
    return _KEPT | changed | {"op": f"CAST({op} AS INT)", "seq": f"CAST({seq} AS BIGINT)"}


_NEW_ID = f"customer_id + {NEW_ID_FLOOR}"

# Lines of a change log; operation 1 is delete, 2 insert, 3 before update, 4 after update.
LOGGED = {
    "before": ("customer_id % 4 = 0", _logged(3, 10)),
    "after": ("customer_id % 4 = 0", _logged(
        4, 11, email="'after.' || CAST(customer_id AS STRING)", country="'NZ'", lifetime_value="lifetime_value + 1")),
    "changed": ("customer_id % 4 = 1", _logged(4, 10, country="'XX'")),
    "then_deleted": ("customer_id % 4 = 1", _logged(1, 20)),
    "deleted": ("customer_id % 4 = 2", _logged(1, 10)),
    "then_inserted": ("customer_id % 4 = 2", _logged(
        2, 20, email="'again.' || CAST(customer_id AS STRING)", country="'BR'")),
    "new": ("customer_id % 10 = 0", _logged(2, 10, customer_id=_NEW_ID, country="'SG'")),
    "new_then_deleted": ("customer_id % 20 = 0", _logged(1, 20, customer_id=_NEW_ID, country="'SG'")),
}


def branches_sql(table_name: str, branches: dict[str, tuple[str, dict[str, str]]]) -> str:
    """One SELECT per branch, for the oracle."""
    return " UNION ALL ".join(
        f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table_name} WHERE {condition}"
        for condition, columns in branches.values()
    )


def branch_rows(df: DataFrame, branches: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """The rows of all branches from a single scan: each row emits those whose condition holds."""
    made = [
        F.when(F.expr(condition), F.struct(*[F.expr(e).alias(c) for c, e in columns.items()]))
        for condition, columns in branches.values()
    ]
    return df.select(F.inline(F.array_compact(F.array(*made))))


ORDERS_AS_SOURCE = """
SELECT o_custkey AS customer_id, 'Order ' || CAST(o_orderkey AS STRING) AS full_name,
       'order.' || CAST(o_orderkey AS STRING) || '@example.com' AS email, o_orderstatus AS country,
       TRUE AS is_active, o_totalprice AS lifetime_value, CAST(o_orderdate AS TIMESTAMP) AS updated_ts,
       o_orderkey AS order_key
FROM {orders}
"""


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return spark.sql(CLAIMS_RAW, lineitem=lines, orders=table(spark, sf_dir, "orders"))


def claims_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims under headings as people type them."""
    raw = claims_raw(spark, sf_dir)
    return raw.toDF(*[f" {c.replace('_', ' ').title()} " for c in raw.columns])


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS_FEED, events=table(spark, sf_dir, "events"))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_FEED, orders=table(spark, sf_dir, "orders"))


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_V2, orders=table(spark, sf_dir, "orders"))


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CUSTOMER_TARGET, customer=table(spark, sf_dir, "customer"))


def customer_changes(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    chosen = {kind: CHANGES[kind] for kind in kinds or CHANGES}
    return branch_rows(customer_target(spark, sf_dir), chosen)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branch_rows(customer_target(spark, sf_dir), LOGGED).withColumnRenamed("op", "__$operation")


def orders_as_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_AS_SOURCE, orders=table(spark, sf_dir, "orders"))


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and payment structs."""
    key = F.col("c_custkey")
    mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    customer = F.struct(
        key.alias("id"),
        F.struct(
            F.col("n_name").alias("city"),
            F.substring("r_name", 1, 2).alias("country_code"),
            F.concat(F.lit("Street "), (key % 100).cast("string")).alias("street"),
        ).alias("address"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        F.when(key % 7 == 0, None).otherwise(mail).alias("email"),
    )
    order_key = F.col("o_orderkey")
    payment = F.struct(
        F.when(order_key % 9 == 0, None).otherwise((order_key * 37) % 1000).alias("amount_cents"),
        F.when(order_key % 6 == 0, None).otherwise(F.lit(" usd ")).alias("currency"),
    )
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == key)
    return orders.select(order_key.alias("order_id"), customer.alias("customer"), payment.alias("payment"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents with an items array, one document per order.

    A document holds all items of its order, however the files are split, so
    an order has to fit into one row.  Orders with items come from
    an inner join and the others from an anti join on distinct keys: adaptive
    execution can split a hot order in both.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    part_key = F.col("l_partkey")
    item = F.struct(
        F.col("p_name").alias("name"),
        F.when(part_key % 8 == 0, None).otherwise((part_key % 100).cast("double") + 0.5).alias("price"),
        F.when(part_key % 10 == 0, None).otherwise(F.col("l_quantity").cast("int")).alias("qty"),
        F.when(F.col("l_linenumber") == 7, None)
        .otherwise(F.concat(F.lit("SKU-"), part_key.cast("string"))).alias("sku"),
    )
    baskets = (
        table(spark, sf_dir, "lineitem").join(part, part_key == F.col("p_partkey"), "left")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.collect_list(item).alias("items"))
    )
    headers = order_headers(spark, sf_dir)
    filled = headers.join(baskets, "order_id")
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id")).distinct()
    empty = headers.join(keys, "order_id", "left_anti").withColumn(
        "items", F.lit(None).cast(filled.schema["items"].dataType))
    return filled.unionByName(empty)


def orders_flat_sql() -> str:
    """What the flattened documents must contain, straight from the base tables."""
    return """
SELECT o_orderkey AS order_id,
       c_custkey AS customer__id,
       n_name AS customer__address__city,
       substr(r_name, 1, 2) AS customer__address__country_code,
       'Street ' || CAST(c_custkey % 100 AS STRING) AS customer__address__street,
       c_mktsegment AS customer__loyalty_tier,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS customer__email,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey * 37) % 1000 END AS payment__amount_cents,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE ' usd ' END AS payment__currency,
       p_name AS item__name,
       CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(l_partkey % 100 AS DOUBLE) + 0.5 END AS item__price,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS item__quantity,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 'SKU-' || CAST(l_partkey AS STRING) END AS item__sku
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
     JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""


ITEM_JOIN = " JOIN {lineitem} ON l_orderkey = o_orderkey LEFT JOIN {part} ON l_partkey = p_partkey"
ITEM_LEFT_JOIN = " LEFT JOIN {lineitem} ON l_orderkey = o_orderkey LEFT JOIN {part} ON l_partkey = p_partkey"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver order lines without the detour over documents."""
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region", "lineitem", "part")}
    filled = spark.sql(orders_flat_sql() + ITEM_JOIN, **tables)
    keys = tables["lineitem"].select(F.col("l_orderkey").alias("order_id")).distinct()
    headers = order_headers(spark, sf_dir)
    empty = flatten_structs(headers).join(keys, "order_id", "left_anti")
    return filled.unionByName(empty, allowMissingColumns=True)
