"""Tables, paths and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Shape of a nested order document and of an event row.
ORDER_DOCUMENT = (
    "order_id bigint, "
    "customer struct<id: bigint, address: struct<city: string, country_code: string, street: string>, "
    "loyalty_tier: string, email: string>, "
    "payment struct<amount_cents: bigint, currency: string>, "
    "items array<struct<name: string, price: double, qty: int, sku: string>>"
)
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("amount", T.DoubleType()),
    T.StructField("event_ts", T.TimestampType(), False),
])


def read_files(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SQL scan of a folder, without a catalog entry."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str = ORDER_DOCUMENT) -> DataFrame:
    """Nested documents with a declared schema, so no pass over the files is spent on inference."""
    return spark.read.schema(schema).json(path)
