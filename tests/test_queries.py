"""Registered queries against their oracles, and whole flows on small tables."""

import datetime as dt
import uuid

import duckdb
import pytest
from conftest import plan, rows

import __spark_entry__ as entry
from check import canonical
from smeltery.plans import fixtures as X, medallion, registry as R

ORACLE = {name: q.oracle for name, q in R.QUERIES.items() if q.oracle is not None}


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for table in X.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(R.QUERIES))
def test_query_matches_its_oracle(spark, small, db, name):
    frame = R.QUERIES[name].run(spark, small)
    got = [tuple(r) for r in frame.collect()]
    if name not in ORACLE:
        assert got
        return
    answer = db.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(frame.columns)
    assert canonical(frame.columns, got) == canonical(names, answer.fetchall())


def test_entry(spark, small):
    assert entry.entry(spark).count() > 0


def test_only_needed_columns_are_read(spark, small):
    text = plan(R.gold_patient_summary(spark, small))
    assert "l_tax" not in text[text.index("== Physical Plan =="):]


def test_ranked_view_is_a_top_k(spark, small):
    assert "TakeOrderedAndProject" in plan(R.gold_procedure_top50(spark, small))


def test_claims_layers(spark, small, folder):
    database = f"db_{uuid.uuid4().hex}"
    medallion.build_claims(X.claims_untidy(spark, small), database, folder, order_by=R.TIES,
                           as_of=dt.datetime(2024, 1, 1))
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()} >= {
        "bronze_claims", "silver_claims", "vw_silver_claims", "gold_patient_summary", "gold_monthly_spend",
        "gold_procedure_cost", "vw_gold_patient_summary", "vw_gold_monthly_spend", "vw_gold_procedure_cost"}
    assert rows(spark.table(f"{database}.gold_patient_summary")) == rows(R.gold_patient_summary(spark, small))
    assert rows(spark.table(f"{database}.vw_gold_procedure_cost")) == rows(R.gold_procedure_top50(spark, small))
    silver = spark.table(f"{database}.vw_silver_claims")
    assert silver.select("source_table").distinct().first()[0] == "claims"


def test_order_layers(spark, small, folder):
    database = f"db_{uuid.uuid4().hex}"
    for _ in range(2):
        medallion.build_orders(spark, X.order_documents(spark, small), database, folder, dt.datetime(2024, 1, 6))
    assert rows(spark.table(f"{database}.gold_country_orders")) == rows(R.gold_country_orders(spark, small))
    day = spark.table(f"{database}.silver_mdf_orders").select("order__day_of_week", "order__is_weekend").distinct()
    assert rows(day) == [("Saturday", "Y")]


def test_one_document_per_order_whatever_the_splits(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").count()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (before, "16k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            documents = X.order_documents(spark, small)
            assert documents.count() == documents.select("order_id").distinct().count() == orders
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
