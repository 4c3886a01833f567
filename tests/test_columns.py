import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from smeltery.functions import columns as C, money as M
from smeltery.functions.calendar import calendar_parts, shift_back, since_yesterday
from smeltery.functions.masking import mask_email
from smeltery.operators import conform


def test_names_are_stripped_lowered_and_joined(spark):
    df = spark.createDataFrame([(1, 2)], ["  Claim ID ", "Paid Amount"])
    assert C.normalize_columns(df).columns == ["claim_id", "paid_amount"]


def test_names_that_collide_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Claim ID", "claim_id "])
    with pytest.raises(ValueError, match="claim_id"):
        C.normalize_columns(df)


def test_presence_decides_not_value(spark):
    df = spark.createDataFrame([(None, "b")], "patient_id string, member_id string")
    assert rows(df.select(C.resolve_column(df, ["patient_id", "member_id"]))) == [(None,)]


def test_absent_column_is_a_typed_null(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = df.select(C.resolve_column(df, ["y"], "double").alias("y"))
    assert out.schema["y"].dataType.simpleString() == "double"
    assert rows(out) == [(None,)]


def test_dates_and_numbers_that_do_not_parse_become_null(spark):
    df = spark.createDataFrame([("2024-02-30", "1x"), ("2024-02-29", "1.5"), (None, None)], "d string, n string")
    out = df.select(C.tolerant_date(df, F.col("d")), C.tolerant_number(F.col("n"), "double"))
    assert rows(out) == [(None, None), (None, None), (dt.date(2024, 2, 29), 1.5)]


def test_typed_dates_pass_through(spark):
    df = spark.sql("SELECT DATE '2024-01-02' AS d, TIMESTAMP_NTZ '2024-01-02 10:00:00' AS t")
    out = df.select(C.tolerant_date(df, F.col("d")), C.tolerant_date(df, F.col("t")))
    assert rows(out) == [(dt.date(2024, 1, 2), dt.date(2024, 1, 2))]


def test_claims_with_no_optional_column_still_conform(spark):
    out = conform.conform_claims(spark.createDataFrame([("c1",)], ["Claim ID"]))
    row = out.first().asDict()
    assert row["claim_id"] == "c1"
    assert all(row[c] is None for c in ("service_date", "paid_amount", "quantity", "patient_id", "claim_type"))


def test_rules_name_what_failed_and_null_counts_as_failed(spark):
    df = spark.createDataFrame([(1, 5), (None, -1), (2, None)], "k int, v int")
    rules = {"key": F.col("k").isNotNull(), "positive": F.col("v") > 0}
    good, bad = conform.split_invalid(df, rules)
    assert rows(good) == [(1, 5)]
    assert rows(bad) == [(None, -1, "key,positive"), (2, None, "positive")]


@pytest.mark.parametrize("mail, masked", [
    ("john@x.com", "j***@x.com"), ("a@b@c", "a**@c"), ("ab@c@d", "a***@d"), ("j@x", "j@x"),
    ("nobody", "nobody"), ("", ""), (None, None), ("ñandú@x.com", "ñ****@x.com"),
])
def test_mask(spark, mail, masked):
    df = spark.createDataFrame([(mail,)], "m string")
    assert rows(df.select(mask_email("m"))) == [(masked,)]


def test_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double").repartition(3)
    assert rows(df.agg(M.total("x"), M.mean("x"))) == [(1.0, 0.1)]


def test_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    assert rows(df.agg(M.mean("x"))) == [(0.02,)]


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-06 23:15:00' AS t")
    out = df.select(*[c.alias(n) for n, c in calendar_parts(F.col("t")).items()])
    assert rows(out) == [(2024, 1, "Saturday", 23, "Y")]


def test_shift_and_window(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 00:00:00' AS t, 30 AS s")
    assert rows(df.select(shift_back(F.col("t"), days=1, seconds=F.col("s")))) == [(dt.datetime(2023, 12, 31, 23, 59, 30),)]
    edge = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2024-01-01 23:59:59', TIMESTAMP_NTZ '2024-01-02 00:00:00')) AS t")
    kept = edge.filter(since_yesterday(F.col("t"), F.lit(dt.date(2024, 1, 3))))
    assert rows(kept) == [(dt.datetime(2024, 1, 2),)]


def test_instant_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        micros = spark.range(1).select(F.unix_micros(C.instant(dt.datetime(1970, 1, 1)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert micros == 0
