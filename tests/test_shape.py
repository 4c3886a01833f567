import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from smeltery.operators import conform, dedupe, enrich, layout, nested, quality, rollup
from smeltery.operators.dedupe import pick_one_per_key
from smeltery.plans import registry as R
from smeltery.sources.readers import ORDER_DOCUMENT, read_json_documents


def documents(spark):
    return spark.createDataFrame([
        (1, (7, ("Oslo", "NO", "S1"), "gold", "ann@x.no"), (500, " usd "),
         [("pen", 60.0, 2, "a"), ("ink", None, 1, None)]),
        (2, (8, ("Rome", "IT", "S2"), None, None), (None, None), []),
        (3, (9, ("Rome", "IT", "S3"), None, "b@x.it"), (100, "eur"), None),
    ], ORDER_DOCUMENT)


def test_flatten_keeps_parents_without_items(spark):
    flat = nested.flatten_orders(documents(spark))
    assert flat.columns == [
        "order_id", "customer__id", "customer__address__city", "customer__address__country_code",
        "customer__address__street", "customer__loyalty_tier", "customer__email", "payment__amount_cents",
        "payment__currency", "item__name", "item__price", "item__quantity", "item__sku",
    ]
    assert rows(flat, "order_id", "item__name") == [(1, "ink"), (1, "pen"), (2, None), (3, None)]


def test_flatten_handles_dots_in_field_names(spark):
    df = spark.sql("SELECT named_struct('a.b', 1, 'c', named_struct('d', 2)) AS s")
    assert nested.flatten_structs(df).columns == ["s__a.b", "s__c__d"]


def test_json_round_trip(spark, folder):
    documents(spark).write.json(f"{folder}/docs")
    back = read_json_documents(spark, f"{folder}/docs")
    assert rows(nested.flatten_orders(back)) == rows(nested.flatten_orders(documents(spark)))


def test_score_and_grades(spark):
    scored = quality.score_quality(nested.flatten_orders(documents(spark)))
    got = rows(scored, "order_id", "item__name", "_quality_score", "_quality_grade")
    assert got == [(1, "ink", 80, "B"), (1, "pen", 100, "A"), (2, None, 40, "F"), (3, None, 80, "B")]


@pytest.mark.parametrize("score, letter", [(100, "A"), (99, "B"), (80, "B"), (79, "C"), (60, "C"), (59, "F"), (0, "F")])
def test_grade_floors(spark, score, letter):
    assert spark.range(1).select(quality.grade(F.lit(score))).first()[0] == letter


def test_line_values_with_nulls(spark):
    df = spark.createDataFrame(
        [(2, 49.99, 499), (None, 50.0, 500), (1, None, None), (3, 1.255, 100)],
        "item__quantity int, item__price double, payment__amount_cents bigint")
    out = enrich.line_values(df)
    got = [(r.item__total, r.item__discount_applied, r.order__value_tier) for r in out.collect()]
    assert got == [(99.98, "Y", "medium"), (None, "N", "high"), (None, "N", "low"), (3.76, "Y", "medium")]


def test_repair_after_totals_keeps_null_totals(spark):
    df = spark.createDataFrame(
        [(None, 10.0, None, None)],
        "item__quantity int, item__price double, payment__amount_cents bigint, payment__currency string")
    after = enrich.totals_and_repair(df).first()
    before = enrich.totals_and_repair(df, repair_first=True).first()
    assert (after.item__quantity, after.item__total, after.payment__amount) == (1, None, 0.0)
    assert (before.item__quantity, before.item__total, before.payment__currency) == (1, 10.0, "USD")


def test_survivor_does_not_depend_on_row_order(spark):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n"), (None, 4, "m")]
    want = [(None, 4, "m"), ("k", 1, "a")]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k string, o int, v string").repartition(4)
        assert rows(dedupe.pick_one_per_key(df, ["k"], ["o"])) == want
    assert rows(dedupe.pick_one_per_key(df, ["k"], ["o"], latest=True)) == [(None, 5, "n"), ("k", 2, "b")]


def test_dedupe_without_keys_is_refused(spark):
    with pytest.raises(ValueError):
        dedupe.pick_one_per_key(spark.range(3), [])


def test_dedupe_of_bare_keys_and_of_maps(spark):
    assert rows(dedupe.pick_one_per_key(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"])) == [(1,), (2,)]
    maps = spark.sql("SELECT 1 AS k, map('a', 1) AS m UNION ALL SELECT 1, map('a', 1)")
    assert dedupe.pick_one_per_key(maps, ["k"]).count() == 1


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3).withColumn("v", F.col("id") % 10)
    text = plan(dedupe.pick_one_per_key(df, ["k"], ["v"]))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange hashpartitioning")


def silver(spark):
    return spark.createDataFrame([
        ("p1", "A", "x", "d1", "n1", 10.0, 20.0, "2024-01-01"),
        ("p1", "B", "y", "d1", "n2", 5.5, None, "2024-02-01"),
        ("p2", "A", "x", None, None, None, 1.0, None),
        (None, None, None, None, None, 1.25, 1.0, "2024-01-15"),
    ], "patient_id string, claim_type string, procedure_code string, diagnosis_code string, provider_id string, "
       "paid_amount double, allowed_amount double, service_date string",
    ).withColumn("service_date", F.to_date("service_date"))


def test_patient_summary(spark):
    got = rows(rollup.patient_summary(silver(spark)).drop("first_service_date", "last_service_date"))
    assert got == [
        (None, 1, 0, 0, 0, 1.25, 1.25, 1.0, 0),
        ("p1", 2, 2, 1, 2, 15.5, 7.75, 20.0, 31),
        ("p2", 1, 1, 0, 0, None, None, 1.0, None),
    ]


def test_monthly_spend_leaves_out_undated_claims(spark):
    got = rows(rollup.monthly_spend(silver(spark)), "year_month", "claim_type", "claim_count", "unique_patients")
    assert got == [("2024-01", None, 1, 0), ("2024-01", "A", 1, 1), ("2024-02", "B", 1, 1)]


def test_procedure_cost_leaves_out_missing_codes(spark):
    got = rows(rollup.procedure_cost(silver(spark)))
    assert got == [("x", 2, 2, 10.0, 10.0, 10.0, 10.0), ("y", 1, 1, 5.5, 5.5, 5.5, 5.5)]


def test_approximate_counts_agree_on_small_groups(spark):
    exact = rollup.patient_summary(silver(spark))
    assert rows(rollup.patient_summary(silver(spark), approximate=True)) == rows(exact)


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "k string, v double")
    top = rollup.top_by(df, "v", 2, "k")
    assert [r.k for r in top.collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan(top)


def test_country_grain_differs_by_line_count(spark):
    lines = spark.createDataFrame(
        [("NO", 1, 1.0, 100.0), ("NO", 1, 2.0, 100.0), ("NO", 1, None, 100.0), ("NO", 2, 4.0, 200.0)],
        "customer__address__country_code string, order_id int, item__total double, payment__amount double")
    assert rows(rollup.country_orders(lines)) == [("NO", 2, 7.0, 125.0)]
    assert rows(rollup.country_orders_by_order(lines)) == [("NO", 2, 7.0, 150.0)]


def test_clustering_sorts_inside_ranges_and_splits_a_hot_key(spark):
    df = spark.range(4000).withColumn("k", F.when(F.col("id") < 3000, 7).otherwise(F.col("id")))
    laid = layout.cluster_by_key(df, "k", partitions=4).withColumn("p", F.spark_partition_id())
    hot = laid.filter("k = 7").groupBy("p").count().collect()
    assert len(hot) > 1
    assert laid.count() == 4000


def test_partition_report_counts_every_row(spark):
    report = layout.partition_report(layout.gather_by_key(spark.range(100), "id", partitions=4))
    assert report.agg(F.sum("rows")).first()[0] == 100


def test_kept_columns_are_the_only_ones_moved(spark, small):
    text = plan(R.gold_monthly_spend(spark, small))
    text = text[text.index("== Physical Plan =="):]
    shuffled = [line for line in text.splitlines() if "SortAggregate" in line or "Exchange hashpartitioning" in line]
    assert shuffled and "Window" not in text
    for unused in ("icd_code", "npi", "claim_date", "l_tax"):
        assert unused not in text


def test_survivor_by_kept_columns_equals_the_ranked_row(spark):
    import random

    rng = random.Random(3)
    data = [(rng.choice([1, 2, None]), rng.choice(["a", None]), rng.choice([None, 1, 2, 3]), rng.random(), float("nan")) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, k2 string, o int, v double, `a.b` double").repartition(5)
    for latest in (False, True):
        whole = pick_one_per_key(df, ["k", "k2"], ["o", "v"], latest=latest)
        part = pick_one_per_key(df, ["k", "k2"], ["o", "v"], latest=latest, keep=["k", "v", "o"])
        assert part.columns == ["k", "o", "v"]
        assert rows(part) == rows(whole.select("k", "o", "v"))
    ties = spark.createDataFrame([(1, 5, "b", "x"), (1, 5, "a", "y")], "k int, o int, v string, w string")
    assert rows(pick_one_per_key(ties, ["k"], ["o"], keep=["v"])) == [("a",)]
    assert rows(pick_one_per_key(ties, ["k"], ["o"], keep=["k"])) == [(1,)]


def test_tiny_amounts_add_up_and_others_are_counted(spark):
    values = [4e-7] * 10 + [float("nan"), float("inf"), 1e16, None, -0.5]
    df = spark.createDataFrame([("g", v) for v in values], "g string, amount double")
    assert rows(rollup.money_check(df, "amount", "g")) == [("g", -0.499996, 11, 3)]
    assert rows(rollup.money_check(df.where("amount > 0 AND amount < 1"), "amount", "g")) == [("g", 4e-6, 10, 0)]


def test_split_is_evaluated_once_and_adds_up(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(20).selectExpr("id", "IF(id % 4 = 0, NULL, id) AS v").mapInPandas(count, "id long, v double")
    rules = {"present": F.col("v").isNotNull(), "small": F.col("v") < 10}
    good, bad, counts = conform.publish_split(df, rules, folder + "/split")
    assert seen.value == 20 and counts == {"accepted": 7, "rejected": 13}
    assert (good.count(), bad.count(), good.columns) == (7, 13, ["id", "v"])
    assert rows(bad.where("id IN (0, 11)"), "id", "_failed_rules") == [(0, "present,small"), (11, "small")]
    empty = conform.publish_split(df.limit(0), rules, folder + "/empty")
    assert empty[2] == {"accepted": 0, "rejected": 0} and empty[0].count() == empty[1].count() == 0


def test_lookup_cost_tells_a_copy_from_clusters(spark, folder):
    df = spark.range(1000).withColumnRenamed("id", "k")
    df.repartition(4).write.parquet(f"{folder}/copy")
    layout.cluster_by_key(df, "k", partitions=4).write.parquet(f"{folder}/clustered")
    spark.createDataFrame([(1,), (1,), (2,)], "k long").repartitionByRange(1, "k").write.parquet(f"{folder}/one")
    cost = lambda name: rows(layout.lookup_cost(spark.read.parquet(f"{folder}/{name}"), "k"))[0]
    assert cost("clustered") == (1000, 4, 0, 0.25)
    copied = cost("copy")
    assert copied[:3] == (1000, 4, 3) and copied[3] > 0.9
    assert cost("one") == (3, 1, 0, 1.0)


def test_touching_ranges_meet(spark, folder):
    for pair in ((1, 5), (5, 9), (10, 12)):
        spark.createDataFrame([(k,) for k in pair], "k long").coalesce(1).write.mode("append").parquet(f"{folder}/t")
    assert rows(layout.lookup_cost(spark.read.parquet(f"{folder}/t"), "k"))[0][1:3] == (3, 1)
