import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from smeltery.operators import cdc, merge as G
from smeltery.operators.sizing import fits_broadcast, measure

OLD, NEW, AT = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
COLUMNS = "customer_id bigint, full_name string, email string, country string, is_active boolean, " \
          "lifetime_value double, updated_ts timestamp"


def target(spark):
    base = spark.createDataFrame([
        (1, "A", "a@x", "US", True, 1.0, OLD), (2, "B", "b@x", "US", True, 2.0, OLD),
        (3, "C", "c@x", "US", True, 3.0, OLD), (4, "D", None, "US", True, 4.0, OLD),
        (5, "E", "e@x", "US", True, 5.0, OLD),
    ], COLUMNS)
    return G.bootstrap_customers(base, OLD)


def source(spark):
    return spark.createDataFrame([
        (1, "A2", "a@new", "DE", True, 1.5, NEW),
        (2, "ignored", "ignored", "XX", False, 0.0, NEW),
        (3, "renamed", "c@x", "US", True, 3.0, NEW),
        (4, "D", "d@x", "US", True, 4.0, NEW),
        (9, "N", "n@x", "SG", False, 9.0, NEW),
    ], COLUMNS)


STRICT = [
    (1, "A2", "a@new", "DE", True, 1.5, "CRM_INITIAL", "update"),
    (2, "B", "b@x", "US", False, 0.0, "CRM_INITIAL", "soft_delete"),
    (3, "C", "c@x", "US", True, 3.0, "CRM_INITIAL", "keep"),
    (4, "D", None, "US", True, 4.0, "CRM_INITIAL", "keep"),
    (5, "E", "e@x", "US", True, 5.0, "CRM_INITIAL", "keep"),
    (9, "N", "n@x", "SG", False, 9.0, "CRM_CDC", "insert"),
]
SHOWN = ("customer_id", "full_name", "email", "country", "is_active", "lifetime_value", "record_source", G.ACTION)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
def test_first_true_clause_decides(spark, strategy):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT, null_safe=False, strategy=strategy, with_action=True)
    assert rows(out, *SHOWN) == STRICT


def test_null_safe_sees_a_filled_value(spark):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT, with_action=True)
    changed = [r for r in rows(out, *SHOWN) if r[0] == 4]
    assert changed == [(4, "D", "d@x", "US", True, 4.0, "CRM_INITIAL", "update")]


def test_only_touched_rows_get_a_new_load_time(spark):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT, null_safe=False)
    assert rows(out.filter(F.col("load_ts") == F.lit(OLD)), "customer_id") == [(3,), (4,), (5,)]


def test_merging_twice_changes_nothing_more(spark):
    once = G.merge_scd1(target(spark), source(spark), as_of=AT)
    twice = G.merge_scd1(once, source(spark), as_of=AT)
    assert rows(twice) == rows(once)


def test_actions_cover_all_keys(spark):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT, with_action=True)
    keys = target(spark).select("customer_id").union(source(spark).select("customer_id")).distinct().count()
    assert sum(r["rows"] for r in G.action_counts(out).collect()) == keys


def test_inactive_rows_can_be_removed(spark):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT, delete_inactive=True)
    assert rows(out, "customer_id") == [(1,), (3,), (4,), (5,), (9,)]


def test_new_source_column_survives(spark):
    evolved = source(spark).withColumn("loyalty_tier", F.lit("GOLD"))
    out = G.merge_scd1(target(spark), evolved, as_of=AT, evolve=True)
    assert rows(out, "customer_id", "loyalty_tier") == [
        (1, "GOLD"), (2, None), (3, None), (4, "GOLD"), (5, None), (9, "GOLD")]


def test_without_evolution_the_new_column_stays_out(spark):
    evolved = source(spark).withColumn("loyalty_tier", F.lit("GOLD"))
    assert "loyalty_tier" not in G.merge_scd1(target(spark), evolved, as_of=AT).columns


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_several_source_rows_for_one_target_row_fail(spark, strategy):
    twice = source(spark).union(source(spark).limit(1))
    with pytest.raises(G.AmbiguousMatchError):
        G.merge_scd1(target(spark), twice, strategy=strategy)


def test_repeated_keys_that_match_nothing_are_inserted(spark):
    new = source(spark).filter("customer_id = 9")
    out = G.merge_scd1(target(spark), new.union(new), as_of=AT)
    assert out.filter("customer_id = 9").count() == 2


def test_newest_row_per_key_resolves_repeats(spark):
    later = source(spark).filter("customer_id = 1").withColumn("updated_ts", F.lit(AT)).withColumn("email", F.lit("z@z"))
    newest = G.latest_by(source(spark).union(later), ["customer_id"], ["updated_ts"])
    out = G.merge_scd1(target(spark), newest, as_of=AT)
    assert rows(out.filter("customer_id = 1"), "email") == [("z@z",)]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_null_keys_match_nothing(spark, strategy):
    void = "SELECT CAST(NULL AS BIGINT) AS k, {0} AS v"
    old, new = spark.sql(void.format("'old'")), spark.sql(void.format("'new'"))
    assert rows(G.upsert(old, new.union(new), ["k"], strategy=strategy), "v") == [("new",), ("new",), ("old",)]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_one_source_row_updates_every_copy_in_the_target(spark, strategy):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "n")], "k int, v string")
    assert rows(G.upsert(old, new, ["k"], strategy=strategy)) == [(1, "n"), (1, "n"), (2, "c")]


def test_empty_sides(spark):
    none = source(spark).limit(0)
    assert rows(G.merge_scd1(target(spark), none, as_of=AT)) == rows(target(spark))
    built = G.merge_scd1(target(spark).limit(0), source(spark), as_of=AT)
    assert built.count() == source(spark).count()


def test_older_rows_do_not_replace_newer_ones(spark):
    old = spark.createDataFrame([(1, 5, "x")], "k int, seq int, v string")
    late = spark.createDataFrame([(1, 4, "late")], "k int, seq int, v string")
    assert rows(G.upsert(old, late, ["k"], newer_by="seq")) == [(1, 5, "x")]


def test_small_batch_is_broadcast_and_the_target_is_not_shuffled(spark):
    out = G.merge_scd1(target(spark), source(spark), as_of=AT)
    text = plan(out)
    physical = text[text.index("== Physical Plan =="):]
    assert "BroadcastHashJoin [customer_id" in physical and "LeftOuter" in physical
    assert "SortMergeJoin" not in physical


def test_batch_over_the_limit_goes_through_the_shuffle(spark):
    old = spark.range(100).withColumn("v", F.lit("old"))
    new = spark.range(50, 150).withColumn("v", F.lit("new"))
    values = {"id": "source.id", "v": "source.v"}
    clauses = ([G.Matched("update", None, values)], G.Missing(values))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = G.merge(old, new, ["id"], *clauses, strategy="broadcast", broadcast_rows=10)
        assert "BroadcastHashJoin" not in plan(big)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    small = G.merge(old, new, ["id"], *clauses, strategy="broadcast")
    assert rows(big) == rows(small)
    assert big.count() == 150


def test_measure_counts_copies_of_real_keys_only(spark):
    df = spark.createDataFrame([(1, "aa"), (1, "b"), (None, "c"), (None, "d"), (None, "e")], "k int, v string")
    size = measure(df, ["k"])
    assert (size.rows, size.max_copies, size.key_ranges) == (5, 2, {"k": (1, 1)})


def test_broadcast_limits_rows_and_bytes(spark):
    df = spark.range(100).withColumn("v", F.repeat(F.lit("x"), 1000))
    assert fits_broadcast(df, 100)
    assert not fits_broadcast(df, 100, max_rows=99)
    assert not fits_broadcast(df, 100, max_bytes=100_000)


def test_change_log_replays_the_last_operation(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame([
        (1, "a", 3, 1), (1, "a2", 4, 2),
        (2, "b", 1, 1), (2, "again", 2, 2),
        (3, "c3", 4, 1), (3, "c3", 1, 2),
        (4, "d", 2, 1), (5, "e", 2, 1), (5, "e", 1, 2),
    ], ["id", "v", cdc.OP_COLUMN, "seq"])
    assert rows(cdc.apply_change_log(old, log, ["id"], "seq")) == [(1, "a2"), (2, "again"), (4, "d")]


def test_batch_is_put_together_by_name(spark):
    a = spark.createDataFrame([(1, "a", True)], "customer_id int, email string, is_active boolean")
    b = spark.createDataFrame([("b", False, 2)], "email string, is_active boolean, customer_id int")
    batch = cdc.with_operation(cdc.cdc_batch(a, a.withColumn("customer_id", F.lit(500)), b), 100)
    assert rows(batch, "customer_id", "operation") == [(1, "update"), (2, "soft_delete"), (500, "insert")]


def test_merge_report(spark):
    out = G.merge_report(G.merge_scd1(target(spark), source(spark), as_of=AT), 5)
    assert rows(out) == [(6, 2, 1)]


def test_clauses_need_their_own_names(spark):
    clause = G.Matched("update", None, {})
    with pytest.raises(ValueError):
        G.merge(target(spark), source(spark), ["customer_id"], [clause, clause], None)
