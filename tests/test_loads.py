import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from smeltery.operators import filters
from smeltery.plans import loads, snapshot as S, state

T0 = dt.datetime(2024, 1, 1)


def feed(spark, hours):
    data = [(i, T0 + dt.timedelta(hours=h), None if i == 3 else "view", float(i)) for i, h in enumerate(hours)]
    df = spark.createDataFrame(data, "event_id int, event_ts timestamp_ntz, event_type string, amount double")
    return df.withColumn("event_date", F.to_date("event_ts"))


def run(spark, folder, df, marks, upto=None, **options):
    return loads.incremental_load(df, f"{folder}/silver", marks, "event_ts", loads.events_transform("INCREMENTAL"),
                                  keys=["event_id"], partition_column="event_date", upto=upto, **options)


def ids(spark, folder):
    return rows(loads.read_sink(spark, f"{folder}/silver"), "event_id")


def marks(spark, folder, lookback=0):
    return state.TimestampWatermark(spark, f"{folder}/marks", "events", lookback)


@pytest.mark.parametrize("lookback", [0, 7200])
@pytest.mark.parametrize("batches", [1, 3])
def test_batches_add_up_to_a_full_load(spark, folder, lookback, batches):
    df = feed(spark, range(0, 60, 5))
    store = marks(spark, folder, lookback)
    for i in range(1, batches):
        run(spark, folder, df, store, upto=T0 + dt.timedelta(hours=60 * i / batches))
    run(spark, folder, df, store)
    run(spark, folder, df, store)
    full = S.Snapshots(spark, f"{folder}/full")
    loads.full_load(df, full, loads.events_transform("FULL_OVERWRITE"))
    assert ids(spark, folder) == rows(full.read(), "event_id")
    assert store.raw() == T0 + dt.timedelta(hours=55)


def test_rows_without_a_type_are_left_out_and_amount_is_renamed(spark, folder):
    run(spark, folder, feed(spark, range(5)), marks(spark, folder))
    out = spark.read.parquet(f"{folder}/silver")
    assert ids(spark, folder) == [(0,), (1,), (2,), (4,)]
    assert "amount" not in out.columns
    assert {r.load_strategy for r in out.collect()} == {"INCREMENTAL"}


def test_a_run_without_news_writes_nothing(spark, folder):
    df, store = feed(spark, range(3)), marks(spark, folder)
    first = run(spark, folder, df, store)
    again = run(spark, folder, df, store)
    assert (first.rows, again.rows, again.mark) == (3, 0, T0 + dt.timedelta(hours=2))


def test_the_mark_itself_is_not_read_again(spark, folder):
    store = marks(spark, folder)
    run(spark, folder, feed(spark, [0, 1]), store)
    run(spark, folder, feed(spark, [0, 1, 1, 2]).filter("event_id <> 3 OR event_ts IS NOT NULL"), store)
    assert (2,) not in ids(spark, folder)


def test_late_rows_inside_the_lookback_are_caught(spark, folder):
    store = marks(spark, folder, lookback=2 * 3600)
    run(spark, folder, feed(spark, [0, 5]), store)
    run(spark, folder, feed(spark, [0, 5, 4]), store)
    assert ids(spark, folder) == [(0,), (1,), (2,)]
    assert store.raw() == T0 + dt.timedelta(hours=5)


def test_copies_in_the_feed_become_one_row_with_lookback(spark, folder):
    store = marks(spark, folder, lookback=7200)
    df = feed(spark, [0, 1, 2])
    run(spark, folder, df.union(df), store, upto=T0 + dt.timedelta(hours=1))
    run(spark, folder, df.union(df).union(df), store)
    assert ids(spark, folder) == [(0,), (1,), (2,)]


def test_replay_after_a_crash_before_the_mark_moved(spark, folder):
    df = feed(spark, range(3))
    store = marks(spark, folder)
    run(spark, folder, df, store, upto=T0)
    batch = loads.events_transform("INCREMENTAL")(filters.between_cursors(df, "event_ts", T0, None))
    loads.append_new(spark, f"{folder}/silver", batch, ["event_id"], "event_ts", T0, "event_date")
    run(spark, folder, df, store)
    assert ids(spark, folder) == [(0,), (1,), (2,)]


def test_the_first_run_takes_rows_without_a_timestamp(spark, folder):
    df = feed(spark, range(2)).unionByName(feed(spark, [9]).withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
                                           .withColumn("event_id", F.lit(77)))
    run(spark, folder, df, marks(spark, folder))
    assert ids(spark, folder) == [(0,), (1,), (77,)]


def test_upsert_rewrites_only_touched_partitions(spark, folder):
    df, store = feed(spark, [0, 30, 31]), marks(spark, folder, lookback=3600)
    run(spark, folder, df, store)
    before = {f for f in loads.read_sink(spark, f"{folder}/silver").inputFiles() if "2024-01-01" in f}
    run(spark, folder, feed(spark, [0, 30, 31, 32]).withColumn("event_type", F.lit("changed")), store)
    now = loads.read_sink(spark, f"{folder}/silver")
    assert before and before == {f for f in now.inputFiles() if "2024-01-01" in f}
    assert rows(now, "event_id", "event_type") == [(0, "view"), (1, "view"), (2, "changed"), (3, "changed")]


def test_a_key_that_changes_partition_is_refused(spark, folder):
    df, store = feed(spark, [0, 30]), marks(spark, folder, lookback=3600)
    run(spark, folder, df, store)
    moved = feed(spark, [50])
    with pytest.raises(loads.MovedKeyError):
        run(spark, folder, moved, store)


def test_timestamps_with_zone_work_in_any_session_zone(spark, folder):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = feed(spark, range(4)).drop("event_date").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    df.write.parquet(f"{folder}/source")
    store = marks(spark, folder)
    transform = loads.events_transform("INCREMENTAL")
    try:
        for zone_now, upto in (("America/New_York", T0 + dt.timedelta(hours=1)), ("Asia/Tokyo", None)):
            spark.conf.set("spark.sql.session.timeZone", zone_now)
            loads.incremental_load(spark.read.parquet(f"{folder}/source"), f"{folder}/silver", store, "event_ts",
                                   transform, keys=["event_id"], upto=upto)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ids(spark, folder) == [(0,), (1,), (2,)]
    assert store.raw() == T0 + dt.timedelta(hours=3)


def test_id_cursor_sees_inserts_only(spark, folder):
    store = state.SequenceWatermark(spark, f"{folder}/marks", "orders")
    assert store.get() == -1
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "order_id bigint, order_amount double")
    for upto in (4, None, None):
        loads.incremental_load(df, f"{folder}/silver", store, "order_id", loads.orders_transform("SEQUENCE"),
                               keys=["order_id"], upto=upto)
    assert store.get() == 9
    out = spark.read.parquet(f"{folder}/silver")
    assert rows(out, "order_id", "order_amount_usd") == [(i, float(i)) for i in range(10)]


def test_tables_in_one_store_keep_their_marks(spark, folder):
    a = marks(spark, folder)
    b = state.TimestampWatermark(spark, f"{folder}/marks", "other", 60)
    a.save(T0)
    b.save(T0 + dt.timedelta(days=1))
    a.save(T0 + dt.timedelta(hours=1))
    assert a.get() == T0 + dt.timedelta(hours=1)
    assert b.get() == T0 + dt.timedelta(days=1, seconds=-60)
    a.reset()
    assert a.get() is None and b.raw() is not None
    assert rows(state.current_marks(spark, f"{folder}/marks"), "table_name") == [("other",)]


def test_a_broken_store_is_not_a_first_run(spark, folder):
    (__import__("pathlib").Path(folder) / "marks_ts").mkdir()
    (__import__("pathlib").Path(folder) / "marks_ts" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        marks(spark, folder).get()


def test_cursor_filter_and_partition_filter_reach_the_scan(spark, folder):
    feed(spark, range(0, 96, 6)).write.partitionBy("event_date").parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    after = T0 + dt.timedelta(days=2)
    out = filters.since_partition(filters.between_cursors(stored, "event_ts", after, None), "event_date", after)
    text = plan(out)
    assert "GreaterThan(event_ts,2024-01-03T00:00" in text
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert out.count() == 7


def test_delete_leaves_rows_with_an_unknown_condition(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(filters.without(df, "x = 1")) == [(None,), (2,)]


def test_lookback_overlap(spark):
    df = feed(spark, range(5))
    assert rows(loads.lookback_overlap(df, "event_ts", (0, 3600, 7200))) == [(0, 0), (3600, 1), (7200, 2)]


def test_saved_share(spark):
    out = loads.run_size(feed(spark, range(4)), "event_ts", T0 + dt.timedelta(hours=2))
    assert rows(out) == [(4, 1, 0.75)]


def test_late_partition_is_delivered(spark, folder):
    shape = "event_id long, event_ts timestamp, day date"
    store = state.TimestampWatermark(spark, f"{folder}/marks", "late", lookback_seconds=0)
    load = lambda rows: loads.incremental_load(
        spark.createDataFrame(rows, shape), f"{folder}/sink", store, "event_ts", lambda df: df, keys=["event_id"], partition_column="day")
    first = (1, dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    late = (2, dt.datetime(2024, 1, 7), dt.date(2024, 1, 2))
    load([first])
    assert load([first, late]).rows == 1
    assert spark.read.parquet(f"{folder}/sink").count() == 2


def test_version_that_came_after_a_crash_is_delivered(spark, folder):
    shape = "event_id long, event_ts timestamp, day date"
    old, new = ((1, dt.datetime(2024, 1, d), dt.date(2024, 1, d)) for d in (5, 6))
    spark.createDataFrame([old], shape).write.partitionBy("day").parquet(f"{folder}/sink")  # written, mark not moved
    store = state.TimestampWatermark(spark, f"{folder}/marks", "crash", lookback_seconds=0)
    store.save(dt.datetime(2024, 1, 1))
    result = loads.incremental_load(spark.createDataFrame([old, new], shape), f"{folder}/sink", store, "event_ts", lambda df: df,
                              keys=["event_id"], partition_column="day")
    assert result.rows == 1 and spark.read.parquet(f"{folder}/sink").count() == 2
