import datetime as dt
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from smeltery.plans import snapshot as S
from smeltery.plans.parted import KeyRanges, PartedTable
from smeltery.streaming import flows

SHAPE = "k int, seq int, ts timestamp_ntz"


def put(spark, path, *values):
    data = [(k, seq, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=seq)) for k, seq in values]
    spark.createDataFrame(data, SHAPE).coalesce(1).write.mode("append").parquet(path)


def stream(spark, folder, **options):
    return flows.stream_files(spark, f"{folder}/in", SHAPE, **options)


def test_each_file_is_taken_once(spark, folder):
    put(spark, f"{folder}/in", (1, 1), (2, 1))
    ran = [flows.ingest_files(stream(spark, folder), f"{folder}/out", f"{folder}/ck") for _ in range(2)]
    assert ran == [1, 0]
    put(spark, f"{folder}/in", (3, 1))
    flows.ingest_files(stream(spark, folder), f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out"), "k") == [(1,), (2,), (3,)]


def test_ingest_applies_the_transform(spark, folder):
    put(spark, f"{folder}/in", (1, 1), (2, 2))
    flows.ingest_files(stream(spark, folder), f"{folder}/out", f"{folder}/ck", lambda df: df.filter("k > 1"))
    assert rows(spark.read.parquet(f"{folder}/out"), "k") == [(2,)]


def test_upsert_does_not_depend_on_file_order(spark, folder):
    put(spark, f"{folder}/in", (1, 9), (2, 1))
    put(spark, f"{folder}/in", (1, 3), (2, 5), (1, 4))
    put(spark, f"{folder}/in", (3, 1))
    sink = S.Snapshots(spark, f"{folder}/out")
    batches = flows.upsert_stream(stream(spark, folder, files_per_trigger=1), sink, f"{folder}/ck", ["k"], ["seq"])
    assert batches == 3
    assert rows(sink.read(), "k", "seq") == [(1, 9), (2, 5), (3, 1)]


def test_a_lost_checkpoint_changes_nothing(spark, folder):
    put(spark, f"{folder}/in", (1, 1), (2, 7))
    sink = S.Snapshots(spark, f"{folder}/out")
    for checkpoint in ("ck", "lost"):
        flows.upsert_stream(stream(spark, folder), sink, f"{folder}/{checkpoint}", ["k"], ["seq"])
        assert rows(sink.read(), "k", "seq") == [(1, 1), (2, 7)]


def test_replayed_batches_are_skipped(spark, folder):
    put(spark, f"{folder}/in", (1, 1))
    sink = S.Snapshots(spark, f"{folder}/out")
    flows.upsert_stream(stream(spark, folder), sink, f"{folder}/ck", ["k"], ["seq"])
    shutil.rmtree(f"{folder}/ck/commits")
    flows.upsert_stream(stream(spark, folder), sink, f"{folder}/ck", ["k"], ["seq"])
    assert sink.history(5).count() == 1


def test_a_second_source_keeps_its_batches(spark, folder):
    sink = S.Snapshots(spark, f"{folder}/out")
    for source, k in (("a", 1), ("b", 2)):
        put(spark, f"{folder}/{source}/in", (k, 1))
        flows.upsert_stream(stream(spark, f"{folder}/{source}"), sink, f"{folder}/{source}/ck", ["k"], ["seq"])
    assert rows(sink.read(), "k", "seq") == [(1, 1), (2, 1)]


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_ties_on_the_first_column_follow_the_whole_sequence(spark, folder, order):
    for i in order:
        spark.createDataFrame([(1, 5, (10, 3)[i])], "k int, a int, b int").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    sink = S.Snapshots(spark, f"{folder}/out")
    source = flows.stream_files(spark, f"{folder}/in", "k int, a int, b int", files_per_trigger=1)
    assert flows.upsert_stream(source, sink, f"{folder}/ck", ["k"], ["a", "b"]) == 2
    assert rows(sink.read(), "b") == [(10,)]


@pytest.mark.parametrize("splits", [1, 4])
def test_repeats_are_dropped_across_runs(spark, folder, splits):
    def run():
        flows.dedupe_stream(stream(spark, folder), f"{folder}/out", f"{folder}/ck", ["k"], "ts", "30 days",
                            hot_key_splits=splits)

    put(spark, f"{folder}/in", (1, 1), (2, 2), (1, 1))
    put(spark, f"{folder}/in", (1, 1), (1, 1))
    run()
    put(spark, f"{folder}/in", (2, 2), (3, 3))
    run()
    assert rows(spark.read.parquet(f"{folder}/out").groupBy("k").agg(F.count("*"))) == [(1, 1), (2, 1), (3, 1)]


def test_json_folder_with_new_files_between_runs(spark, folder):
    for text in ('{"k": 1}', '{"k": 2, "other": true}'):
        spark.createDataFrame([(text,)], "value string").write.mode("append").text(f"{folder}/in")
        source = flows.stream_files(spark, f"{folder}/in/", "k int", fmt="json")
        flows.ingest_files(source, f"{folder}/out", f"{folder}/ck")
    assert rows(spark.read.parquet(f"{folder}/out")) == [(1,), (2,)]


def test_kept_dropped_and_late_rows_add_up(spark, folder):
    def run():
        files = flows.stream_files(spark, f"{folder}/in", SHAPE, files_per_trigger=1)
        return flows.dedupe_with_late_rows(files, folder, f"{folder}/ck", ["k"], "ts", 600)

    batches = [[(1, 0), (1, 1), (2, 5)], [(1, 2), (3, 30), (2, 30)], [(4, 19), (5, 21), (1, 22)], [(3, 31), (6, 60)], [(3, 55)]]
    for batch in batches:
        put(spark, f"{folder}/in", *batch)
        assert run() == 1
    read = lambda name: rows(spark.read.parquet(f"{folder}/{name}"), "k", "seq")
    # After 30 minutes the mark is at 20: key 1 of minute 0 is forgotten then, and (4, 19) is late.
    assert read("kept") == [(1, 0), (1, 22), (2, 5), (3, 30), (3, 55), (5, 21), (6, 60)]
    assert read("late") == [(4, 19)]
    keys = S.Snapshots(spark, f"{folder}/keys")
    total = {name: sum(r["metrics"][name] for r in keys.history(9).collect()) for name in ("kept", "late", "dropped")}
    assert total == {"kept": 7, "late": 1, "dropped": 4} and sum(total.values()) == sum(map(len, batches))
    assert rows(keys.read(), "k") == [(3,), (6,)]
    assert run() == 0


def test_a_batch_run_again_replaces_itself(spark, folder):
    put(spark, f"{folder}/in", (1, 1), (2, 2))
    source = lambda: flows.stream_files(spark, f"{folder}/in", SHAPE)
    flows.dedupe_with_late_rows(source(), folder, f"{folder}/ck", ["k"], "ts", 600)
    shutil.rmtree(f"{folder}/ck/commits")
    flows.dedupe_with_late_rows(source(), folder, f"{folder}/ck", ["k"], "ts", 600)
    assert rows(spark.read.parquet(f"{folder}/kept"), "k") == [(1,), (2,)]
    assert S.Snapshots(spark, f"{folder}/keys").history(9).count() == 1


def test_upserts_into_parts_rewrite_only_theirs(spark, folder):
    sink = PartedTable(spark, f"{folder}/out", KeyRanges("k", (10, 20)))
    put(spark, f"{folder}/in", (1, 1), (15, 1), (25, 1))
    flows.upsert_stream(stream(spark, folder), sink, f"{folder}/ck", ["k"], ["seq"])
    before = sink.parts()
    put(spark, f"{folder}/in", (15, 5), (16, 2))
    flows.upsert_stream(stream(spark, folder), sink, f"{folder}/ck", ["k"], ["seq"])
    assert {p for p in before if before[p] != sink.parts()[p]} == {"000001"}
    assert rows(sink.read(), "k", "seq") == [(1, 1), (15, 5), (16, 2), (25, 1)]
    shutil.rmtree(f"{folder}/ck/commits")
    flows.upsert_stream(stream(spark, folder), sink, f"{folder}/ck", ["k"], ["seq"])
    assert len(sink.versions.numbers()) == 2
