"""Tables in parts: what a change rewrites, what readers see when a writer dies, and two writers at once."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from smeltery.operators.merge import upsert
from smeltery.plans import dimension, loads, parted as P, snapshot as S
from smeltery.plans.versions import VersionTakenError, Versions

SHAPE = "k bigint, v string"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), SHAPE)


def ranges(spark, folder, bounds=(10, 20, 30)):
    table = P.PartedTable(spark, folder, P.KeyRanges("k", bounds))
    table.create(frame(spark, *[(k, "old") for k in (-5, 3, 10, 19, 20, 29, 30, 99)], (None, "old")))
    return table


def replace(present, new):
    return upsert(present, new, ["k"])


def test_ranges_hold_their_keys(spark, folder):
    table = ranges(spark, folder)
    assert {p: e["rows"] for p, e in table.parts().items()} == {"000000": 2, "000001": 2, "000002": 2, "000003": 2, "none": 1}
    assert rows(table.read(["000001"]), "k") == [(10,), (19,)]
    assert rows(table.read(["none", "missing"]), "k") == [(None,)]


def test_untouched_parts_keep_their_files(spark, folder):
    table = ranges(spark, folder)
    before, files = table.parts(), set(table.read().inputFiles())
    table.upsert(frame(spark, (11, "new"), (19, "new"), (500, "new")), ["k"])
    after = table.parts()
    assert {p for p in after if after[p] != before.get(p)} == {"000001", "000003"}
    kept = [f for f in table.read().inputFiles() if "_part=000001" not in f and "_part=000003" not in f]
    assert kept and set(kept) <= files
    assert rows(table.read()) == sorted(
        [(None, "old"), (-5, "old"), (3, "old"), (10, "old"), (11, "new"), (19, "new"), (20, "old"), (29, "old"),
         (30, "old"), (99, "old"), (500, "new")], key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows(table.read(version=0), "v") == [("old",)] * 9


def test_scans_of_a_merge(spark, folder):
    """The derived batch is evaluated once, and no file of an untouched part is opened."""
    table = ranges(spark, folder)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    gone = [f.removeprefix("file:") for f in table.read(["000000", "000002", "000003"]).inputFiles()]
    for f in gone:
        __import__("pathlib").Path(f.removeprefix("//")).unlink()
    table.upsert(frame(spark, (11, "new"), (19, "new")).mapInPandas(count, SHAPE), ["k"])
    assert seen.value == 2
    assert rows(table.read(["000001"])) == [(10, "old"), (11, "new"), (19, "new")]


def test_a_writer_that_dies_changes_nothing(spark, folder, monkeypatch):
    table = ranges(spark, folder)
    before = rows(table.read())
    table.prepare_merge(frame(spark, (3, "dead")), ["k"], replace)
    assert rows(table.read()) == before and len(table.versions.numbers()) == 1

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(table.versions, "put", die)
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, (3, "dead")), ["k"])
    assert rows(P.PartedTable(spark, folder).read()) == before
    table.upsert(frame(spark, (3, "new")), ["k"])
    assert ("new",) in rows(table.read(), "v")


def test_two_writers_on_other_parts_both_count(spark, folder):
    table = ranges(spark, folder)
    a = table.prepare_merge(frame(spark, (3, "a")), ["k"], replace)
    b = table.prepare_merge(frame(spark, (20, "b")), ["k"], replace)
    table.commit(a)
    table.commit(b)
    got = dict(rows(table.read()))
    assert (got[3], got[20], got[-5]) == ("a", "b", "old")


def test_two_writers_on_one_part_one_looks_again(spark, folder):
    table = ranges(spark, folder)
    late = table.prepare_merge(frame(spark, (3, "late")), ["k"], replace)
    table.upsert(frame(spark, (-5, "first")), ["k"])
    with pytest.raises(P.ConcurrentChangeError):
        table.commit(late)
    real, calls = table.commit, []

    def overtaken(change):
        if not calls:
            calls.append(1)
            P.PartedTable(spark, folder).upsert(frame(spark, (4, "between")), ["k"])
        return real(change)

    table.commit = overtaken
    table.upsert(frame(spark, (3, "again")), ["k"])
    got = dict(rows(table.read()))
    assert (got[-5], got[3], got[4]) == ("first", "again", "between")


def test_versions_are_put_once(spark, folder):
    log = Versions(spark, f"{folder}/log")
    assert log.newest() is None and log.numbers() == []

    def put(i):
        try:
            log.put(0, {"writer": i, "text": "é" * 5000})
            return i
        except VersionTakenError:
            return None

    with ThreadPoolExecutor(8) as pool:
        done = [w for w in pool.map(put, range(16)) if w is not None]
    assert len(done) == 1 and log.newest() == {"writer": done[0], "text": "é" * 5000}
    log.put(1, {})
    assert log.numbers() == [0, 1] and [v.get("writer") for v in log.last(5)] == [None, done[0]]
    assert not [f for f in __import__("os").listdir(f"{folder}/log") if "_" in f and not f.startswith(".")]


def test_of_two_publications_of_one_version_one_fails(spark, folder):
    slow, fast = S.Snapshots(spark, folder), S.Snapshots(spark, folder)

    def overtaken(n):
        fast.publish(frame(spark, (2, "fast")))
        return {}

    with pytest.raises(VersionTakenError):
        slow.publish(frame(spark, (1, "slow")), metrics=overtaken)
    assert rows(slow.read(), "v") == [("fast",)]
    slow.publish(frame(spark, (1, "slow")), metrics=lambda n: overtaken(n) or {"insert": n}, retries=1)
    assert rows(slow.read(), "v") == [("slow",)]
    assert [r.version for r in slow.history(9).collect()] == [2, 1, 0]


def test_values_come_back_as_written(spark, folder):
    table = P.PartedTable(spark, folder, P.ByValue("zone"))
    values = ["007", "7", "", "a/b=c", "ü" * 300, None, "none", "x y", "%2F"]
    df = spark.createDataFrame(list(enumerate(values)), "k int, zone string")
    table.create(df)
    assert rows(table.read()) == rows(df)
    table.upsert(spark.createDataFrame([(1, "7"), (20, "007"), (21, None)], "k int, zone string"), ["k"])
    assert rows(table.read().where("zone = '007'"), "k") == [(0,), (20,)]
    with pytest.raises(P.MovedKeyError):
        table.upsert(spark.createDataFrame([(1, "8")], "k int, zone string"), ["k"])
    with pytest.raises(ValueError):
        ranged = ranges(spark, f"{folder}/r")
        ranged.upsert(frame(spark, (1, "x")), ["v"])


def test_new_columns_and_emptied_parts(spark, folder):
    table = ranges(spark, folder)
    wide = spark.createDataFrame([(3, "new", 1.5)], SHAPE + ", extra double")

    def combine(present, batch):
        return upsert(present.withColumn("extra", F.lit(None).cast("double")), batch, ["k"])

    table.merge(wide, ["k"], combine)
    assert rows(table.read().where("k IN (3, 10)")) == [(3, "new", 1.5), (10, "old", None)]
    table.merge(frame(spark, (20, "x"), (29, "x")), ["k"], lambda present, batch: present.join(batch, "k", "left_anti"))
    assert "000002" not in table.parts() and table.read().count() == 7
    with pytest.raises(S.SchemaMismatchError):
        table.append(spark.createDataFrame([("x", "y")], "k string, v string"))
    assert table.append(frame(spark, (3, "copy"), (700, "more"))) == 2
    assert table.read().count() == 9 and len(table.parts()["000000"]["folders"]) == 2
    assert table.upsert(spark.createDataFrame([], SHAPE), ["k"])["rows"] == 0


def test_retired_folders_are_gone_and_carried_ones_stay(spark, folder):
    table = ranges(spark, folder)
    for word in ("a", "b", "c"):
        table.upsert(frame(spark, (3, word)), ["k"])
    assert table.retire(1) == 3
    assert table.read().count() == 9 and dict(rows(table.read()))[3] == "c"


def test_even_ranges_split_the_keys(spark, folder):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    dealt = P.even_ranges(df, "k", 5)
    table = P.PartedTable(spark, folder, dealt)
    table.create(df)
    assert len(table.parts()) == 5 and all(100 < p["rows"] < 300 for p in table.parts().values())
    by_text = P.even_ranges(df.select(F.col("k").cast("string").alias("k")), "k", 3)
    assert list(by_text.bounds) == sorted(by_text.bounds) and len(by_text.bounds) == 2


def test_rows_and_mark_move_together(spark, folder):
    t0 = dt.datetime(2024, 1, 1)
    feed = spark.createDataFrame([(i, t0 + dt.timedelta(hours=i), f"v{i}") for i in range(6)] + [(9, None, "no time")],
                                 "k int, at timestamp_ntz, v string")
    table = P.PartedTable(spark, folder, P.HashBuckets(("k",), 4))

    def load(upto=None, df=feed):
        return loads.incremental_merge(df, table, "at", lambda d: d, keys=["k"], name="feed", lookback_seconds=3600, upto=upto)

    assert load(t0 + dt.timedelta(hours=2)).rows == 4
    put = table.versions.put
    table.versions.put = lambda *_: (_ for _ in ()).throw(RuntimeError("killed"))
    with pytest.raises(RuntimeError):
        load()
    table.versions.put = put
    assert table.mark("feed") == "2024-01-01T02:00:00" and table.read().count() == 4
    assert load().mark == t0 + dt.timedelta(hours=5)
    assert rows(table.read()) == rows(feed)
    older = spark.createDataFrame([(5, t0 + dt.timedelta(hours=4, minutes=30), "older")], feed.schema)
    load(df=older)
    assert rows(table.read()) == rows(feed)


def test_dimension_counts_its_actions(spark, folder):
    shape = ("customer_id bigint, full_name string, email string, country string, is_active boolean, lifetime_value double, "
             "updated_ts timestamp")
    at = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(i, f"n{i}", f"{i}@x", "DE", True, 1.0, at) for i in range(20)], shape)
    new = spark.createDataFrame([(1, "n1", "new@x", "DE", True, 1.0, at), (2, "n2", "2@x", "DE", False, 0.0, at),
                                 (3, "n3", "3@x", "DE", True, 1.0, at), (50, "n50", "50@x", "FR", True, 1.0, at)], shape)
    table = P.PartedTable(spark, folder, P.KeyRanges("customer_id", (10, 30)))
    dimension.bootstrap(table, old, at)
    later = dt.datetime(2024, 1, 2)
    done = dimension.apply_changes(table, new, as_of=later)
    assert {k: done[k] for k in dimension.ACTIONS} == {"insert": 1, "update": 1, "soft_delete": 1, "keep": 8}
    assert {r.record_source for r in table.read().where("customer_id < 20").collect()} == {"CRM_INITIAL"}
    assert rows(dimension.validation(table.read(), later, 5, 40)) == [
        (21, 1, 1, 1, "new@x", "CRM_INITIAL"), (21, 1, 1, 2, "2@x", "CRM_INITIAL")]
    with pytest.raises(VersionTakenError):
        dimension.bootstrap(table, old, at)


def test_text_partitions_behind_a_view(spark, folder):
    df = spark.createDataFrame([(1, "007"), (2, "7")], "k int, zone string")
    known_as = f"zones_{__import__('uuid').uuid4().hex}"
    S.publish_verified(df, known_as, folder, partition_by=["zone"])
    assert spark.table(known_as).schema["zone"].dataType.simpleString() == "string"
    assert rows(spark.table(known_as)) == [(1, "007"), (2, "7")]
    assert [r["published_by"] for r in S.Snapshots(spark, folder).history(1).collect()] == [spark.sparkContext.sparkUser()]
