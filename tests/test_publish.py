import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from smeltery.operators import drift as D, merge as G
from smeltery.plans import audit, snapshot as S, state
from smeltery.sources import jdbc, readers


def frame(spark, *values):
    return spark.createDataFrame([(v, str(v)) for v in values], "k int, v string")


def name():
    return f"t_{uuid.uuid4().hex}"


def test_publications_replace_the_content_and_are_remembered(spark, folder):
    table = S.Snapshots(spark, folder)
    assert not table.exists()
    table.publish(frame(spark, 1, 2))
    table.publish(frame(spark, 3), "SECOND", metrics={"insert": 1})
    assert rows(table.read()) == [(3, "3")]
    last = table.history(5).select("version", "operation", "row_count", "metrics").collect()
    assert [tuple(r) for r in last] == [(1, "SECOND", 1, {"insert": 1}), (0, "WRITE", 2, {})]
    assert table.history(1).count() == 1


def test_old_publications_can_be_retired(spark, folder):
    table = S.Snapshots(spark, folder)
    for k in range(4):
        table.publish(frame(spark, k))
    assert [table.retire(2), table.retire(2)] == [2, 0]
    assert rows(table.read(), "k") == [(3,)]
    with pytest.raises(ValueError):
        table.retire(0)


def test_content_may_be_derived_from_itself(spark, folder):
    table = S.Snapshots(spark, folder)
    table.publish(frame(spark, 1, 2))
    table.publish(table.read().withColumn("k", F.col("k") + 10))
    assert rows(table.read(), "k") == [(11,), (12,)]


def test_same_schema_is_enforced(spark, folder):
    table = S.Snapshots(spark, folder)
    table.publish(frame(spark, 1))
    with pytest.raises(S.SchemaMismatchError):
        table.publish(frame(spark, 1).withColumn("x", F.lit(1)), schema="same")
    assert rows(table.read()) == [(1, "1")]


def test_union_schema_keeps_old_columns(spark, folder):
    table = S.Snapshots(spark, folder)
    table.publish(frame(spark, 1))
    table.publish(spark.createDataFrame([(2, 0.5)], "k int, extra double"), schema="union")
    assert table.read().columns == ["k", "extra", "v"]
    assert rows(table.read()) == [(2, 0.5, None)]
    with pytest.raises(S.SchemaMismatchError):
        table.publish(spark.createDataFrame([("x",)], "k string"), schema="union")


def test_partitioned_publication_keeps_types_even_when_empty(spark, folder):
    table = S.Snapshots(spark, folder)
    df = frame(spark, 1, 2).withColumn("d", F.to_date(F.lit("2024-01-01")))
    table.publish(df.filter("k > 5"), partition_by=["d"])
    assert table.read().count() == 0
    table.publish(df, partition_by=["d"])
    assert table.read().schema["d"].dataType == T.DateType()


def test_readers_of_the_name_follow_the_switch(spark, folder):
    known_as = name()
    S.publish_verified(frame(spark, 1), known_as, folder)
    S.publish_verified(frame(spark, 1, 2).withColumn("new", F.lit(True)), known_as, folder)
    assert spark.table(known_as).columns == ["k", "v", "new"]
    assert spark.table(known_as).count() == 2


def test_catalog_tables(spark, folder):
    database, table = name(), name()
    S.ensure_database(spark, database, f"{folder}/db")
    S.ensure_database(spark, database, f"{folder}/db")
    full = f"{database}.{table}"
    S.save_table(frame(spark, 1), full, path=f"{folder}/t")
    S.save_table(frame(spark, 2), full, path=f"{folder}/t", same_schema=True)
    with pytest.raises(S.SchemaMismatchError):
        S.save_table(spark.range(1), full, path=f"{folder}/t", same_schema=True)
    S.save_table(spark.range(3), full, path=f"{folder}/t")
    assert spark.table(full).columns == ["id"]
    assert [r.tableName for r in S.list_tables(spark, database).collect()] == [table]
    assert [r.col_name for r in S.describe(spark, full).collect()] == ["id"]
    S.drop_table(spark, full)
    assert not spark.catalog.tableExists(full)


def test_merge_metrics_come_from_the_write(spark, folder):
    table = S.Snapshots(spark, folder)
    table.publish(frame(spark, 1, 2, 3))
    new = spark.createDataFrame([(1, "gone"), (2, "new"), (9, "in")], "k int, v string")
    clauses = [G.Matched("delete", "source.v = 'gone'", delete=True), G.Matched("update", None, {"v": "source.v"})]
    merged = G.merge(table.read(), new, ["k"], clauses, G.Missing({"k": "source.k", "v": "source.v"}), with_action=True)
    assert audit.publish_merge(table, merged) == 3
    assert rows(table.read()) == [(2, "new"), (3, "3"), (9, "in")]
    metrics = table.history(1).first()["metrics"]
    assert metrics == {"insert": 1, "update": 1, "soft_delete": 0, "keep": 1, "delete": 1}


V1 = "id bigint, price double, note string, small smallint"
V2 = "id bigint, price string, small smallint, extra float"


def v2(spark):
    return spark.createDataFrame([(1, "1.5", 1, 0.5), (2, "n/a", 2, None), (3, None, 3, 1.0)], V2)


def drift(spark):
    return D.detect_drift("t", spark.createDataFrame([], V1).schema, v2(spark))


def test_drift_is_found_by_kind(spark):
    assert drift(spark).entries() == [
        ("extra", "new", None, "float"), ("note", "dropped", "string", None),
        ("price", "type_changed", "double", "string")]
    assert not D.detect_drift("t", v2(spark).schema, v2(spark)).has_drift


def test_without_a_saved_schema_everything_is_new(spark):
    found = D.detect_drift("t", None, v2(spark))
    assert list(found.new_columns) == ["id", "price", "small", "extra"]


def test_repair_takes_incoming_types(spark):
    out = D.apply_drift(v2(spark), drift(spark))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {"id": "bigint", "price": "string", "small": "smallint", "extra": "double", "note": "string",
                     "_schema_version": "string", "_processed_at": "timestamp"}


def test_repair_to_saved_types_nulls_what_does_not_fit(spark):
    out = D.apply_drift(v2(spark), drift(spark), keep_saved_types=True, stamp=False)
    assert rows(out, "id", "price", "note") == [(1, 1.5, None), (2, None, None), (3, None, None)]
    assert not D.detect_drift("t", out.schema, out).has_drift


def test_report_counts_lost_values(spark):
    got = {r.column_name: (r.filled, r.lost_values) for r in D.drift_report(v2(spark), drift(spark)).collect()}
    assert got == {"extra": (2, 0), "note": (0, 0), "price": (2, 1)}
    same = D.detect_drift("t", v2(spark).schema, v2(spark))
    assert D.drift_report(v2(spark), same).count() == 0


def test_version_depends_on_content_only(spark):
    assert D.schema_fingerprint(v2(spark).schema) == D.schema_fingerprint(v2(spark).limit(0).schema)
    assert D.schema_fingerprint(v2(spark).schema) != D.schema_fingerprint(v2(spark).drop("id").schema)


def test_report_survives_json(spark):
    found = drift(spark)
    assert D.Drift.from_json(found.to_json()) == found


def test_newest_saved_schema_wins(spark, folder):
    saved = state.SavedSchemas(spark, folder, "t")
    assert saved.get() is None
    saved.save(spark.range(1).schema)
    saved.save(v2(spark).schema)
    assert saved.get() == v2(spark).schema


def test_snapshot_repairs_before_it_publishes(spark, folder):
    known_as = name()
    old = spark.createDataFrame([(1, 1.0, "x", 1)], V1)
    audit.snapshot_with_drift(old, "t", known_as, folder)
    assert audit.drift_log(spark, f"{folder}/drift_log").count() == 0
    audit.snapshot_with_drift(v2(spark), "t", known_as, folder, keep_saved_types=True)
    assert {"note", "extra"} <= set(spark.table(known_as).columns)
    assert audit.drift_log(spark, f"{folder}/drift_log").count() == 3
    audit.snapshot_with_drift(v2(spark), "t", known_as, folder, keep_saved_types=True)
    repeated = audit.drift_log(spark, f"{folder}/drift_log").groupBy("column_name").count()
    assert dict(rows(repeated)) == {"price": 1, "note": 1, "extra": 1}
    assert dict(rows(spark.table(known_as), "id", "price")) == {1: 1.5, 2: None, 3: None}


def test_a_widened_column_is_no_drift_later(spark, folder):
    known_as = name()
    small = spark.createDataFrame([(1, 2, 1.5)], "k int, `a.b` smallint, f float")
    for _ in range(3):
        audit.snapshot_with_drift(small, "t", known_as, folder)
    assert audit.drift_log(spark, f"{folder}/drift_log").count() == 0
    assert [f.dataType.simpleString() for f in spark.table(known_as).schema] == ["int", "int", "double"]


def test_columns_with_dots_can_drift(spark):
    old, new = (spark.createDataFrame([(1, "2")], f"k int, `a.b` {t}") for t in ("string", "string"))
    new = new.withColumn("c.d", F.lit(1))
    found = D.detect_drift("t", old.schema, new.withColumn("k", F.lit("x")))
    assert D.apply_drift(new.withColumn("k", F.lit("x")), found, stamp=False).columns == ["k", "a.b", "c.d"]
    assert D.drift_report(new.withColumn("k", F.lit("x")), found).count() == 2


def test_configured_tables_are_snapshotted_and_verified(spark, folder):
    names = {"a": name(), "b": name()}
    done = audit.snapshot_all({"a": frame(spark, 1, 2), "b": spark.range(3)}, folder, names)
    assert done == {"a": 2, "b": 3}
    assert rows(audit.verify_tables(spark, names)) == [("a", 2, 2), ("b", 3, 1)]


def test_columns_only_in_the_new_frame(spark):
    assert D.columns_only_in(v2(spark), spark.createDataFrame([], V1)) == ["extra"]


class FakeReader:
    """Stands in for spark.read, since no database may run here."""

    def __init__(self, spark, bounds):
        self.calls, self._spark, self._bounds = [], spark, bounds
        self.read = self

    def jdbc(self, **options):
        self.calls.append(options)
        return self._spark.createDataFrame([self._bounds], "lo bigint, hi bigint")


@pytest.mark.parametrize("bounds, want", [((10, 99), {"column": "k", "lowerBound": 10, "upperBound": 100,
                                                       "numPartitions": 4}), ((None, None), {})])
def test_snapshot_read_is_split_by_key_range(spark, bounds, want):
    fake = FakeReader(spark, bounds)
    jdbc.read_snapshot(fake, "jdbc:x", "orders", {"user": "u"}, partition_column="k", partitions=4)
    probe, read = fake.calls
    assert "MIN(k)" in probe["table"]
    assert read == {"url": "jdbc:x", "table": "orders", "properties": {"user": "u"}} | want


def test_snapshot_read_by_remainder_covers_every_row_once(spark):
    parts = jdbc.spread_predicates("k", 3)
    df = spark.createDataFrame([(k,) for k in [None, -4, -1, 0, 1, 2, 3, 10]], "k int")
    hits = [df.filter(p).count() for p in parts]
    assert sum(hits) == df.count()


def test_whole_table_read(spark):
    fake = FakeReader(spark, (1, 2))
    jdbc.read_snapshot(fake, "jdbc:x", "orders", {})
    assert len(fake.calls) == 1


def test_path_scans(spark, folder):
    frame(spark, 1).write.parquet(f"{folder}/t")
    assert rows(readers.scan_path(spark, f"{folder}/t")) == [(1, "1")]
    assert rows(readers.read_files(spark, f"{folder}/t", schema="k int")) == [(1,)]


def test_reports_are_replayed_and_a_third_run_is_quiet(spark, folder):
    known_as = name()
    first = spark.createDataFrame([(1, 1.0, "x")], "id bigint, price double, note string")
    second = spark.createDataFrame([(2, "2.5", 3, 0.5)], "id bigint, price string, small smallint, part float")
    for df in (first, second, second):
        audit.snapshot_with_drift(df, "t", known_as, folder, keep_saved_types=True)
    kept = state.DriftReports(spark, f"{folder}/drift_reports", "t")
    assert rows(kept.replay(), "run", "column_name", "kind", "to_type") == [
        (1, "note", "dropped", None), (1, "part", "new", "double"), (1, "price", "type_changed", "string"), (1, "small", "new", "int")]
    assert audit.drift_log(spark, f"{folder}/drift_log").count() == 4
    assert spark.table(known_as).schema.simpleString() == "struct<id:bigint,price:double,small:int,part:double,note:string>"
    assert rows(audit.verify_sample(spark, {"t": known_as}, {"t": "id"}), "sample") == [('{"id":2,"price":2.5,"small":3,"part":0.5}',)]
