"""Publishing tables: fresh folder, verified count, then one switch."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from smeltery.functions.columns import quoted
from smeltery.operators.layout import gather_by_key
from smeltery.plans.versions import VersionTakenError, Versions, locate

HISTORY = ("version bigint, published_at timestamp, operation string, row_count bigint, metrics map<string,bigint>, "
           "published_by string")


class SchemaMismatchError(ValueError):
    """The frame does not have the columns and types the table has."""


class IncompleteWriteError(RuntimeError):
    """The folder does not hold the rows that were written."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there; a failing file system raises instead of looking like a first run."""
    files, location = locate(spark, path)
    return files.exists(location)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder; False when it was not there."""
    files, location = locate(spark, path)
    return files.delete(location, True)


def read_if_exists(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """The folder as a frame, or None when it is not there."""
    if not path_exists(spark, path):
        return None
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def write_counted(df: DataFrame, path: str, *, mode: str = "errorifexists",
                  partition_by: Sequence[str] = (), **options: str) -> int:
    """Write and return the number of rows, counted by the write job itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)
    return int(seen.get["rows"])


def append_line(spark: SparkSession, path: str, line: Mapping[str, Column], partition_by: Sequence[str] = ()) -> None:
    """Append one row to a folder of state lines."""
    row = spark.range(0, 1, 1, 1).select(*[value.alias(name) for name, value in line.items()])
    row.write.mode("append").partitionBy(*partition_by).parquet(path)


def signature(spark: SparkSession) -> dict[str, str]:
    """When and by whom a version is published."""
    return {"published_at": dt.datetime.now(dt.UTC).isoformat(), "published_by": spark.sparkContext.sparkUser()}


def history_frame(spark: SparkSession, versions: Sequence[Mapping]) -> DataFrame:
    """Versions as rows, in the order given."""
    lines = [(v["version"], dt.datetime.fromisoformat(v["published_at"]), v["operation"], v["row_count"], v["metrics"],
              v["published_by"])
             for v in versions]
    return spark.createDataFrame(lines, HISTORY).coalesce(1)


def highest(marks: Mapping[str, int], metrics: Mapping[str, int]) -> dict[str, int]:
    """The largest value so far under each name."""
    return {**marks, **{name: max(value, marks.get(name, value)) for name, value in metrics.items()}}


class Snapshots:
    """A path table whose content is replaced as a whole.

    Every publication writes a fresh folder, checks its row count and puts the
    next version in place; the newest version says where readers look.  At no
    moment is the table missing or half written.  Of two writers that publish
    the same version one fails and can try again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.written: str | None = None
        self.versions = Versions(spark, f"{self.root}/versions")

    def exists(self) -> bool:
        return self.versions.newest() is not None

    def read(self) -> DataFrame:
        return self._open(self._newest())

    def _newest(self) -> dict:
        now = self.versions.newest()
        if now is None:
            raise LookupError(f"nothing published under {self.root}")
        return now

    def _open(self, line: Mapping) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(line["schema"]))).parquet(line["folder"])

    def folder(self) -> str:
        return self._newest()["folder"]

    def publish(self, df: DataFrame, operation: str = "WRITE", *, schema: str = "replace",
                partition_by: Sequence[str] = (), retries: int = 0,
                metrics: Mapping[str, int] | Callable[[int], Mapping[str, int]] | None = None) -> int:
        """Make ``df`` the content and return its row count.

        ``schema`` is ``replace``; ``same``, which refuses other columns or
        types; or ``union``, which keeps columns of the present content that
        ``df`` lacks, as nulls.  ``metrics`` go into the history; as a function
        they are made from the row count once the data is written.

        The version that follows the present one is published; if another writer
        was faster, :class:`VersionTakenError` is raised.  ``retries`` takes the
        next free version instead, for content that does not depend on the present
        one.  ``same`` and ``union`` hold against the version seen first.
        """
        now = self.versions.newest()
        if now is not None and schema != "replace":
            df = self._fit(df, T.StructType.fromJson(json.loads(now["schema"])), schema)
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        shaped = gather_by_key(df, *partition_by) if partition_by else df
        rows = write_counted(shaped, folder, partition_by=partition_by)
        order = [c for c in df.columns if c not in partition_by] + list(partition_by)
        stored = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order])
        found = self.spark.read.schema(stored).parquet(folder).count()
        if found != rows:
            raise IncompleteWriteError(f"{folder} holds {found} rows, {rows} were written")
        noted = dict((metrics(rows) if callable(metrics) else metrics) or {})
        line = {"operation": operation, "row_count": rows, "metrics": noted, "folder": folder, "schema": stored.json(),
                "partition_by": list(partition_by)}
        self._commit(now, line, retries)
        self.written = folder
        return rows

    def _commit(self, now: Mapping | None, line: Mapping, retries: int) -> None:
        while True:
            version = 0 if now is None else now["version"] + 1
            marks = highest({} if now is None else now["marks"], line["metrics"])
            try:
                self.versions.put(version, {**line, "version": version, "marks": marks, **signature(self.spark)})
                return
            except VersionTakenError:
                if retries < 1:
                    raise
                retries, now = retries - 1, self.versions.newest()

    def _fit(self, df: DataFrame, present: T.StructType, schema: str) -> DataFrame:
        if schema == "same":
            if not same_columns(df.schema, present):
                raise SchemaMismatchError(f"expected {present.simpleString()}, got {df.schema.simpleString()}")
            return df
        if schema != "union":
            raise ValueError(f"unknown schema rule {schema!r}")
        incoming = {f.name: f.dataType for f in df.schema.fields}
        clash = [f.name for f in present.fields if incoming.get(f.name, f.dataType) != f.dataType]
        if clash:
            raise SchemaMismatchError(f"columns change type: {clash}")
        absent = {f.name: F.lit(None).cast(f.dataType) for f in present.fields if f.name not in incoming}
        return df.withColumns(absent) if absent else df

    def retire(self, keep: int) -> int:
        """Delete the folders of all but the newest ``keep`` publications; returns how many went.

        Readers that still hold an older publication lose it, so ``keep`` has
        to cover the longest running reader.
        """
        if keep < 1:
            raise ValueError("the current publication has to stay")
        return sum(delete_folder(self.spark, self.versions.read(n)["folder"]) for n in self.versions.numbers()[:-keep])

    def latest_metric(self, name: str) -> int | None:
        """The largest value published under ``name`` so far; the newest version carries it."""
        now = self.versions.newest()
        return None if now is None else now["marks"].get(name)

    def history(self, n: int) -> DataFrame:
        """The last ``n`` publications, newest first."""
        return history_frame(self.spark, self.versions.last(n))


def save_table(df: DataFrame, name: str, *, path: str | None = None, same_schema: bool = False) -> None:
    """Catalog table replaced by ``df``; ``same_schema`` refuses a different one."""
    spark = df.sparkSession
    if same_schema and spark.catalog.tableExists(name):
        present = spark.table(name).schema
        if not same_columns(df.schema, present):
            raise SchemaMismatchError(f"expected {present.simpleString()}, got {df.schema.simpleString()}")
    writer = df.write.format("parquet").mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def publish_as(name: str, snapshots: Snapshots) -> None:
    """Point the catalog name at the newest publication in one statement, schema changes included.

    The view names its columns.  Folder names carry no types, so a partitioned
    publication gets a table of its own that declares them, and the view reads
    that: a text such as '007' stays a text.
    """
    spark, now = snapshots.spark, snapshots._newest()
    schema = T.StructType.fromJson(json.loads(now["schema"]))
    columns, source = ", ".join(quoted(c) for c in schema.names), f"parquet.`{now['folder']}`"
    if now["partition_by"]:
        database, _, short = name.rpartition(".")
        source = f"{database + '.' if database else ''}{short}_{now['folder'].rsplit('/', 1)[1]}"
        declared = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(quoted(c) for c in now["partition_by"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {source} ({declared}) USING parquet PARTITIONED BY ({by}) "
                  f"LOCATION '{now['folder']}'")
        spark.sql(f"MSCK REPAIR TABLE {source}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {source}")


def publish_verified(df: DataFrame, name: str, root: str, **options) -> int:
    """Publish ``df`` under ``root`` and as catalog name, and check what readers of the name now see."""
    snapshots = Snapshots(df.sparkSession, root)
    rows = snapshots.publish(df, "SNAPSHOT", **options)
    publish_as(name, snapshots)
    seen = df.sparkSession.table(name).count()
    if seen != rows:
        raise IncompleteWriteError(f"{name} shows {seen} rows, {rows} were written")
    return rows


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")
