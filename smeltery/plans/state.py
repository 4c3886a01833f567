"""High-water marks and saved schemas.

State folders are append-only: saving or resetting adds one line, and the
newest line of a table name counts.  A store has one writer at a time.  Tables that share a store keep their own
lines, and the earlier lines are the history of the store.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from smeltery.operators.dedupe import pick_one_per_key
from smeltery.operators.drift import Drift
from smeltery.operators.filters import Cursor
from smeltery.plans.snapshot import append_line, read_if_exists


class _Lines:
    """Append-only lines, one folder per table name."""

    field = ("", "")

    def __init__(self, spark: SparkSession, path: str, table_name: str):
        self.spark = spark
        self.path = path
        self.table_name = table_name
        self.schema = f"{' '.join(self.field)}, version bigint, updated_at timestamp, table_name string"
        self._version: int | None = None

    def _read(self) -> DataFrame | None:
        return read_if_exists(self.spark, self.path, self.schema)

    def _newest(self):
        lines = self._read()
        if lines is None:
            return None
        mine = lines.filter(F.col("table_name") == self.table_name)
        last = mine.orderBy(F.desc("version"), F.desc("updated_at")).limit(1).first()
        self._version = None if last is None else last["version"]
        return last

    def _append(self, value: Column) -> None:
        if self._version is None:
            self._newest()
        self._version = 0 if self._version is None else self._version + 1
        column, dtype = self.field
        append_line(self.spark, self.path, {
            column: value.cast(dtype), "version": F.lit(self._version).cast("bigint"),
            "updated_at": F.current_timestamp(), "table_name": F.lit(self.table_name),
        }, partition_by=["table_name"])


class TimestampWatermark(_Lines):
    """Highest processed timestamp of a table, read back minus a lookback for late rows."""

    field = ("watermark_ts", "timestamp_ntz")

    def __init__(self, spark: SparkSession, store_path: str, table_name: str, lookback_seconds: int = 300):
        super().__init__(spark, f"{store_path}_ts", table_name)
        self.lookback_seconds = lookback_seconds

    def raw(self) -> dt.datetime | None:
        last = self._newest()
        return None if last is None else last["watermark_ts"]

    def get(self) -> dt.datetime | None:
        return self.start_after(self.raw())

    def start_after(self, mark: dt.datetime | None) -> dt.datetime | None:
        return None if mark is None else mark - dt.timedelta(seconds=self.lookback_seconds)

    def save(self, value: Cursor) -> None:
        self._append(F.lit(value.isoformat(sep=" ")))

    def reset(self) -> None:
        if self.raw() is not None:
            self._append(F.lit(None))


class SequenceWatermark(_Lines):
    """Highest processed id of a table, -1 before the first run; sees inserts only."""

    field = ("last_id", "bigint")
    lookback_seconds = 0

    def __init__(self, spark: SparkSession, store_path: str, table_name: str):
        super().__init__(spark, f"{store_path}_id", table_name)

    def raw(self) -> int | None:
        last = self._newest()
        return None if last is None else last["last_id"]

    def get(self) -> int:
        mark = self.raw()
        return -1 if mark is None else mark

    def start_after(self, mark: int | None) -> int | None:
        return mark

    def save(self, value: Cursor) -> None:
        self._append(F.lit(int(value)))

    def reset(self) -> None:
        if self.raw() is not None:
            self._append(F.lit(None))


def current_marks(spark: SparkSession, store_path: str) -> DataFrame:
    """One row per table with a mark, over the timestamp and the id store."""
    shape = "table_name string, watermark_ts timestamp_ntz, last_id bigint, updated_at timestamp"
    marks = spark.createDataFrame([], shape)
    stores = ((TimestampWatermark, "_ts", "watermark_ts"), (SequenceWatermark, "_id", "last_id"))
    for store, suffix, column in stores:
        lines = read_if_exists(spark, store_path + suffix, store(spark, store_path, "").schema)
        if lines is None:
            continue
        last = pick_one_per_key(lines, ["table_name"], ["version", "updated_at"], latest=True)
        held = last.filter(F.col(column).isNotNull()).select("table_name", column, "updated_at")
        marks = marks.unionByName(held, allowMissingColumns=True)
    return marks


class SavedSchemas(_Lines):
    """Schema of a table as of its last publication."""

    field = ("schema_json", "string")

    def get(self) -> T.StructType | None:
        last = self._newest()
        return None if last is None else T.StructType.fromJson(json.loads(last["schema_json"]))

    def save(self, schema: T.StructType) -> None:
        self._append(F.lit(schema.json()))


class DriftReports(_Lines):
    """Drift of every run of a table, kept as JSON."""

    field = ("report_json", "string")

    def save(self, drift: Drift) -> None:
        self._append(F.lit(drift.to_json()))

    def replay(self) -> DataFrame:
        """Every difference ever reported, with the number of its report."""
        shape = "run bigint, table_name string, column_name string, kind string, from_type string, to_type string"
        lines = self._read()
        if lines is None:
            return self.spark.createDataFrame([], shape)
        mine = lines.filter(F.col("table_name") == self.table_name).orderBy("version", "updated_at")
        # A report is a line of schemas, and there is one per run of the table.
        found = [(line["version"], *entry) for line in mine.toLocalIterator()
                 for drift in [Drift.from_json(line["report_json"])]
                 for entry in [(drift.table, *e) for e in drift.entries()]]
        return self.spark.createDataFrame(found, shape)
