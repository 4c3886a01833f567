"""A table kept in parts, of which a change rewrites only those it touches.

Rows are dealt to parts by ranges of a key, by hash of the keys or by the value
of a partition column.  A version names the folders of every part; a change
writes new folders for the parts it touches and carries the others over as they
are.  Nothing is visible before the version is in place, and a version is put in
place once, so a job that dies leaves readers on the old rows and of two writers
that touch the same parts one has to look again.

Marks (a stream's batch number, a load's high-water mark) are part of the
version, so they move together with the rows or not at all.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from smeltery.functions.columns import quoted
from smeltery.operators.layout import gather_by_key
from smeltery.operators.merge import ACTION, upsert
from smeltery.operators.sizing import fits_broadcast, measure
from smeltery.plans.snapshot import (
    IncompleteWriteError, SchemaMismatchError, delete_folder, history_frame, signature, write_counted,
)
from smeltery.plans.versions import VersionTakenError, Versions

PART = "_part"
NO_KEY = "none"
Mark = int | str
Combine = Callable[[DataFrame, DataFrame], DataFrame]


class ConcurrentChangeError(RuntimeError):
    """Another writer has changed the same parts in between."""


class MovedKeyError(ValueError):
    """A key of the batch lives in another partition of the table."""


@dataclass(frozen=True)
class KeyRanges:
    """Ranges of one key; a row belongs to the number of bounds at or below its key.

    ``bounds`` ascend. The part is found by a binary choice, so up to about a
    thousand bounds are practical; parts may hold any number of files.
    """

    column: str
    bounds: tuple

    def label(self, schema: T.StructType) -> Column:
        key, kind = F.col(quoted(self.column)), schema[self.column].dataType

        def part(low: int, high: int) -> Column:
            if low == high:
                return F.lit(f"{low:06d}")
            middle = (low + high) // 2
            return F.when(key < F.lit(_text(self.bounds[middle])).cast(kind), part(low, middle)).otherwise(
                part(middle + 1, high))

        return F.when(key.isNull(), NO_KEY).otherwise(part(0, len(self.bounds)))

    def fixed_by(self, keys: Collection[str]) -> bool:
        return self.column in keys

    def spec(self) -> dict:
        return {"kind": "ranges", "column": self.column, "bounds": [_text(b) for b in self.bounds]}


@dataclass(frozen=True)
class HashBuckets:
    """A fixed number of buckets by hash of the key columns, for keys without a known range."""

    columns: tuple[str, ...]
    count: int

    def label(self, schema: T.StructType) -> Column:
        return F.lpad(F.pmod(F.xxhash64(*[quoted(c) for c in self.columns]), F.lit(self.count)).cast("string"), 6, "0")

    def fixed_by(self, keys: Collection[str]) -> bool:
        return set(self.columns) <= set(keys)

    def spec(self) -> dict:
        return {"kind": "hash", "columns": list(self.columns), "count": self.count}


@dataclass(frozen=True)
class ByValue:
    """One part per value of a column; null has its own.

    The column stays in the files, so its values and type come back as written.
    ``fixed`` states that a key never changes its value of the column, which
    saves looking for keys that move.
    """

    column: str
    fixed: bool = False

    def label(self, schema: T.StructType) -> Column:
        value = F.col(quoted(self.column)).cast("string")
        # Values that a folder name would have to escape, or could not hold, go by their digest.
        plain = F.concat(F.lit("v-"), value)
        return (F.when(value.isNull(), NO_KEY).when(value.rlike("^[A-Za-z0-9._-]{1,100}$"), plain)
                .otherwise(F.concat(F.lit("h-"), F.sha2(value, 256))))

    def fixed_by(self, keys: Collection[str]) -> bool:
        return self.fixed or self.column in keys

    def spec(self) -> dict:
        return {"kind": "value", "column": self.column, "fixed": self.fixed}


Parting = KeyRanges | HashBuckets | ByValue


def parting_from(spec: Mapping) -> Parting:
    if spec["kind"] == "ranges":
        return KeyRanges(spec["column"], tuple(spec["bounds"]))
    if spec["kind"] == "hash":
        return HashBuckets(tuple(spec["columns"]), spec["count"])
    return ByValue(spec["column"], spec["fixed"])


def _text(value: object) -> str:
    return value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)


def even_ranges(df: DataFrame, column: str, parts: int) -> KeyRanges:
    """Ranges that hold about the same number of rows, measured from the key column alone."""
    keys = df.select(column).where(F.col(column).isNotNull())
    starts = (keys.repartitionByRange(parts, column).groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min(column).alias("low")).orderBy("low"))
    # One row per part comes back.
    return KeyRanges(column, tuple(r["low"] for r in starts.collect()[1:]))


@dataclass(frozen=True)
class Change:
    """Rows that are written and wait for their version."""

    base: Mapping | None
    parts: Mapping[str, dict | None]
    schema: T.StructType
    operation: str
    metrics: Mapping[str, int] = field(default_factory=dict)
    marks: Mapping[str, Mark] = field(default_factory=dict)


class PartedTable:
    """``parting`` is needed for the first version only; later ones keep it."""

    def __init__(self, spark: SparkSession, root: str, parting: Parting | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.versions = Versions(spark, f"{self.root}/versions")
        self._parting = parting

    # ---- reading

    def exists(self) -> bool:
        return self.versions.newest() is not None

    def read(self, parts: Collection[str] | None = None, version: int | None = None) -> DataFrame:
        """The newest rows, or those of some parts, or those of an older version."""
        now = self._newest() if version is None else self.versions.read(version)
        return self._open(now, parts)

    def parts(self, version: int | None = None) -> dict[str, dict]:
        """``{part: {folders, rows}}`` of a version."""
        return (self._newest() if version is None else self.versions.read(version))["parts"]

    def history(self, n: int) -> DataFrame:
        return history_frame(self.spark, self.versions.last(n))

    def mark(self, name: str) -> Mark | None:
        now = self.versions.newest()
        return None if now is None else now["marks"].get(name)

    def latest_metric(self, name: str) -> Mark | None:
        return self.mark(name)

    def _newest(self) -> dict:
        now = self.versions.newest()
        if now is None:
            raise LookupError(f"nothing published under {self.root}")
        return now

    def _open(self, now: Mapping, parts: Collection[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        chosen = now["parts"] if parts is None else {p: now["parts"][p] for p in parts if p in now["parts"]}
        folders = [f for p in chosen.values() for f in p["folders"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- writing

    def _dealt(self, now: Mapping | None) -> Parting:
        parting = self._parting if now is None else parting_from(now["parting"])
        if parting is None:
            raise ValueError("the first version needs a parting")
        return parting

    def _write(self, df: DataFrame, parting: Parting, area: str) -> tuple[str, dict[str, int]]:
        """Rows by part below a fresh folder, counted by the write and again from the files."""
        folder = f"{self.root}/{area}/{uuid.uuid4().hex}"
        dealt = df.withColumn(PART, parting.label(df.schema))
        rows = write_counted(gather_by_key(dealt, PART), folder, partition_by=[PART])
        found = self.spark.read.schema(f"{PART} string").parquet(folder).groupBy(PART).count()
        # One row per touched part comes back.
        counts = {r[PART]: r["count"] for r in found.collect()}
        if sum(counts.values()) != rows:
            raise IncompleteWriteError(f"{folder} holds {sum(counts.values())} rows, {rows} were written")
        return folder, counts

    def _staged(self, batch: DataFrame, folder: str, counts: Mapping[str, int]) -> DataFrame:
        if not counts:
            return self.spark.createDataFrame([], batch.schema)
        return self.spark.read.schema(batch.schema).parquet(folder).drop(PART)

    @staticmethod
    def _folders(folder: str, counts: Mapping[str, int]) -> dict[str, dict]:
        return {p: {"folders": [f"{folder}/{PART}={p}"], "rows": n} for p, n in counts.items()}

    def create(self, df: DataFrame, operation: str = "WRITE", *, marks: Mapping[str, Mark] | None = None) -> int:
        """The first version; fails when there is one."""
        if self.exists():
            raise VersionTakenError(f"{self.root} has been written before")
        return self.commit(self.prepare_create(df, operation, marks=marks))

    def prepare_create(self, df: DataFrame, operation: str = "WRITE", *, marks: Mapping[str, Mark] | None = None) -> Change:
        folder, counts = self._write(df, self._dealt(None), "data")
        return Change(None, self._folders(folder, counts), df.schema, operation, {}, dict(marks or {}))

    def append(self, batch: DataFrame, *, marks: Mapping[str, Mark] | None = None) -> int:
        """Add rows without reading or rewriting any; returns the rows of the batch."""
        if not self.exists():
            return self.create(batch, "APPEND", marks=marks)
        now = self._newest()
        schema = self._wider(now, batch.schema)
        folder, counts = self._write(batch, self._dealt(now), "data")
        added = self._folders(folder, counts)

        def grown(base: Mapping) -> Change:
            parts = {p: {"folders": [*base["parts"].get(p, {"folders": []})["folders"], *new["folders"]],
                         "rows": base["parts"].get(p, {"rows": 0})["rows"] + new["rows"]} for p, new in added.items()}
            return Change(base, parts, schema, "APPEND", {"insert": sum(counts.values())}, dict(marks or {}))

        while True:
            try:
                self.commit(grown(now))
                return sum(counts.values())
            except ConcurrentChangeError:
                now = self._newest()

    def merge(self, batch: DataFrame, keys: Sequence[str], combine: Combine, operation: str = "MERGE", *,
              marks: Mapping[str, Mark] | None = None, actions: Sequence[str] = (), attempts: int = 5) -> Mapping[str, int]:
        """Replace the parts the batch touches by ``combine(present rows, batch)``.

        The batch is evaluated once, when it is written beside the table; all
        passes over it read that copy.  Of the table only the touched parts are
        read.  ``actions`` are counted while the merge is written.  A writer that
        was overtaken on the same parts merges again from what is there now.
        """
        now = self._newest()
        folder, counts = self._write(batch, self._dealt(now), "staged")
        try:
            staged = self._staged(batch, folder, counts)
            for attempt in range(1, attempts + 1):
                change = self._merged(now, staged, counts, keys, combine, operation, marks, actions)
                try:
                    self.commit(change)
                    return change.metrics
                except ConcurrentChangeError:
                    if attempt == attempts:
                        raise
                    now = self._newest()
        finally:
            delete_folder(self.spark, folder)

    def prepare_merge(self, batch: DataFrame, keys: Sequence[str], combine: Combine, operation: str = "MERGE", *,
                      marks: Mapping[str, Mark] | None = None, actions: Sequence[str] = ()) -> Change:
        """The rows of :meth:`merge`, written but not yet visible."""
        now = self._newest()
        folder, counts = self._write(batch, self._dealt(now), "staged")
        staged = self._staged(batch, folder, counts)
        change = self._merged(now, staged, counts, keys, combine, operation, marks, actions)
        delete_folder(self.spark, folder)
        return change

    def upsert(self, batch: DataFrame, keys: Sequence[str], *, newer_by: Sequence[str] | None = None,
               marks: Mapping[str, Mark] | None = None) -> Mapping[str, int]:
        """Replace rows by key and add the others; see :func:`smeltery.operators.merge.upsert`.

        Rows are replaced as a whole: columns the batch lacks become null.
        """
        absent = {f.name: F.lit(None).cast(f.dataType) for f in self.read([]).schema.fields if f.name not in batch.columns}
        batch = batch.withColumns(absent) if absent else batch
        return self.merge(batch, keys, lambda present, new: upsert(present, new, keys, newer_by=newer_by), "UPSERT", marks=marks)

    def _merged(self, now: Mapping, staged: DataFrame, counts: Mapping[str, int], keys: Sequence[str], combine: Combine,
                operation: str, marks: Mapping[str, Mark] | None, actions: Sequence[str]) -> Change:
        parting = self._dealt(now)
        if not parting.fixed_by(keys):
            if not isinstance(parting, ByValue):
                raise ValueError(f"parts follow from {parting.spec()}, which the keys {list(keys)} do not hold")
            self._refuse_moved_keys(now, staged, list(keys), parting.column)
        merged = combine(self._open(now, list(counts)), staged)
        seen = Observation()
        if actions:
            merged = merged.observe(seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in actions])
        schema = self._wider(now, merged.drop(ACTION).schema)
        # Parts that end up empty are not among the folders written and leave the table.
        folder, written = self._write(merged.drop(ACTION), parting, "data")
        if not set(written) <= set(counts):
            raise MovedKeyError(f"the merge puts rows into parts the batch does not touch: {sorted(set(written) - set(counts))[:3]}")
        metrics = {a: int(n) for a, n in seen.get.items()} if actions else {}
        parts = {p: None for p in counts} | self._folders(folder, written)
        return Change(now, parts, schema, operation, {**metrics, "rows": sum(counts.values()), "parts": len(counts)}, dict(marks or {}))

    def _refuse_moved_keys(self, now: Mapping, staged: DataFrame, keys: list[str], column: str) -> None:
        size = measure(staged, keys)
        home = staged.select(*keys, F.col(column).alias("_new_home"))
        home = F.broadcast(home) if fits_broadcast(home, size.rows) else home
        placed = size.within_range(self._open(now).select(*keys, column))
        moved = placed.join(home, keys).filter(~F.col(column).eqNullSafe(F.col("_new_home")))
        if not moved.isEmpty():
            raise MovedKeyError(f"{keys} would change {column}; merge over the whole table instead")

    @staticmethod
    def _wider(now: Mapping, incoming: T.StructType) -> T.StructType:
        """The table's columns and the new ones behind them."""
        present = T.StructType.fromJson(json.loads(now["schema"]))
        kinds = {f.name: f.dataType for f in present.fields}
        clash = [f.name for f in incoming.fields if kinds.get(f.name, f.dataType) != f.dataType]
        if clash:
            raise SchemaMismatchError(f"columns change type: {clash}")
        return T.StructType([*present.fields, *[T.StructField(f.name, f.dataType) for f in incoming.fields if f.name not in kinds]])

    def commit(self, change: Change) -> int:
        """Put the change in place; returns the rows of the table.

        When another version came first, the change is carried onto it as long as
        neither the parts it touches nor its marks have changed.
        """
        base = change.base
        while True:
            parts = dict({} if base is None else base["parts"])
            for part, new in change.parts.items():
                parts.pop(part, None)
                if new is not None:
                    parts[part] = new
            total = sum(p["rows"] for p in parts.values())
            schema = change.schema if base is None else self._wider(base, change.schema)
            line = {
                "version": 0 if base is None else base["version"] + 1, "operation": change.operation, "row_count": total,
                "metrics": dict(change.metrics), "marks": {**({} if base is None else base["marks"]), **change.marks},
                "parting": self._dealt(base).spec(), "schema": schema.json(), "parts": parts, **signature(self.spark),
            }
            try:
                self.versions.put(line["version"], line)
                return total
            except VersionTakenError:
                newer = self._newest()
                if change.base is None or not self._untouched(change, newer):
                    raise ConcurrentChangeError(f"another writer has changed the same parts of {self.root}") from None
                base = newer

    @staticmethod
    def _untouched(change: Change, newer: Mapping) -> bool:
        before = change.base
        return (all(before["parts"].get(p) == newer["parts"].get(p) for p in change.parts)
                and all(before["marks"].get(m) == newer["marks"].get(m) for m in change.marks))

    def retire(self, keep: int) -> int:
        """Delete the folders that none of the newest ``keep`` versions names; returns how many went."""
        if keep < 1:
            raise ValueError("the current version has to stay")
        numbers = self.versions.numbers()
        named = {f for n in numbers[-keep:] for p in self.versions.read(n)["parts"].values() for f in p["folders"]}
        old = {f for n in numbers[:-keep] for p in self.versions.read(n)["parts"].values() for f in p["folders"]}
        return sum(delete_folder(self.spark, f) for f in sorted(old - named))
