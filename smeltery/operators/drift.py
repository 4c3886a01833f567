"""Schema drift: detect it, report it, repair a frame for it."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from smeltery.functions.columns import quoted

NEW, DROPPED, CHANGED = "new", "dropped", "type_changed"

# Types that are stored one size up.
WIDENED = {T.ByteType(): T.IntegerType(), T.ShortType(): T.IntegerType(), T.FloatType(): T.DoubleType()}


def widened(dtype: T.DataType) -> T.DataType:
    return WIDENED.get(dtype, dtype)


def widen_types(df: DataFrame) -> DataFrame:
    """The frame with small number types as they are stored."""
    return df.select(*[F.col(quoted(f.name)).cast(widened(f.dataType)).alias(f.name) if f.dataType in WIDENED
                       else F.col(quoted(f.name)) for f in df.schema.fields])


def schema_types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def schema_fingerprint(schema: T.StructType) -> str:
    """Content hash of a schema; the same columns and types give the same stamp everywhere."""
    text = ",".join(f"{name}:{kind}" for name, kind in schema_types(schema).items())
    return hashlib.sha256(text.encode()).hexdigest()[:12]


@dataclass(frozen=True)
class Drift:
    table: str
    saved: T.StructType
    incoming: T.StructType

    def _names(self) -> tuple[set[str], set[str]]:
        return set(self.saved.names), set(self.incoming.names)

    @property
    def new_columns(self) -> dict[str, T.DataType]:
        saved, _ = self._names()
        return {f.name: f.dataType for f in self.incoming.fields if f.name not in saved}

    @property
    def dropped_columns(self) -> dict[str, T.DataType]:
        _, incoming = self._names()
        return {f.name: f.dataType for f in self.saved.fields if f.name not in incoming}

    @property
    def type_changes(self) -> dict[str, tuple[T.DataType, T.DataType]]:
        now = {f.name: f.dataType for f in self.incoming.fields}
        return {
            f.name: (f.dataType, now[f.name])
            for f in self.saved.fields
            if f.name in now and now[f.name] != f.dataType
        }

    @property
    def has_drift(self) -> bool:
        return bool(self.new_columns or self.dropped_columns or self.type_changes)

    def entries(self) -> list[tuple[str, str, str | None, str | None]]:
        """(column, kind, from_type, to_type) of every difference."""
        found = [(c, NEW, None, t.simpleString()) for c, t in self.new_columns.items()]
        found += [(c, DROPPED, t.simpleString(), None) for c, t in self.dropped_columns.items()]
        found += [(c, CHANGED, a.simpleString(), b.simpleString()) for c, (a, b) in self.type_changes.items()]
        return found

    def to_json(self) -> str:
        return json.dumps({
            "table": self.table,
            "saved": self.saved.jsonValue(),
            "incoming": self.incoming.jsonValue(),
        })

    @staticmethod
    def from_json(text: str) -> Drift:
        raw = json.loads(text)
        return Drift(raw["table"], T.StructType.fromJson(raw["saved"]), T.StructType.fromJson(raw["incoming"]))


def detect_drift(table: str, saved: T.StructType | None, df: DataFrame) -> Drift:
    """Differences between the saved schema and the frame; without a saved schema all columns are new."""
    return Drift(table, saved or T.StructType(), df.schema)


def apply_drift(df: DataFrame, drift: Drift, *, keep_saved_types: bool = False,
                stamp: bool = True) -> DataFrame:
    """The frame with its drift repaired, in one projection.

    New columns stay, dropped ones come back as typed nulls.  Changed columns
    take the incoming type; with ``keep_saved_types`` they are cast back to
    the saved type and values that do not fit become null.
    """
    targets: dict[str, T.DataType] = {c: widened(t) for c, t in drift.new_columns.items()}
    for name, (before, now) in drift.type_changes.items():
        targets[name] = before if keep_saved_types else widened(now)
    present = {c.lower() for c in df.columns}
    out = [
        F.col(quoted(c)).try_cast(targets[c]).alias(c) if c in targets else F.col(quoted(c))
        for c in df.columns
    ]
    absent = {**drift.new_columns, **drift.dropped_columns}
    out += [F.lit(None).cast(widened(t)).alias(c) for c, t in absent.items() if c.lower() not in present]
    if stamp:
        out.append(F.lit(f"{drift.table}_v{schema_fingerprint(drift.incoming)}").alias("_schema_version"))
        out.append(F.current_timestamp().alias("_processed_at"))
    return df.select(*out)


def repair_if_drifted(df: DataFrame, drift: Drift, **options: bool) -> DataFrame:
    return apply_drift(df, drift, **options) if drift.has_drift else df


def _rows(df: DataFrame, structs: list[Column], schema: str) -> DataFrame:
    """One aggregate over ``df`` turned into one row per struct."""
    if not structs:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def schema_rows(df: DataFrame) -> DataFrame:
    """Position, name, type and filled values of every column."""
    structs = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.count(quoted(f.name)).alias("filled"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return _rows(df, structs, "position int, column_name string, data_type string, filled bigint")


def drift_report(df: DataFrame, drift: Drift) -> DataFrame:
    """Every difference with the values it touches.

    ``lost_values`` counts incoming values that would not survive a cast back
    to the saved type.
    """
    text = "string"
    structs = []
    for column, kind, before, now in drift.entries():
        filled, lost = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        if kind != DROPPED:
            filled = F.count(quoted(column))
        if kind == CHANGED:
            lost = F.count_if(F.col(quoted(column)).isNotNull() & F.col(quoted(column)).try_cast(before).isNull())
        structs.append(F.struct(
            F.lit(drift.table).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(kind).alias("kind"), F.lit(before).cast(text).alias("from_type"),
            F.lit(now).cast(text).alias("to_type"), filled.alias("filled"), lost.alias("lost_values"),
        ))
    return _rows(df, structs, "table_name string, column_name string, kind string, from_type string, "
                              "to_type string, filled bigint, lost_values bigint")


def columns_only_in(new: DataFrame, old: DataFrame) -> list[str]:
    return sorted(set(new.columns) - set(old.columns))
