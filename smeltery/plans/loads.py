"""Full and incremental loads.

Data is written first and the mark moves afterwards.  A run that dies in
between is repeated over the same window, and rows it already delivered are
recognised by key and cursor.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from smeltery.functions.columns import with_audit
from smeltery.operators import filters
from smeltery.operators.layout import gather_by_key
from smeltery.operators.merge import latest_by
from smeltery.plans.parted import ByValue, Mark, MovedKeyError, PartedTable
from smeltery.plans.snapshot import Snapshots, path_exists, read_if_exists, write_counted
from smeltery.plans.state import SequenceWatermark, TimestampWatermark

Transform = Callable[[DataFrame], DataFrame]
Store = TimestampWatermark | SequenceWatermark


@dataclass(frozen=True)
class LoadResult:
    rows: int
    mark: filters.Cursor | None


def events_transform(strategy: str) -> Transform:
    """Typed events without rows that lack a type, stamped with the load strategy."""
    def apply(df: DataFrame) -> DataFrame:
        typed = df.filter(F.col("event_type").isNotNull()).withColumn("amount_usd", F.col("amount").cast("double"))
        return with_audit(typed.drop("amount"), {"load_strategy": strategy}, loaded_at="load_ts")

    return apply


def orders_transform(strategy: str) -> Transform:
    def apply(df: DataFrame) -> DataFrame:
        typed = df.withColumn("order_amount_usd", F.col("order_amount").cast("double"))
        return with_audit(typed, {"wm_strategy": strategy}, loaded_at="load_ts")

    return apply


def full_load(source: DataFrame, sink: Snapshots, transform: Transform, *, schema: str = "union",
              partition_by: Sequence[str] = ()) -> LoadResult:
    """Everything, every run."""
    rows = sink.publish(transform(source), "FULL_OVERWRITE", schema=schema, partition_by=partition_by)
    return LoadResult(rows, None)


def read_sink(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What an incremental load has delivered to ``path``, a table in parts or a plain folder."""
    table = PartedTable(spark, path)
    if table.exists():
        return table.read()
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def incremental_load(source: DataFrame, sink: str | PartedTable, store: Store, cursor: str, transform: Transform, *,
                     keys: Sequence[str], partition_column: str | None = None,
                     upto: filters.Cursor | None = None, fixed_partition: bool = False,
                     partition_is_cursor_date: bool = False) -> LoadResult:
    """Deliver the rows past the mark, then move the mark.

    ``partition_is_cursor_date`` states that the partition column holds the date
    of the cursor; only then does the mark bound the folders that are read.

    The upper end of the window is fixed before anything is written, so the
    rows counted, written and remembered are the same rows even while the
    source grows.  Without lookback the window is new and is appended to a plain
    folder.  With lookback it overlaps what was delivered before and is upserted
    by key into a :class:`PartedTable` with a part per partition value, so the
    sink holds one row per key and readers see a run as a whole or not at all.
    :func:`read_sink` reads either.
    """
    spark = source.sparkSession
    previous = store.raw()
    first_run = previous is None
    after = store.start_after(previous)
    window = filters.between_cursors(source, cursor, after, upto)
    if partition_is_cursor_date and partition_column in source.columns:
        window = filters.since_partition(window, partition_column, after)
    high = filters.highest_cursor(window, cursor)
    if high is None and not first_run:
        return LoadResult(0, previous)
    if first_run:
        # Rows without a cursor value are past no mark; only the first run can take them.
        taken = F.col(cursor).isNull()
        if high is not None:
            taken = taken | (F.col(cursor) <= filters.cursor_literal(source, cursor, high))
        batch = transform(source.filter(taken))
    else:
        batch = transform(filters.between_cursors(window, cursor, None, high))
    if store.lookback_seconds > 0:
        # Upserts need one row per key; copies within the window become the newest one.
        batch = latest_by(batch, keys, [cursor])
    if store.lookback_seconds > 0:
        rows = upsert_partitions(sink_table(spark, sink, partition_column, fixed_partition), batch, keys)
    else:
        rows = append_new(spark, sink, batch, keys, cursor, after, partition_column, partition_is_cursor_date)
    mark = high if previous is None else max(previous, high)
    if mark is not None:
        store.save(mark)
    return LoadResult(rows, mark)


def sink_table(spark: SparkSession, sink: str | PartedTable, partition_column: str | None,
               fixed_partition: bool = False) -> PartedTable:
    """The table in parts that an upserting load keeps."""
    if isinstance(sink, PartedTable):
        return sink
    if partition_column is None:
        raise ValueError("a lookback window needs a partition column to upsert into")
    table = PartedTable(spark, sink, ByValue(partition_column, fixed=fixed_partition))
    if path_exists(spark, sink) and not path_exists(spark, f"{sink}/data") and not table.exists():
        raise ValueError(f"{sink} holds plain files; read them into a new PartedTable before loading with a lookback")
    return table


def append_new(spark: SparkSession, sink: str | PartedTable, batch: DataFrame, keys: Sequence[str], cursor: str,
               after: filters.Cursor | None, partition_column: str | None = None,
               partition_is_cursor_date: bool = False) -> int:
    """Append a batch once.

    Rows past the mark that are already in the sink come from a run that died
    before it could move the mark. They are left out by key and cursor, so a
    version of a key that came since is delivered.
    """
    if isinstance(sink, PartedTable):
        delivered = sink.read() if sink.exists() else None
    else:
        delivered = read_if_exists(spark, sink, batch.schema)
    if delivered is not None:
        early = filters.between_cursors(delivered, cursor, after, None)
        if partition_is_cursor_date and partition_column:
            early = filters.since_partition(early, partition_column, after)
        if not early.isEmpty():
            seen = early.select(*[F.col(c).alias(f"_seen_{i}") for i, c in enumerate((*keys, cursor))]).distinct()
            same = [batch[c].eqNullSafe(seen[f"_seen_{i}"]) for i, c in enumerate((*keys, cursor))]
            batch = batch.join(seen, reduce(and_, same), "left_anti")
    if isinstance(sink, PartedTable):
        return sink.append(batch)
    if partition_column:
        return write_counted(gather_by_key(batch, partition_column), sink, mode="append",
                             partition_by=[partition_column])
    return write_counted(batch, sink, mode="append")


def upsert_partitions(table: PartedTable, batch: DataFrame, keys: Sequence[str]) -> int:
    """Upsert a batch, rewrite only the parts it touches and switch readers over in one step.

    The partition must follow from the key.  A batch that would move a key to
    another partition is refused: it needs a merge over the whole table.
    """
    if not table.exists():
        return table.create(batch, "UPSERT")
    return table.upsert(batch, keys)["rows"]


def mark_text(value: filters.Cursor) -> Mark:
    return value.isoformat() if isinstance(value, dt.datetime) else value


def mark_value(mark: Mark | None) -> filters.Cursor | None:
    return dt.datetime.fromisoformat(mark) if isinstance(mark, str) else mark


def incremental_merge(source: DataFrame, table: PartedTable, cursor: str, transform: Transform, *, keys: Sequence[str],
                      name: str, lookback_seconds: int = 0, upto: filters.Cursor | None = None) -> LoadResult:
    """Merge the rows past the mark into a table whose version holds the mark itself.

    Rows and mark become visible in one step, so a run that dies anywhere is
    simply run again: it starts from the mark that belongs to the rows that are
    there.  Copies of a key become the newest one by the cursor, and an older row
    never replaces a newer one.
    """
    previous = mark_value(table.mark(name))
    after = previous - dt.timedelta(seconds=lookback_seconds) if isinstance(previous, dt.datetime) else previous
    window = filters.between_cursors(source, cursor, after, upto)
    high = filters.highest_cursor(window, cursor)
    if previous is None:
        # Rows without a cursor value are past no mark; only the first run can take them.
        taken = F.col(cursor).isNull()
        if high is not None:
            taken = taken | (F.col(cursor) <= filters.cursor_literal(source, cursor, high))
        window = source.filter(taken)
    elif high is None:
        return LoadResult(0, previous)
    else:
        window = filters.between_cursors(window, cursor, None, high)
    batch = latest_by(transform(window), keys, [cursor])
    mark = high if previous is None else max(previous, high)
    marks = {} if mark is None else {name: mark_text(mark)}
    if not table.exists():
        return LoadResult(table.create(batch, "MERGE", marks=marks), mark)
    return LoadResult(table.upsert(batch, keys, newer_by=[cursor], marks=marks)["rows"], mark)


def lookback_overlap(source: DataFrame, cursor: str, lookbacks: Sequence[int]) -> DataFrame:
    """Rows every run would append again for each lookback, with no new data at all."""
    high = filters.highest_cursor(source, cursor)
    if high is None:
        return source.sparkSession.createDataFrame([], "lookback_seconds int, repeated_rows bigint")
    top = filters.cursor_literal(source, cursor, high)

    def start(seconds: int) -> Column:
        return top - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))

    recent = source.filter(F.col(cursor) > start(max(lookbacks)))
    lines = [
        F.struct(F.lit(s).alias("lookback_seconds"), F.count_if(F.col(cursor) > start(s)).alias("repeated_rows"))
        for s in lookbacks
    ]
    return recent.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def run_size(source: DataFrame, cursor: str, after: filters.Cursor) -> DataFrame:
    """Rows past the mark against all rows: what an incremental run saves."""
    counted = source.agg(
        F.count(F.lit(1)).alias("full_rows"),
        F.count_if(F.col(cursor) > filters.cursor_literal(source, cursor, after)).alias("incremental_rows"),
    )
    share = (1 - F.col("incremental_rows") / F.col("full_rows")).cast(T.DoubleType())
    return counted.withColumn("saved_share", F.when(F.col("full_rows") > 0, share))
