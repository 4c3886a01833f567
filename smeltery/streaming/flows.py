"""Checkpointed streams that drain what is there and stop.

File names of a finished run are remembered in the checkpoint, so each file
is read once.  Streams start with ``availableNow`` and end by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from smeltery.operators.dedupe import pick_one_per_key
from smeltery.operators.merge import latest_by, upsert
from smeltery.plans.parted import PartedTable
from smeltery.plans.snapshot import Snapshots, write_counted

#: Where a micro-batch finds the id that its checkpoint keeps.
STREAM_ID = "sql.streaming.queryId"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
DISK_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a folder, or over a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    if path[-1].isalnum():
        # As a glob the path may name either a file or a folder.
        path = f"{path[:-1]}[{path[-1]}]"
    return reader.format(fmt).load(path)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Run until everything available is processed; failures of the stream are raised."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batches_run(query: StreamingQuery) -> int:
    """Micro-batches of this run that carried rows."""
    return sum(1 for p in query.recentProgress if p.numInputRows > 0)


def ingest_files(stream: DataFrame, sink_path: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append each source file to the sink exactly once; returns the micro-batches run."""
    rows = transform(stream) if transform else stream
    writer = rows.writeStream.format("parquet").outputMode("append")
    return batches_run(drain(writer.option("path", sink_path).option("checkpointLocation", checkpoint)))


def upsert_stream(stream: DataFrame, sink: Snapshots | PartedTable, checkpoint: str, keys: Sequence[str],
                  sequence: Sequence[str]) -> int:
    """Merge every micro-batch into the sink.

    A batch is reduced to its newest row per key, and an older row never
    replaces a newer one, both in one total order, so the result does not
    depend on file order.  The batch number is published with the data under
    the id its checkpoint gives the stream; a batch published before a crash is
    skipped when that checkpoint replays it.  Other streams into the same sink
    and new checkpoints count their batches anew.

    A :class:`PartedTable` rewrites only the parts a batch touches; a
    :class:`Snapshots` sink is written anew for every batch.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        number = f"batch of {batch.sparkSession.sparkContext.getLocalProperty(STREAM_ID)}"
        done = sink.latest_metric(number)
        if done is not None and done >= batch_id:
            return
        newest = latest_by(batch, keys, sequence)
        if isinstance(sink, PartedTable):
            if sink.exists():
                sink.upsert(newest, keys, newer_by=sequence, marks={number: batch_id})
            else:
                sink.create(newest, "STREAM_MERGE", marks={number: batch_id})
            return
        merged = upsert(sink.read(), newest, keys, newer_by=sequence) if sink.exists() else newest
        sink.publish(merged, "STREAM_MERGE", metrics={number: batch_id})

    writer = stream.writeStream.outputMode("update").foreachBatch(apply)
    return batches_run(drain(writer.option("checkpointLocation", checkpoint)))


def dedupe_stream(stream: DataFrame, sink_path: str, checkpoint: str, keys: Sequence[str], ts_column: str,
                  delay: str, hot_key_splits: int = 16) -> int:
    """First row of each key within ``delay`` of the event time.

    Streams have no map-side combine, so all copies of one key would meet in
    one task.  They are thinned out first in ``hot_key_splits`` groups that
    follow the input splits; what is left per key is one row per group.  With
    1 that stage is left out, for keys known to have few copies.  Keys wait in
    a disk-backed state store until the event-time watermark has passed them.
    """
    spark = stream.sparkSession
    timed = stream.withColumn(ts_column, F.col(ts_column).cast("timestamp")).withWatermark(ts_column, delay)
    if hot_key_splits > 1:
        group = F.pmod(F.spark_partition_id(), F.lit(hot_key_splits))
        timed = timed.withColumn("_group", group).dropDuplicatesWithinWatermark([*keys, "_group"]).drop("_group")
    unique = timed.dropDuplicatesWithinWatermark(list(keys))
    before = spark.conf.get(STATE_STORE_CONF, None)
    spark.conf.set(STATE_STORE_CONF, DISK_STATE_STORE)
    try:
        writer = unique.writeStream.format("parquet").outputMode("append")
        return batches_run(drain(writer.option("path", sink_path).option("checkpointLocation", checkpoint)))
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE_CONF)
        else:
            spark.conf.set(STATE_STORE_CONF, before)


def dedupe_with_late_rows(stream: DataFrame, folder: str, checkpoint: str, keys: Sequence[str], ts_column: str,
                          delay_seconds: int) -> int:
    """First row of each key, rows that come too late in an output of their own.

    A row is late when its time lies more than ``delay_seconds`` before the
    newest time of the micro-batches before it; rows without a time are never
    late.  Keys are remembered until they could only come late, and forgotten
    then; keys without a time are kept.  Kept and late rows are written below a
    folder of the batch, so a batch that is run again replaces itself, and the
    remembered keys, the watermark and the counts are published together.
    Copies of a key within a batch become its earliest row.
    """
    spark = stream.sparkSession
    state = Snapshots(spark, f"{folder}/keys")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if (state.latest_metric("batch") or 0) > batch_id:
            return
        mark = state.latest_metric("watermark")
        time = F.unix_micros(F.col(ts_column).cast("timestamp"))
        late = F.lit(False) if mark is None else F.coalesce(time < mark, F.lit(False))
        first = pick_one_per_key(batch.where(~late), keys, [ts_column])
        if state.exists():
            seen = state.read().select(*[F.col(k).alias(f"_seen_{i}") for i, k in enumerate(keys)])
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_seen_{i}")) for i, k in enumerate(keys)])
            first = first.join(seen, same, "left_anti")
        kept = write_counted(first, f"{folder}/kept/batch={batch_id}", mode="overwrite")
        gone = write_counted(batch.where(late), f"{folder}/late/batch={batch_id}", mode="overwrite")
        total, newest = batch.agg(F.count(F.lit(1)), F.max(time)).first()
        marks = [m for m in (mark, None if newest is None else newest - delay_seconds * 1_000_000) if m is not None]
        new = spark.read.schema(batch.schema).parquet(f"{folder}/kept/batch={batch_id}").select(*keys, ts_column)
        known = state.read().unionByName(new) if state.exists() else new
        if marks:
            known = known.where(F.coalesce(time >= max(marks), F.lit(True)))
        counts = {"batch": batch_id + 1, "kept": kept, "late": gone, "dropped": total - kept - gone}
        state.publish(known, "STREAM_DEDUPE", metrics=counts | ({"watermark": max(marks)} if marks else {}))

    writer = stream.writeStream.outputMode("update").foreachBatch(apply)
    return batches_run(drain(writer.option("checkpointLocation", checkpoint)))
