"""Helpers the text operators share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smeltery.plans.snapshot import delete_folder
from smeltery.workspace import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of texts in one Arrow batch.
BATCH_ROWS = 1000
#: Places of the bitmap by which rows are chosen before they move; it is at most an eighth as many bytes, however many keys are wanted.
PLACES = 1 << 25


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def whole_text(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder behind a frame that ``stored`` returned, once all that was made from it is stored too."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def release(df: DataFrame) -> None:
    """Let go of the shuffle files of finished steps.

    Spark deletes them once the driver has collected the plans that made them,
    which on a driver with room to spare can take until the job is over.
    """
    for again in (False, True):  # the events of the step that has just ended hold its plan until they are handled
        if again:
            time.sleep(0.5)
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()


def marked(rows: DataFrame, key: Column, wanted: DataFrame, flag: str) -> DataFrame:
    """``rows`` and whether their ``key`` may be in the one column of ``wanted``: true for all that are and a few others.

    Keys are looked up by hash in a bitmap of bounded size, so no row moves. An
    exact join of the rows with the flag has to follow; null is a key.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES))
    block, bits = free_name(rows, "_block"), free_name(rows, "_bits")
    sought = wanted.select(place(F.col(wanted.columns[0])).alias("place"))
    maps = sought.groupBy(F.bitmap_bucket_number("place").alias(block)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(bits))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    keyed = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place(key)) == F.col(block), "left")
    return keyed.select(*[rows[c] for c in rows.columns], F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(flag))


def small_batches(df: DataFrame) -> None:
    """Hand texts to Python at most ``BATCH_ROWS`` rows at a time, in this session from now on.

    Spark's default of 10,000 whole texts is held by the executor and by the
    Python worker of every running task. A smaller setting of the caller stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(id, label)`` for every id in ``links(a, b)``: the smallest id it reaches.

    Labels spread along the links and jump to the label of their label, so a
    chain shortens each round. Labels are a stored table in every join, so a
    vertex with very many links is a skewed join side that Spark can split.
    Rows with a null end are ignored.
    """
    pairs = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), f"{label}-links")
    labels = stored(both.groupBy(F.col("a").alias("id"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), label)
    while True:
        heard = (both.join(labels.withColumnRenamed("id", "a"), "a")
                 .groupBy(F.col("b").alias("id")).agg(F.min("label").alias("heard")))
        lower = labels.join(heard, "id").select("id", F.col("label").alias("was"),
                                                F.least("label", "heard").alias("via"))
        jumped = labels.select(F.col("id").alias("via"), F.col("label").alias("beyond"))
        after = stored(lower.join(jumped, "via").select(
            "id", "was", F.least("via", "beyond").alias("label")), label)
        labels = after.select("id", "label")
        if after.where("label <> was").isEmpty():
            return labels
