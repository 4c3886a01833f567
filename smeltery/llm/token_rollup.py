"""Token counts kept as additive totals under inserts, deletes and revisions.

A batch of changes becomes signed rows (what it takes away, what it adds), and
its totals by source, language and tokenizer version. A batch counts from the
moment its commit row is written, which is last; a repeated batch is a no-op,
and one that broke off before its commit row overwrites its own folders.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.llm.common import stored

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how byte-level BPE vocabularies of this family cut a text before merging.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEY = ("doc_id", "tokenizer")
GROUP = ("source", "lang", "tokenizer")
SIGNED = "doc_id long, tokenizer string, source string, lang string, docs long, tokens long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


@lru_cache(maxsize=8)
def _encoding(folder: str, tokenizer: str):
    import tiktoken

    with open(f"{folder}/{tokenizer}.tiktoken", "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(tokenizer, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, tokenizer: str, folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` without ``text``, with ``tokenizer`` and ``tokens``: the tokens of the whole text, null as empty.

    Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("text", "tokenizer", "tokens")]

    # an Arrow batch is walked text by text, so that no task holds thousands of texts as Python strings
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoding(folder, tokenizer).encode_ordinary
        for batch in batches:
            yield pa.array([len(encode(t)) if (t := text.as_py()) else 0 for text in batch], pa.int64())

    return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(tokenizer).alias("tokenizer"), count(F.col("text")).alias("tokens"))


class TokenRollup:
    """Totals below ``root``, a folder all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            rows = self.spark.read.option("basePath", f"{self.root}/{part}").schema(f"{schema}, batch string").parquet(
                f"{self.root}/{part}")
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], f"{schema}, batch string")
        return rows

    def committed(self) -> DataFrame:
        return self._read("commits", "done boolean").select("batch").distinct()

    def _live(self, part: str, schema: str) -> DataFrame:
        return self._read(part, schema).join(self.committed(), "batch", "left_semi")

    def documents(self) -> DataFrame:
        """``(doc_id, tokenizer, source, lang, tokens)`` of what the committed batches leave."""
        return (self._live("signed", SIGNED).groupBy("doc_id", "tokenizer", "source", "lang")
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs > 0").drop("docs"))

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)``; adds up the totals of the batches, not the documents."""
        return (self._live("totals", TOTALS).groupBy(*GROUP)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit ``changes(doc_id, tokenizer, op, source, lang, tokens[, seq])`` as ``batch``; False if it was there.

        ``op`` is insert, delete or revise. Insert and revise both set the count
        of (doc_id, tokenizer), whatever it was; delete takes it away and does
        nothing where there is none. Of several changes of one key in a batch
        the one with the largest ``seq`` counts (without ``seq`` the largest
        row: op, then count). Rows without doc_id or tokenizer are ignored; a
        null count is 0; null sources and languages are groups of their own. An
        empty batch is committed as well. Other columns are ignored.
        """
        if self.committed().where(F.col("batch") == batch).count():
            return False
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        value = F.struct(seq.alias("seq"), "op", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), "source", "lang")
        # written once: both sides below read it, and the counts come from whole texts
        last = stored(changes.where("doc_id IS NOT NULL AND tokenizer IS NOT NULL")
                      .groupBy(F.col("doc_id").cast("long").alias("doc_id"), "tokenizer").agg(F.max(value).alias("v"))
                      .select("doc_id", "tokenizer", "v.*"), "token-changes")
        gone = self.documents().join(last.select(*KEY), list(KEY), "left_semi").select(
            "doc_id", "tokenizer", "source", "lang", F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))
        come = last.where("op IN ('insert', 'revise')").select(
            "doc_id", "tokenizer", "source", "lang", F.lit(1).cast("long").alias("docs"), "tokens")
        signed = f"{self.root}/signed/batch={batch}"
        gone.unionByName(come).write.mode("overwrite").parquet(signed)
        (self.spark.read.schema(SIGNED).parquet(signed).groupBy(*GROUP)
         .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(f"{self.root}/totals/batch={batch}"))
        self.spark.range(1).selectExpr("true AS done").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/commits/batch={batch}")
        return True


def corpus_changes(spark: SparkSession, docs: DataFrame, rollup: TokenRollup, folder: str = TOKENIZERS) -> DataFrame:
    """Run the life of a corpus through ``rollup`` and return its totals.

    First every document is inserted, then all but the smallest doc_id of equal
    texts are deleted, then the documents that are left and not English move to
    a vocabulary for many languages; each batch is sent twice. Documents without
    a language stay where they are. Texts are counted where they are read and
    only the counts are moved.
    """
    one, many = "byte_bpe_50k", "byte_bpe_multi_50k"
    rollup.apply("load", counted(docs.select("doc_id", "source", "lang", "text"), one, folder).withColumn("op", F.lit("insert")))
    copies = (docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content")))
    first = copies.groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    lost = copies.join(first, "content").where("doc_id <> first").select(
        "doc_id", F.lit(one).alias("tokenizer"), F.lit("delete").alias("op"), "source", "lang", F.lit(0).alias("tokens"))
    for _ in range(2):
        rollup.apply("copies", lost)
    foreign = docs.where("lang <> 'en'").select("doc_id", "source", "lang", "text")
    here = rollup.documents().select("doc_id").distinct()
    moved = stored(counted(foreign, many, folder).withColumn("op", F.lit("revise")), "token-moves").join(here, "doc_id", "left_semi")
    left = moved.select("doc_id", F.lit(one).alias("tokenizer"), F.lit("delete").alias("op"), "source", "lang",
                        F.lit(0).cast("long").alias("tokens"))
    for _ in range(2):
        rollup.apply("languages", moved.unionByName(left))
    return rollup.totals()
