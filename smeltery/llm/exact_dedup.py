"""Exact de-duplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so. Each distinct chunk moves once, to
verify that its digest stands for one content; from then on a document is the
ordered list of chunk identifiers, and only those lists are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import free_name, lower_ascii, marked, release, stored, whole_text

MIN_CHUNK = 512
MAX_CHUNK = 4096
#: A chunk ends behind a clause mark and white space, or at its largest size.
CUT = r"(?<=[.,;:!?]\s)"


def chunks(text: Column, smallest: int = MIN_CHUNK, largest: int = MAX_CHUNK) -> Column:
    """Content-defined chunks; joined together they are the text again."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{smallest},{largest}}}?{CUT}|.{{1,{largest}}}"), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunk_dictionary(texts: Column, docs: DataFrame) -> DataFrame:
    """``(identifier, low, high)``: smallest and largest content met under each identifier."""
    parts = docs.select(F.explode(chunks(texts)).alias("chunk"))
    return (parts.groupBy(identifier(F.col("chunk")).alias("identifier"))
            .agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")))


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z. The row with the
    largest key stays. A null text is the empty text; empty texts are equal. A
    null key never wins against another one; in a group of null keys only,
    ``keep_id`` is null and the rows stay. Rows that repeat a kept key with an
    equal text all stay. Other columns are not looked at. Should two contents
    ever share an identifier, the job stops with an error: nothing is merged
    unverified.
    """
    body = lower_ascii(whole_text(text))
    if chunk_dictionary(body, docs).where("low <> high").count():
        raise ValueError("two chunks of different content share an identifier")
    recipes = stored(docs.select(
        F.col(key).alias("doc_id"), F.sha2(body, 256).alias("text_sha256"),
        F.transform(chunks(body), identifier).alias("recipe")), "recipes")
    groups = stored(recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "recipe-groups")
    joined = recipes.join(groups, "recipe", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("doc_id").alias(key), keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Only rows whose key may be one that goes are moved."""
    of, sha, flag = free_name(docs, "_key"), free_name(docs, "_sha"), free_name(docs, "_may_go")
    lost = stored(exact_duplicates(docs, text, key).where("NOT kept")
                  .select(F.col(key).alias(of), F.col("text_sha256").alias(sha)), "exact-copies")
    release(docs)
    body = F.sha2(lower_ascii(whole_text(text)), 256)
    told = marked(docs, docs[key], lost.select(of), flag)
    some = told.where(flag).drop(flag)
    stay = some.join(lost, some[key].eqNullSafe(F.col(of)) & (body == F.col(sha)), "left_anti")
    return told.where(~F.col(flag)).drop(flag).union(stay)
