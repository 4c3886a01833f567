"""Language identification: held-out accuracy, and the rows that have no language."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

from smeltery.llm import language_id, queries as Q


def plain_features(text):
    """Buckets of the n-grams, character by character."""
    text = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
    counts = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            gram = text[i:i + n]
            if gram == " ":
                continue
            h = n
            for c in gram:
                h = (h * 2654435761 + ord(c)) % 2**32
            counts[(h * 2246822519) % 2**32 >> 16] += 1
    return dict(counts)


def test_features_count_whole_texts(monkeypatch):
    texts = ["That it.", "É", "a", "über  9 Straße!!", "x" * 50 + "  y " * 30, "the last words, and THE end"]
    for piece in (1 << 20, 7, 1):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for text in texts:
            assert dict(zip(*map(np.ndarray.tolist, language_id.features(text)))) == plain_features(text)
    for nothing in (None, "", " \t", "123 ++", "²"):
        assert len(language_id.features(nothing)[0]) == 0


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    got = Q.op12_language_id(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("d"), "lang", "text")
    rows = got.join(truth, F.col("doc_id") == F.col("d")).where("held_out").collect()
    assert len(rows) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)


def test_held_out_rows_teach_nothing(spark, tmp_path):
    docs = spark.createDataFrame(
        [(i, "the cat and the dog", "en") for i in range(40)] + [(i, "el gato y el perro", "es") for i in range(40, 80)],
        "doc_id bigint, text string, lang string")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    swapped = docs.withColumn("lang", F.when(fold == 2, "xx").otherwise(F.col("lang")))
    for name, df in (("a", docs), ("b", swapped)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    a, b = (sorted(map(tuple, Q.op12_language_id(spark, f"{tmp_path}/{n}").collect())) for n in "ab")
    assert a == b and {r[2] for r in a} == {"en", "es"}


def test_odd_rows(spark):
    learn = spark.createDataFrame([("the cat and dog", "en"), ("el gato y perro", "es"), (None, "fr"), ("123", "de"), ("x y", None)],
                                  "text string, lang string")
    model = language_id.fit(learn)
    assert model.languages == ("en", "es")
    odd = spark.createDataFrame(
        [(9007199254740993, None, 1), (None, "", 2), (3, " 12 ", 3), (3, "the cat", None), (3, "the cat", None), (4, "gato " * 300_000, 5)],
        "doc_id bigint, text string, score int")
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language_id.predict(odd, model).collect()), key=str)
    assert got == sorted([(9007199254740993, "und", False), (None, "und", False), (3, "und", False), (3, "en", True),
                          (3, "en", True), (4, "es", True)], key=str)
    assert language_id.predict(odd.limit(0), model).count() == 0
    nothing = language_id.fit(learn.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_sample_is_bounded_and_the_same_every_time(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 == 0, "es").otherwise("en").alias("lang"),
                                    F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    drawn = [sorted(map(tuple, language_id.sample(df, 40).collect())) for df in (rows, rows.repartition(7))]
    assert drawn[0] == drawn[1]
    sizes = collections.Counter(r[0] for r in drawn[0])
    assert sizes["en"] <= 40 and 20 <= sizes["es"] <= 40 and len({(r[0], r[2]) for r in drawn[0]}) == len(drawn[0])


def test_temperature_follows_the_errors():
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 3, 600)
    logits = rng.normal(0, 0.3, (600, 3))
    logits[np.arange(600), np.where(rng.random(600) < 0.8, truth, (truth + 1) % 3)] += 9
    shares = language_id.softmax(logits / language_id.fit_temperature(logits, truth)).max(1)
    assert abs(shares.mean() - 0.8) < 0.06
