"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, every run of other characters than letters becomes one
blank, and the n-grams of one to three characters are hashed into a fixed
number of buckets and weighted by TF-IDF. The weights are learned by
follow-the-regularised-leader with elastic-net penalties; a temperature, fitted
on rows the weights have not seen, turns the scores into probabilities.

Document frequencies count all documents that may be learned from; only the
regression itself is fitted on a bounded sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LONGEST = 3
#: Distinct texts per language that the regression is fitted on, at most; every fourth only sets the temperature.
TEXTS_PER_LANGUAGE = 800
HELD_FOR_TEMPERATURE = 4
EPOCHS = 3
#: Learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
#: Characters taken from a text at a time.
PIECE = 1 << 20
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_BLANK = 32
_STEP, _MIX = np.uint32(2654435761), np.uint32(2246822519)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _hashed(codes: np.ndarray, seen: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams that end after the first ``seen`` codes; a lone blank is none."""
    for n in range(1, LONGEST + 1):
        begin = max(0, seen - n + 1)
        count = len(codes) - n + 1 - begin
        if count <= 0:
            continue
        rolled = np.full(count, n, np.uint32)
        for i in range(n):
            rolled = rolled * _STEP + codes[begin + i:begin + i + count]
        buckets = (rolled * _MIX) >> np.uint32(32 - BUCKET_BITS)
        yield buckets[codes[begin:begin + count] != _BLANK] if n == 1 else buckets


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the whole text in ascending order and how often each occurs; none without a letter."""
    counts = np.zeros(BUCKETS, np.int64)
    tail = np.zeros(0, np.uint32)
    if not has_letter(text):
        return np.zeros(0, np.int64), counts[:0]
    pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)] if len(text) > PIECE else [text]
    pieces[0] = " " + pieces[0]
    pieces[-1] += " "
    for piece in pieces:
        codes = np.frombuffer(_OTHER.sub(" ", piece.lower()).encode("utf-32-le"), "<u4").astype(np.uint32)
        if len(tail) and tail[-1] == _BLANK and len(codes) and codes[0] == _BLANK:
            codes = codes[1:]
        whole = np.concatenate([tail, codes])
        counts += np.bincount(np.concatenate([*_hashed(whole, len(tail)), codes[:0]]), minlength=BUCKETS)
        tail = whole[-(LONGEST - 1):]
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class LanguageModel:
    """Languages, idf by bucket, weights by bucket (the last row is the bias) and language, temperature."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(found, counts, self.idf)

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(found, counts) @ self.weights[found] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; ``und`` and 0 without a letter or without any language learned."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        shares = softmax(self.logits(*features(text)) / self.temperature)
        best = int(shares.argmax())
        return self.languages[best], float(min(1.0, shares[best]))


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length."""
    x = (1 + np.log(counts)) * idf[found]
    return x / np.sqrt(x @ x)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], languages: int, *, seed: int = 7) -> np.ndarray:
    """Weights after follow-the-regularised-leader over ``(buckets, tf-idf, language)``."""
    z, n = np.zeros((BUCKETS + 1, languages)), np.zeros((BUCKETS + 1, languages))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            found, x, language = examples[i]
            rows, x = np.append(found, BUCKETS), np.append(x, 1.0)
            zs, ns = z[rows], n[rows]
            w = weights(zs, ns)
            error = softmax(x @ w)
            error[language] -= 1
            slope = x[:, None] * error
            more = ns + slope * slope
            z[rows] = zs + slope - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
            n[rows] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden section on its logarithm.

    The truth is smoothed by one wrong row in two more than there are, so rows
    that are all right do not make the scores certain.
    """
    if not len(logits) or logits.shape[1] < 2:
        return 1.0
    doubt = 1 / (len(truth) + 2)
    target = np.full(logits.shape, doubt / (logits.shape[1] - 1))
    target[np.arange(len(truth)), truth] = 1 - doubt

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return float((target * (np.log(np.exp(scaled).sum(axis=1, keepdims=True)) - scaled)).sum())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with a letter, and documents by bucket, over all rows of ``texts(text)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found, _ = features(text.as_py())
                seen[found] += 1
                seen[BUCKETS] += len(found) > 0
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(seen[found])], ["bucket", "n"])

    counts = np.zeros(BUCKETS + 1, np.int64)
    parts = texts.mapInArrow(count, "bucket int, n bigint")
    # One row per bucket comes back, whatever the number of documents.
    total = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[total["bucket"].to_numpy()] = total["n"].to_numpy()
    return int(counts[-1]), counts[:-1]


def sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` distinct texts of each language, the same on every run.

    Rows are thinned out by the hash of their text before they are grouped, so
    neither a common language nor a group of copies meets in one task whole.
    What is broadcast is one line per language, and the model itself holds a
    weight per bucket for each.
    """
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("draw"))
    sizes = rows.groupBy("lang").count().select(F.col("lang").alias("of"), "count")
    share = F.pmod("draw", F.lit(1 << 30)) / F.lit(1 << 30)
    thin = rows.join(F.broadcast(sizes), F.col("lang") == F.col("of")).where(share < 2 * per_language / F.col("count"))
    distinct = thin.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1 << 30)), "draw"))
    return distinct.withColumn("place", place).where(F.col("place") <= per_language)


def fit(docs: DataFrame, learn: Column | None = None, *, per_language: int = TEXTS_PER_LANGUAGE) -> LanguageModel:
    """Learn from ``docs(text, lang)``, rows for which ``learn`` holds and ``lang`` is set.

    Without such rows, or without a letter in them, the model knows no language.
    """
    labelled = docs.select("text", "lang", (F.lit(True) if learn is None else learn).alias("_learn"))
    labelled = labelled.where(F.col("_learn") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    documents, frequencies = document_frequencies(labelled.select("text"))
    idf = np.log((1 + documents) / (1 + frequencies)) + 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([m[0].astype(np.int32) for m in made], pa.list_(pa.int32())),
                 pa.array([m[1] for m in made], pa.list_(pa.int64()))], ["lang", "place", "buckets", "counts"])

    drawn = sample(labelled, per_language).select("lang", "text", "place")
    lines = [r for r in drawn.mapInArrow(spread, "lang string, place int, buckets array<int>, counts array<bigint>").toArrow()
             .sort_by([("lang", "ascending"), ("place", "ascending")]).to_batches()]
    rows = [(lang.as_py(), place.as_py(), b.values.to_numpy().astype(np.int64), c.values.to_numpy())
            for batch in lines for lang, place, b, c in zip(*batch.columns, strict=True)]
    rows = [r for r in rows if len(r[2])]
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return LanguageModel((), idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    known = [(found, weighted(found, counts, idf), languages.index(lang), place) for lang, place, found, counts in rows]
    learned = [k[:3] for k in known if k[3] % HELD_FOR_TEMPERATURE]
    weights = train(learned or [k[:3] for k in known], len(languages))
    unseen = [k for k in known if not k[3] % HELD_FOR_TEMPERATURE]
    logits = np.array([x @ weights[found] + weights[-1] for found, x, _, _ in unseen])
    truth = np.array([k[2] for k in unseen], dtype=np.int64)
    return LanguageModel(languages, idf, weights, fit_temperature(logits, truth))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of columns of these names.

    Null texts, empty ones and those without a letter are ``und`` with score 0.
    Only texts go to Python; all other columns, nulls and repeated rows included, stay as they are.
    """
    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            yield pd.DataFrame([model.predict(t) for t in series], columns=["lang_pred", "score"])

    inner = "_judged"
    while inner in docs.columns:
        inner += "_"
    judged = docs.withColumn(inner, judge(F.col(text)))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return judged.select(*rest, F.col(f"{inner}.lang_pred").alias("lang_pred"), F.col(f"{inner}.score").alias("score"))
