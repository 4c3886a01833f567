"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Every term of the examples spans the space, weighted by its idf and by how far it
tells the labels apart. The index keeps, for each term, its weight in the
examples that hold it and the largest weight of each block of examples; a query
visits blocks in the order of their bound and stops when no block can hold a
nearer example. Neighbours vote by closeness and the votes are calibrated on the
examples themselves, each left out in turn.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import small_batches

#: Bound of the fit: at most so many labelled examples of each label, the first in a seeded order.
EXAMPLES = 2000
NEIGHBOURS = 15
BLOCK = 64
#: Blocks looked at together.
ROUND = 16
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")


def _letters() -> bytes:
    """Latin-1 characters in lower case, all that are no letters as blanks."""
    return b"".join(chr(i).lower().encode("latin-1") if _WORD.fullmatch(chr(i)) else b" " for i in range(256))


_LETTERS = _letters()


def words_of(text: str | None) -> list[str]:
    """The runs of ``_WORD`` in the lower-case text; most texts are Latin-1 and need no pattern for that."""
    try:
        return (text or "").encode("latin-1").translate(_LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text.lower())


def term_counts(text: str | None, wanted: frozenset | None = None) -> dict[str, int]:
    """Lower-case letter runs of the whole text; only ``wanted`` ones if given."""
    words = Counter(words_of(text))
    return words if wanted is None else {t: n for t, n in words.items() if t in wanted}


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, end), one range after the other."""
    long = ends - starts
    return np.repeat(starts - np.cumsum(long) + long, long) + np.arange(long.sum())


@dataclass
class Postings:
    """Weights sorted by term and place; an entry stands for the places of one term in one block."""

    first: np.ndarray  # entry of each term, and the end
    block: np.ndarray  # of the entry
    top: np.ndarray  # largest weight of the entry
    start: np.ndarray  # of the entry among the weights, and the end
    spot: np.ndarray  # place of the weight
    weight: np.ndarray
    blocks: int

    @classmethod
    def build(cls, terms: int, blocks: int, rows: list[tuple[np.ndarray, np.ndarray]]) -> Postings:
        term = np.concatenate([np.zeros(0, np.int64), *(at for at, _ in rows)])
        spot = np.repeat(np.arange(len(rows), dtype=np.int32), [len(at) for at, _ in rows])
        weight = np.concatenate([np.zeros(0), *(w for _, w in rows)])
        order = np.argsort(term, kind="stable")  # the places of a term rise already
        term, spot, weight = term[order], spot[order], weight[order]
        del order
        entry = term * blocks + spot // BLOCK
        start = np.flatnonzero(np.diff(entry, prepend=-1))
        top = np.maximum.reduceat(weight, start) if len(start) else np.zeros(0)
        first = np.searchsorted(term[start], np.arange(terms + 1))
        return cls(first, spot[start] // BLOCK, top, np.append(start, len(term)), spot, weight, blocks)

    def __getitem__(self, at) -> np.ndarray:
        """Dense weights by term, block and example in the block."""
        out = np.zeros((len(at), self.blocks * BLOCK))
        for row, t in zip(out, at, strict=True):
            here = slice(self.start[self.first[t]], self.start[self.first[t + 1]])
            row[self.spot[here]] = self.weight[here]
        return out.reshape(len(at), self.blocks, BLOCK)


@dataclass
class Index:
    """Unit vectors of the examples as postings, with the maxima of the blocks."""

    place: dict[str, int]
    idf: np.ndarray  # times the weight of the term
    ids: np.ndarray
    labels: np.ndarray
    tiles: Postings
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))
    empty: float = 0.0

    @classmethod
    def build(cls, terms: list[str], idf: np.ndarray, examples: Iterable[tuple[int, int, dict[str, int]]]) -> Index:
        place = {t: i for i, t in enumerate(terms)}
        index = cls(place, idf, np.zeros(0), np.zeros(0), None)
        rows = [(i, y, *index.vector(c), max(c, key=lambda t: (c[t], t), default="")) for i, y, c in examples]
        rows = [r for r in rows if len(r[2])]
        rows.sort(key=lambda r: (r[4], r[1], r[0]))  # the word used most: examples of a language share blocks
        blocks = max(1, -(-len(rows) // BLOCK))
        index.tiles = Postings.build(len(terms), blocks, [r[2:4] for r in rows])
        index.ids, index.labels = np.full(blocks * BLOCK, -1, np.int64), np.zeros(blocks * BLOCK)
        index.ids[:len(rows)], index.labels[:len(rows)] = [r[0] for r in rows], [r[1] for r in rows]
        return index

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        known = [self.place.get(t, -1) for t in counts]
        at, times = np.array(known, np.int64), np.fromiter(counts.values(), np.float64, len(counts))
        order = np.argsort(at)[known.count(-1):]
        at = at[order]
        if not len(at):
            return at, np.zeros(0)
        weight = (1 + np.log(times[order])) * self.idf[at]
        return at, weight / np.linalg.norm(weight)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, exactly; ties go to the smaller place."""
        index, near, close = self.tiles, np.zeros(0, np.int64), np.zeros(0)
        entry = _runs(index.first[at], index.first[at + 1])
        mine = np.repeat(weight, index.first[at + 1] - index.first[at])
        block = index.block[entry]
        bound = np.bincount(block, mine * index.top[entry], index.blocks)
        order = np.argsort(-bound, kind="stable")
        for first in range(0, index.blocks, ROUND):
            if bound[order[first]] <= 0 or len(close) == k and bound[order[first]] < close[-1] - 1e-12:
                break
            some = np.zeros(index.blocks, bool)
            some[order[first:first + ROUND]] = True
            used = some[block]
            start, end = index.start[entry[used]], index.start[entry[used] + 1]
            post = _runs(start, end)
            cosine = np.bincount(index.spot[post], index.weight[post] * np.repeat(mine[used], end - start), len(self.ids))
            least = close[-1] - 1e-11 if len(close) == k else 0
            here = np.flatnonzero((cosine > 0) & (cosine >= least))
            here = here[self.ids[here] != skip] if skip is not None else here
            near, close = np.concatenate([near, here]), np.concatenate([close, cosine[here]])
            best = np.lexsort((near, -np.round(close, 12)))[:k]
            near, close = near[best], close[best]
        return near, close

    def vote(self, at, weight, skip=None) -> tuple[float, np.ndarray]:
        near, close = self.nearest(at, weight, NEIGHBOURS, skip)
        if not len(near):
            return -1.0, near
        pull = 1.0 / (1.0 - np.minimum(close, 1.0) + 0.05)
        return float(pull @ self.labels[near] / pull.sum()), near

    def score(self, vote: float) -> float:
        """Calibrated: the step of the monotone fit that the vote falls on."""
        if vote < 0 or not len(self.steps[0]):
            return self.empty
        return float(np.interp(vote, *self.steps))


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least-squares rising fit, pooled from neighbours that fall."""
    pools: list[list[float]] = []
    for a, b, c in sorted(zip(x.tolist(), y.tolist(), w.tolist(), strict=True)):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _counted(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per example its terms, with one space between, and how often it holds each."""
    for batch in rows:
        found = [term_counts(text) for text in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [" ".join(c) for c in found],
                            "times": [np.array([*c.values()], np.int64).tobytes() for c in found]})


class Examples:
    """``(doc_id, label, counts)`` of the examples by doc_id, each opened as it is read: all dictionaries at once would be many times their text."""

    def __init__(self, rows: pa.Table):
        self.terms, self.times = (rows.column(c).combine_chunks() for c in ("terms", "times"))
        at = dict(zip(zip(rows.column("doc_id").to_pylist(), rows.column("toxic").to_pylist(), strict=True), range(len(rows)), strict=True))
        self.at = sorted(at.items())

    def __iter__(self) -> Iterator[tuple[int, int, dict[str, int]]]:
        for (i, y), at in self.at:
            terms, times = self.terms[at].as_py(), np.frombuffer(self.times[at].as_py(), np.int64)
            yield i, y, dict(zip(terms.split(" "), times.tolist(), strict=True)) if terms else {}


def told_apart(held: np.ndarray, toxic: np.ndarray, n: int, pos: int) -> np.ndarray:
    """Weight of terms that ``held`` of n examples have, ``toxic`` of them toxic: root of chi-square against the label, plus one.

    No term is left out: one that tells nothing weighs 1.
    """
    cross = n * toxic - held * pos
    spare = float(pos) * (n - pos) * held * (n - held)
    return np.sqrt(1 + np.divide(n * cross * cross, spare, out=np.zeros(len(held)), where=spare > 0))


def fit(docs: DataFrame, labels: DataFrame) -> Index | None:
    """The index over the training labels; None without two labels to learn from.

    Held out are rows whose crc32 of the doc_id as text is 1 modulo 3. The fit
    sees at most ``EXAMPLES`` distinct texts of each label; how often a term
    occurs is counted over all documents.
    """
    small_batches(docs)
    learn = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    learn = learn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = dict(learn.groupBy("toxic").count().collect())
    first = F.xxhash64(F.lit("examples"), "doc_id")
    picked = None
    for label in (0, 1):
        some = learn.where(F.col("toxic") == label).orderBy(first, "doc_id").limit(EXAMPLES)
        picked = some if picked is None else picked.union(some)
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["text"]).persist()
    sizes = dict(chosen.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        return None
    n, pos = sum(sizes.values()), sizes[1]
    examples = Examples(chosen.select("doc_id", "toxic", "text").mapInPandas(
        _counted, "doc_id long, toxic int, terms string, times binary").toArrow())
    chosen.unpersist()
    held, toxic = Counter(), Counter()
    for _, y, c in examples:
        held.update(c.keys())
        toxic.update(c.keys() if y else ())
    terms = sorted(held)
    wanted = frozenset(terms)

    # here and below an Arrow batch is walked text by text, so that no task holds thousands of texts as Python strings
    def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = Counter(), 0
        for batch in rows:
            seen += len(batch)
            for text in batch.column("text"):
                total.update(wanted.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_pydict({"term": pa.array([*total, None], pa.string()), "n": pa.array([*total.values(), seen], pa.int64())})

    counted = docs.select("text").mapInArrow(spread, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    seen = dict(zip(counted.column("term").to_pylist(), counted.column("n").to_pylist(), strict=True))
    del counted
    idf = np.array([np.log((1 + seen[None]) / (1 + seen.get(t, 0))) + 1 for t in terms])
    idf *= told_apart(np.array([held[t] for t in terms], float), np.array([toxic[t] for t in terms], float), n, pos)
    del held, toxic
    index = Index.build(terms, idf, examples)
    weight = {y: totals[y] / sizes[y] for y in sizes}
    votes = [(index.vote(*index.vector(c), skip=i)[0], y) for i, y, c in examples]
    x, y = np.array([v for v, _ in votes]), np.array([y for _, y in votes], float)
    w = np.array([weight[int(v)] for v in y])
    bare = x < 0
    index.empty = float((y[bare] @ w[bare] + weight[1] * 0.5) / (w[bare].sum() + weight[1])) if bare.any() else 0.0
    if (~bare).any():
        index.steps = monotone(x[~bare], y[~bare], w[~bare])
    return index


def score_texts(docs: DataFrame, index: Index | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` for every row of ``docs``.

    ``score`` depends on the text alone. A null or empty text, or one without
    any term of the examples, has the rate of such examples. Without an index the score is
    0. ``evidence`` lists the nearest examples by doc_id. A null doc_id is held
    out as the text ``null`` would be: never, as it has no remainder.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    # Only texts go to Python.
    @F.arrow_udf("score double, predicted int, evidence string")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for batch in batches:
            scores, evidence = [], []
            for text in batch:
                vote, near = (-1.0, []) if index is None else index.vote(*index.vector(term_counts(text.as_py())))
                scores.append(0.0 if index is None else index.score(vote))
                evidence.append(",".join(str(index.ids[i]) for i in near[:5]) if index else "")
            yield pa.StructArray.from_arrays([
                pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                pa.array(evidence, pa.string())], ["score", "predicted", "evidence"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, judge(F.col("text")).alias("judged"))
    return judged.select("doc_id", "held_out", "judged.score", "judged.predicted", "judged.evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``THRESHOLD``, with all their columns."""
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for batch in batches:
            yield pa.array([bool(index is None or index.score(index.vote(*index.vector(term_counts(t.as_py())))[0]) < THRESHOLD)
                            for t in batch], pa.bool_())

    return docs.where(clean(F.col("text")))
