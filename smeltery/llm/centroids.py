"""Centroid clustering in exact integers with a progressive search over Walsh-Hadamard coefficients.

Vectors and centroids are integers; their Walsh-Hadamard transforms are integers
too, and the squared distance of two transforms is 64 times that of the vectors.
Differences are added from coarse to fine coefficients. A partial sum only
grows, so a centroid whose sum is strictly above the whole distance of another
one is out; ties stay and are settled by the centroid's number.

Each round is one pass over the vectors. A task sends at most one row per
centroid, component and digit, Spark adds them up, and the driver holds the
centroids only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import stored

# Components of a vector, what they are multiplied by, centroids and rounds.
COMPONENTS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Up to this size of a component all sums fit a long; larger ones are Python integers.
NARROW = 1 << 24
#: Sums travel as digits of this many bits, so no component is too large for them.
DIGIT_BITS = 31
#: Coefficients finished at each step of the search, coarse to fine.
STEPS = (4, 8, 16, 32, 64)
BLOCK = 2048
LARGEST = (1 << 63) - 1


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, by additions and subtractions only."""
    out, half = rows, 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([low + high, low - high], axis=2).reshape(rows.shape)
        half *= 2
    return out


def _coarse_first() -> np.ndarray:
    signs = hadamard(np.eye(COMPONENTS, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=1) != 0).sum(1), kind="stable")


#: Coefficients by their number of sign changes.
ORDER = _coarse_first()


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(64 * x)`` of finite doubles: longs where all are narrow, Python integers otherwise."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if not scaled.size or np.abs(scaled).max() <= NARROW:
        return scaled.astype(np.int64)
    exact = [int(s) if math.isfinite(s) else int(x) * SCALE for s, x in zip(scaled.flat, values.flat, strict=True)]
    return np.array(exact, dtype=object).reshape(values.shape)


def _narrow(rows: np.ndarray) -> np.ndarray:
    """Whether each row fits the arithmetic of longs."""
    return np.abs(rows).max(axis=1) <= NARROW


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row and the squared distance to it; ties take the smaller number."""
    if rows.dtype != centroids.dtype:
        rows, centroids = rows.astype(object), centroids.astype(object)
    ours, theirs = hadamard(rows)[:, ORDER], hadamard(centroids)[:, ORDER]
    count = len(centroids)

    def spent(row: np.ndarray, centroid: np.ndarray, start: int, stop: int) -> np.ndarray:
        gap = ours[row, start:stop] - theirs[centroid, start:stop]
        return (gap * gap).sum(axis=1)

    row = np.repeat(np.arange(len(rows)), count)
    centroid = np.tile(np.arange(count), len(rows))
    sums = spent(row, centroid, 0, STEPS[0])
    # The coarsest favourite of each row is finished at once: nothing above its distance can win.
    favourite = sums.reshape(-1, count).argmin(axis=1)
    everyone = np.arange(len(rows))
    bound = sums.reshape(-1, count)[everyone, favourite] + spent(everyone, favourite, STEPS[0], COMPONENTS)
    for start, stop in zip(STEPS, (*STEPS[1:], None), strict=True):
        alive = (sums <= bound[row]).astype(bool)
        row, centroid, sums = row[alive], centroid[alive], sums[alive]
        if stop:
            sums = sums + spent(row, centroid, start, stop)
    best: dict[int, tuple] = {}
    if rows.dtype == object:
        for r, c, s in zip(row, centroid, sums, strict=True):
            best[r] = min(best.get(r, (s, c)), (s, c))
        found = np.array([best[r][1] for r in range(len(rows))], dtype=np.int64)
        gaps = np.array([best[r][0] // COMPONENTS for r in range(len(rows))], dtype=object)
        return found, gaps
    order = np.lexsort((centroid, sums, row))
    first = order[np.searchsorted(row[order], everyone)]
    return centroid[first], sums[first] // COMPONENTS


def assign(values: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(places, integers, centroid, distance)`` of all rows, in blocks; wide rows come in blocks of their own."""
    rows = integers(values)
    groups = [np.arange(len(rows))]
    if rows.dtype == object and len(rows):
        narrow = _narrow(rows)
        groups = [np.flatnonzero(narrow), np.flatnonzero(~narrow)]
    for number, group in enumerate(groups):
        for start in range(0, len(group), BLOCK):
            places = group[start:start + BLOCK]
            block = rows[places]
            if number == 0:
                block = block.astype(np.int64)
            yield places, block, *nearest(block, centroids)


def _values(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, COMPONENTS)


def _digits(number: int) -> Iterator[tuple[int, int]]:
    sign, number, place = (-1 if number < 0 else 1), abs(number), 0
    while number:
        yield place, sign * (number & ((1 << DIGIT_BITS) - 1))
        number >>= DIGIT_BITS
        place += 1


def _matrix(centroids: Sequence[Sequence[int]]) -> np.ndarray:
    exact = np.array([list(c) for c in centroids], dtype=object).reshape(-1, COMPONENTS)
    return exact.astype(np.int64) if _narrow(exact).all() else exact


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; those without vectors stay."""
    matrix = _matrix(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(matrix), COMPONENTS + 1), dtype=object)
        for batch in batches:
            for _, rows, cluster, _ in assign(_values(batch.column(0)), matrix):
                for c in np.unique(cluster):
                    mine = rows[cluster == c]
                    sums[c, :-1] += mine.sum(axis=0).astype(object)
                    sums[c, -1] += len(mine)
        lines = [(c, p, place, digit) for c in range(len(sums)) for p in range(COMPONENTS + 1)
                 for place, digit in _digits(int(sums[c, p]))]
        if lines:
            cluster, position, place, digit = zip(*lines, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster, pa.int32()), pa.array(position, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(digit, pa.int64())], ["cluster", "position", "place", "digit"])

    parts = kept.select("values").mapInArrow(partial, "cluster int, position int, place int, digit bigint")
    totals = [[0] * (COMPONENTS + 1) for _ in centroids]
    # At most one row per centroid, component and digit comes back.
    for line in parts.groupBy("cluster", "position", "place").agg(F.sum("digit").alias("digit")).collect():
        totals[line["cluster"]][line["position"]] += line["digit"] << (DIGIT_BITS * line["place"])
    return [[s // total[-1] for s in total[:-1]] if total[-1] else before
            for before, total in zip(centroids, totals, strict=True)]


def _whole(values: Column) -> Column:
    """Exactly the right number of components, none null, NaN or infinite."""
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return values.isNotNull() & (F.size(values) == COMPONENTS) & finite


def cluster(vectors: DataFrame, key: str = "vec_id", values: str = "embedding", *, centroids: int = CENTROIDS,
            rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """Every usable vector with its cluster, its distance and the digest of its centroid.

    Vectors with another number of components, or with null, NaN or infinite
    ones, are left out. The first centroids are the vectors with the smallest
    SHA-256 of ``seed:key``; rows that share a key are told apart by their
    components, and rows without a key are taken last. Fewer vectors than
    centroids make fewer centroids, none an empty result. Rows that repeat are
    all kept. Other columns are not read. A distance or sum beyond a long is
    given as the largest long; the search itself is exact at any size.
    """
    kept = (vectors.select(F.col(key).alias("id"), F.col(values).cast("array<double>").alias("values"))
            .where(_whole(F.col("values"))))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(digest.asc_nulls_last(), "values").limit(centroids).select("values").collect()
    chosen = [[int(x) for x in integers(np.array(s["values"], dtype=np.float64))] for s in starts]
    for _ in range(rounds if chosen else 0):
        chosen = moved(kept, chosen)
    matrix = _matrix(chosen)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for places, _, found, gaps in assign(_values(batch.column(1)), matrix):
                clusters[places] = found
                distances[places] = [min(int(g), LARGEST) for g in gaps] if gaps.dtype == object else gaps
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clusters), pa.array(distances)],
                                             ["id", "cluster", "distance"])

    kind = kept.schema["id"].dataType.simpleString()
    assigned = stored(kept.mapInArrow(final, f"id {kind}, cluster int, distance bigint"), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in
            assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in chosen]

    def by_cluster(of: Sequence, dtype: str) -> Column:
        return F.get(F.array(*[F.lit(x) for x in of]).cast(f"array<{dtype}>"), F.col("cluster"))

    return assigned.select(
        F.col("id").alias(key), "cluster", "distance",
        by_cluster([min(sums.get(c, 0), LARGEST) for c in range(len(chosen))], "bigint").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), LARGEST)).cast("bigint").alias("inertia"),
        by_cluster(digests, "string").alias("centroid_sha256"))
