"""Centroid clustering against plain integer k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from smeltery.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)


def whole(x):
    return math.floor(x * 64) if math.isfinite(x * 64) else int(x) * 64


def brute(rows, k=16, rounds=3):
    usable = [(i, tuple(whole(x) for x in v)) for i, v in rows
              if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in usable)[:k]
    centres = [v for _, _, v in first]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in usable:
            groups.setdefault(best(v)[1], []).append(v)
        centres = [tuple(sum(c) // len(groups[n]) for c in zip(*groups[n])) if n in groups else centre
                   for n, centre in enumerate(centres)]
    got = [(i, *best(v)) for i, v in usable]
    top = (1 << 63) - 1
    inner = {n: sum(min(d, top) for _, d, m in got if m == n) for n in range(k)}
    return sorted(((i, n, min(d, top), min(inner[n], top), min(sum(inner.values()), top),
                    hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, d, n in got), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_clusters_equal_plain_means(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(j % 3, 1) for j in range(64)]) for i in range(300)]
    same = [0.5] * 64
    rows += [(1000 + i, same) for i in range(150)] + [(7, same), (7, same), (None, same), (None, [0.25] * 64)]
    rows += [(2000, [1.0] * 63), (2001, [1.0] * 65), (2002, [None] + [1.0] * 63), (2003, [math.nan] + [1.0] * 63),
             (2004, [math.inf] + [1.0] * 63), (2005, None), (2006, [])]
    assert found(centroids.cluster(frame(spark, rows))) == brute(rows)


def test_huge_components_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(40)]
    rows += [(100, [1e30] + [0.0] * 63), (101, [1.7e308] * 64), (102, [-1e9] * 64), (103, [2.0**40 + 0.3] * 64),
             (9007199254740993, [3e5] * 64)]
    assert found(centroids.cluster(frame(spark, rows))) == brute(rows)


def test_few_vectors_and_none(spark):
    assert found(centroids.cluster(frame(spark, []))) == []
    rows = [(1, [0.0] * 64), (2, [-0.001] * 64)]
    assert found(centroids.cluster(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_equals_whole_distances(kind):
    rng = np.random.default_rng(3)
    rows, chosen = rng.integers(-40, 40, (500, 64)), rng.integers(-40, 40, (16, 64))
    chosen[9] = chosen[4]
    rows[:20] = (chosen[2] + chosen[11]) // 2
    whole_gaps = ((rows[:, None, :] - chosen[None]) ** 2).sum(2)
    cluster, gap = centroids.nearest(rows.astype(kind), chosen.astype(kind))
    assert (cluster == whole_gaps.argmin(1)).all() and (gap == whole_gaps.min(1)).all()


def test_transform_keeps_distances():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-9, 9, (5, 64)), rng.integers(-9, 9, (5, 64))
    assert (((centroids.hadamard(a) - centroids.hadamard(b)) ** 2).sum(1) == 64 * ((a - b) ** 2).sum(1)).all()
    assert (centroids.hadamard(centroids.hadamard(a)) == 64 * a).all()
