"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents that belong to the same set of sources are interchangeable for the
flow, so the graph holds patterns and sources, never documents. Each pattern may
be passed several times; every further pass costs more, so words are repeated
only where a quota can't be met otherwise. Documents are then chosen in a seeded
order until each flow is used up.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Hashable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from smeltery.llm.common import WORD, stored, whole_text

MAX_PASSES = 3
BIN_ROWS = 1000
TRIES = 16
#: Patterns and sources go to the driver to be solved; more than this is an error, never a cut.
MAX_PATTERNS = 20_000
#: Seeded places are 60-bit numbers, narrowed down ten bits at a time.
PLACES, DIGIT = 1 << 60, 1 << 10


def word_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def targets(sizes: dict[Hashable, int], weights: dict[Hashable, float], limit: float = MAX_PASSES) -> dict[Hashable, float]:
    """Share the total by weight; a target stops at ``limit`` times its source's size and the excess is reshared."""
    left, open_, out = float(sum(sizes.values())), dict(weights), {}
    while open_:
        total = sum(open_.values())
        full = [s for s in open_ if total and left * open_[s] / total > limit * sizes[s]]
        if not full:
            return out | {s: left * w / total if total else 0.0 for s, w in open_.items()}
        for s in full:
            out[s] = float(limit * sizes[s])
            left -= out[s]
            del open_[s]
    return out


def route(capacity: dict[tuple, int], quota: dict[Hashable, int], passes: int = MAX_PASSES) -> dict[tuple, dict]:
    """Words each pattern gives to each of its sources at the least repetition cost.

    A pattern's k-th pass holds its capacity again at cost k - 1. Successive
    cheapest augmenting paths over residual arcs, found by Dijkstra with
    potentials; costs are small integers, so there are few path lengths.
    """
    arcs: list[list] = []  # to, room, cost
    out: dict[Hashable, list[int]] = {}

    def arc(a, b, room, cost):
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out.setdefault(x, []).append(len(arcs))
            arcs.append([y, r, c])

    for pattern, words in capacity.items():
        for k in range(passes):
            arc("begin", ("p", pattern), words, k)
        for source in pattern:
            arc(("p", pattern), ("s", source), passes * words, 0)
    for source, words in quota.items():
        arc(("s", source), "end", words, 0)
    height = dict.fromkeys(out, 0)
    order = {v: i for i, v in enumerate(out)}
    while "begin" in out and "end" in out:
        far, came, heap = {"begin": 0}, {}, [(0, order["begin"], "begin")]
        while heap:
            d, _, v = heapq.heappop(heap)
            if d > far[v]:
                continue
            for i in out[v]:
                w, room, cost = arcs[i]
                if room and (n := d + cost + height[v] - height[w]) < far.get(w, float("inf")):
                    far[w], came[w] = n, i
                    heapq.heappush(heap, (n, order[w], w))
        if "end" not in far:
            break
        top = max(far.values())
        for v in height:
            height[v] += far.get(v, top)
        path, v = [], "end"
        while v != "begin":
            path.append(came[v])
            v = arcs[came[v] ^ 1][0]
        step = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= step
            arcs[i ^ 1][1] += step
    flow: dict[tuple, dict] = {p: {} for p in capacity}
    for pattern in capacity:
        for i in out[("p", pattern)]:
            if i % 2 == 0 and arcs[i][0][0] == "s" and (used := arcs[i ^ 1][1]):
                flow[pattern][arcs[i][0][1]] = used
    return flow


def _crossing(placed: DataFrame, state: list[list], width: int) -> list[list]:
    """Narrow each pattern's interval of places to the bin in which its gap is used up."""
    spark, step = placed.sparkSession, width // DIGIT
    asked = spark.createDataFrame(state, "_pattern int, _low long, _gap long, _n long")
    inside = placed.join(F.broadcast(asked), "_pattern").where(
        f"_n > {BIN_ROWS} AND _place >= _low AND _place < _low + {width}L")
    order = Window.partitionBy("_pattern").orderBy("_digit")
    bins = (inside.groupBy("_pattern", "_low", "_gap", F.expr(f"(_place - _low) DIV {step}L").alias("_digit"))
            .agg(F.sum("_size").alias("words"), F.count("*").alias("n"))
            .withColumn("upto", F.sum("words").over(order)))
    first = bins.where("upto > _gap").groupBy("_pattern").agg(F.min(F.struct(
        "_digit", F.expr("_gap - upto + words").alias("gap"), "n")).alias("bin"))
    found = {r["_pattern"]: r["bin"] for r in first.collect()}
    return [[p, low + found[p]["_digit"] * step, found[p]["gap"], found[p]["n"]] if p in found else [p, low, gap, n]
            for p, low, gap, n in state]


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Take what still fits, in the one of ``TRIES`` seeded orders that leaves the smallest gap."""
    rows = rows.sort_values(["_place", "_row"], kind="stable")
    sizes, best = rows["_size"].to_numpy(), None
    for k in range(TRIES):
        gap, fits = int(rows["_gap"].iloc[0]), np.zeros(len(sizes), bool)
        for i in np.random.default_rng(k).permutation(len(sizes)):
            if 0 < sizes[i] <= gap:
                fits[i] = True
                gap -= sizes[i]
        if best is None or gap < best[0]:
            best = gap, fits
    return rows[["_row"]].assign(_fits=best[1])


def mix(docs: DataFrame, members: Column, size: Column, weights: Callable[[list], dict], seed: int = 0,
        key: str = "doc_id") -> tuple[DataFrame, dict, dict]:
    """Rows ``(key, members, size, taken)``; also the size and the target of each source.

    ``members`` is the array of the sources a row belongs to (a null element is
    a source of its own), ``weights`` maps the sorted sources to their weights.
    Rows are whole documents, taken 0 to ``MAX_PASSES`` times. A row without
    words is never taken. Rows with equal keys share one place in the seeded
    order. Reruns agree. No rows give no rows.

    All rows of a pattern get the full passes of its flow. For the rest, rows
    have seeded places: those below the crossing bin are taken once more, the
    crossing bin (about ``BIN_ROWS`` rows, found by sums per bin, never by
    sorting a pattern) is filled with what still fits.
    """
    spark = docs.sparkSession
    sized = stored(docs.select(
        F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), size.alias("_size"),
        F.array_sort(F.array_distinct(members)).alias("_members"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 4).alias("_place")), "mix-sizes")
    totals = sized.groupBy("_members").agg(F.sum("_size").alias("words"), F.count("*").alias("n"))
    found = totals.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: [(m is None, m or "") for m in r["_members"]])
    capacity = {tuple(r["_members"]): r["words"] for r in found}
    sources = sorted({m for p in capacity for m in p}, key=lambda m: (m is None, m or ""))
    sizes = {s: sum(w for p, w in capacity.items() if s in p) for s in sources}
    goal = targets(sizes, weights(sources))
    flow = route(capacity, {s: round(t) for s, t in goal.items()})

    plan, state = [], []
    for i, r in enumerate(found):
        passes, gap = divmod(sum(flow[tuple(r["_members"])].values()), r["words"] or 1)
        plan.append((i, list(r["_members"]), passes))
        state.append([i, 0, gap, r["n"]])
    patterns = spark.createDataFrame(plan, "_pattern int, _of array<string>, _passes long")
    placed = sized.join(F.broadcast(patterns), F.col("_members").eqNullSafe(F.col("_of"))).drop("_of")
    width, bounds = PLACES, []
    while width > 1 and any(n > BIN_ROWS for *_, n in state):
        narrowed = _crossing(placed, state, width)
        bounds += [(p, low, low + width, gap) for p, low, gap, n in state if n <= BIN_ROWS and p not in {b[0] for b in bounds}]
        state, width = narrowed, width // DIGIT
    done = {b[0] for b in bounds}
    bounds += [(p, low, low + width, gap) for p, low, gap, _ in state if p not in done]
    edges = spark.createDataFrame(bounds, "_pattern int, _low long, _high long, _gap long")
    cut = placed.join(F.broadcast(edges), "_pattern")
    fitted = (cut.where("_gap > 0 AND _place >= _low AND _place < _high").groupBy("_pattern")
              .applyInPandas(_fill, "_row long, _fits boolean").where("_fits"))
    more = F.when(F.col("_place") < F.col("_low"), 1).otherwise(F.coalesce(F.col("_fits").cast("int"), F.lit(0)))
    taken = F.when(F.col("_size") > 0, (F.col("_passes") + more) * F.col("_size")).otherwise(0)
    out = cut.join(fitted, "_row", "left").select(
        F.col("_key").alias(key), F.col("_members").alias("members"), F.col("_size").alias("size"),
        taken.cast("long").alias("taken"))
    return out, sizes, goal


def weigh_in_turn(sources: list) -> dict:
    """Weights 1, 2, 3, repeating, over the sources in their order."""
    return {s: 1 + i % 3 for i, s in enumerate(sources)}


def mix_by_source(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for documents with one ``source`` each; sizes are words."""
    rows, sizes, goal = mix(docs, F.array("source"), word_count("text"), weigh_in_turn, seed)
    spark = docs.sparkSession
    known = spark.createDataFrame([([s], n, goal[s]) for s, n in sizes.items()],
                                  "of array<string>, source_size long, target double")
    return (rows.join(F.broadcast(known), F.col("members").eqNullSafe(F.col("of")))
            .select("doc_id", "size", "source_size", "target", "taken"))
