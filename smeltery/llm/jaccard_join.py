"""Similarity join on word shingles with PartEnum signatures.

The feature domain (64-bit shingle hashes) is cut into 2^j first-level halves
whose number follows the size band of a set; each signature is the projection of
the set on one of the enumerated sub-partitions. Two similar sets differ in few
features, fewer than the larger one has filled sub-partitions, so at least one
filled sub-partition is the same in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import components, discard, free_name, marked, release, small_batches, stored
from smeltery.llm.shingles import SIZE, batches, scramble, shingle_sets

#: Similar: NUMERATOR * union <= DENOMINATOR * intersection, that is 75 / 100.
NUMERATOR, DENOMINATOR = 3, 4
#: Sets below this size use one sub-partition per feature.
SMALL = 64
#: A shingle that this share of a task's documents has is reported as frequent; the report only orders signatures.
FREQUENT_SHARE, FREQUENT_KEPT = 0.002, 100_000
#: Bytes of signatures one reducing task handles at a time.
BUCKET_BYTES = 6 << 20
PARTNERS_PER_TASK = 64
#: Features or signatures a task gathers before it hands them on.
SLICE = 1 << 20
#: Bits of the smallest sketch. A bit tells whether an odd number of features falls on it; there are at least two for each feature.
SKETCH = 64
#: A signature with more holders than this is looked at through its most central holder first.
CROWD = 16
#: Holders of a crowd whose sketches are compared at once, and bits of them.
SIDE, WIDE = 512, 1 << 11
#: What is known of a holder.
HELD = ("rep", "n", "label", "alone", "apart")
#: Two holders of a crowded signature differ from its centre in ``apart`` features each; what they differ in alike
#: leaves out the features that only one set of the crowd has. So they differ in at least this many.
DIFFER = "x_apart + y_apart - 2 * least(x_apart - x_alone, y_apart - y_alone)"
UNLIKE = (f"x_apart IS NULL OR y_apart IS NULL OR "
          f"{DENOMINATOR + NUMERATOR} * ({DIFFER}) <= {DENOMINATOR - NUMERATOR} * (x_n + y_n)")
FACTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary()),
                   ("feature", pa.int64()), ("often", pa.int64())])
OWN = pa.schema([("bucket", pa.int64()), ("marks", pa.binary()), ("ids", pa.binary()), ("shared", pa.binary())])
BLOCKS = pa.schema([("bucket", pa.int64()), ("marks", pa.binary()), ("ids", pa.binary()), ("hubs", pa.binary())])


def most_apart(a: int, b: int) -> int:
    """Largest symmetric difference of similar sets of sizes a and b."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def level(size: int) -> int:
    """log2 of the number of sub-partitions for a band, 2 to 4 for each feature; 0: one per feature.

    Most filled sub-partitions then hold one feature, which leaves the most room
    to pass over projections that very many sets share.
    """
    return 0 if size < SMALL else (size - 1).bit_length() + 1


def levels(size: int) -> dict[int, int]:
    """Bands a set of this size meets partners in, with the largest partner there."""
    top = size * DENOMINATOR // NUMERATOR
    if size < 2 * SMALL:
        out = {}
        for b in range(size, top + 1):
            out[level(b)] = b
        return out
    if level(size) == level(top):
        return {level(size): top}
    return {level(size): 1 << (level(size) - 1), level(top): top}


def signatures(features: np.ndarray, frequent: np.ndarray, often: np.ndarray) -> np.ndarray:
    """PartEnum signatures of a sorted set of features.

    Of the filled sub-partitions only the rarest ones have to be compared: as
    similar sets differ in at most d features they share all but d of them, so
    d + 1 of each side, in one common order, are enough. The order puts
    projections made of frequent features last.
    """
    n, out = len(features), []
    seen = np.zeros(n, np.int64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, features), len(frequent) - 1)
        seen = np.where(frequent[place] == features, often[place], 0)
    for j, top in levels(n).items():
        if j == 0:
            parts, rare = scramble(features ^ np.uint64(0x5851F42D4C957F2D)), seen
        else:
            cell = features >> np.uint64(64 - j)
            first = np.flatnonzero(np.diff(cell, prepend=cell[0] ^ np.uint64(1)))
            if j == level(n) and len(first) <= most_apart(n, n):
                raise ValueError("too few filled sub-partitions to find every similar set")
            rare = np.minimum.reduceat(seen, first)
            parts = scramble(np.add.reduceat(scramble(features), first) + cell[first] * np.uint64(0x2545F4914F6CDD1D)
                             + np.uint64(j))
        need = most_apart(n, top) + 1
        if need < len(parts):
            parts = parts[np.lexsort((parts, rare))[:need]]
        out.append(parts)
    return np.concatenate(out)


def sketch(features: np.ndarray) -> bytes:
    """Bits by the last digits of the features, each set where their number is odd."""
    size = max(SKETCH, 1 << (2 * len(features) - 1).bit_length()) if len(features) else SKETCH
    return np.packbits(np.bincount((features & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1).tobytes()


def folded(sketches: pd.Series, width: int) -> np.ndarray:
    """Sketches of one size as rows of ``width`` bytes, as smaller sketches of the same sets would be."""
    out = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    while out.shape[1] > width:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[pa.Buffer | None]:
    """The texts as Arrow holds them, one at a time."""
    return (t.as_buffer() for t in batch.column("text"))


def _describe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the size and a digest of its set; per slice the shingles frequent in it."""

    def told(first: int, sizes: list[int], digests: list[bytes], sketches: list[bytes]) -> pa.RecordBatch:
        ids = batch.column("doc_id").slice(first, len(sizes))
        return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(digests), pa.array(sketches),
                                           none(len(sizes)), none(len(sizes))], schema=FACTS)

    def often(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        every, times = np.unique(np.concatenate(sets), return_counts=True)
        much = times >= max(4, FREQUENT_SHARE * len(sets))
        count = int(much.sum())
        if len(sets) > 1 and count:
            empty = pa.nulls(count, pa.binary())
            yield pa.RecordBatch.from_arrays([none(count), none(count), empty, empty,
                                              pa.array(every[much].view(np.int64)), pa.array(times[much])], schema=FACTS)

    none = lambda k: pa.nulls(k, pa.int64())
    kept, held = {}, 0
    for batch in rows:
        for first, run in batches(_texts(batch)):
            sizes, digests, sketches = [], [], []
            for s in shingle_sets(run):
                digest = np.concatenate(([np.uint64(len(s))], [s.sum(dtype=np.uint64)],
                                         [scramble(s + np.uint64(7)).sum(dtype=np.uint64)])).tobytes()
                sizes.append(len(s))
                digests.append(digest)
                sketches.append(sketch(s))
                if digest not in kept:
                    kept[digest] = s
                    held += len(s)
            yield told(first, sizes, digests, sketches)
            if held >= SLICE:
                yield from often(list(kept.values()))
                kept, held = {}, 0
    if kept:
        yield from often(list(kept.values()))


def _emit(buckets: int, frequent: np.ndarray, often: np.ndarray):
    """Blocks of signatures by bucket. A set met before in the slice is not repeated.

    Within a slice the first document with a signature stands for it; the
    others become finished edges, so a signature that very many documents share
    reaches its bucket once per slice.
    """

    def blocks(marks: list[np.ndarray], owner: list[np.ndarray]) -> pa.RecordBatch:
        mark, own = np.concatenate(marks), np.concatenate(owner)
        order = np.lexsort((own, mark))
        mark, own = mark[order], own[order]
        new = np.diff(mark, prepend=mark[0] ^ np.uint64(1)) != 0
        hub = own[np.flatnonzero(new)][np.cumsum(new) - 1]
        extra = ~new & (own != hub)
        bucket = (mark[new] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] ^ np.uint64(1)))
        ends = np.append(cuts[1:], len(bucket))
        m, o = mark[new], own[new]
        out = [(int(bucket[a]), m[a:b].tobytes(), o[a:b].tobytes(), None) for a, b in zip(cuts, ends, strict=True)]
        if extra.any():
            deal = int(own[0]) % buckets
            out.append((deal, mark[extra].tobytes(), own[extra].tobytes(), hub[extra].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), BLOCKS, strict=True)], schema=BLOCKS)

    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks, owner, held = set(), [], [], 0
        for batch in rows:
            ids = batch.column("doc_id").to_numpy()
            for first, run in batches(_texts(batch)):
                for i, s in enumerate(shingle_sets(run), first):
                    seen = (len(s), int(s.sum(dtype=np.uint64)))
                    if len(s) and seen not in known:
                        known.add(seen)
                        marks.append(signatures(s, frequent, often))
                        owner.append(np.full(len(marks[-1]), ids[i]))
                        held += len(marks[-1])
                if held >= SLICE:
                    yield blocks(marks, owner)
                    known, marks, owner, held = set(), [], [], 0
        if marks:
            yield blocks(marks, owner)

    return emit


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Edges (mark, hub, id) of one bucket: every holder of a signature with the smallest one."""
    ready = rows["hubs"].notna()
    out = [(np.frombuffer(m, np.int64), np.frombuffer(h, np.int64), np.frombuffer(i, np.int64))
           for m, i, h in rows.loc[ready, ["marks", "ids", "hubs"]].itertuples(index=False)]
    if not ready.all():
        mark = np.concatenate([np.frombuffer(x, np.uint64) for x in rows.loc[~ready, "marks"]])
        own = np.concatenate([np.frombuffer(x, np.int64) for x in rows.loc[~ready, "ids"]])
        order = np.lexsort((own, mark))
        mark, own = mark[order], own[order]
        new = np.diff(mark, prepend=mark[0] ^ np.uint64(1)) != 0
        hub = own[np.flatnonzero(new)][np.cumsum(new) - 1]
        more = own != hub
        out.append((mark[more].view(np.int64), hub[more], own[more]))
    mark, hub, own = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"mark": mark, "hub": hub, "id": own})


def _compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symmetric difference of a leading set and the sets sorted behind it, and whether they are similar."""
    lead, base = None, np.zeros(0, np.uint64)
    for batch in rows:
        a, b, apart, similar = [], [], [], []
        hubs, parts, ids = (batch.column(c).to_numpy() for c in ("hub", "part", "id"))
        for first, run in batches(_texts(batch)):
            for i, s in enumerate(shingle_sets(run), first):
                if ids[i] == hubs[i]:
                    lead, base = (hubs[i], parts[i]), s
                    continue
                if (hubs[i], parts[i]) != lead:
                    continue
                place = np.minimum(np.searchsorted(base, s), len(base) - 1)
                both = int((base[place] == s).sum()) if len(base) else 0
                a.append(hubs[i])
                b.append(ids[i])
                apart.append(len(s) + len(base) - 2 * both)
                similar.append(both > 0 and DENOMINATOR * both >= NUMERATOR * (len(s) + len(base) - both))
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                                          "apart": pa.array(apart, pa.int64()), "similar": pa.array(similar, pa.bool_())})


def measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, apart, similar)`` of the pairs (a, b), compared exactly on their whole sets.

    A text that leads very many pairs is sent to several tasks, each with at
    most about ``PARTNERS_PER_TASK`` partners.
    """
    many = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS_PER_TASK).alias("parts")), "jaccard-leads")
    dealt = pairs.join(many, "a")
    partners = dealt.select(F.col("a").alias("hub"), F.expr("pmod(xxhash64(b), parts)").alias("part"), F.col("b").alias("id"))
    leads = many.select(F.col("a").alias("hub"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.col("a").alias("id"))
    asked = partners.union(leads).join(texts, "id")
    lined = (asked.repartition("hub", "part")
             .sortWithinPartitions("hub", "part", F.col("id") != F.col("hub")))
    return lined.select("hub", "part", "id", "text").mapInArrow(
        _compare, "a long, b long, apart long, similar boolean")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return measured(pairs, texts).where("similar").select("a", "b")


def _may_link(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose sketches differ in few enough bits: the sets differ in at least as many features."""
    for batch in rows:
        for (x, y), some in batch.groupby([batch["x"].str.len(), batch["y"].str.len()]):
            differ = np.bitwise_count(folded(some["x"], min(x, y)) ^ folded(some["y"], min(x, y))).sum(1, dtype=np.int64)
            room = (DENOMINATOR + NUMERATOR) * differ <= (DENOMINATOR - NUMERATOR) * (some["n"] + some["m"])
            if room.any():
                yield some.loc[room, ["a", "b"]]


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that ``sketches(rep, n, sketch)`` do not rule out."""
    side = lambda c, n, s: sketches.select(F.col("rep").alias(c), F.col("n").alias(n), F.col("sketch").alias(s))
    return (pairs.select("a", "b").join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b")
            .mapInPandas(_may_link, "a long, b long"))


def _with_partner(rows: pd.DataFrame) -> pd.DataFrame:
    """Of two parts of the holders around one hub, those that sizes and sketches allow a partner with another label in the other part."""
    found = np.zeros(len(rows), bool)
    n, label, own = (rows[c].to_numpy() for c in ("n", "label", "own"))
    i, j = rows["i"].iat[0], rows["j"].iat[0]
    widths = rows["sketch"].str.len().to_numpy()
    for x in np.unique(widths[own == i]):
        for y in np.unique(widths[own == j]):
            left, right = np.flatnonzero((own == i) & (widths == x)), np.flatnonzero((own == j) & (widths == y))
            width = min(x, y)
            p, q = folded(rows["sketch"].iloc[left], width), folded(rows["sketch"].iloc[right], width)
            differ = np.bitwise_count(p).sum(1, dtype=np.int64)[:, None] + np.bitwise_count(q).sum(1, dtype=np.int64)
            for k in range(0, width, WIDE // 8):
                bits = [np.unpackbits(z[:, k:k + WIDE // 8], axis=1).astype(np.float32) for z in (p, q)]
                differ -= 2 * (bits[0] @ bits[1].T).astype(np.int64)
            a, b = n[left][:, None], n[right]
            room = ((label[left][:, None] != label[right]) & (NUMERATOR * np.maximum(a, b) <= DENOMINATOR * np.minimum(a, b))
                    & ((DENOMINATOR + NUMERATOR) * differ <= (DENOMINATOR - NUMERATOR) * (a + b)))
            found[left] |= room.any(1)
            found[right] |= room.any(0)
    return rows.loc[found, ["hub", "rep"]]


def sifted(crowd: DataFrame, whole: DataFrame, sketches: DataFrame) -> DataFrame:
    """``crowd(mark, rep, n)`` without the holders that cannot be similar to any holder of their signature with another label.

    Signatures of one smallest holder are looked at together. Very many holders
    are dealt to parts, and two parts at a time are compared.
    """
    hubs = stored(crowd.groupBy("mark").agg(F.min("rep").alias("hub")), "jaccard-hubs")
    around = crowd.join(hubs, "mark")
    pools = stored(around.select("hub", "rep", "n").distinct(), "jaccard-around")
    sized = pools.groupBy("hub").agg(F.ceil(F.count("*") / SIDE).alias("parts"))
    known = whole.where("doc_id = rep").select("rep", "label").join(sketches.select("rep", "sketch"), "rep")
    dealt = pools.join(sized, "hub").withColumn("own", F.expr("pmod(xxhash64(rep), parts)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).select(
        "hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n")
    kept = dealt.join(known, "rep").groupBy("hub", "i", "j").applyInPandas(_with_partner, "hub long, rep long")
    kept = stored(kept.distinct(), "jaccard-sifted")
    return around.join(kept, ["hub", "rep"], "left_semi").select("mark", "rep", "n")


def _own_features(buckets: int):
    """Blocks of features by bucket, with the set that has each. Features that several sets of a slice have are nobody's own.

    Those are sent once a slice, without a set. 32 bits of a feature tell it from
    others of its bucket; where they do not, the two count as shared, which only
    leaves ``alone`` smaller.
    """

    def blocks(sets: list[np.ndarray], reps: list[int]) -> pa.RecordBatch:
        mark, own = np.concatenate(sets), np.repeat(np.array(reps, np.int64), [len(s) for s in sets])
        order = np.lexsort((own, mark))
        mark, own = mark[order], own[order]
        start = np.flatnonzero(np.diff(mark, prepend=mark[0] ^ np.uint64(1)))
        several = own[start] != own[np.append(start[1:], len(own)) - 1]
        mark, own = mark[start], own[start]
        bucket = (mark >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] ^ np.uint64(1)))
        short, out = mark.astype(np.uint32), []
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
            some, whose, alike = short[a:b], own[a:b], several[a:b]
            by = np.argsort(whose[~alike], kind="stable")
            out.append((int(bucket[a]), some[~alike][by].tobytes(), whose[~alike][by].tobytes(), some[alike].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), OWN, strict=True)], schema=OWN)

    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, reps, held = [], [], 0
        for batch in rows:
            ids = batch.column("id").to_numpy()
            for first, run in batches(_texts(batch)):
                for i, s in enumerate(shingle_sets(run), first):
                    if len(s):
                        sets.append(s)
                        reps.append(ids[i])
                        held += len(s)
                if held >= SLICE:
                    yield blocks(sets, reps)
                    sets, reps, held = [], [], 0
        if sets:
            yield blocks(sets, reps)

    return emit


def _counted_alone(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket, how many features of each set no other set has."""
    mark, own, shared = (np.frombuffer(b"".join(rows[c]), t) for c, t in (("marks", np.uint32), ("ids", np.int64), ("shared", np.uint32)))
    order = np.lexsort((own, mark))
    mark, own = mark[order], own[order]
    start = np.flatnonzero(np.diff(mark.astype(np.int64), prepend=-1))
    sole = own[start] == own[np.append(start[1:], len(own)) - 1] if len(start) else np.zeros(0, bool)
    rep, alone = np.unique(own[start][sole & ~np.isin(mark[start], shared)], return_counts=True)
    return pd.DataFrame({"rep": rep, "alone": alone})


def _alone(texts: DataFrame, buckets: int) -> DataFrame:
    """``(rep, alone)``: about how many features of each of these sets no other of them has, never more than there are."""
    blocks = texts.select("id", "text").mapInArrow(_own_features(buckets), "bucket long, marks binary, ids binary, shared binary")
    own = blocks.groupBy("bucket").applyInPandas(_counted_alone, "rep long, alone long").groupBy("rep").agg(F.sum("alone").alias("alone"))
    reps = texts.select(F.col("id").alias("rep")).distinct()
    return reps.join(own, "rep", "left").select("rep", F.coalesce("alone", F.lit(0)).alias("alone"))


def pooled(holders: DataFrame) -> DataFrame:
    """``(by_centre, key, rep, n, label, alone, apart)``: groups of holders whose pairs cover those of every signature.

    The signatures of one crowd have nearly the same holders, so their pairs
    would be met once for each signature. Where all holders around a centre
    make no more pairs than its signatures one by one, they are one group.
    """
    around = holders.where("centre IS NOT NULL")
    apiece = (around.groupBy("centre", "mark").count().groupBy("centre").agg(F.sum(F.expr("count * count")).alias("apiece")))
    at_once = around.select("centre", "rep").distinct().groupBy("centre").agg(F.expr("count(*) * count(*)").alias("at_once"))
    fewer = apiece.join(at_once, "centre").select("centre", (F.col("at_once") <= F.col("apiece")).alias("by_centre"))
    crowds = around.join(fewer, "centre").select(
        "by_centre", F.when(F.col("by_centre"), F.col("centre")).otherwise(F.col("mark")).alias("key"), *HELD)
    single = holders.where("centre IS NULL").select(F.lit(False).alias("by_centre"), F.col("mark").alias("key"), *HELD)
    return stored(crowds.distinct().union(single), "jaccard-pooled")


def _labelled(of: DataFrame, links: DataFrame) -> DataFrame:
    groups = components(links.select("a", "b")).withColumnRenamed("id", "rep")
    return stored(of.join(groups, "rep", "left").select(
        "doc_id", "rep", "n", F.coalesce("label", "rep").alias("label")), "jaccard-whole")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    A document's set holds its distinct shingles of ``SIZE`` words; with fewer
    words the whole sequence is one; without words or text it is empty and
    linked with nothing. Two documents link when their Jaccard similarity is at
    least 0.75, compared on the whole sets (64-bit hashes). ``component_id`` is
    the smallest doc_id reachable by links. Rows with one doc_id are one
    document. A row without doc_id keeps its size and has no component.
    Links are not counted: pairs within one component need not be compared.
    Other columns are not looked at.

    How no link is lost: equal sets are one vertex. Every holder of a signature
    is compared with the smallest holder. Where that leaves the holders of a
    signature in several components, holders of crowded signatures stay if their
    sketches allow a partner in another component, these are compared with the
    most central of them (fewest features of its own), and then all holders of
    different components that sizes, sketches and differences from the centre do
    not rule out; holders of one component need not be.
    """
    small_batches(docs)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = stored(slim.mapInArrow(_describe, "doc_id long, n long, digest binary, sketch binary, feature long, often long"),
                   "jaccard-facts")
    sizes = facts.where("feature IS NULL").select("doc_id", "n", "digest")
    hot = (facts.where("feature IS NOT NULL").groupBy("feature").agg(F.sum("often").alias("often"))
           .orderBy(F.desc("often"), "feature").limit(FREQUENT_KEPT).toPandas())
    feature = hot["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(feature)
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(64, int(total * 0.45 * 16 // BUCKET_BYTES))

    full = sizes.where("doc_id IS NOT NULL AND n > 0")
    first = stored(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "jaccard-sets")
    of = stored(full.select("doc_id", "digest").join(first, "digest").groupBy("doc_id").agg(
        F.min("rep").alias("rep"), F.first("n").alias("n")), "jaccard-documents")

    blocks = slim.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        _emit(buckets, feature[order], hot["often"].to_numpy(np.int64)[order]),
        "bucket long, marks binary, ids binary, hubs binary")
    met = stored(blocks.groupBy("bucket").applyInPandas(_meet, "mark long, hub long, id long"), "jaccard-edges")
    release(docs)
    rep = lambda c: of.select(F.col("doc_id").alias(c), F.col("rep").alias(f"{c}_rep"), F.col("n").alias(f"{c}_n"))
    near = met.select("hub", "id").distinct().join(rep("hub"), "hub").join(rep("id"), "id")
    edges = stored(near, "jaccard-near")
    release(docs)
    fits = "{0}_rep <> {1}_rep AND {2} * greatest({0}_n, {1}_n) <= {3} * least({0}_n, {1}_n)".format
    sketches = stored(facts.select("doc_id", "n", "sketch").join(first.select(F.col("rep").alias("doc_id")), "doc_id")
                      .dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "rep"), "jaccard-sketches")
    couples = edges.where(fits("hub", "id", NUMERATOR, DENOMINATOR)).select(
        F.least("hub_rep", "id_rep").alias("a"), F.greatest("hub_rep", "id_rep").alias("b")).distinct()
    tried = stored(possible(couples, sketches), "jaccard-tried")
    release(docs)

    def fetched(wanted: DataFrame) -> DataFrame:
        ids = stored(wanted, "jaccard-wanted")
        texts = slim.withColumnRenamed("doc_id", "id")
        return marked(texts, texts["id"], ids, "wanted").where("wanted").drop("wanted").join(ids, "id")

    both_ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    links = stored(verified(tried, fetched(both_ends(tried))), "jaccard-links")
    release(docs)
    whole = _labelled(of, links)
    side = lambda c: whole.select(F.col("doc_id").alias(c), F.col("label").alias(f"{c}_label"))
    split = (edges.select("hub", "id").join(side("hub"), "hub").join(side("id"), "id")
             .where("hub_label <> id_label").select("hub", "id"))
    open_marks = stored(met.join(split, ["hub", "id"], "left_semi").select("mark").distinct(), "jaccard-open")
    holders = met.join(open_marks, "mark", "left_semi")
    holders = (holders.select("mark", "id").union(holders.select("mark", F.col("hub").alias("id")))
               .join(of.withColumnRenamed("doc_id", "id"), "id").select("mark", "rep", "n").distinct())
    holders = stored(holders, "jaccard-holders")
    discard(met)
    discard(edges)

    release(docs)
    crowded = holders.groupBy("mark").count().where(f"count > {CROWD}").select("mark")
    crowded = stored(crowded, "jaccard-crowded")
    crowd = stored(holders.join(crowded, "mark", "left_semi"), "jaccard-crowds")
    release(docs)
    crowd = stored(sifted(crowd, whole, sketches), "jaccard-crowds")
    release(docs)
    holders = stored(holders.join(crowded, "mark", "left_anti").union(crowd), "jaccard-holders")
    reps = stored(crowd.select(F.col("rep").alias("id"), "n").distinct(), "jaccard-reps")
    texts = fetched(reps.select("id").distinct())
    much = reps.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    alone = stored(_alone(texts, max(12, int(much * 16 // BUCKET_BYTES))), "jaccard-alone")
    release(docs)
    crowd = stored(crowd.join(alone, "rep"), "jaccard-crowd")
    centre = stored(crowd.groupBy("mark").agg(F.min(F.struct("alone", "rep")).alias("c"))
                    .select("mark", F.col("c.rep").alias("centre")), "jaccard-centres")
    spokes = stored(crowd.join(centre, "mark").where("rep <> centre"), "jaccard-spokes")
    spans = stored(measured(spokes.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct(),
                            texts), "jaccard-spans")
    release(docs)
    links = stored(links.union(spans.where("similar").select("a", "b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-links")
    whole = _labelled(of, links)
    far = stored(spokes.join(spans.select(F.col("a").alias("centre"), F.col("b").alias("rep"), "apart"), ["centre", "rep"])
                 .select("mark", "rep", "alone", "apart"), "jaccard-far")

    rest = holders.join(far, ["mark", "rep"], "left").join(whole.where("doc_id = rep").select("rep", "label"), "rep")
    rest = stored(rest.join(centre.select("mark", F.col("centre").alias("rep")), ["mark", "rep"], "left_anti"), "jaccard-rest")
    mixed = rest.groupBy("mark").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    rest = pooled(stored(rest.join(mixed.select("mark"), "mark", "left_semi").join(centre, "mark", "left"), "jaccard-mixed"))
    left, right = (rest.select("by_centre", "key", *[F.col(c).alias(f"{s}_{c}") for c in HELD])
                   for s in ("x", "y"))
    more = (left.join(right, ["by_centre", "key"]).where("x_rep < y_rep AND x_label <> y_label")
            .where(fits("x", "y", NUMERATOR, DENOMINATOR)).where(UNLIKE)
            .select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
    more = stored(possible(more, sketches), "jaccard-more")
    discard(rest)
    release(docs)
    late = stored(verified(more, fetched(both_ends(more))), "jaccard-late")
    release(docs)
    links = links.union(late)
    groups = components(links.select("a", "b"))
    tied = stored(of.join(groups.withColumnRenamed("id", "rep"), "rep", "left")
                  .select("doc_id", F.coalesce("label", "rep").alias("component_id")), "jaccard-tied")
    return sizes.select("doc_id", F.col("n").alias("n_shingles")).join(tied, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest doc_id of its component; rows without doc_id stay."""
    lost = stored(jaccard_components(docs).where("component_id <> doc_id").select("doc_id").distinct(), "jaccard-lost")
    release(docs)
    flag = free_name(docs, "_may_go")
    told = marked(docs, docs["doc_id"].cast("long"), lost, flag)  # only rows whose doc_id may go are moved
    stay = told.where(flag).drop(flag).join(lost, "doc_id", "left_anti").select(docs.columns)
    return told.where(~F.col(flag)).drop(flag).union(stay)
