"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Cut into one segment more than edits are allowed, a line shares at least one
whole segment with every line that near. Lines index their segments by length
and place; others probe them with the substrings that could have moved there.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import PLACES, components, discard, free_name, lower_ascii, release, stored, whole_text

EDITS = 2
#: Shorter lines are compared for equality only: a few edits would turn one into another.
SHORTEST = 30
#: Letters whose counts rule out pairs: an edit changes two counts by one at most. Sixteen counts modulo 16 share a number.
TALLIED = ("eanirtosludcmpgh",)
#: Bits of a count.
COUNT_BITS = 4


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """``(doc_id, at, raw, line)``: lines in order, and their form for comparing (trimmed, A-Z lower-cased); ``more`` columns stay."""
    opened = docs.select(F.col(key).alias("doc_id"), *more, F.posexplode(F.split(whole_text(text), "\n")).alias("at", "raw"))
    return opened.withColumn("line", compared(F.col("raw")))


def compared(raw: Column) -> Column:
    """The line trimmed and A-Z lower-cased; runs of other white space are one space. Most lines need no pattern and no table."""
    low = F.when(F.octet_length(raw) == F.length(raw), F.lower(raw)).otherwise(lower_ascii(raw))
    spaced = reduce(Column.__or__, [F.contains(raw, F.lit(c)) for c in "\t\n\x0B\x0C\r"])
    return F.trim(F.when(spaced, F.regexp_replace(low, r"[\x09-\x0D]+", " ")).otherwise(low))


def filled(lines: DataFrame) -> DataFrame:
    """Rows whose ``line`` is not empty, told from ``raw`` so that no line is made for it."""
    return lines.where(F.ltrim(F.col("raw"), F.lit(" \t\n\x0B\x0C\r")) != "")


def _cuts(less: int, edits: int) -> list[tuple[int, int]]:
    """``(segment, move)`` of the substrings that a line ``less`` shorter could have as its segments.

    If the first i segments hold all edits before the shared one, its text has
    moved by at most i; counted from the end, by at most edits - i off the
    difference of the lengths. Some segment is shared with both.
    """
    return [(i, move) for i in range(edits + 1) for move in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)]


def _marked(longs: DataFrame, less: int, cuts: Iterable[tuple[int, int]], edits: int) -> DataFrame:
    """``(line_id, n, mark)``: hashes of the lines' substrings that stand where a line ``less`` shorter has a segment.

    The segments are ``edits + 1`` of nearly equal length, the longer ones last. One difference of lengths at a time:
    code for all of them together is too long for the JVM to compile.
    """
    parts, n = edits + 1, F.col("n")
    sized = longs.where(n - less >= SHORTEST).select("line_id", "n", "line", F.expr(f"CAST((n - {less}) DIV {parts} AS INT)").alias("base"),
                                                     ((n - less) % parts).alias("over"))
    out = []
    for i, move in cuts:
        place = i * F.col("base") + F.greatest(F.lit(0), F.col("over") - (parts - i)) + 1 + move
        size = F.col("base") + F.when(F.col("over") >= parts - i, 1).otherwise(0)
        out.append(F.when((place >= 1) & (place + size - 1 <= n), F.xxhash64(n - less, F.lit(i), F.substring("line", place, size))))
    return sized.select("line_id", "n", F.explode(F.array(*out)).alias("mark")).where("mark IS NOT NULL")


def _among(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` is in the one column of ``wanted``, and a few others.

    A lookup of hashes in a bitmap of bounded size; no row moves. Null is no key.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES))
    words = (wanted.select(place(F.col(wanted.columns[0])).alias("_place")).groupBy((F.col("_place") / 64).cast("long").alias("_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_place % 64 AS INT))")).alias("_bits")))
    at = rows.withColumn("_at", place(key))
    return (at.join(F.broadcast(words), (F.col("_at") / 64).cast("long") == F.col("_word"))
            .where(F.getbit("_bits", (F.col("_at") % 64).cast("int")) == 1).select(*rows.columns))


def _tally(line: Column, n: Column, letters: str) -> Column:
    counts = [F.shiftleft((n - F.length(F.replace(line, F.lit(c), F.lit("")))).cast("long").bitwiseAND((1 << COUNT_BITS) - 1), COUNT_BITS * i)
              for i, c in enumerate(letters)]
    return reduce(Column.bitwiseOR, counts)


def tallied(lines: DataFrame) -> DataFrame:
    """``lines(line, n)`` with their letter counts."""
    return lines.withColumns({f"t{i}": _tally(F.col("line"), F.col("n"), letters) for i, letters in enumerate(TALLIED)})


def _apart(x: Column, y: Column) -> Column:
    """Sum of the differences of the counts, at most twice as many as the edits between the lines."""
    count = lambda z, i: F.shiftrightunsigned(z, COUNT_BITS * i).bitwiseAND((1 << COUNT_BITS) - 1)
    steps = [F.abs(count(x, i) - count(y, i)) for i in range(64 // COUNT_BITS)]
    return reduce(Column.__add__, [F.least(d, (1 << COUNT_BITS) - d) for d in steps])


def within_edits(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether ``a`` and ``b`` are at most ``edits`` edits apart, by a banded bit-parallel automaton.

    Word e of the state has a bit for each diagonal of the band: after j
    characters of ``b``, bit d tells whether the first j + d - edits characters
    of ``a`` are at most e edits from them. One character of ``b`` moves all
    diagonals at once, so a pair costs one step per character.
    """
    band = (1 << 2 * edits + 1) - 1

    def same(a: Column, c: Column, j: Column) -> Column:
        return reduce(Column.bitwiseOR, [F.when(F.get(a, j + F.lit(d - edits)) == c, F.lit(1 << d)).otherwise(F.lit(0))
                                         for d in range(2 * edits + 1)])

    def step(words: Column, equal: Column) -> Column:
        out = [words["w0"].bitwiseAND(equal)]
        for e in range(1, edits + 1):
            less = words[f"w{e - 1}"]
            moved = reduce(Column.bitwiseOR, [less, F.shiftright(less, 1), F.shiftleft(out[-1], 1)])
            out.append(words[f"w{e}"].bitwiseAND(equal).bitwiseOR(moved).bitwiseAND(F.lit(band)))
        return F.struct(*[w.alias(f"w{e}") for e, w in enumerate(out)])

    def fits(pair: Column) -> Column:
        start = F.struct(*[F.lit(((1 << e + 1) - 1) << edits).alias(f"w{e}") for e in range(edits + 1)])
        last = F.size(pair["a"]) - F.size(pair["b"]) + F.lit(edits)
        masks = F.transform(pair["b"], lambda c, j: same(pair["a"], c, j))
        end = lambda words: F.when(last.between(0, 2 * edits), F.getbit(words[f"w{edits}"], last)) == 1
        return F.aggregate(masks, start, step, end)

    # the pair is a lambda variable, so each line is split into characters once
    pair = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"))
    return F.coalesce(F.transform(F.array(pair), fits)[0], F.lit(False))  # null: too far apart in length


def near_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Links ``(a, b)`` between ``lines(line_id, line, n)`` at most ``edits`` edits apart, each once.

    Marks that only one line has are left out before any letter is counted: probes by a bitmap of the segments, the
    rest by grouping. Pairs whose letter counts are too far apart are left out as they are found,
    so lines that share a long passage and little else make few pairs.
    Verified exactly on whole lines by ``within_edits``.
    """
    longs = lines.where(f"n >= {SHORTEST}").select("line_id", "line", "n")
    still = [(i, 0) for i in range(edits + 1)]
    own = _marked(longs, 0, still, edits)
    shifted = [(less, cuts) for less in range(edits + 1) if (cuts := [c for c in _cuts(less, edits) if less or c not in still])]
    rows, probes = own.withColumn("own", F.lit(True)), None
    if shifted:
        moved = reduce(DataFrame.union, [_marked(longs, less, cuts, edits) for less, cuts in shifted])
        probes = stored(_among(moved, F.col("mark"), own.select("mark")), "line-probes")
        rows = rows.union(probes.withColumn("own", F.lit(False)))
    shared = stored(rows.groupBy("mark").agg(F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.max("own").alias("own"))
                    .where("own AND low <> high").select("mark"), "line-marks")
    met = stored(_among(rows, F.col("mark"), shared).join(shared, "mark", "left_semi").select("line_id", "n", "mark", "own"), "line-met")
    holders = stored(met.select("line_id").distinct(), "line-holders")
    known = stored(tallied(_among(longs, F.col("line_id"), holders).join(holders, "line_id", "left_semi")), "line-known")
    release(lines)
    tallies = [f"t{i}" for i in range(len(TALLIED))]
    told = met.join(known.select("line_id", *tallies), "line_id")
    index = told.where("own").drop("own")
    probe = told.select(F.col("line_id").alias("other"), F.col("n").alias("m"), *[F.col(t).alias(f"u{t}") for t in tallies], "mark")
    room = reduce(Column.__add__, [_apart(F.col(t), F.col(f"u{t}")) for t in tallies]) <= 2 * edits
    pairs = (index.join(probe, "mark").where(f"line_id <> other AND m >= n AND m - n <= {edits} AND (m > n OR line_id < other)")
             .where(room)
             .select(F.col("line_id").alias("a"), F.col("other").alias("b")).distinct())
    pairs = stored(pairs, "line-pairs")
    release(lines)
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct(), "line-wanted")
    some = stored(known.select("line_id", "line").join(wanted, "line_id", "left_semi"), "line-texts")
    text = lambda c: some.select(F.col("line_id").alias(c), F.col("line").alias(f"{c}_line"))
    links = stored(pairs.join(text("a"), "a").join(text("b"), "b")
                   .where(within_edits(F.col("a_line"), F.col("b_line"), edits)).select("a", "b"), "line-links")
    for used in (pairs, wanted, some, shared, met, holders, known, *([probes] if probes else [])):
        discard(used)
    release(lines)
    return links


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _placed(lines: DataFrame, edits: int) -> DataFrame:
    """``(digest, class_id, best, alone)`` of every line but empty ones: its class, the first line of that, and whether it occurs once and has no link."""
    firsts = filled(lines).groupBy("line").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("times"))
    known = stored(firsts.select(F.monotonically_increasing_id().alias("line_id"), "line",
                                 F.length("line").alias("n"), "first", "times"), "lines")
    release(lines)
    links = near_lines(known, edits)
    label = components(links, "line-components").withColumnRenamed("id", "line_id")
    linked = stored(known.select("line_id", "first").join(label, "line_id"), "line-classes")
    best = linked.groupBy("label").agg(F.min("first").alias("best"))
    told = stored(linked.join(best, "label").select("line_id", "label", "best"), "line-best")
    placed = stored(known.select("line_id", "first", "times", _digest(F.col("line")).alias("digest")).join(told, "line_id", "left").select(
        "digest", F.coalesce("label", "line_id").alias("class_id"), F.coalesce("best", "first").alias("best"),
        (F.col("label").isNull() & (F.col("times") == 1)).alias("alone")), "line-digests")
    for used in (known, links, linked, told):
        discard(used)
    release(lines)
    return placed


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """``(doc_id, at, raw, class_id, kept)`` for every line of every row of ``docs``.

    Lines are equal if trimmed and lower-cased (A-Z) they are; lines of at least
    ``SHORTEST`` characters are linked at up to ``edits`` edits, and links join
    into classes. The first line of a class, by doc_id and place, is kept.
    Empty lines have no class and are kept. A null text has one empty line.
    Rows with one doc_id are one document. Without any text all lines are kept.
    """
    lines = lines_of(docs, key, text)
    told = lines.withColumn("digest", F.when(F.col("line") != "", _digest(F.col("line"))))
    first = F.struct("doc_id", "at")
    return told.join(_placed(lines, edits).drop("alone"), "digest", "left").select(
        "doc_id", "at", "raw", "class_id", (F.col("best").isNull() | (F.col("best") == first)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_lines, n_kept, text)`` per document: the kept lines of ``line_classes`` in their order.

    Lines are decided by digest and place alone, and only the places that go
    move to their document, so each text is moved once as lines and once whole.
    Rows of one doc_id are told apart by a hash of their text.
    """
    of = free_name(docs, "_of")
    rows = docs.withColumn(of, F.xxhash64(whole_text(text)))
    placed = _placed(lines_of(docs, key, text), EDITS)
    told = filled(lines_of(rows, key, text, F.col(of).alias("of"))).select("doc_id", "of", "at", _digest(F.col("line")).alias("digest"))
    gone = stored(told.join(placed.where("NOT alone").select("digest", "best"), "digest")
                  .where(F.col("best") != F.struct("doc_id", "at")).select("doc_id", "of", "at"), "line-gone")
    discard(placed)
    release(docs)
    whole = rows.select(F.col(key).alias("doc_id"), F.col(of).alias("of"), whole_text(text).alias("text"), F.lit(None).cast("int").alias("at"))
    met = whole.union(gone.select("doc_id", "of", F.lit(None).cast("string"), "at")).repartition("doc_id")
    each = met.groupBy("doc_id", "of").agg(F.collect_list("text").alias("texts"), F.collect_set("at").alias("gone"))
    # places in a text are distinct, so those that stay keep their order
    stay = lambda t: F.array_except(F.sequence(F.lit(0), F.size(t) - 1), F.col("gone"))
    picked = lambda t: F.when(F.size("gone") == 0, F.transform(t, lambda raw, at: F.struct(at.alias("at"), raw.alias("raw")))).otherwise(
        F.transform(stay(t), lambda at: F.struct(at.alias("at"), F.get(t, at).alias("raw"))))
    each = each.select("doc_id", F.transform("texts", lambda t: F.split(t, "\n")).alias("texts"), "gone").select(
        "doc_id", F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.size(t)).alias("n"),
        F.flatten(F.transform("texts", picked)).alias("k"))
    kept = each.groupBy("doc_id").agg(F.sum("n").alias("n_lines"), F.flatten(F.collect_list("k")).alias("k"))
    return kept.select(F.col("doc_id").alias(key), "n_lines", F.size("k").cast("long").alias("n_kept"),
                       F.array_join(F.transform(F.array_sort("k"), lambda z: z["raw"]), "\n").alias("text"))
