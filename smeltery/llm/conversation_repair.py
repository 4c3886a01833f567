"""Conversation repair: the cheapest edits that leave ``system? (user assistant)+``, by a run-length min-plus DP.

A row of a conversation is a symbol: the initial of its role and its fault. What
a symbol does to the state of the conversation is a 4 x 4 min-plus matrix; a run
of equal symbols is a power of it, put together from cached binary powers. The
costs are carried backwards over the runs, and the choices are then unrolled
forwards for the audit.

Rows are ranged over all tasks for the work on single rows, so a conversation of
any length is spread. Per conversation one task sees its runs, at most as many
as its audit has characters, and one task streams its texts, in order, through
SHA-256, which has no other way; it holds the audit and one batch.

Null roles and texts count as one space. Rows of one turn go by role and then by
the SHA-256 of their text, null turns first; equal rows follow each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import stored

# What an edit costs, what a kept truncated row adds, and the characters that are no text.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
#: The state that a row of the role expected next leads to.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = "sua"
_OK, _TRUNCATED, _BLANK, _DUPLICATE = range(4)
_FAR = 1 << 60
#: Rows of a run that are unrolled at a time.
_UNROLLED = 4096
_LARGEST = (1 << 63) - 1

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def symbol(initial: str, fault: int) -> int:
    return 4 * (_INITIALS.find(initial) if initial else -1) + fault + 4


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[x][k] + b[k][y] for k in _STATES) for y in _STATES) for x in _STATES)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[x][y] + v[y] for y in _STATES) for x in _STATES)


def _inserts() -> Matrix:
    one = tuple(tuple(0 if x == y else INSERT if y == _NEXT[x] else _FAR for y in _STATES) for x in _STATES)
    return _times(_times(one, one), one)


_INSERTS = _inserts()
#: What is left to pay in each state once all rows are used up.
_END = _apply(_INSERTS, (0, _FAR, _FAR, 0))


def _kept(sign: int, state: int) -> int | None:
    """The state after keeping the row as it is, if its role may follow."""
    initial = "?sua"[sign // 4]
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if _NEXT[state] == USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=None)
def edits(sign: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """Per state the ``(initial, cost, next state)`` of every edit of the row itself, in ASCII order."""
    fault = sign % 4
    out = []
    for state in _STATES:
        choices = [("D", DELETE, state)]
        if fault in (_OK, _TRUNCATED):
            extra = TRUNCATED if fault == _TRUNCATED else 0
            if _kept(sign, state) is not None:
                choices.append(("K", extra, _kept(sign, state)))
            choices.append(("R", REROLE + extra, _NEXT[state]))
        out.append(tuple(choices))
    return tuple(out)


@lru_cache(maxsize=None)
def power(sign: int, exponent: int) -> Matrix:
    """Transition over ``2 ** exponent`` rows of one symbol."""
    if exponent:
        half = power(sign, exponent - 1)
        return _times(half, half)
    row = tuple(tuple(min((c for _, c, y in edits(sign)[x] if y == to), default=_FAR) for to in _STATES) for x in _STATES)
    return _times(_INSERTS, row)


def before(sign: int, count: int, after: Vector) -> Vector:
    """What is left to pay before ``count`` rows of a symbol, given what is left after them."""
    exponent = 0
    while count:
        if count & 1:
            after = _apply(power(sign, exponent), after)
        count >>= 1
        exponent += 1
    return after


def _unroll(sign: int, count: int, after: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a run and the state they end in."""
    done: list[str] = []
    while count:
        block = min(count, _UNROLLED)
        left = [before(sign, count - block, after)]
        for _ in range(block):
            left.append(_apply(power(sign, 0), left[-1]))
        for i in range(block, 0, -1):
            here, then = left[i], left[i - 1]
            while True:
                name, state = _choice(sign, state, here, then)
                done.append(name)
                if name != "I":
                    break
        count -= block
    return "".join(done), state


def _choice(sign: int, state: int, here: Vector, then: Vector) -> tuple[str, int]:
    (name, cost, to), *rest = edits(sign)[state]
    if cost + then[to] == here[state]:
        return name, to
    if INSERT + here[_NEXT[state]] == here[state]:
        return "I", _NEXT[state]
    return next((name, to) for name, cost, to in rest if cost + then[to] == here[state])


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of ``(symbol, count)`` runs; no rows need no edits."""
    left = [_END]
    for sign, count in reversed(runs):
        left.append(before(sign, count, left[-1]))
    state, audit = START, []
    for (sign, count), after in zip(runs, reversed(left[:-1]), strict=True):
        done, state = _unroll(sign, count, after, state)
        audit.append(done)
    while _END[state]:
        audit.append("I")
        state = _NEXT[state]
    return left[-1][START], "".join(audit)


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def rows_of(conversations: DataFrame) -> DataFrame:
    """``(id, turn, role, text, digest)``, null roles and texts as one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                                F.unhex(F.sha2(text, 256)).alias("digest"))


def marked(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number and fault, texts left behind."""
    end = _trimmed(F.col("text"))
    fault = (F.when(end == "", _BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), _OK).otherwise(_TRUNCATED))
    distinct = (rows.select("id", "turn", "role", "digest", fault.cast("int").alias("fault"))
                .groupBy("id", "turn", "role", "digest", "fault").agg(F.count("*").alias("n")))
    kept = stored(distinct, "conversation-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (kept.groupBy("id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("places"))
             .where("places > 1").select(F.col("id").alias("i"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    joined = kept.join(first, F.col("id").eqNullSafe(F.col("i")) & (F.col("role") == F.col("r"))
                       & (F.col("digest") == F.col("d")), "left")
    seen = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    return stored(joined.select("id", "turn", "role", "digest", "fault", "n", seen.alias("seen")), "conversation-faults")


def _order() -> list[Column | str]:
    return [F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]


class _Segment:
    """Runs and turn counts of the rows of one conversation that one task holds."""

    def __init__(self, key, turn, role, digest):
        self.key, self.first = key, (turn is not None, turn if turn is not None else 0, role, digest)
        self.signs, self.counts = bytearray(), []
        self.low = self.high = None
        self.turns = 0

    def add(self, sign: int, count: int) -> None:
        if self.signs and self.signs[-1] == sign:
            self.counts[-1] += count
        elif count:
            self.signs.append(sign)
            self.counts.append(count)

    def see(self, turn) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1

    def line(self) -> tuple:
        known, turn, role, digest = self.first
        return self.key, known, turn, role, digest, bytes(self.signs), self.counts, self.low, self.high, self.turns


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation its gaps, faults, cost and audit."""
    faults = marked(rows)
    kind = faults.schema["id"].dataType.simpleString()
    names = ["id", "known", "start", "role", "digest", "signs", "counts", "low", "high", "turns"]
    shape = (f"id {kind}, known boolean, start bigint, role string, digest binary, signs binary, counts array<bigint>, "
             "low bigint, high bigint, turns bigint")
    types = [None, pa.bool_(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
             pa.int64(), pa.int64(), pa.int64()]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, id_type = None, [], None

        def out() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            id_type = batch.column(0).type
            for key, turn, role, digest, fault, n, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.line())
                    now = _Segment(key, turn, role, digest)
                now.see(turn)
                again = _BLANK if fault == _BLANK else _DUPLICATE
                now.add(symbol(role[:1], again if seen else fault), 1)
                now.add(symbol(role[:1], again), n - 1)
            if len(done) > 10_000:
                yield out()
                done = []
        if now is not None:
            done.append(now.line())
            yield out()

    ranged = faults.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    parts = ranged.mapInArrow(segments, shape).groupBy("id").agg(F.array_sort(F.collect_list(
        F.struct("known", "start", "role", "digest", "signs", "counts", "low", "high", "turns"))).alias("parts"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [_solved(parts) for parts in batch["parts"]]
            made = pd.DataFrame(out, columns=["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])
            made.insert(0, "place", batch["place"].to_numpy())
            yield made

    # The id itself stays in Spark: pandas would turn a nullable whole number into a double.
    held = stored(parts.withColumn("place", F.monotonically_increasing_id()), "conversation-runs")
    figures = held.select("place", "parts").mapInPandas(solve, (
        "place bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"))
    return held.select("id", "place").join(figures, "place").drop("place")


def _solved(parts) -> tuple:
    runs: list[tuple[int, int]] = []
    low = high = None
    turns = 0
    for part in parts:
        for sign, count in zip(part["signs"], part["counts"], strict=True):
            if runs and runs[-1][0] == sign:
                runs[-1] = (sign, runs[-1][1] + int(count))
            else:
                runs.append((int(sign), int(count)))
        if part["low"] is not None:
            turns += int(part["turns"]) - (high is not None and int(part["low"]) == high)
            low = int(part["low"]) if low is None else low
            high = int(part["high"])
    faults = [0] * 4
    illegal, last = 0, None
    for sign, count in runs:
        faults[sign % 4] += count
        initial = "?sua"[sign // 4]
        illegal += count - 1 + (last is not None and last + initial not in LEGAL)
        last = initial
    gaps = 0 if low is None else min(high - low + 1 - turns, _LARGEST)
    cost, audit = cheapest(runs)
    return gaps, faults[_BLANK], faults[_DUPLICATE], faults[_TRUNCATED], illegal, cost, audit


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _together(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's plan and then its rows in order, all in one partition."""
    rows = rows.select("id", F.lit(1).alias("kind"), "turn", "role", "text", "digest",
                       *[F.lit(None).cast(planned.schema[c].dataType).alias(c) for c in _FIGURES])
    heads = planned.select("id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                           F.lit(None).cast("binary").alias("digest"), *_FIGURES)
    order = [F.col("id").asc_nulls_first(), "kind", *_order()[1:]]
    return heads.unionByName(rows).repartition("id").sortWithinPartitions(*order).drop("turn", "digest")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(plan, None)`` at the start of each conversation, then ``(plan, (edit, role, text))`` per edit."""
    plan, audit, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield plan, ("I", _ROLE_OF[state], "")

    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        kinds = columns["kind"].to_pylist()
        for i, kind in enumerate(kinds):
            if kind == 0:
                yield from inserted()
                plan = {c: columns[c][i].as_py() for c in ("id", *_FIGURES)}
                audit, at, state = plan["audit"], 0, START
                yield plan, None
                continue
            yield from inserted()
            edit, role = audit[at], columns["role"][i].as_py()
            at += 1
            if edit == "K":
                state = _kept(symbol(role[:1], _OK), state)
            elif edit == "R":
                state = _NEXT[state]
                role = _ROLE_OF[state]
            yield plan, (edit, role, "" if edit == "D" else columns["text"][i].as_py())
    yield from inserted()


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the rows that are left or new, numbered from 0 per conversation.

    A conversation whose rows all go has no row here. Columns other than
    conv_id, turn, role and text are not read.
    """
    rows = rows_of(conversations)
    kind = rows.schema["id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen["type"] = batch.schema.field("id").type
                yield batch

        def out(lines: list[tuple]) -> pa.RecordBatch:
            kinds = [seen["type"], pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), kinds, strict=True)],
                                              ["conv_id", "place", "edit", "role", "text"])

        lines, place, held = [], 0, 0
        for plan, step in _walk(typed(batches)):
            if step is None:
                place = 0
            elif step[0] != "D":
                lines.append((plan["id"], place, *step))
                place, held = place + 1, held + len(step[2]) + 64
                if held > 8 << 20:
                    yield out(lines)
                    lines, held = [], 0
        if lines:
            yield out(lines)

    return _together(rows, plans(rows)).mapInArrow(write, f"conv_id {kind}, place bigint, edit string, role string, text string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Per conversation its figures, its audit and the digest of ``role:text`` of its repaired rows, newline-joined."""
    rows = rows_of(conversations)
    planned = plans(rows)
    shape = rows.select(F.col("id").alias("conv_id")).schema["conv_id"].dataType.simpleString()
    numbers = _FIGURES[:-1]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen["type"] = batch.schema.field("id").type
                yield batch

        def out(lines: list[tuple]) -> pa.RecordBatch:
            kinds = [seen["type"], *[pa.int64()] * len(numbers), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), kinds, strict=True)],
                                              ["conv_id", *_FIGURES, "repaired_sha256"])

        lines, sha, last, empty = [], None, None, True
        for plan, step in _walk(typed(batches)):
            if step is None:
                if sha is not None:
                    lines.append((*last.values(), sha.hexdigest()))
                sha, last, empty = hashlib.sha256(), plan, True
                if len(lines) > 10_000:
                    yield out(lines)
                    lines = []
            elif step[0] != "D":
                sha.update(f"{'' if empty else chr(10)}{step[1]}:{step[2]}".encode())
                empty = False
        if sha is not None:
            lines.append((*last.values(), sha.hexdigest()))
        if lines:
            yield out(lines)

    return _together(rows, planned).mapInArrow(
        digest, f"conv_id {shape}, {', '.join(f'{n} bigint' for n in numbers)}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``: 0 drops, 1 empties, 2 takes ``.!?`` out, 3 repeats, 4 is all user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = text_of("text")
    return (conversations.select("conv_id", "turn", text_of("role").alias("role"), text.alias("text"), draw.alias("draw"))
            .where("draw <> 0")
            .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """:func:`repair_report` of the damaged rows, with a row for every original conversation, null ids included."""
    report = repair_report(damaged(conversations))
    every = conversations.select(F.col("conv_id").alias("_id")).distinct()
    found = every.join(report, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return found.select(
        F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _FIGURES[:-1]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
