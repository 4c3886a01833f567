"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from smeltery.llm import conversation_repair as C

SPACES = " \t\n\x0b\x0c\r"


def best_repair(rows):
    """Cheapest, then ASCII-least edits of ``(role, text, fault)`` rows by a search that knows no runs and no states."""
    queue, seen = [(0, "", 0, ())], set()
    while queue:
        cost, audit, i, out = heapq.heappop(queue)
        roles = "".join(r[:1] if r else "?" for r, _ in out)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit, out
        tail = (i, roles[-1:], bool(roles))
        if tail in seen:
            continue
        seen.add(tail)
        options = [(2, "I", i, (role, "")) for role in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            options.append((3, "D", i + 1, None))
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                options.append((extra, "K", i + 1, (role, text)))
                options += [(2 + extra, "R", i + 1, (r, text)) for r in ("user", "assistant")]
        for price, name, place, line in options:
            more = out + ((line,) if line else ())
            so_far = "".join(r[:1] if r else "?" for r, _ in more)
            if re.fullmatch(r"(s?(ua)*u?)?", so_far):
                heapq.heappush(queue, (cost + price, audit + name, place, more))


def brute(rows):
    """Figures of one conversation from ``(turn, role, text)`` rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, out = best_repair([(r, x, f) for (_, r, x), f in zip(rows, faults)])
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def made(rng, size):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Fine.", "Fine.", "cut off", "", "  ", None, "Why?  ", "other!", "x.y", "\x85"]
    return [(rng.choice([None, *range(size + 3)]) if rng.random() < 0.3 else n, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0],
             rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}.") for n in range(size)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)


def by_conversation(rows):
    groups = {}
    for key, *row in rows:
        groups.setdefault(key, []).append(tuple(row))
    return groups


def test_report_equals_search(spark):
    rng = random.Random(11)
    rows = [(c, *r) for c in [*range(120), None, 9007199254740993] for r in made(rng, rng.randint(1, 9))]
    rows += rng.choices(rows, k=60)
    got = {r[0]: tuple(r)[1:] for r in C.repair_report(frame(spark, rows)).collect()}
    assert got == {key: brute(group) for key, group in by_conversation(rows).items()}


def test_long_runs_and_one_long_conversation(spark):
    rng = random.Random(12)
    rows = [(1, n, "user", f"u{n}.") for n in range(300)] + [(2, None, "user", "same.") for _ in range(200)]
    rows += [(3, n, ("user", "assistant")[n % 2], f"a{n}.") for n in range(500)]
    rows += [(4, n, rng.choice(["user", "assistant", "system"]), f"{n}") for n in range(400)]
    rows += [(5, 1, "user", "x" * 3_000_000), (5, 2, "assistant", "y" * 3_000_000 + ".")]
    got = {r[0]: tuple(r)[1:] for r in C.repair_report(frame(spark, rows)).collect()}
    assert got == {key: brute(group) for key, group in by_conversation(rows).items()}


def test_after_damage(spark):
    rng = random.Random(13)
    rows = [(c, *r) for c in range(60) for r in made(rng, rng.randint(1, 6))] + [(None, None, None, None), (77, 21, "user", "a.")]
    damage = []
    for key, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
        damage += [(key, turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    want = {key: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for key, *_ in rows}
    want |= {key: brute(group) for key, group in by_conversation(damage).items()}
    df = frame(spark, rows).withColumn("audit", F.lit(1)).withColumn("id", F.lit("x")).withColumn("kind", F.lit(2))
    got = {r[0]: tuple(r)[1:] for r in C.repaired_after_damage(df).collect()}
    assert got == want
    assert C.repaired_after_damage(df.limit(0)).count() == 0


def test_turns_are_the_digested_rows(spark):
    rng = random.Random(14)
    rows = [(c, *r) for c in range(30) for r in made(rng, rng.randint(1, 7))]
    df = frame(spark, rows)
    turns = {}
    for r in sorted(C.repaired_turns(df).collect(), key=lambda r: (r["conv_id"], r["place"])):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in C.repair_report(df).collect():
        text = "\n".join(turns.get(r["conv_id"], []))
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


@pytest.mark.parametrize("count", [1, 2, 3, 64, 4095, 4096, 4097, 20_000])
def test_powers_equal_steps(count):
    for sign in range(16):
        after = (0, 5, 3, 9)
        one_by_one = after
        for _ in range(count):
            one_by_one = C._apply(C.power(sign, 0), one_by_one)
        assert C.before(sign, count, after) == one_by_one
    cost, audit = C.cheapest([(C.symbol("u", 0), count)])
    assert len(audit.replace("I", "")) == count and C.before(C.symbol("u", 0), count, C._END)[0] == cost
