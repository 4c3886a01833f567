"""Personal data: base patterns, and a character BiLSTM with CRF transitions that adds spans.

The tagger is trained in numpy on spans the base patterns find, as they stand
and in forms the patterns miss, in their own and in other surroundings. It reads
every character of a text in overlapping windows. A character takes its scores
from the window in which it lies farthest from an edge, and the path of tags is
decoded over the text as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: Length and step of the overlapping windows, and how many are scored together.
WINDOW, STRIDE, TOGETHER = 128, 104, 640
#: Steps from either edge within which a window inside a text has all the characters it answers for.
INNER = WINDOW - (WINDOW - STRIDE) // 2
#: Characters of texts that may wait for their windows to be scored.
WAITING = 1 << 21
#: Bound of the fit: windows with spans, windows without any, of each document at most.
WITH_SPANS, BARE, PER_DOCUMENT = 1200, 1200, 3
#: Windows made of these to learn from, steps of the fit, windows a step.
LESSONS, STEPS, BATCH = 6000, 1000, 32
HIDDEN, EMBED = 14, 8
#: Mean probability from which a tagged span is added.
SURE = 0.8

_TRIGGER = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

_GROUPS = ("0123456789", "@", ".", "-", "+", "_", "%", "(", ")", "[", "]", "{", "}", "/", ":", ",", " ",
           "\t\n\v\f\r", "\"'`", *(c + c.upper() for c in "abcdefghijklmnopqrstuvwxyz"))
#: Class of each code point: its group, other ASCII, or anything else.
_CLASS = np.full(129, len(_GROUPS), np.uint8)
for _i, _set in enumerate(_GROUPS):
    for _c in _set:
        _CLASS[ord(_c)] = _i
_CLASS[128] = len(_GROUPS) + 1
PAD, CLASSES = len(_GROUPS) + 2, len(_GROUPS) + 3


def _luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped; in linear time."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        head = text[end:m.start()]
        start = m.start() - (len(head) - len(head.rstrip(_LOCAL)))
        if start < m.start():
            out.append(("email", start, m.end()))
            end = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def windows(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows over ``n`` characters, and the range of characters that each one answers for."""
    starts = np.append(np.arange(0, n - WINDOW, STRIDE), max(0, n - WINDOW))
    middle = (starts[1:] + starts[:-1] + WINDOW) // 2
    return starts, np.append(0, middle), np.append(middle, n)


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(codes, 128)]


class Tagger:
    """Character BiLSTM with CRF transitions over the tags none, email, ip, card, phone.

    Before the first and behind the last character stands none. Arrays go by
    character, direction, feature and window, so all windows step together.
    """

    def __init__(self, seed: int = 0):
        rng, k = np.random.default_rng(seed), len(KINDS) + 1
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[-1]), s)
        # columns of w: embedding, state, constant; rows: input, forget, output gate, update
        w = draw(2, 4 * HIDDEN, EMBED + HIDDEN + 1)
        w[:, :, -1] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        p = {"emb": rng.normal(0, 0.5, (EMBED, CLASSES)), "w": w, "out": draw(k, 2 * HIDDEN), "bias": np.zeros((k, 1)),
             "trans": np.zeros((k, k))}
        self.p = {n: v.astype(np.float32) for n, v in p.items()}

    def _run(self, chars: np.ndarray, tape: list | None = None, steps: int | None = None) -> np.ndarray:
        """States of both directions as (character, feature, window), twice as large without a tape, which keeps what the gradient needs.

        With fewer ``steps`` than characters each direction stops short of the far edge, and only the states of the
        characters that both have reached are there.
        """
        (b, t), f = chars.shape, np.float32
        w = self.p["w"] * np.repeat([0.5, 0.5, 0.5, 1.0], HIDDEN).astype(f)[:, None]  # sigmoids by way of tanh
        if tape is None:
            w[:, :, EMBED:-1] *= f(0.5)  # states are kept twice as large: gates of 0 to 2 need no halving, and halves and doubles are exact
        x = np.take(self.p["emb"], chars.T.ravel(), axis=1).reshape(EMBED, t, b)
        z, c = np.zeros((2, EMBED + HIDDEN + 1, b), f), np.zeros((2, HIDDEN, b), f)
        z[:, -1] = 1
        h, g, e = z[:, EMBED:-1], np.empty((2, 4 * HIDDEN, b), f), np.empty((2, HIDDEN, b), f)
        gates, a, forget, o, u = g[:, :3 * HIDDEN], *(g[:, i * HIDDEN:(i + 1) * HIDDEN] for i in range(4))
        hs = np.empty((t, 2 * HIDDEN, b), f)
        steps = t if steps is None else steps
        for i in range(steps):
            z[0, :EMBED], z[1, :EMBED] = x[:, i], x[:, t - 1 - i]
            np.matmul(w, z, out=g)
            np.tanh(g, out=g)
            if tape is None:
                gates += f(1)
                a *= u
                c *= forget
                c += a
                c *= f(0.5)
                np.tanh(c, out=e)
                np.multiply(o, e, out=h)
            else:
                gates *= f(0.5)
                gates += f(0.5)
                tape.append((z.copy(), g.copy(), c.copy()))
                a *= u
                c *= forget
                c += a
                np.tanh(c, out=e)
                tape[-1] += (e.copy(),)
                np.multiply(o, e, out=h)
            hs[i, :HIDDEN], hs[t - 1 - i, HIDDEN:] = h[0], h[1]
        return hs[t - steps:steps]

    def scores(self, chars: np.ndarray, steps: int | None = None) -> np.ndarray:
        """Scores of the tags as (character, tag, window), without the characters near an edge that ``steps`` leave out."""
        out = np.matmul(self.p["out"] * np.float32(0.5), self._run(chars, steps=steps))
        out += self.p["bias"]
        return out

    def beliefs(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithm of the sum over all paths, probabilities of the tags, and of the pairs; ``scores`` go by stretch, character, tag."""
        b, t, k = scores.shape
        high = scores.max(2, keepdims=True)
        q, trans = np.exp(scores - high).transpose(1, 0, 2).astype(float), np.exp(self.p["trans"].astype(float))
        ahead, behind, norm = np.empty((t, b, k)), np.empty((t, b, k)), np.empty((t, b, 1))
        last = trans[:1]
        for i in range(t):
            now = last * q[i]
            norm[i] = now.sum(1, keepdims=True)
            ahead[i] = now / norm[i]
            last = ahead[i] @ trans
        behind[-1] = trans[:, 0]
        for i in range(t - 1, 0, -1):
            now = (q[i] * behind[i]) @ trans.T
            behind[i - 1] = now / now.sum(1, keepdims=True)
        total = np.log(norm).sum((0, 2)) + high.sum((1, 2)) + np.log(ahead[-1] @ trans[:, 0])
        prob = ahead * behind
        prob /= prob.sum(2, keepdims=True)
        pair = ahead[:-1, :, :, None] * trans * (q * behind)[1:, :, None]
        pair /= pair.sum((2, 3), keepdims=True)
        return total, prob.transpose(1, 0, 2), pair

    def gradient(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean loss of the windows, and its derivatives."""
        (b, t), p, tape = chars.shape, self.p, []
        hs = self._run(chars, tape)
        scores = (np.matmul(p["out"], hs) + p["bias"]).transpose(2, 0, 1)
        total, prob, pair = self.beliefs(scores)
        closed = np.pad(tags, ((0, 0), (1, 1)))
        hot = np.eye(len(KINDS) + 1)[tags]
        loss = float((total - (scores * hot).sum((1, 2)) - p["trans"][closed[:, :-1], closed[:, 1:]].sum(1)).mean())
        trans = pair.sum((0, 1))
        trans[0] += prob[:, 0].sum(0)
        trans[:, 0] += prob[:, -1].sum(0)
        np.subtract.at(trans, (closed[:, :-1].ravel(), closed[:, 1:].ravel()), 1)
        ds = ((prob - hot) / b).astype(np.float32).transpose(1, 2, 0)
        grad = {"trans": trans / b, "bias": ds.sum((0, 2))[:, None], "out": np.tensordot(ds, hs, ((0, 2), (0, 2)))}
        far = np.matmul(p["out"].T, ds)
        z, g, old, e = (np.stack(part) for part in zip(*tape, strict=True))
        a, forget, o, u = (g[:, :, i * HIDDEN:(i + 1) * HIDDEN] for i in range(4))
        # what each gate hands on of the derivative of the cell (of the state for the output gate)
        slope = np.concatenate([u * a * (1 - a), old * forget * (1 - forget), e * o * (1 - o), a * (1 - u * u)], 2)
        through, dg = o * (1 - e * e), np.empty_like(g)
        dh, dc, back = np.zeros((2, HIDDEN, b), np.float32), np.zeros((2, HIDDEN, b), np.float32), p["w"][:, :, EMBED:-1].transpose(0, 2, 1).copy()
        for i in range(t - 1, -1, -1):
            dh[0] += far[i, :HIDDEN]
            dh[1] += far[t - 1 - i, HIDDEN:]
            dc += dh * through[i]
            by = np.concatenate([dc, dc, dh, dc], 1)
            np.multiply(by, slope[i], out=dg[i])
            np.matmul(back, dg[i], out=dh)
            dc *= forget[i]
        grad["w"] = np.stack([np.tensordot(dg[:, d], z[:, d], ((0, 2), (0, 2))) for d in (0, 1)])
        dx = np.matmul(p["w"][:, :, :EMBED].transpose(0, 2, 1), dg)
        dx = (dx[:, 0] + dx[::-1, 1]).transpose(1, 0, 2).reshape(EMBED, -1)
        flat = chars.T.ravel()
        grad["emb"] = np.stack([np.bincount(flat, row, CLASSES) for row in dx])
        return loss, grad

    def train(self, chars: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 0, rate: float = 0.02) -> float:
        """Adam over batches drawn without replacement until all have had their turn, with a falling rate.

        The number of steps is fixed, so a small table is learned as long as a
        large one. The mean loss of the last tenth of the steps.
        """
        rng, losses, order = np.random.default_rng(seed), [], np.zeros(0, np.int64)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        s = {n: np.zeros_like(v) for n, v in self.p.items()}
        for step in range(1, steps + 1):
            while len(order) < min(BATCH, len(chars)):
                order = np.append(order, rng.permutation(len(chars)))
            some, order = order[:BATCH], order[BATCH:]
            loss, grad = self.gradient(chars[some], tags[some])
            losses.append(loss)
            pace = rate * (1 - 0.95 * step / steps)
            for n, g in grad.items():
                g = np.clip(g, -1, 1)
                m[n], s[n] = 0.9 * m[n] + 0.1 * g, 0.99 * s[n] + 0.01 * g * g
                self.p[n] -= pace * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(s[n] / (1 - 0.99 ** step)) + 1e-8)
        return float(np.mean(losses[-max(1, steps // 10):]))

    def best_paths(self, scores: np.ndarray) -> np.ndarray:
        """The best path of tags in each of many stretches, none standing on both sides."""
        n, t, _ = scores.shape
        trans, rows = self.p["trans"], np.arange(n)
        best, came = scores[:, 0] + trans[0], np.zeros(scores.shape, np.int8)
        for i in range(1, t):
            every = best[:, :, None] + trans
            came[:, i], best = every.argmax(1), every.max(1) + scores[:, i]
        path = np.zeros((n, t), np.int8)
        path[:, -1] = (best + trans[:, 0]).argmax(1)
        for i in range(t - 1, 0, -1):
            path[:, i - 1] = came[rows, i, path[:, i]]
        return path

    def likely(self, e: np.ndarray) -> np.ndarray:
        """Which characters of a text can have a tag on a best path, by their scores as (character, tag).

        A tagged stretch gains over none at most the sum of its characters' best
        differences, with the best transitions. A character has a tag only if some
        stretch around it does not lose: the highest sum up to a place from it on,
        less the lowest up to a place before it.
        """
        t = self.p["trans"].astype(float)
        step = t[1:, 1:].max() - t[0, 0]
        doors = t[0, 1:].max() + t[1:, 0].max() - t[0, 0] - step
        best = reduce(np.maximum, e[:, 1:].T)
        sums = np.append(0.0, np.cumsum((best - e[:, 0]).astype(float) + step))
        return np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1]) + doors >= -1e-6

    def stretches(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, first character, scores) of the runs of characters that may have a tag; all others have none.

        Windows of several texts are scored together; the scores of a text are
        kept until its last window is done.
        """
        # windows inside a text answer for their middle alone, so both directions may stop at its ends
        jobs, open_texts, left = {INNER: [], WINDOW: []}, {}, {}

        def score(steps: int) -> None:
            some, skipped = jobs[steps], WINDOW - steps
            chars = np.full((len(some), WINDOW), PAD, np.uint8)
            for row, (_, s, _, _, codes) in zip(chars, some, strict=True):
                part = codes[s:s + WINDOW]
                row[:len(part)] = part
            e = np.ascontiguousarray(self.scores(chars, steps).transpose(2, 0, 1))
            for window, (no, s, lo, hi, _) in zip(e, some, strict=True):
                open_texts[no][lo:hi] = window[lo - s - skipped:hi - s - skipped]
                left[no] -= 1
            some.clear()

        def finished() -> Iterator[tuple[int, int, np.ndarray]]:
            for no in [n for n, more in left.items() if not more]:
                e = open_texts.pop(no)
                del left[no]
                likely = self.likely(e)
                if not likely.any():
                    continue
                edge = np.flatnonzero(np.diff(likely.astype(np.int8), prepend=0, append=0))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    yield no, a, e[a:b].copy()

        waiting = 0
        for no, text in enumerate(texts):
            if not text:
                continue
            codes = classes(text)
            open_texts[no] = np.empty((len(codes), len(KINDS) + 1), np.float32)
            spans = list(zip(*(part.tolist() for part in windows(len(codes))), strict=True))
            left[no] = len(spans)
            waiting += len(codes)
            for s, lo, hi in spans:
                steps = INNER if WINDOW - INNER <= lo - s and hi - s <= INNER else WINDOW
                jobs[steps].append((no, s, lo, hi, codes))
                if len(jobs[steps]) == TOGETHER:
                    score(steps)
            if waiting >= WAITING:  # few windows at edges, and long texts: none waits until they are many
                for steps in jobs:
                    if jobs[steps]:
                        score(steps)
                waiting = 0
            yield from finished()
        for steps in jobs:
            if jobs[steps]:
                score(steps)
        yield from finished()

    def tag(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Sure spans of each whole text, confirmed by what they hold."""
        out: list[list] = [[] for _ in texts]
        runs = sorted(self.stretches(texts), key=lambda r: len(r[2]))
        while runs:
            # of like length together, as many as fit a bounded table
            longest = len(runs[-1][2])
            some = runs[-max(1, 2 ** 14 // longest):]
            del runs[-len(some):]
            scores = np.full((len(some), longest, len(KINDS) + 1), -1e9)
            scores[:, :, 0] = 0
            for row, (_, _, e) in zip(scores, some, strict=True):
                row[:len(e)] = e
            paths = self.best_paths(scores)
            held = np.flatnonzero(paths.any(1))
            sure = self.beliefs(scores[held])[1] if len(held) else []
            for j, chance in zip(held, sure, strict=True):
                no, first, _ = some[j]
                edge = np.flatnonzero(np.diff(paths[j], prepend=0, append=0))
                for x, y in zip(edge[:-1], edge[1:], strict=True):
                    kind = paths[j][x]
                    if kind and chance[x:y, kind].mean() >= SURE:
                        span = whole(KINDS[kind - 1], texts[no], first + int(x), first + int(y))
                        if span and span not in out[no]:
                            out[no].append(span)
        return [apart(spans) for spans in out]


def apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in order, without those that begin inside an earlier one."""
    out: list = []
    for span in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


_DIGITS = re.compile(r"[0-9]+")
_DOT = re.compile(r"[A-Za-z0-9](?:\s*\.\s*|[^A-Za-z0-9]+dot[^A-Za-z0-9]+)[A-Za-z0-9]", re.IGNORECASE)
_AT = re.compile(r"@|(?<![A-Za-z])at(?![A-Za-z])", re.IGNORECASE)


def whole(kind: str, text: str, x: int, y: int) -> tuple[str, int, int] | None:
    """The tagged stretch grown to whole names or numbers; None where it cannot be of its kind.

    An address has an ``at``, then names with a dot between them, an ip four parts up to 255, a card 14 to 19
    digits that pass Luhn, a phone 9 to 15 digits and no letters.
    """
    body = _LOCAL if kind == "email" else "0123456789"
    while x < y and (text[x].isspace() or text[x] in ",;:.!?-)]}\"'"):
        x += 1
    while x < y and (text[y - 1].isspace() or text[y - 1] in ",;:.!?-([{\"'"):
        y -= 1
    if x == y:
        return None
    if text[x] in body:
        while x and text[x - 1] in body:
            x -= 1
    if text[y - 1] in body:
        while y < len(text) and text[y] in body:
            y += 1
        while text[y - 1] in ".-":
            y -= 1
    piece = text[x:y]
    digits = "".join(found := _DIGITS.findall(piece))
    if kind == "email":
        fits = (m := _AT.search(piece)) and any(map(str.isalnum, piece[:m.start()])) and _DOT.search(piece, m.end())
    elif kind == "ip":
        fits = len(found) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found)
    elif kind == "card":
        fits = 14 <= len(digits) <= 19 and _luhn(digits)
    else:
        fits = 9 <= len(digits) <= 15 and not any(map(str.isalpha, piece))
    return (kind, x, y) if fits else None


def rewritten(kind: str, piece: str, rng) -> str:
    """The span as the base patterns would not find it."""
    if kind == "email" and rng.random() < 0.4:  # spelled out as one says it
        return piece.replace(".", " dot ").replace("@", " at ")
    if kind == "email":
        at = rng.choice([" @ ", "@ ", " @", " at ", " at ", " at ", " AT ", "(at)", "[at]", " (at) ", " [at] ", "{at}"])
        dot = rng.choice([" dot ", " dot ", "[dot]", "(dot)", " . ", " [dot] "] if "@" not in at else [".", " . ", " dot "])
        local, _, domain = piece.partition("@")
        return (local.replace(".", dot) if "dot" in dot and rng.random() < 0.7 else local) + at + domain.replace(".", dot)
    if kind == "ip":
        return piece.replace(".", rng.choice(["[.]", " . ", "(.)", " dot ", "[dot]", "(dot)"]))
    if kind == "card":
        return rng.choice([".", "/", "_", "  ", " - "]).join(re.findall(r"[0-9]{1,4}", piece.replace(" ", "").replace("-", "")))
    bare = re.sub(r"^\+[0-9]+[ .-]*", "", piece)
    return rng.choice([piece[1:], "00" + piece[1:], bare, bare.replace(" ", "."), piece.replace(" ", " / "), "00 " + piece[1:]])


def varied(kind: str, piece: str, words: list[str], rng) -> str:
    """Another span of the same shape: other digits, other names."""
    if kind == "ip":
        return ".".join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == "email":
        local, _, domain = piece.partition("@")
        pick = lambda: re.sub(r"[^a-z0-9]", "", words[rng.integers(len(words))].lower()) or "post"
        names = lambda part: re.sub(r"[A-Za-z]+", lambda _: pick(), part)
        head, _, last = domain.rpartition(".")
        if rng.random() < 0.5:
            local = rng.choice([".", ".", "_", "-"]).join(pick() for _ in range(rng.integers(1, 4)))
            head = ".".join(pick() for _ in range(rng.integers(1, 4)))
        return f"{names(local)}@{names(head)}.{last if rng.random() < 0.5 else rng.choice(['com', 'org', 'net', 'edu', 'de', 'io'])}"
    if kind == "phone" and rng.random() < 0.4:
        groups = [rng.integers(1, 4), *rng.integers(2, 8, rng.integers(2, 4))]
        return "+" + " ".join("".join(map(str, rng.integers(0, 10, n))) for n in groups)
    return re.sub(r"[0-9]", lambda _: str(rng.integers(0, 10)), piece)


def missed_form(text: str, spans: list[tuple[str, int, int]], rng) -> tuple[str, list[tuple[str, int, int]]]:
    """The same text with its spans written as the base patterns would not find them."""
    return replaced(text, spans, lambda kind, piece: rewritten(kind, piece, rng))


def replaced(text: str, spans: list[tuple[str, int, int]], by) -> tuple[str, list[tuple[str, int, int]]]:
    out, new, at = "", [], 0
    for kind, a, b in spans:
        if a < at:
            continue
        piece = by(kind, text[a:b])
        out += text[at:a]
        new.append((kind, len(out), len(out) + len(piece)))
        out, at = out + piece, b
    return out + text[at:], new


def lessons(pieces: list[tuple[str, list]], bare: list[str], n: int, seed: int = 0) -> list[tuple[str, list]]:
    """``n`` windows to learn from: spans of every kind alike, as found or rewritten, where they stood or elsewhere.

    A quarter hold no span.
    """
    rng, out = np.random.default_rng(seed), []
    pool = {k: [p[a:b] for p, spans in pieces for kind, a, b in spans if kind == k] for k in KINDS}
    kinds = [k for k in KINDS if pool[k]]
    words = [w for t in [*bare, *(p for p, _ in pieces)] for w in t.split() if w.isalpha()] or ["name"]
    for _ in range(n):
        lot = rng.random()
        if lot < 0.25 and bare:
            out.append((bare[rng.integers(len(bare))], []))
            continue
        if lot < 0.5 or not bare:
            text, spans = pieces[rng.integers(len(pieces))]
        else:
            kind = kinds[rng.integers(len(kinds))]
            text = bare[rng.integers(len(bare))][:int(rng.integers(20, 76))]
            gaps = [0, *(m.end() for m in re.finditer(r"\s", text)), len(text)]
            at = gaps[rng.integers(len(gaps))]
            piece, tail = pool[kind][rng.integers(len(pool[kind]))], rng.choice([" ", " ", ", ", ". ", "\n", ") "])
            head = text[:at] + ("" if not at or text[at - 1].isspace() else " ")
            text, spans = head + piece + tail + text[at:], [(kind, len(head), len(head) + len(piece))]
        other, odd = rng.random() < 0.7, rng.random() < 0.7
        out.append(replaced(text, spans, lambda k, p: (lambda q: rewritten(k, q, rng) if odd else q)(varied(k, p, words, rng) if other else p)))  # noqa: B023
    return out


def _examples(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows with their spans, and one without any, to learn from; whose key sets the places."""
    for batch in rows:
        found = []
        for key, text in zip(batch["key"], batch["text"], strict=True):
            if not text:
                continue
            spans = base_spans(text)
            rng = np.random.default_rng(key % 2 ** 32)
            for _, x, y in spans[:PER_DOCUMENT]:
                a = max(0, x - int(rng.integers(8, 40)))
                b = min(len(text), a + WINDOW * 3 // 4)
                inside = [(k, i - a, j - a) for k, i, j in spans if a <= i and j <= b]
                whole_ends = all(not (i < a < j or i < b < j) for _, i, j in spans)
                if inside and whole_ends:
                    found.append((key, text[a:b], written(inside)))
            m = _TRIGGER.search(text, int(rng.integers(len(text)))) if rng.random() < 0.3 else None
            a = max(0, m.start() - 40) if m else int(rng.integers(max(1, len(text) - WINDOW)))
            b = min(len(text), a + WINDOW)
            if all(j <= a or i >= b for _, i, j in spans):
                found.append((key, text[a:b], ""))
        if found:
            yield pd.DataFrame(found, columns=["key", "piece", "spans"])


def parsed(spans: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def encode(pieces: list[tuple[str, list]]) -> tuple[np.ndarray, np.ndarray]:
    chars, tags = np.full((len(pieces), WINDOW), PAD), np.zeros((len(pieces), WINDOW), np.int64)
    for i, (text, spans) in enumerate(pieces):
        coded = classes(text)[:WINDOW]
        chars[i, :len(coded)] = coded
        for kind, a, b in spans:
            tags[i, a:b] = KINDS.index(kind) + 1
    return chars, tags


def fit(docs: DataFrame, seed: int = 0) -> Tagger | None:
    """A tagger trained on a bounded sample of windows; None where no text has a span."""
    keyed = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), "text")
    rows = (keyed.mapInPandas(_examples, "key long, piece string, spans string")
            .withColumn("bare", F.col("spans") == ""))
    rows = stored(rows, "pii-windows")  # both kinds are chosen from one pass over the texts
    some = [rows.where(f"bare = {b}").orderBy("key", "piece").limit(n) for b, n in (("false", WITH_SPANS), ("true", BARE))]
    seen = [(r["piece"], parsed(r["spans"])) for r in some[0].union(some[1]).collect()]
    pieces, bare = [p for p in seen if p[1]], [t for t, spans in seen if not spans]
    if not pieces:
        return None
    tagger = Tagger(seed)
    tagger.train(*encode(lessons(pieces, bare, LESSONS, seed)), seed=seed)
    return tagger


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` for every row of ``docs``.

    Base patterns and tagger read every character of a text. While a text is
    tagged its task keeps about 50 bytes for each of its characters.

    The counts and the digest are those of the base spans; ``spans`` lists them
    and the added ones, which never overlap a base span. A null text is empty.
    Equal rows have equal results; extra columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    found = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "n_added"]

    # Only texts go to Python: pandas would turn a nullable whole number into a double.
    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch]
            base = [base_spans(t) if _TRIGGER.search(t) else [] for t in texts]
            distinct = list(dict.fromkeys(texts))
            tagged = dict(zip(distinct, shared.value.tag(distinct), strict=True)) if shared.value else {}
            added = [tagged.get(t, []) for t in texts]
            more = [[s for s in new if not any(s[1] < b and a < s[2] for _, a, b in old)]
                    for new, old in zip(added, base, strict=True)]
            out = {f"n_{k}": [sum(s[0] == k for s in spans) for spans in base] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(written(s).encode()).hexdigest() for s in base]
            out["spans"] = [written(a + b) for a, b in zip(base, more, strict=True)]
            out["n_added"] = [len(m) for m in more]
            yield pd.DataFrame(out)

    scanned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text")).alias("found"))
    return scanned.select("doc_id", *[F.col(f"found.{c}").alias(c) for c in found])
