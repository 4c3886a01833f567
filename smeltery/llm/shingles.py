"""Word shingles of whole batches of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Buffer, Iterable, Iterator

import numpy as np

SIZE = 5
#: Texts are hashed together up to this many bytes; one longer text is a batch of its own.
BATCH_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = [np.uint64(pow(_BASE, 3 * k + 2, 1 << 64)) for k in range(64)]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def scramble(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, BATCH_BYTES + 64), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and how many words each text has."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    up, down = _power_tables(len(data))
    solid = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:len(data)], out=sums[1:])
    words = scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, begins))


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words, the whole sequence as one."""
    words, counts = word_hashes(texts)
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled[:max(0, n - k)] += words[k:] * _STEP[k]
    rolled = scramble(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= size:
            found = np.sort(rolled[at:at + c - size + 1])
            out.append(found[np.flatnonzero(np.diff(found, prepend=found[0] ^ np.uint64(1)))])
        elif c:
            short = (words[at:at + c] * np.array(_STEP[:c])).sum(dtype=np.uint64, keepdims=True)
            out.append(scramble(short + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def batches(texts: Iterable[str | Buffer | None]) -> Iterator[tuple[int, list[Buffer]]]:
    """``(index of the first, UTF-8 texts)`` in runs of bounded size; null is empty, buffers are UTF-8 already."""
    run, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text if isinstance(text, Buffer) else b""
        if run and size + len(raw) > BATCH_BYTES:
            yield first, run
            run, size, first = [], 0, i
        run.append(raw)
        size += len(raw) + 1
    if run:
        yield first, run
