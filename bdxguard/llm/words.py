"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than space, tab, newline, vertical tab, form
feed and carriage return; A-Z are lower-cased.  All of these are single bytes
in UTF-8, so working on bytes gives the words of the code points.

Word hash: polynomial over random byte values, taken from prefix sums, then
mixed.  Two different strings share a 64-bit hash with a chance of about 2^-64
per pair; callers that need exact answers about hashes state that chance.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_CASED = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (multiply, xor, shift)."""
    x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x1) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = 1 << max(n, 1 << 12).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each text."""
    n = len(data)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    before |= edge[:-1]
    starts = np.flatnonzero(inside & before)
    before[:-1] = ~inside[1:]
    before[-1] = True
    before |= edge[1:]
    ends = np.flatnonzero(inside & before) + 1
    counts[:] = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cased: bool = False) -> np.ndarray:
    """Hash of each byte span; spans are in order of their starts. Worked through in windows of 1 MB."""
    out = np.empty(len(starts), np.uint64)
    table = _CASED if cased else _BYTE
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + _WINDOW))
        b = int(ends[i:j].max())
        up, down = _power(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        h = (sums[e] - sums[s]) * down[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    starts, ends, counts = word_spans(data, offsets)
    return span_hashes(data, starts, ends), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``size`` words of each text (with repeats), and how many each has.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    n = len(words)
    per = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    if n == 0:
        return np.zeros(0, np.uint64), per
    firsts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=firsts[1:])
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    sums = padded[:n] * _PLACE[0]
    for k in range(1, size):
        sums += padded[k:n + k] * _PLACE[k]
    keep = np.ones(n, bool)
    tail = np.flatnonzero(counts >= size)
    for k in range(1, size):
        keep[firsts[tail + 1] - k] = False
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        a, c = firsts[d], counts[d]
        keep[a + 1:a + c] = False
        sums[a] = np.append(words[a:a + c], np.uint64(c)).astype(np.uint64).dot(np.append(_PLACE[:c], _PLACE[15]))
    return mix(sums[keep]), per


def split(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The flat array cut into one array per text."""
    ends = np.cumsum(counts)
    return [values[e - c:e] for e, c in zip(ends.tolist(), np.asarray(counts).tolist(), strict=True)]
