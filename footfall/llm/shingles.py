"""Word shingles of texts as 64-bit hashes, computed with numpy over batches of texts."""

from __future__ import annotations

import numpy as np

WORDS = 5

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    at = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    return mixed(at * np.uint64(_STEP)) | np.uint64(1)


_POWERS = numbers(64, 1)
_PLACES = numbers(WORDS, 2)
_is_word: np.ndarray | None = None


def word_characters() -> np.ndarray:
    """For each code point, whether it belongs to a word: letters, digits, marks within them."""
    global _is_word
    if _is_word is None:
        _is_word = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool)
    return _is_word


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, each text followed by a line break, and where each text begins
    (with one more entry, the end)."""
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "replace"), "<u4")
    return points, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def spread_points(points: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """For each code point a hash of it and its place in its run, 0 outside runs. Sums of these
    over a run, or over its start, are hashes of the run or of its prefix."""
    starts, ends = runs(inside)
    at = np.flatnonzero(inside)
    place = (at - np.repeat(starts, ends - starts)) & 63
    out = np.zeros(len(points), dtype=np.uint64)
    out[at] = mixed(points[at].astype(np.uint64) * np.uint64(_STEP)) * _POWERS[place]
    return out


def run_hashes(points: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the runs."""
    starts, ends = runs(inside)
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    return starts, ends, mixed(np.add.reduceat(spread_points(points, inside), starts))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingles of each text. Words are runs of letters and digits in lower
    case; a text of one to four words has one shingle, all its words; one without words none."""
    points, begins = code_points([t.lower() for t in texts])
    starts, _, hashes = run_hashes(points, word_characters()[points])
    bounds = np.searchsorted(starts, begins)
    empty = np.empty(0, dtype=np.uint64)
    n = max(0, len(hashes) - WORDS + 1)
    grams = mixed(sum(hashes[k : k + n] * _PLACES[k] for k in range(WORDS))) if n else empty
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            whole = sum(hashes[a + k : a + k + 1] * _PLACES[k] for k in range(b - a))
            out.append(mixed(whole + np.uint64(b - a)))
        else:
            out.append(empty)
    return out


def minima(sets: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """MinHash values, one row per set (none of them empty), one column per seed."""
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), len(seeds)), dtype=np.uint64)
    for k, seed in enumerate(seeds):
        out[:, k] = np.minimum.reduceat((joined ^ (seed >> np.uint64(7))) * seed, starts)
    return out
