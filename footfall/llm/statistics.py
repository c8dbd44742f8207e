"""Statistics of a document's text, as columns for a classifier."""

from __future__ import annotations

import numpy as np

from .shingles import code_points, run_hashes

NAMES = (
    "log_chars log_words upper lower digit space symbol exclamation bar line_breaks non_ascii "
    "stops word_length long_words upper_words capital_words symbol_ends repeated_next "
    "distinct_words distinct_pairs distinct_triples top_word line_length distinct_lines "
    "word_spread symbol_words"
).split()

_kinds: dict[str, np.ndarray] = {}


def _kind(name: str) -> np.ndarray:
    """For each code point, whether it is of a kind."""
    if not _kinds:
        chars = [chr(c) for c in range(0x30000)]
        for kind, test in (
            ("upper", str.isupper),
            ("lower", str.islower),
            ("digit", str.isdigit),
            ("space", str.isspace),
            ("alnum", str.isalnum),
        ):
            table = np.zeros(0x110000, dtype=bool)
            table[: len(chars)] = [test(c) for c in chars]
            _kinds[kind] = table
    return _kinds[name]


def statistics(texts: list[str]) -> np.ndarray:
    """One row per text, one column per name. An empty text has zeros throughout."""
    points, begins = code_points(texts)
    n = np.diff(begins) - 1
    at = begins[:-1]

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), at) / np.maximum(of, 1)

    out = np.zeros((len(texts), len(NAMES)))
    put = {name: k for k, name in enumerate(NAMES)}
    upper, space, alnum = _kind("upper")[points], _kind("space")[points], _kind("alnum")[points]
    space[begins[1:] - 1] = True
    symbol = ~space & ~alnum
    breaks = points == 10
    breaks[begins[1:] - 1] = False
    own_space = space.copy()
    own_space[begins[1:] - 1] = False
    out[:, put["log_chars"]] = np.log1p(n)
    for name, mask in (
        ("upper", upper),
        ("lower", _kind("lower")[points]),
        ("digit", _kind("digit")[points]),
        ("space", own_space),
        ("symbol", symbol),
        ("exclamation", points == ord("!")),
        ("bar", points == ord("|")),
        ("line_breaks", breaks),
        ("non_ascii", points > 127),
        ("stops", points == ord(".")),
    ):
        out[:, put[name]] = share(mask, n)

    starts, ends, hashes = run_hashes(points, ~space)
    bounds = np.searchsorted(starts, begins)
    words = np.diff(bounds)
    out[:, put["log_words"]] = np.log1p(words)
    length = ends - starts
    uppers = np.concatenate(([0], np.cumsum(upper)))
    symbols = np.concatenate(([0], np.cumsum(symbol)))
    all_upper = (uppers[ends] - uppers[starts] >= 2) & (
        uppers[ends] - uppers[starts] + symbols[ends] - symbols[starts] == length
    )
    capital = upper[starts] if len(starts) else upper[:0]
    last = symbol[ends - 1] & (length > 1) & (points[ends - 1] != ord(".")) & (
        points[ends - 1] != ord(",")
    ) if len(starts) else symbol[:0]
    bare = symbols[ends] - symbols[starts] == length
    same = np.concatenate((hashes[1:] == hashes[:-1], [False])) if len(hashes) else symbol[:0]
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    triples = pairs[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[2:]
    lines = np.flatnonzero(points == 10)
    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if a == b:
            continue
        size = length[a:b]
        out[k, put["word_length"]] = size.mean()
        out[k, put["word_spread"]] = size.std()
        out[k, put["long_words"]] = (size > 12).mean()
        out[k, put["upper_words"]] = all_upper[a:b].mean()
        out[k, put["capital_words"]] = capital[a:b].mean()
        out[k, put["symbol_ends"]] = last[a:b].mean()
        out[k, put["symbol_words"]] = bare[a:b].mean()
        out[k, put["repeated_next"]] = same[a : b - 1].mean() if b - a > 1 else 0.0
        _, counts = np.unique(hashes[a:b], return_counts=True)
        out[k, put["distinct_words"]] = len(counts) / (b - a)
        out[k, put["top_word"]] = counts.max() / (b - a)
        out[k, put["distinct_pairs"]] = len(np.unique(pairs[a : b - 1])) / max(1, b - a - 1)
        out[k, put["distinct_triples"]] = len(np.unique(triples[a : max(a, b - 2)])) / max(1, b - a - 2)
    first, stop = np.searchsorted(lines, begins[:-1]), np.searchsorted(lines, begins[1:] - 1)
    for k, text in enumerate(texts):
        if text:
            count = stop[k] - first[k] + 1
            out[k, put["line_length"]] = np.log1p(n[k] / count)
            out[k, put["distinct_lines"]] = len(set(text.split("\n"))) / count
    return out
