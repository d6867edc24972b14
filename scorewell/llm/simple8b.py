"""Simple-8b: integers in 64-bit words, four bits of selector and 60 of values.

A selector names how many values a word holds and how wide each is.
Values of 2**60 or more do not fit: selector 0 marks their place and the
value itself stands in the escape list.  Both directions run on whole
blocks with numpy; only the walk from one word's first value to the next
word's is a loop.
"""

from __future__ import annotations

import numpy as np

# Fixed values: (values in a word, bits of each), selectors 1 to 14.
LAYOUT = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
          (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))

_U = np.uint64
_COUNTS = np.array([1] + [k for k, _ in LAYOUT], np.int64)
_LIMITS = np.array([(1 << w) - 1 for _, w in LAYOUT], np.uint64)
_ESCAPE = len(LAYOUT)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of non-negative integers below 2**64."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    width = np.searchsorted(_LIMITS, values).astype(np.uint8)  # narrowest layout of each value
    best = np.minimum(width, _ESCAPE)
    best[width < _ESCAPE] = _ESCAPE - 1
    span, have = width, 1  # span[i]: widest of values[i : i + have]
    for c in range(_ESCAPE - 2, -1, -1):
        k = LAYOUT[c][0]
        if k > n:
            break
        span, have = np.maximum(span[:n - k + 1], span[k - have:n - have + 1]), k
        best[:n - k + 1][span <= c] = c
    best += 1
    best[best == _ESCAPE + 1] = 0
    step, at, first = _COUNTS[best].tolist(), 0, []
    while at < n:
        first.append(at)
        at += step[at]
    first = np.array(first)
    chosen = best[first]
    words = np.zeros(len(first), np.uint64)
    for s in np.unique(chosen):
        if s:
            k, w = LAYOUT[s - 1]
            at = chosen == s
            lanes = values[first[at][:, None] + np.arange(k)] << (np.arange(k) * w).astype(_U)
            words[at] = np.bitwise_or.reduce(lanes, axis=1) | (_U(s) << _U(60))
    return words, values[first[chosen == 0]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values that ``pack`` was given."""
    chosen = (words >> _U(60)).astype(np.int64)
    counts = _COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts
    for s in np.unique(chosen):
        at = chosen == s
        if s:
            k, w = LAYOUT[s - 1]
            lanes = words[at][:, None] >> (np.arange(k) * w).astype(_U) & _U((1 << w) - 1)
            out[starts[at][:, None] + np.arange(k)] = lanes
        else:
            out[starts[at]] = escapes
    return out
