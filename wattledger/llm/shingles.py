"""Word shingles of whole texts as sorted 64-bit hashes, computed over a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import string_bytes

WORDS = 5
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + _M3
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# a random value for each byte, upper-case ASCII letters as their lower case
_VALUES = mix(np.arange(256, dtype=np.uint64))
_VALUES[65:91] = _VALUES[97:123]
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, n: int) -> np.ndarray:
    """The first n powers of the base, or of its inverse, modulo 2^64."""
    if len(_powers[name]) < n:
        steps = np.full(max(n, 1 << 16), _BASE if name == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and the bounds of each text's set.

    Words are runs of anything but ASCII white space; a text of fewer than five words has its whole sequence as one
    shingle, and one without words has none.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    raw, bounds, _, _ = string_bytes(texts)
    n_texts = len(texts)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_WHITE[raw]
    edge = inside[1:] != inside[:-1]
    edge[bounds] |= inside[1:][bounds] & inside[:-1][bounds]  # a word that meets the next text's first one
    places = np.flatnonzero(edge)
    starts = places[inside[1:][places]]
    ends = places[inside[:-1][places]]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * _power("up", len(raw)), out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _power("down", len(raw) + 1)[starts])
    del sums
    first = np.searchsorted(starts, bounds)  # words before each text
    counts = np.diff(first)
    whole = len(words) - WORDS + 1
    if whole > 0:
        grams = words[:whole]
        for i in range(1, WORDS):
            grams = mix(grams * _M1 + words[i : i + whole])
    else:
        grams = np.zeros(0, np.uint64)
    sets, sizes = [], np.zeros(n_texts, np.int64)
    for i, (at, n) in enumerate(zip(first[:-1].tolist(), counts.tolist(), strict=True)):
        if n >= WORDS:
            own = np.unique(grams[at : at + n - WORDS + 1])
        elif n:
            gram = words[at : at + 1]
            for j in range(1, n):
                gram = mix(gram * _M1 + words[at + j : at + j + 1])
            own = mix(gram + np.uint64(n))
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def fingerprint(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, whatever the order; 0 for an empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ _M2), dtype=np.uint64)])
    found = mix(sums[bounds[1:]] - sums[bounds[:-1]])
    return np.where(np.diff(bounds) > 0, found, np.uint64(0)).view(np.int64)
