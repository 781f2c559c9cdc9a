"""Vectorised hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

#: White space of the word pattern [^\x20\x09-\x0D]+.
SPACES = [32, 9, 10, 11, 12, 13]
_rng = np.random.default_rng(20240501)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[SPACES] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, kept for the longest buffer so far."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)]), dtype=np.uint64)
                      for x in (_STEP, inverse)]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, with A-Z lower-cased; number of the first word of each text, and the total)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _IS_SPACE[data]
    edge = np.diff(space, prepend=True, append=True)
    begin, end = np.flatnonzero(edge[:-1] & ~space), np.flatnonzero(edge[1:] & ~space) + 1
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(begin, starts)


def text_blocks(texts: list[bytes], size: int = 1 << 20):
    """(first, last) of consecutive texts of about ``size`` bytes together."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle, none is an empty set."""
    out: list[np.ndarray] = []
    for a, b in text_blocks(texts, 1 << 18):
        words, first = word_hashes(texts[a:b])
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size):
            rolled = rolled * _STEP + words[k:k + len(rolled)]
        rolled = mix(rolled)
        for i, j in zip(first.tolist(), first[1:].tolist(), strict=False):
            if j - i >= size:
                out.append(np.unique(rolled[i:j - size + 1]))
            elif j > i:
                h = np.uint64(j - i)
                with np.errstate(over="ignore"):
                    for w in words[i:j]:
                        h = h * _STEP + w
                out.append(mix(np.array([h], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
