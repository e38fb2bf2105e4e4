"""Word and shingle hashes of whole texts, vectorised over many documents."""

from __future__ import annotations

import numpy as np

from .common import mix64

_CHUNK = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _powers:
        for root in (_ROOT, _INVERSE):
            run = np.full(_CHUNK + 1, root, dtype=np.uint64)
            run[0] = 1
            _powers.append(np.multiply.accumulate(run))
    return _powers


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every maximal run of bytes other than 09-0D and 20."""
    inside = ~_SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased; equal for equal words in any text."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _CHUNK, side="right"))
        if j > i:
            a, b = starts[i], ends[j - 1]
            out[i:j] = _hash_spans(data[a:b], starts[i:j] - a, ends[i:j] - a)
        else:  # one word of over a megabyte: its pieces' hashes, folded
            j, total = i + 1, np.zeros(1, np.uint64)
            for a in range(int(starts[i]), int(ends[i]), _CHUNK):
                piece = data[a : min(a + _CHUNK, int(ends[i]))]
                total = mix64(total) + _hash_spans(piece, np.array([0]), np.array([len(piece)]))
            out[i] = total[0]
        i = j
    return mix64(out + (ends - starts).astype(np.uint64) * _STEPS[63])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingle hashes of document i are hashes[bounds[i]:bounds[i+1]].

    A shingle is ``words`` consecutive words; a document with fewer words has its
    whole sequence as one shingle, one without words has none.
    """
    n = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    w = word_hashes(data, starts, ends)
    total = np.zeros(len(w), np.uint64)
    for k in range(words):
        total[: len(w) - k] += w[k:] * _STEPS[k]
    counts = np.bincount(owner, minlength=n)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    whole = np.zeros(len(w), bool)
    whole[: max(0, len(w) - words + 1)] = owner[words - 1 :] == owner[: max(0, len(w) - words + 1)]
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        a, b = firsts[i], firsts[i + 1]
        total[a] = np.append(w[a:b] * _STEPS[: b - a], _STEPS[40 + b - a]).sum(dtype=np.uint64)
        whole[a] = True
    hashes, owner = mix64(total[whole]), owner[whole]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], np.concatenate(([0], np.cumsum(np.bincount(owner[keep], minlength=n))))
