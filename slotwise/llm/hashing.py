"""Hashes of words and word windows, vectorised over a batch of texts.

Hashes are polynomial over random byte values modulo 2^64 and mixed; two
different texts get equal ones with a chance of about 2^-64 per pair.
"""

from __future__ import annotations

import hashlib

import numpy as np

BLOCK = 1 << 20  #: bytes hashed at a time; longer words are hashed one by one

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEPS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE)
_INVERSE = _powers(pow(_BASE, -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text); words are parted by ASCII white space as bytes.split does."""
    counts = np.zeros(len(texts), np.int64)
    parts = []
    for i, t in enumerate(texts):
        words = t.split()
        counts[i] = len(words)
        if words:
            parts.append(b" ".join(words))
    joined = b" ".join(parts)
    if not joined:
        return np.zeros(0, np.uint64), counts
    data = np.frombuffer(joined, np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = starts[at]
        until = int(np.searchsorted(ends, lo + BLOCK, "right"))
        if until <= at:  # a word longer than a block
            out[at] = int.from_bytes(hashlib.blake2b(joined[lo : ends[at]], digest_size=8).digest(), "little")
            at += 1
            continue
        sums = np.zeros(int(ends[until - 1] - lo) + 1, np.uint64)
        np.cumsum(_BYTE[data[lo : ends[until - 1]]] * _POWERS[: len(sums) - 1], out=sums[1:])
        s, e = starts[at:until] - lo, ends[at:until] - lo
        out[at:until] = (sums[e] - sums[s]) * _INVERSE[s] + (e - s).astype(np.uint64)
        at = until
    return mix(out), counts


def window_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from every word on (fewer at the end: those only)."""
    out = np.zeros(len(words), np.uint64)
    for j in range(min(size, len(words))):
        term = words[j:] * np.uint64(pow(int(_STEPS[which]), j, 2**64))
        out[: len(words) - j] += term
    return mix(out + np.uint64(size))


def whole(counts: np.ndarray, size: int) -> np.ndarray:
    """Whether the window from every word on ends inside its text."""
    total = int(counts.sum())
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return left >= size


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of ``size`` values from every place on (fewer at the end)."""
    out, width = values.copy(), 1
    while width < size:
        step = min(width, size - width)
        if step < len(out):
            out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out
