"""Vectorised word hashing over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 4_000_000  # text that is hashed at a time

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_WORD[128:] = True


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(0, n - 1), _BASE, np.uint64))])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a fixed bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def slices(texts: list[str], size: int = SLICE_BYTES) -> Iterator[slice]:
    """Cuts a batch into runs of about ``size`` characters, one text at least."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t) > size:
            yield slice(start, i)
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): the lower-cased words of all texts in order, as 64-bit
    hashes, and the index of the text each one is from.  A word is a run of
    ASCII letters and digits and of non-ASCII characters."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], _WORD[buf]]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = buf[at + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    hashes = mixed(np.add.reduceat(values * _powers(int(lengths.max()))[at], first) + lengths.astype(np.uint64))
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    return hashes, np.searchsorted(text_ends, starts, side="right")
