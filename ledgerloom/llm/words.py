"""Words and their hashes for whole batches of texts, with numpy instead of a loop over words.

Words are runs of bytes other than space and U+0009 to U+000D. Those bytes never occur
inside a UTF-8 sequence, so words are found in the bytes of an Arrow column.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_CHUNK = 1 << 19  # bytes whose 64-bit work arrays are held at once

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def give_back() -> None:
    """Returns the memory that this worker doesn't use to the system: it stays for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after which the worker gives back the memory that it doesn't use."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits depend on all input bits (splitmix64)."""
    x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(256))
_BYTE_LOWER = _BYTE[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & (2**64 - 1), np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWERS = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest table is kept, up to twice the chunk."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        kept = _powers(base, max(n, _CHUNK))
        if n <= 2 * _CHUNK:
            _POWERS[base] = kept
    return kept[:n]


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins, with the end last; null is empty."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may have bytes of its own
        texts = texts.fill_null(b"")
        return flat_bytes(pa.concat_arrays([texts]))
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word, with the end last."""
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first[begins] = inside[begins]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are ordered and don't overlap."""
    table = _BYTE_LOWER if lower else _BYTE
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        piece = table[raw[base : ends[upto - 1]]] * powers(_BASE, int(ends[upto - 1] - base))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(piece, dtype=np.uint64)))
        lo, hi = starts[at:upto] - base, ends[at:upto] - base
        back = powers(_BASE_INVERSE, int(lo[-1]) + 1)[lo]
        out[at:upto] = mix64((sums[hi] - sums[lo]) * back + (hi - lo).astype(np.uint64))
        at = upto
    return out


def shingle_hashes(words: np.ndarray, first_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and for each text the index of its first run, with the end last.

    A text of fewer than n words, but at least one, has its whole sequence as its one run.
    """
    counts = np.diff(first_word)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate(([0], np.cumsum(runs)))
    text = np.repeat(np.arange(len(counts)), runs)
    at = first_word[:-1][text] + (np.arange(begin[-1]) - begin[:-1][text])
    length = np.minimum(counts[text], n)
    out = mix64(length)
    for k in range(n):
        has = length > k
        word = words[np.minimum(at + k, len(words) - 1)] if len(words) else words
        out = np.where(has, mix64(out * np.uint64(0xD6E8FEB86659FD93) + word), out)
    return out, begin
