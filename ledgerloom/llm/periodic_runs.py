"""Periodic runs of words: stretches that repeat with some period, found by multi-scale minimizers.

A run is a maximal stretch whose words a smallest period q apart are identical, of at least ``max(6, 4 * q)`` words.

For periods in (2^(s-1), 2^s], scale s looks at all grams of 2^s words and keeps those that are least in some window of 2^(s-1)
neighbouring grams. Inside a run of such a period, windows repeat at period distance, and so do their
least grams; a gram as long as the period occurs there at multiples of the period only. A run of four periods holds a
whole window and the same one a period later, hence two kept grams with equal words, next to each
other among the equal ones, one period apart: the seed, which is extended to both sides as long as words a period apart agree. Periods
up to ``DIRECT`` are found by comparing all words with those the lag further on.

The texts of a slice are one sequence, with a word of its own between any two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerloom.llm.words import flat_bytes, mix64, span_hashes, tidy, word_spans

REPEATS, LEAST = 4, 6  # Fixed values: a run has max(LEAST, REPEATS * period) words or more
DIRECT = 4  # periods found by lag scans; a power of two
_TEXT_BYTES = 1 << 20  # of texts whose words are taken at once
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def minimizer_seeds(grams: np.ndarray, width: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Offset and lag of pairs of equal grams, each the least of a window of ``width``, with none of them
    between; lags from ``longest`` / 2 + 1 to ``longest``."""
    none = np.zeros(0, np.int64)
    if len(grams) <= width:
        return none, none
    least = _window_minima(grams, width)
    # A gram is kept if it equals the minimum of any window that it lies in: of the largest such minimum.
    outer = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    top = ~_window_minima(~outer, width)
    kept = np.flatnonzero(top == grams)
    order = kept[np.argsort(grams[kept], kind="stable")]
    lag = np.diff(order)
    good = (grams[order[1:]] == grams[order[:-1]]) & (lag > longest // 2) & (lag <= longest)
    return order[:-1][good], lag[good]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal those ``lag`` further right."""
    n = len(words) - lag
    done, look = 0, 64
    while True:
        if step > 0:
            lo, hi = at + done, min(n, at + done + look)
        else:
            lo, hi = max(0, at + 1 - done - look), at + 1 - done
        if lo >= hi:
            return done
        differ = words[lo:hi] != words[lo + lag : hi + lag]
        if step < 0:
            differ = differ[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += hi - lo
        look *= 2


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of ``period`` is a period of the run from ``start`` on."""
    rest, prime, unit = period, 2, words[start : start + period]
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime:
            prime += 1
            continue
        while rest % prime == 0:
            rest //= prime
        shorter = period // prime
        if (unit[:-shorter] == unit[shorter:]).all():
            return False
    return True


def find_runs(words: np.ndarray, longest_text: int | None = None) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence, by start, then period.

    No run is longer than ``longest_text``, if given.
    """
    n = len(words)
    most = n if longest_text is None else min(n, longest_text)
    found: list[tuple[int, int, int]] = []
    for lag in range(1, min(DIRECT, most // REPEATS) + 1):
        same = np.zeros(n - lag + 2, np.int8)
        same[1:-1] = words[:-lag] == words[lag:]
        turns = np.flatnonzero(np.diff(same))
        starts, lengths = turns[::2], turns[1::2] - turns[::2] + lag
        for k in np.flatnonzero(lengths >= max(LEAST, REPEATS * lag)).tolist():
            found.append((int(starts[k]), int(lengths[k]), lag))
    gram, grams = 1, words
    while gram < DIRECT:
        grams = mix64(grams[: len(grams) - gram] * _STEP + grams[gram:]) if len(grams) > gram else grams[:0]
        gram *= 2
    while REPEATS * (gram + 1) <= most:
        # Now periods above ``gram``, up to twice that.
        grams = mix64(grams[: len(grams) - gram] * _STEP + grams[gram:]) if len(grams) > gram else grams[:0]
        gram *= 2
        at, lags = minimizer_seeds(grams, gram // 2, gram)
        order = np.lexsort((at, lags))
        stop, of = -1, 0
        for i, lag in zip(at[order].tolist(), lags[order].tolist(), strict=True):
            if lag == of and i < stop:
                continue  # within the stretch just looked at
            left, right = _reach(words, i, lag, -1), _reach(words, i, lag, 1)
            of, stop = lag, i + right
            if right and left + right - 1 + lag >= REPEATS * lag:
                found.append((i - left + 1, left + right - 1 + lag, lag))
    runs = sorted({r for r in found if _primitive(words, r[0], r[2])}, key=lambda r: (r[0], r[2]))
    return np.array(runs, np.int64).reshape(-1, 3)


def _slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of some texts at a time, each text whole."""
    raw, offsets = flat_bytes(texts)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TEXT_BYTES, side="right")) - 1)
        yield raw[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


def slice_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts in ``raw``: number of words, text and (start, length, period) of all runs, and a mask of what
    stays of ``raw``: the bytes of words that no run contains after its first period, with one space between them (which is
    written into ``raw``)."""
    starts, ends, first = word_spans(raw, offsets)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    # One sequence, with a word of its own after each text.
    begins = first[:-1] + np.arange(len(counts))
    known = np.unique(span_hashes(raw, starts, ends), return_inverse=True)[1]
    sequence = np.empty(len(starts) + len(counts), np.uint64)
    sequence[begins + counts] = mix64(np.arange(len(counts), dtype=np.uint64) + np.uint64(1 << 62))
    sequence[np.arange(len(starts)) + text] = mix64(known.astype(np.uint64))
    runs = find_runs(sequence, int(counts.max(initial=0)))
    of = np.searchsorted(begins, runs[:, 0], side="right") - 1
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2] - of, 1)
    np.add.at(change, runs[:, 0] + runs[:, 1] - of, -1)
    runs[:, 0] -= begins[of]
    words = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    edge = np.zeros(len(raw) + 1, np.int8)
    edge[starts[words]] += 1
    edge[ends[words]] -= 1
    stays = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    followed = words[:-1][text[words[1:]] == text[words[:-1]]]
    raw[ends[followed]] = ord(" ")
    stays[ends[followed]] = True
    return counts, of, runs, stays


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for raw, offsets in _slices(batch.column("text")):
            raw = raw.copy()
            counts, of, runs, stays = slice_runs(raw, offsets)
            columns = pa.StructArray.from_arrays([pa.array(c) for c in runs.T], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(counts) + 1)).astype(np.int32)), columns)
            kept = np.concatenate(([0], np.cumsum(stays)))[offsets]
            joined = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(kept.astype(np.int64).tobytes()), pa.py_buffer(raw[stays].tobytes()))
            part = batch.column("row").slice(at, len(counts))
            yield pa.RecordBatch.from_arrays([part, pa.array(counts, pa.int64()), lists, joined.cast(pa.string())], names=["row", "n_words", "runs", "collapsed"])
            at += len(counts)


def collapse_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``row, n_words, runs, collapsed``: each row, its text's number of words, all periodic runs (``start`` as a word number from 0,
    ``length``, ``period``) by start, then period, and the words that no run contains after its first period, joined by one space.

    Words are runs of characters other than space and U+0009 to U+000D, compared as they are (by 64-bit hashes). A run
    is a stretch of consecutive words with smallest period q and at least max(6, 4 * q) words that no neighbouring word extends
    keeping period q; runs may overlap. Null texts and texts without words have no runs and an empty
    ``collapsed``. Every row is looked at on its own, so that repeated rows and ties give equal results. Nulls elsewhere and other columns,
    whatever their names, are handed through in ``row``. An empty table gives an empty result. A text is looked at whole, in a few
    dozen bytes for each of its own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("row")).select("row", F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).alias("text"))
    run = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
    schema = StructType([rows.schema["row"], StructField("n_words", LongType()), StructField("runs", ArrayType(run)), StructField("collapsed", StringType())])
    return rows.mapInArrow(tidy(_run), schema)
