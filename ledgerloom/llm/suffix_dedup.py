"""Removal of byte strings that occur more than once anywhere in a corpus, by bucket-pointer refinement.

Suffixes are sorted in buckets that are refined by the bucket identifiers of later offsets:

1. The initial bucket of an offset is its q-gram (q a quarter of the wanted length L); deeper identifiers
   come from shallower ones, ``I_2d(i) = mix(I_d(i), I_d(i + d))``, each depth reusing the one before. They are
   functions of the bytes alone, so that tasks agree on them without an exchange.
2. Each offset points to its anchor, the offset of least q-gram identifier within its L bytes. Offsets with one
   anchor are cut into cells at fixed distances from it; a cell's bucket is the identifier of the bytes
   that all its L-byte strings share. Cells are sorted by (bucket, identifier of all the cell's bytes). Cells alone in a
   bucket hold no repeated string; cells with all bytes equal hold nothing else.
3. Only what is left, a cell whose bucket has others that aren't equal to it, and one of each set of equal
   cells there, is refined to single offsets, sorted by the identifier of depth L.

Rows are dealt by range of all sort columns, so that a bucket which a third of all documents share is spread over many
tasks; rows at the ends of a task's range count as undecided and are settled in the next refinement, or, in
the last, among themselves. Equal texts are found by counting texts, and give cells once a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ledgerloom.llm.tables import Scratch, with_likely
from ledgerloom.llm.words import flat_bytes, mix64, powers, tidy

MIN_BYTES = 400
_SLICE = 1 << 19  # bytes that are looked at together
_PLACE = np.uint64((1 << 20) - 1)  # bits of an offset within a slice
_SEEN = 200_000  # texts that a task remembers, to give cells of equal texts once
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 << 32))
_STEP = np.uint64(0x9E3779B97F4A7C15)

_CELL = "core long, whole long, text_key long, lo int, hi int"
_OFFSET = "deep long, text_key long, at int"
_SPANS = "array<struct<start:bigint,stop:bigint>>"


def gram_identifiers(raw: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of the q-grams at all offsets of ``raw``."""
    n = len(raw)
    if n < q:
        return np.zeros(0, np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[raw] * powers(_BASE, n), dtype=np.uint64)))
    return mix64((sums[q:] - sums[: n - q + 1]) * powers(_BASE_INVERSE, n)[: n - q + 1])


def deeper(identifiers: np.ndarray, depth: int, wanted: int) -> np.ndarray:
    """Identifiers of depth ``wanted`` (at most twice ``depth``) from those of ``depth`` at both ends."""
    later = wanted - depth
    return mix64(identifiers[: len(identifiers) - later] * _STEP + identifiers[later:])


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def _slices(texts: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Index of the first text, bytes, offsets of the texts in them, and offset of the first byte in its text.

    Short texts come several at a time. A long one comes alone, in slices that overlap by ``length`` - 1 bytes.
    """
    raw, offsets = flat_bytes(texts)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, side="right")) - 1)
        begin, end = int(offsets[at]), int(offsets[upto])
        if end - begin <= _SLICE:
            yield at, raw[begin:end], offsets[at : upto + 1] - begin, 0
        else:
            for first in range(begin, end, _SLICE):
                piece = raw[first : min(end, first + _SLICE + length - 1)]
                yield at, piece, np.array([0, len(piece)]), first - begin
        at = upto


def _whole_strings(offsets: np.ndarray, length: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """For the first ``upto`` offsets: their text, and whether ``length`` bytes of it follow."""
    at = np.arange(upto)
    text = np.searchsorted(offsets, at, side="right") - 1
    return text, at + length <= offsets[text + 1]


def find_cells(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Cells of the texts in ``raw``: core, whole, index of the text, first and last offset (from the text's begin)."""
    q = -(-length // 4)
    empty = np.zeros(0, np.int64)
    if len(raw) < length:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    grams = gram_identifiers(raw, q)
    half = deeper(grams, q, 2 * q)
    deep = deeper(half, 2 * q, length)
    # The least gram of the string, the first of equal ones, by the gram's upper bits and then its place.
    least = _window_minima((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - q + 1)
    anchor = (least & _PLACE).astype(np.int64)
    text, whole_string = _whole_strings(offsets, length, len(deep))
    valid = np.flatnonzero(whole_string)
    if not len(valid):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(valid) > 1) | (np.diff(anchor[valid]) != 0) | (np.diff(text[valid]) != 0)
    lo, hi = valid[new], valid[np.append(new[1:], True)]
    a = anchor[lo]
    # Cut at distances from the anchor that are multiples of q.
    steps = (a - lo) // q - (a - hi) // q + 1
    of = np.repeat(np.arange(len(lo)), steps)
    k = (a[of] - lo[of]) // q - (np.arange(len(of)) - np.repeat(np.cumsum(steps) - steps, steps))
    a = a[of]
    lo, hi = np.maximum(lo[of], a - q * k - (q - 1)), np.minimum(hi[of], a - q * k)
    shared = a - q * k  # bytes from here on, q - 1 fewer than length, are in all strings that the cell may have
    core = mix64(half[shared] + mix64(half[shared + length - q + 1 - 2 * q] * _STEP + k.astype(np.uint64)))
    shape = ((a - lo) * (2 * length) + (hi - lo)).astype(np.uint64)
    whole = mix64(deep[lo] * _STEP + mix64(deep[hi] + mix64(shape)))
    return core, whole, text[lo], lo - offsets[text[lo]], hi - offsets[text[lo]]


def _cells(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            fresh = []
            for k, key in enumerate(keys.tolist()):
                if key not in seen:
                    fresh.append(k)
                    seen.add(key)
                if len(seen) >= _SEEN:
                    seen.clear()
            keys, texts = keys[fresh], batch.column(1).take(pa.array(fresh, pa.int64()))
            for first, raw, offsets, before in _slices(texts, length):
                core, whole, text, lo, hi = find_cells(raw, offsets, length)
                columns = [core.view(np.int64), whole.view(np.int64), keys[first + text], (lo + before).astype(np.int32), (hi + before).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["core", "whole", "text_key", "lo", "hi"])

    return run


def _sort_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of cells in order of (core, whole): ``text_key, lo, hi, repeated, open``.

    Repeated are cells with an equal neighbour. Open are the first cell of each set of equal ones in a bucket that has
    several sets, and those sets that the range of this task may have cut.
    """

    def out(rows: np.ndarray, repeated: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
        keep = repeated | open_
        text, lo, hi = (rows[keep, k] for k in (2, 3, 4))
        columns = [pa.array(text), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(repeated[keep]), pa.array(open_[keep])]
        return pa.RecordBatch.from_arrays(columns, names=["text_key", "lo", "hi", "repeated", "open"])

    held = None  # the last row, not yet given
    held_equal = False  # whether it equals the row before it
    held_open = False
    first_of_bucket = None  # first row of the only set of equal cells in the current bucket, so far not open
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], axis=1)
        start = held is None
        if not start:
            rows = np.concatenate((held[None], rows))
        n = len(rows)
        same_core = np.zeros(n, bool)
        same_core[1:] = rows[1:, 0] == rows[:-1, 0]
        equal = np.zeros(n, bool)
        equal[1:] = same_core[1:] & (rows[1:, 1] == rows[:-1, 1])
        open_ = same_core & ~equal
        equal[0], open_[0] = held_equal, held_open or start
        # The first set of a bucket is open as soon as there is a second one.
        bucket = np.cumsum(~same_core) - 1
        begins = np.flatnonzero(~same_core)
        others = np.bincount(bucket[1:][open_[1:]], minlength=len(begins)) > 0
        extra = None
        if others[0] and first_of_bucket is not None:
            extra, first_of_bucket = first_of_bucket, None
        inner = begins[1:][others[1:]]
        open_[inner] = True
        if len(begins) > 1:
            first_of_bucket = None if others[-1] else rows[begins[-1]]
        repeated = equal.copy()
        repeated[:-1] |= equal[1:]
        if extra is not None:
            yield out(extra[None], np.zeros(1, bool), np.ones(1, bool))
        yield out(rows[:-1], repeated[:-1], open_[:-1])
        held, held_equal, held_open = rows[-1], bool(equal[-1]), bool(open_[-1])
    if held is not None:
        if first_of_bucket is not None:
            yield out(first_of_bucket[None], np.zeros(1, bool), np.ones(1, bool))
        yield out(held[None], np.array([held_equal]), np.array([held_open]))


def _offsets(length: int):
    """Depth-``length`` identifiers at the offsets that each text's list of (lo, hi) names, every offset once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = -(-length // 4)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            lists = batch.column(2)
            for first, raw, offsets, before in _slices(batch.column(1), length):
                deep = deeper(deeper(gram_identifiers(raw, q), q, 2 * q), 2 * q, length) if len(raw) >= length else np.zeros(0, np.uint64)
                wanted = np.zeros(len(raw) + 1, np.int64)
                for k in range(len(offsets) - 1):
                    spans = lists[first + k].values.flatten()
                    lo, hi = (np.clip(s.to_numpy() + offsets[k] - before + d, 0, len(raw)) for s, d in zip(spans, (0, 1), strict=True))
                    np.add.at(wanted, lo, 1)
                    np.add.at(wanted, hi, -1)
                at = np.flatnonzero(np.cumsum(wanted)[: len(deep)] > 0)
                text = np.searchsorted(offsets, at, side="right") - 1
                columns = [deep[at].view(np.int64), keys[first + text], (at - offsets[text] + before).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["deep", "text_key", "at"])

    return run


def _sort_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of offsets in order of identifier, those with an equal neighbour; the first and last also as ``edge``."""

    def out(rows, keep, edge: bool):
        columns = [pa.array(rows[keep, 0]), pa.array(rows[keep, 1]), pa.array(rows[keep, 2].astype(np.int32)), pa.array(np.full(int(np.count_nonzero(keep)), edge))]
        return pa.RecordBatch.from_arrays(columns, names=["deep", "text_key", "at", "edge"])

    held, held_equal = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
        if held is None:
            yield out(rows[:1], np.ones(1, bool), True)
        else:
            rows = np.concatenate((held[None], rows))
        equal = np.zeros(len(rows), bool)
        equal[1:] = rows[1:, 0] == rows[:-1, 0]
        equal[0] = held_equal
        repeated = equal.copy()
        repeated[:-1] |= equal[1:]
        yield out(rows[:-1], repeated[:-1], False)
        held, held_equal = rows[-1], bool(equal[-1])
    if held is not None:
        yield out(held[None], np.array([held_equal]), False)
        yield out(held[None], np.ones(1, bool), True)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal spans of each text among its spans (text_key, start, stop), sorted by (text_key, start)."""

    def out(keys, starts, stops):
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(starts.astype(np.int64)), pa.array(stops.astype(np.int64))], names=["start", "stop"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(keys)).astype(np.int32)), spans)
        return pa.RecordBatch.from_arrays([pa.array(keys[begin]), lists], names=["text_key", "spans"])

    kept: list[np.ndarray] = []  # merged spans of the text that the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
        rows = np.concatenate([*kept, rows])
        text = np.cumsum(np.append(0, rows[1:, 0] != rows[:-1, 0]))
        # Stops of later texts are set above those of earlier ones, for one running maximum.
        height = int(rows[:, 2].max()) + 1
        reach = np.maximum.accumulate(rows[:, 2] + text * height)
        new = np.append(True, (rows[1:, 1] + text[1:] * height > reach[:-1]) | (text[1:] != text[:-1]))
        begin = np.flatnonzero(new)
        stops = reach[np.append(begin[1:], len(rows)) - 1] - text[begin] * height
        done = np.stack([rows[begin, 0], rows[begin, 1], stops], axis=1)
        open_text = done[:, 0] == done[-1, 0]
        yield out(*done[~open_text].T)
        kept = [done[open_text]]
    if kept:
        yield out(*kept[0].T)


def repeated_spans(texts: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """``text_key, spans``: of the texts (columns ``text_key``, ``text``), the maximal runs of bytes that are covered by a
    string of ``length`` bytes which also starts at another offset of the same or another text.

    Texts that occur several times, and texts without such a string, have no row.
    """
    if not 8 <= length <= _SLICE // 2:
        raise ValueError(f"strings of 8 to {_SLICE // 2} bytes can be looked for, not of {length}")
    long_enough = texts.where(F.octet_length("text") >= length)
    cells = scratch.write(long_enough.mapInArrow(tidy(_cells(length)), _CELL))
    by = ["core", "whole", "text_key", "lo"]
    sorted_cells = scratch.write(
        cells.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(tidy(_sort_cells), "text_key long, lo int, hi int, repeated boolean, open boolean")
    )
    scratch.drop(cells)
    # Lists are no longer than their text; a text of many rows is taken once.
    opened = scratch.write(sorted_cells.where("open").groupBy("text_key").agg(F.collect_set(F.struct("lo", "hi")).alias("cells")))
    likely = with_likely(long_enough, opened, "text_key", "_open").where("_open").groupBy("text_key").agg(F.first("text").alias("text"))
    offsets = scratch.write(likely.join(opened, "text_key").select("text_key", "text", "cells").mapInArrow(tidy(_offsets(length)), _OFFSET))
    by = ["deep", "text_key", "at"]
    found = scratch.write(
        offsets.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(tidy(_sort_offsets), "deep long, text_key long, at int, edge boolean")
    )
    scratch.drop(offsets)
    # A few rows for each task of the sort.
    edges = found.where("edge").select("deep", "text_key", "at").distinct()
    across = edges.join(edges.groupBy("deep").count().where("count > 1"), "deep").select("text_key", "at")
    single = found.where("not edge").select("text_key", "at").unionAll(across)
    spans = sorted_cells.where("repeated").select("text_key", F.col("lo").alias("start"), (F.col("hi") + length).alias("stop")).unionAll(
        single.select("text_key", F.col("at").alias("start"), (F.col("at") + length).alias("stop"))
    )
    dealt = spans.distinct().repartition("text_key").sortWithinPartitions("text_key", "start")
    merged = scratch.write(dealt.mapInArrow(tidy(_merged), f"text_key long, spans {_SPANS}"))
    for done in (sorted_cells, opened, found):
        scratch.drop(done)
    return merged


def _cut(text_col: str):
    """``kept`` beside each row: the bytes of its text outside the spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            texts = pc.struct_field(batch.column("row"), [text_col]).cast(pa.string()).cast(pa.large_binary())
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                raw, at, parts = text.as_py() or b"", 0, []
                for span in spans:
                    parts.append(raw[at : span["start"]])
                    at = span["stop"]
                kept.append(b"".join([*parts, raw[at:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kept, pa.binary())], names=["row", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(df: DataFrame, length: int = MIN_BYTES, text_col: str = "text") -> DataFrame:
    """``row, n_bytes, spans, kept``: each row, its text's size in UTF-8 bytes, the runs of bytes (``start``, ``stop``) that are
    removed, and the bytes that stay.

    A byte goes if a string of ``length`` bytes covers it that also starts at any other offset of this or another row's text, as the
    texts were given: overlapping and all occurrences go, the first one too. Bytes at the border may
    be part of a character, hence ``kept`` is binary. Null texts are empty; a shorter text loses nothing. Rows
    with equal texts, also whole rows that are repeated, count as several occurrences. Nulls elsewhere and other
    columns, whatever their names, are handed through in ``row``. An empty table gives an empty result. Strings and texts are known by
    64-bit hashes.
    """
    scratch = Scratch(df.sparkSession, "repeats")
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = rows.select("row", F.xxhash64(text).alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"))
    merged = repeated_spans(rows.select("text_key", text.alias("text")), length, scratch)
    copies = rows.where(F.col("n_bytes") >= length).groupBy("text_key").agg(F.count("*").alias("n"), F.first("n_bytes").alias("stop")).where("n > 1")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("stop").alias("stop")))
    removed = scratch.write(
        merged.join(copies, "text_key", "full").select("text_key", F.when(F.col("n").isNotNull(), all_of_it).otherwise(F.col("spans")).alias("spans"))
    )
    scratch.drop(merged)
    # Only texts that may lose something are dealt by key.
    flagged = with_likely(rows, removed, "text_key", "_likely")
    nothing = F.array().cast(_SPANS)
    touched = flagged.where("_likely").join(removed, "text_key", "left").select("row", "n_bytes", F.coalesce("spans", nothing).alias("spans"))
    schema = StructType([*touched.schema.fields, StructField("kept", BinaryType())])
    whole = flagged.where("not _likely").select("row", "n_bytes", nothing.alias("spans"), F.encode(text, "UTF-8").alias("kept"))
    return whole.unionByName(touched.mapInArrow(tidy(_cut(text_col)), schema))
