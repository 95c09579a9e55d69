from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import suffix_dedup


def brute(texts: list[str | None], length: int) -> list[tuple[list[tuple[int, int]], bytes]]:
    """Spans to remove and what stays, from a count of all strings."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 2, np.int8)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = 1
        turns = np.flatnonzero(np.diff(gone))
        kept = np.frombuffer(raw, np.uint8)[gone[1:-1] == 0].tobytes()
        out.append(([(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2], strict=True)], kept))
    return out


def removed(spark, texts, length, partitions=4):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(partitions)
    rows = {r["row"]["doc_id"]: r for r in suffix_dedup.remove_repeats(df, length).collect()}
    return [([tuple(s) for s in rows[k]["spans"]], bytes(rows[k]["kept"])) for k in range(len(texts))]


def made_up(seed: int) -> list[str | None]:
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("ab é"), int(rng.integers(5, 60)))) for _ in range(12)]
    texts = ["".join(rng.choice(pool, int(rng.integers(0, 4)))) + "".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 60)))) for _ in range(60)]
    return [*texts, None, "", "x" * 300, "xy" * 200, *["a text that occurs more than once in this table"] * 3]


@pytest.mark.parametrize("length", [8, 9, 16, 41])
def test_against_counting_all_strings(spark, length):
    texts = made_up(length)
    assert removed(spark, texts, length) == brute(texts, length)


def test_slices_of_long_texts(spark, monkeypatch):
    """Work in slices of a few bytes, so that strings and cells lie across their borders."""
    rng = np.random.default_rng(7)
    passage = "".join(rng.choice(list("abcdef"), 100))
    texts = [passage[:70], "zz" + passage + "yy", passage[20:] + passage[:50]]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["text_key", "text"])
    whole = suffix_dedup.find_cells(*_joined(texts), 16)
    assert len(whole[0]) == sum(1 for _ in whole[0])
    monkeypatch.setattr(suffix_dedup, "_SLICE", 64)
    cells = [r for b in suffix_dedup._cells(16)(iter([batch])) for r in b.to_pylist()]
    for key, text in zip((1, 2, 3), texts, strict=True):
        offsets = sorted(k for c in cells if c["text_key"] == key for k in range(c["lo"], c["hi"] + 1))
        assert offsets == list(range(len(text) - 15))


def _joined(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return raw, np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_sorting_cells_over_batches_and_tasks(size):
    """What is decided doesn't depend on how rows are cut into batches; what a task can't know is left open."""
    rng = np.random.default_rng(size)
    rows = sorted({(int(rng.integers(40)), int(rng.integers(3)), int(rng.integers(50)), int(rng.integers(3))) for _ in range(200)})
    table = [dict(zip(("core", "whole", "text_key", "lo"), r, strict=True)) | {"hi": r[3] + 1} for r in rows]
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("text_key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
    equal = Counter(r[:2] for r in rows)
    sets = Counter(core for core, _ in equal)
    for cut in (len(rows), 77):
        found = []
        for part in (table[:cut], table[cut:]):
            batches = [pa.RecordBatch.from_pylist(part[k : k + size], schema) for k in range(0, len(part), size)]
            found += [r for b in suffix_dedup._sort_cells(iter(batches)) for r in b.to_pylist()]
        at = {(r["text_key"], r["lo"]): [] for r in found}
        repeated = Counter((r["text_key"], r["lo"]) for r in found if r["repeated"])
        opened = {(r["text_key"], r["lo"]) for r in found if r["open"]}
        assert len(at) <= len(rows)
        expected = Counter((r[2], r[3]) for r in rows if equal[r[:2]] > 1)
        # A row may be equal to one in the other task only.
        assert sum((expected - repeated).values()) <= (0 if cut == len(rows) else 2) and not repeated - expected
        first = {}
        for r in rows:
            first.setdefault(r[:2], (r[2], r[3]))
        assert {place for (core, _), place in first.items() if sets[core] > 1} <= opened


def test_all_copies_go_and_clean_texts_stay(spark):
    rng = np.random.default_rng(5)
    words = [f"word{k}" for k in range(900)]
    clean = [" ".join(rng.choice(words, 200)) for _ in range(10)]
    passage = " ".join(rng.choice(words, 80))
    texts = [*clean, *[clean[0][:100] + passage + c[-200:] for c in clean], *["copy " * 200] * 30]
    for (spans, kept), text in zip(removed(spark, texts, 400, partitions=9), texts, strict=True):
        if text in clean:
            assert kept == text.encode() and not spans
        elif text.startswith("copy"):
            assert spans == [(0, 1000)] and not kept
        else:
            assert len(spans) == 1 and passage.encode() not in kept
    assert removed(spark, texts, 400) == brute(texts, 400)


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    df = spark.sql("select cast(null as bigint) as doc_id, repeat('abcdefgh', 60) as text, 1 as spans, 'k' as text_key, 'r' as row")
    rows = suffix_dedup.remove_repeats(df.unionAll(df)).collect()
    assert [(r["row"]["spans"], r["row"]["text_key"], r["row"]["row"], bytes(r["kept"])) for r in rows] == [(1, "k", "r", b"")] * 2
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []
    one = suffix_dedup.remove_repeats(df).first()
    # One text whose strings repeat within it.
    assert [tuple(s) for s in one["spans"]] == [(0, 480)]
    with pytest.raises(ValueError, match="8 to"):
        suffix_dedup.remove_repeats(df, 7)
