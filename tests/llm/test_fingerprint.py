from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, sketch string, id int, part string"


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def all_hashes(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    out = set()
    for k in range(max(1, len(words) - fp.WORDS + 1) if words else 0):
        h = 42
        for w in words[k : k + fp.WORDS]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(signed(h))
    return out


def texts(seed, n, longest=400):
    rnd = random.Random(seed)
    vocabulary = [f"wörd{k}" for k in range(300)]
    return [" ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 4, 5, 6, 60, longest]))) for _ in range(n)]


def test_sketches_and_edits_equal_brute_force(spark):
    rows = [(7 * k, t, "x", 1, "y") for k, t in enumerate(texts(1, 40) + [None, "", "  a\t"])]
    random.Random(2).shuffle(rows)
    found = {r["doc_id"]: r for r in fp.with_edited(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    ordered = sorted(rows)
    assert len(found) == len(rows)
    for k, row in enumerate(ordered):
        text, following = row[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        got = found[row[0]]
        assert got["text"] == text and got["edited"] == edited
        for column, of in (("sketch", text), ("edited_sketch", edited), ("next_sketch", following)):
            assert got[column] == sorted(all_hashes(of))[: fp.K]


def test_rows_without_an_id_have_their_own_sketch(spark):
    rows = [(None, "a b c d e f", "x", 1, "y"), (None, None, "x", 1, "y"), (1, "a b c", "x", 1, "y")]
    found = fp.with_edited(spark.createDataFrame(rows, SCHEMA)).collect()
    alone = sorted((r["text"], r["sketch"], r["edited"], r["edited_sketch"], r["next_sketch"]) for r in found if r["doc_id"] is None)
    assert alone == [("", [], None, None, None), ("a b c d e f", sorted(all_hashes("a b c d e f")), None, None, None)]
    assert len(found) == 3


def test_likeness(spark):
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(3000)]
    pairs = []
    for keep in (1.0, 0.99, 0.9, 0.5, 0.0):
        changed = [w if rnd.random() < keep else f"x{k}" for k, w in enumerate(base)]
        pairs.append((" ".join(base), " ".join(changed)))
    pairs += [("", ""), ("a b", ""), ("a b", "a b"), ("a b c d e f", "a b c d e"), (" ".join(base[:50]), " ".join(base[:60]))]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "sa"), "b", "sb")
    got = df.select("a", "b", fp.resemblance(F.col("sa"), F.col("sb")).alias("r"), fp.containment(F.col("sa"), F.col("sb")).alias("c"), fp.distinct_shingles(F.col("sa")).alias("n")).collect()
    for row in got:
        a, b = all_hashes(row["a"]), all_hashes(row["b"])
        exact = len(a) < fp.K and len(b) < fp.K
        assert row["r"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0, abs=1e-12 if exact else 0.15)
        assert row["c"] == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=1e-12 if exact else 0.25)
        assert row["n"] == pytest.approx(len(a), rel=0.3)


def test_sketches_of_parts_merge(spark):
    a, b = (" ".join(f"{p}{k % 700}" for k in range(900)) for p in "ab")
    df = fp.with_sketch(fp.with_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    assert df.select(fp.merge(F.col("sa"), F.col("sb")).alias("m")).first()["m"] == sorted(all_hashes(a) | all_hashes(b))[: fp.K]


def test_edge_cases(spark):
    assert fp.with_edited(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = fp.with_edited(spark.createDataFrame([(5, "abcdefgh", "x", 1, "y")], SCHEMA)).collect()
    assert [r["edited"] for r in alone] == ["abcdefab"]
    rows = [(1, "same text", "", 1, ""), (1, "same text", "", 1, ""), (2, "é" * 200_000, "", 1, ""), (2, "zz", "", 1, ""), (None, "lost", "", 1, "")]
    got = sorted((r["doc_id"], len(r["text"]), r["edited"][-2:]) for r in fp.with_edited(spark.createDataFrame(rows, SCHEMA)).collect() if r["doc_id"])
    assert got == [(1, 9, "zz"), (1, 9, "zz"), (2, 2, "zz"), (2, 200_000, "xt")]
