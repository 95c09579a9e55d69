from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, row long"


def brute_targets(sizes: dict, weights=(5, 2, 1), percent=150, most=2) -> dict:
    """Share, cut at the limit, share what is left over again, until nothing is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = sum(sizes.values()) * percent / 100
    full: set = set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        shares = {s: most * sizes[s] if s in full else weight[s] * left / open_weight for s in order}
        above = {s for s in order if s not in full and shares[s] > most * sizes[s]}
        if not above:
            return shares
        full |= above


def documents(seed, sources):
    rnd = random.Random(seed)
    rows = []
    for source, n in sources.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * rnd.choice([0, 1, 30, 200, 900])), source, "x", 1))
    return rows


@pytest.mark.parametrize(("block_words", "near"), [(1000, 450), (50_000, 100)])  # within half of the next longer document that is left
@pytest.mark.parametrize("sources", [{"a": 40, "b": 5, "é": 60, None: 12, "B": 3}, {"only": 30}, {"a": 200, "b": 2, "c": 2, "d": 1}])
def test_targets_and_taken_words(spark, sources, block_words, near, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block_words)
    rows = documents(len(sources), sources)
    found = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=5).select("row.doc_id", "row.source", "size", "source_size", "target", "draws").collect()
    assert sorted(r["doc_id"] for r in found) == [r[0] for r in rows]
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(r[1].split())
    targets = brute_targets(sizes)
    for r in found:
        assert r["size"] == len(rows[r["doc_id"]][1].split())
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert len(r["draws"]) <= 2 and len({d["epoch"] for d in r["draws"]}) == len(r["draws"])
        assert all(0 <= d["shard"] < 5 for d in r["draws"])
    for source, target in targets.items():
        taken = sum(r["size"] * len(r["draws"]) for r in found if r["source"] == source)
        assert abs(taken - target) <= near


def test_rerun_agrees(spark):
    rows = documents(9, {"a": 50, "b": 20})
    runs = [{(r["id"], str(r["draws"])) for r in mixing.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(n)).select(F.col("row.doc_id").alias("id"), "draws").collect()} for n in (1, 7)]
    assert runs[0] == runs[1]


def test_edge_cases(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, None, "s", 1), (2, "", "a", None, None), (None, "x y", "a", None, None), (2, "", "a", None, None), (3, " w " * 50_000, "a", None, None)]
    found = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).select("row.*", "target", F.size("draws").alias("n")).collect()
    assert len(found) == 5 and all(r["target"] in (0.0, 1.5 * 50_002) for r in found)
    only = spark.createDataFrame([(1, None, None, "s", 1)], SCHEMA)
    assert mixing.mixed_rows(mixing.mix_sources(only)).columns == only.columns


def test_mixed_rows_are_the_draws(spark):
    df = spark.createDataFrame(documents(4, {"a": 30, "b": 30}), SCHEMA)
    mixed = mixing.mix_sources(df, shards=3)
    expected = {r["id"]: r["n"] for r in mixed.select(F.col("row.doc_id").alias("id"), F.size("draws").alias("n")).collect() if r["n"]}
    assert {r["doc_id"]: r["count"] for r in mixing.mixed_rows(mixed).groupBy("doc_id").count().collect()} == expected


def test_splits_keep_quotas_and_follow_the_distribution():
    quotas = np.array([50, 0, 30, 20])
    shares = np.array([mixing.split_quotas(quotas, 4, 1, (k, 0, 4)) for k in range(4000)])
    assert (shares.sum(axis=1) == 25).all() and (shares <= quotas).all() and (shares >= 0).all()
    assert np.allclose(shares.mean(axis=0), quotas / 4, atol=0.15)
    assert shares[:, 0].var() == pytest.approx(25 * 0.5 * 0.5 * 75 / 99, rel=0.1)


def test_a_block_taken_in_part_is_filled_past_long_documents(spark):
    """190 documents of 100 words and one of 30,000 that no share has room for, wherever it comes."""
    for seed in range(3):
        texts = {k: 100 for k in range(190)} | {190: 30_000}
        rows = [(k, " ".join(["w"] * n), "a", "x", 1) for k, n in texts.items()]
        found = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), seed=seed, percent=24, most=1).select("size", "target", F.size("draws").alias("n")).collect()
        assert found[0]["target"] == pytest.approx(0.24 * 49_000)
        assert abs(sum(r["size"] * r["n"] for r in found) - found[0]["target"]) <= 100


@pytest.mark.parametrize("seed", range(5))
def test_runs_name_what_is_chosen(seed):
    rnd = np.random.default_rng(seed)
    for _ in range(200):
        n = int(rnd.integers(1, 300))
        hashes, sizes = np.sort(rnd.choice(10**6, n, replace=False)), rnd.choice([0, 1, 7, 100, 101, 3000], n)
        if not sizes.sum():
            continue
        wanted = float(rnd.random() * sizes.sum())
        picked, runs, fillers = mixing._choose(hashes, sizes, wanted)
        named = [any(a <= h <= b and least <= s <= most for a, b, least, most in runs) or h in fillers for h, s in zip(hashes.tolist(), sizes.tolist(), strict=True)]
        assert named == picked.tolist() and len(fillers) <= mixing._FILLERS + 1
        missing, rest = wanted - sizes[picked].sum(), sizes[~picked & (sizes > 0)]
        if missing >= 0:
            assert missing < (rest.min() if len(rest) else 1)
        else:  # the last one taken was nearer than none
            assert -missing <= sizes[hashes == fillers[-1]][0] / 2


def test_rows_of_one_id_in_the_block_taken_in_part(spark):
    rows = [(k // 3, " ".join(["w"] * (0, 5, 400)[k % 3]), "a", "x", 1) for k in range(90)]
    found = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), percent=37, most=1).select("row.doc_id", "size", "target", F.size("draws").alias("n")).collect()
    times = {}
    for r in found:
        times.setdefault(r["doc_id"], set()).add(r["n"])
    assert all(len(n) == 1 for n in times.values())
    assert abs(sum(r["size"] * r["n"] for r in found) - found[0]["target"]) <= 405


def test_shards_follow_the_words_and_hold_what_the_tree_gave_them(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARDS", 2)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3_000)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    rows = [(k, "w " * (1 + k % 40), "abc"[k % 3]) for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(df).collect()
    words: dict = {}
    for r in mixed:
        for d in r["draws"]:
            words[d["shard"]] = words.get(d["shard"], 0) + r["size"]
    total = sum(words.values())
    assert set(words) == set(range(-(-int(1.5 * sum(1 + k % 40 for k in range(1500))) // 3_000)))
    # Equal shares up to blocks: a leaf holds one number of blocks or one more.
    assert max(words.values()) < 2 * total / len(words) and min(words.values()) > total / len(words) / 2
    # What a document's draws add up to doesn't depend on how the blocks are split.
    few = mixing.mix_sources(df, shards=3).collect()
    assert {r["row"]["doc_id"]: len(r["draws"]) for r in few} == {r["row"]["doc_id"]: len(r["draws"]) for r in mixed}
    assert {d["shard"] for r in few for d in r["draws"]} == {0, 1, 2}
