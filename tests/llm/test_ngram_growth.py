"""What many documents have in common, and large groups of similar ones, make no work that grows faster than the documents."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import ngram_join, signature_tree

SCHEMA = "doc_id long, text string"


def tokens(rnd, n):
    return np.unique(rnd.integers(0, 2**64, n, np.uint64, endpoint=False))


@pytest.mark.parametrize("size", [60, 128, 256, 1000])
def test_sketches_tell_unrelated_sets_apart(size):
    """Whatever their size lies next to a power of two."""
    rnd = np.random.default_rng(size)
    sets = [tokens(rnd, size) for _ in range(200)]
    i, _ = ngram_join.sketch_pairs(np.zeros(200, np.int64), np.array([len(s) for s in sets]), [ngram_join.set_sketch(s) for s in sets], 80)
    assert len(i) < 20  # of 19,900


def test_a_group_is_connected_with_few_comparisons(monkeypatch):
    rnd = np.random.default_rng(3)
    base = tokens(rnd, 300)
    sets = [np.unique(np.concatenate([np.delete(base, rnd.integers(0, 300, 3)), tokens(rnd, 3)])) for _ in range(400)] + [tokens(rnd, 300)]
    run, node = np.repeat(np.arange(5), len(sets)), np.tile(np.arange(len(sets)) - 7, 5)
    compared = []
    near = ngram_join._Sketches.near
    monkeypatch.setattr(ngram_join._Sketches, "near", lambda self, i, j: compared.append(len(i)) or near(self, i, j))
    sketches = [ngram_join.set_sketch(s) for s in sets]
    i, j = ngram_join.sketch_pairs(run, np.tile([len(s) for s in sets], 5), sketches * 5, 80, node)
    nodes, smallest = ngram_join.local_stars(node[i], node[j])
    assert sorted(nodes.tolist()) == list(range(-6, 393)) and set(smallest.tolist()) == {-7}
    assert sum(compared) < 5 * 3 * len(sets)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_share_a_key_that_both_need(percent):
    """Whichever keys are those of long runs."""
    rnd = np.random.default_rng(percent)
    looked_at = spared = 0
    for size in [1, 2, 5, 9, 17, 30, 90, 400]:
        for _ in range(30):
            a = tokens(rnd, size)
            drop = rnd.integers(0, ngram_join.most_differing(size, percent) + 1)
            b = np.unique(np.concatenate([a[drop:], tokens(rnd, int(rnd.integers(0, drop + 2)))]))
            if not len(b) or np.array_equal(a, b) or not signature_tree.overlap_suffices(len(np.intersect1d(a, b)), len(a), len(b), percent):
                continue
            looked_at += 1
            of = [ngram_join.class_keys(x, percent) for x in (a, b)]
            every = np.unique(np.concatenate([keys for classes in of for keys, _ in classes.values()]))
            for share in (0.3, 1):
                long = every[rnd.random(len(every)) < share]
                needed = []
                for classes in of:
                    needed.append(set())
                    for keys, spare in classes.values():
                        of_long = np.sort(keys[np.isin(keys, long)])
                        spared += min(spare, len(of_long))
                        needed[-1] |= set(keys.tolist()) - set(of_long[:spare].tolist())
                assert needed[0] & needed[1]
    assert looked_at > 50 and spared > 300


def test_keys_that_sets_can_do_without(spark):
    one, two = 1 * 64 + 5, 2 * 64 + 5
    keyed = spark.createDataFrame([(k, s) for s in (1, 2, 3) for k in (one, two, 3 * 64 + 4, -64 + 4)], "key long, set_id long")
    sets = spark.createDataFrame([(1, {5: 1, 4: 0}), (2, {5: 0, 4: 7}), (3, {5: 2, 4: 2})], "set_id long, spare map<int,int>")
    found = sorted(tuple(r) for r in ngram_join._needed(keyed, sets).collect())
    assert found == sorted([(two, 1), (3 * 64 + 4, 1), (-64 + 4, 1), (one, 2), (two, 2)])


@pytest.mark.parametrize("whole", [4096, 2])
def test_a_common_passage_makes_no_candidates(spark, monkeypatch, whole):
    """1,000 documents that share more than half of their words, and three groups of similar ones among them."""
    monkeypatch.setattr(ngram_join, "_WHOLE", whole)
    rnd = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(64))
    own = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(1000)]
    group = list(range(1000))
    for first, others in ((0, range(100, 400)), (1, range(500, 502)), (2, [900])):
        for k in others:
            own[k] = list(own[first])
            own[k][rnd.randrange(60)] = f"n{k}"
            group[k] = first
    rows = [(k, f"{passage} {' '.join(words)}") for k, words in enumerate(own)]
    candidates = []
    in_blocks = ngram_join._in_blocks
    monkeypatch.setattr(ngram_join, "_in_blocks", lambda sized: candidates.append(sized.count()) or in_blocks(sized))
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(3), 5, 80)
    assert sorted((r["doc_id"], r["component_id"]) for r in found.collect()) == list(enumerate(group))
    assert whole == 2 or candidates[0] < 400  # 306 of them are similar to others
