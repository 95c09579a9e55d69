from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm.components import connected_components, local_stars
from ledgerloom.llm.tables import Scratch


def brute(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def graphs():
    rnd = random.Random(1)
    yield []
    yield [(k, k + 1) for k in range(200)]
    shuffled = list(range(300))
    rnd.shuffle(shuffled)
    yield list(zip(shuffled[:-1], shuffled[1:], strict=True))
    yield [(0, k) for k in range(1, 500)] + [(1000, k) for k in range(499, 700)]
    yield [(rnd.randrange(-200, 200), rnd.randrange(-200, 200)) for _ in range(150)]


@pytest.mark.parametrize("edges", graphs())
def test_components(spark, edges):
    expected = brute([e for e in edges if e[0] != e[1]])
    df = spark.createDataFrame([*edges, (None, 5), (7777, 7777)], "a long, b long")
    found = connected_components(df, Scratch(spark, "test")).collect()
    assert len(found) == len(expected) and {r["node"]: r["component"] for r in found} == expected
    a, b = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    nodes, smallest = local_stars(a, b)
    loops = {x: x for e in edges for x in e}
    assert loops | dict(zip(nodes.tolist(), smallest.tolist(), strict=True)) == brute(edges)
