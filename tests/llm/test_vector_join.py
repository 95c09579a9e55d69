from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import vector_join as vj

SCHEMA = "vec_id long, embedding array<float>, label int, id string, copies string"


def brute(rows, threshold):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vectors = [np.array(v, np.float32).astype(np.float64) if usable(v) and d is not None else None for d, v in rows]
    n = len(rows)
    linked = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b) and (a @ b) / np.sqrt((a @ a) * (b @ b)) >= threshold:
                linked[i].add(j)
                linked[j].add(i)
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for k in linked[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        component = None if d is None else min(rows[k][0] for k in seen)
        out.append((d, len(linked[i]), component, d is not None and component == d))
    return sorted(out, key=repr)


def run(spark, rows, threshold=0.95):
    df = spark.createDataFrame([(d, v, 1, "x", "y") for d, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vj.near_vectors(df, threshold).collect()), key=repr)


def clustered(seed, n, dims=16):
    rnd = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rnd.normal(size=dims) * 10.0 ** rnd.integers(-3, 3)
        for _ in range(int(rnd.integers(1, 12))):
            v = base + rnd.normal(size=dims) * np.linalg.norm(base) * rnd.choice([0, 0.02, 0.06, 0.08]) * rnd.choice([1, 2])
            rows.append((len(rows) * 3 % 1009, [float(x) for x in (v * rnd.choice([1.0, 2.0])).astype(np.float32)]))
    return rows[:n]


def test_equals_brute_force_over_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vj, "CELL", 30)
    monkeypatch.setattr(vj, "BLOCK", 12)
    rows = clustered(1, 300)
    assert run(spark, rows) == brute(rows, 0.95)


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [1.0, float("nan"), 3.0]), (6, [float("inf"), 1.0, 1.0]), (7, v), (7, v), (8, v), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [2.0, 4.0]), (None, v), (12, [0.0, 1.0, 0.0]), (13, [-0.0, 1.0, 0.0]), (14, [3e38, 0.0, 0.0]), (15, [1e-38, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 0.95)
    assert run(spark, []) == []


def test_bounds_are_rigorous():
    rnd = np.random.default_rng(4)
    unit = vj._unit(np.concatenate([rnd.normal(size=(200, 33)), rnd.normal(size=(200, 33)) ** 7]))
    codes, scale, lengths, errors = q = vj.quantise(unit)
    near = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale[None, :]
    assert (np.abs(unit @ unit.T - near) <= lengths[:, None] * errors[None, :] + errors[:, None] + 1e-12).all()
    for threshold in (0.3, 0.9):
        i, j = vj.possible_pairs(q, q, threshold)
        assert set(zip(*np.nonzero(unit @ unit.T >= threshold), strict=True)) <= set(zip(i, j, strict=True))


@pytest.mark.parametrize("n", [1, 7, 40])
def test_similar_vectors_meet_in_a_cell(n):
    rows = clustered(n, 250)
    unit = vj._unit(np.array([v for _, v in rows]))
    row, cell, own = vj.cells(unit, vj.fit_centres(unit, n), 0.95)
    where = [set() for _ in rows]
    home = {}
    for r, c, o in zip(row.tolist(), cell.tolist(), own.tolist(), strict=True):
        where[r].add(c)
        if o:
            home[r] = c
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.95, 1))
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        assert min(home[a], home[b]) in where[a] & where[b]
