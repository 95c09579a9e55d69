from __future__ import annotations

import random

import pytest

from ledgerloom.llm import license_scan as ls

SCHEMA = "doc_id long, text string, licenses string, id string"
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "creative-commons",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
    "Licensed under the Mozilla Public License, Version 2.0": "mozilla",
    "// SPDX-License-Identifier: BSD-3-Clause": "bsd",
}


def prose(rnd, n):
    return " ".join("".join(rnd.choices("aeinorst", k=rnd.randint(1, 8))) for _ in range(n))


def test_lines_of_documents(spark):
    rnd = random.Random(1)
    rows, expected = [], {}
    for k in range(200):
        lines = [prose(rnd, rnd.randint(0, 40)) for _ in range(rnd.randint(1, 6))]
        expected[k] = []
        if k % 4 == 0:
            notice = rnd.choice(list(NOTICES))
            at = rnd.randrange(len(lines) + 1)
            lines.insert(at, notice)
            expected[k] = [(at, NOTICES[notice])]
        rows.append((k, "\n".join(lines), "x", "y"))
    found = ls.scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r["doc_id"]: [(x["line"], x["family"]) for x in r["licenses"] if x["confirmed"]] for r in found} == expected


def test_edge_cases(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, mit), (4, mit), (None, f"\n{mit}\n"), (5, "é" * 300_000 + "\n" + mit), (6, f"{mit}\n{mit}")]
    found = ls.scan_licenses(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).coalesce(1)).collect()
    got = [(r["doc_id"], [x["line"] for x in r["licenses"] if x["confirmed"] and x["family"] == "mit"]) for r in found]
    assert got == [(1, []), (2, []), (3, []), (4, [0]), (4, [0]), (None, [1]), (5, [1]), (6, [0, 1])]
    assert ls.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(2)
    return ls.train([prose(rnd, 20) for _ in range(300)])


def test_held_out_variants(model):
    rnd = ls.np.random.default_rng(99)
    right, n = 0, 0
    for family, templates in ls.TEMPLATES.items():
        texts = [ls._varied(t, rnd) for t in templates for _ in range(10)]
        kind, probability = model.score(*ls._lines(texts))
        right += sum(model.families[k] == family and p >= ls.LEAST_PROBABILITY if k < len(model.families) else False for k, p in zip(kind, probability, strict=True))
        n += len(texts)
    assert right / n > 0.9


def test_unknown_lines(model):
    rnd = random.Random(3)
    texts = [prose(rnd, 30) for _ in range(500)] + ["The license plate of the car was blue.", "Version 4 of the story is the last", "He works for the public."]
    kind, probability = model.score(*ls._lines(texts))
    assert not [t for t, k, p in zip(texts, kind, probability, strict=True) if k < len(model.families) and p >= ls.LEAST_PROBABILITY]


@pytest.mark.parametrize("around", [20, 50, 100, 400, 5000])
def test_notices_inside_long_lines(spark, around):
    rnd = random.Random(around)
    rows, expected = [], {}
    for k in range(60):
        words = prose(rnd, around).split(" ")
        expected[k] = []
        if k % 2:
            notice = rnd.choice(list(NOTICES))
            words.insert(rnd.randrange(len(words) + 1), notice)
            expected[k] = [(0, NOTICES[notice])]
        rows.append((k, " ".join(words), "x", "y"))
    found = ls.scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert {r["doc_id"]: [(x["line"], x["family"]) for x in r["licenses"] if x["confirmed"]] for r in found} == expected


def test_several_notices_in_one_line(spark):
    rnd = random.Random(5)
    both = "Licensed under the Mozilla Public License, Version 2.0. Licensed under the Apache License, Version 2.0."
    far = " ".join([prose(rnd, 150), "Released under the MIT License.", prose(rnd, 150), "Licensed under CC BY-NC 4.0.", prose(rnd, 150), "Released under the MIT License."])
    rows = [(1, both), (2, f"{prose(rnd, 100)} {both} {prose(rnd, 100)}"), (3, far), *((10 + k, prose(rnd, 100)) for k in range(100))]
    found = ls.scan_licenses(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).coalesce(1)).collect()
    got = {r["doc_id"]: sorted(x["family"] for x in r["licenses"] if x["confirmed"]) for r in found if r["licenses"]}
    assert got == {1: ["apache", "mozilla"], 2: ["apache", "mozilla"], 3: ["creative-commons", "mit", "mit"]}


def test_every_notice_of_a_family_in_one_line(spark):
    rnd = random.Random(6)
    notice = "Released under the MIT License."
    rows = [(n, " ".join(x for _ in range(n) for x in (prose(rnd, 120), notice))) for n in range(1, 6)] + [(9, f"{notice} {notice} {notice}")]
    rows += [(10 + k, prose(rnd, 100)) for k in range(100)]
    found = ls.scan_licenses(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).coalesce(1)).collect()
    assert {r["doc_id"]: [x["family"] for x in r["licenses"] if x["confirmed"]] for r in found if r["licenses"]} == {n: ["mit"] * n for n in range(1, 6)} | {9: ["mit"] * 3}
