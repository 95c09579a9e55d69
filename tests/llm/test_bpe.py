from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bpe
from ledgerloom.llm.words import flat_bytes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(VOCABULARY, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def expected():
    return tiktoken.Encoding("expected", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def ids(raw: bytes) -> list[int]:
    return [int.from_bytes(raw[k : k + 4], "little") for k in range(0, len(raw), 4)]


def run(codec, texts):
    (ids, n_ids), (decoded, n_bytes) = codec.run(*flat_bytes(pa.array(texts, pa.string())))
    cut = lambda flat, n: np.split(flat, np.cumsum(n)[:-1])
    return [(i.tolist(), b.tobytes()) for i, b in zip(cut(ids, n_ids), cut(decoded, n_bytes), strict=True)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab \n\t'sÉ1,", max_size=40)), min_size=1, max_size=5))
def test_equals_the_library(codec, expected, texts):
    for text, (found, decoded) in zip(texts, run(codec, texts), strict=True):
        assert found == expected.encode_ordinary(text)
        assert decoded == text.encode()


def test_rounds_continue_where_they_ended(codec, expected, monkeypatch):
    monkeypatch.setattr(bpe, "_STATE_ROWS", 500)
    text = "ab" * 300 + " " + "thereinafterwards" * 20
    assert run(codec, [text])[0][0] == expected.encode_ordinary(text)


def test_forgetting_words(codec, expected, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    for text in ["one two three four five", "one six", "seven"]:
        assert run(codec, [text])[0][0] == expected.encode_ordinary(text)


def test_words_with_one_hash(codec, expected, monkeypatch):
    codec.forget()
    monkeypatch.setattr(bpe, "span_hashes", lambda raw, starts, ends: (ends - starts).astype(np.uint64))
    for text in ["ab cd efg", "xy zw", ""]:
        assert run(codec, [text, "ab"]) == [(expected.encode_ordinary(t), t.encode()) for t in (text, "ab")]
    codec.forget()


def test_every_row(spark, expected):
    texts = [None, "", "Hello  world", "it's\n\n fine ", "x" * 3000, "Hello  world"]
    rows = [(k % 4 if k else None, t, "en", b"z") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, ids binary")
    found = sorted((r["doc_id"] or -1, ids(r["ids"]), bytes(r["decoded"])) for r in bpe.encode_decode(df, VOCABULARY, public_tokenizers.PATTERN).collect())
    assert found == sorted((d or -1, expected.encode_ordinary(t or ""), (t or "").encode()) for d, t, _, _ in rows)
    assert bpe.encode_decode(df.limit(0), VOCABULARY, public_tokenizers.PATTERN).collect() == []
