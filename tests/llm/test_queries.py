"""The registered queries: their columns, one row for each row of their table, and digests taken from the operators."""

from __future__ import annotations

import hashlib
import os
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as driver
from ledgerloom.llm import bpe
from ledgerloom.llm.tables import table

SF = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata") + "/sf0.001"

CONTRACT = {
    "op1_html_text": ("pages", "page_id", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op2_mixing": ("documents", "doc_id", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op3_vector_join": ("embeddings", "vec_id", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op4_ngram_join": ("documents", "doc_id", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}),
    "op5_fingerprint": (
        "documents",
        "doc_id",
        {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    ),
    "op7_secret_scan": ("documents", "doc_id", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
    "op8_license_scan": ("documents", "doc_id", {"doc_id": "bigint", "n_licenses": "bigint", "families": "string", "lines": "string"}),
    "op9_quality": ("documents", "doc_id", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op10_byte_bpe": ("documents", "doc_id", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
}


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_and_rows(spark, name):
    of, key, columns = CONTRACT[name]
    df = driver.queries()[name](spark, SF)
    assert columns.items() <= dict(df.dtypes).items()
    rows = df.collect()
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in table(spark, SF, of).select(key).collect())
    assert all(r[c] is not None for r in rows for c in columns if c != "url")


@pytest.mark.parametrize("name", ["op3_vector_join", "op4_ngram_join", "op11_periodic_runs", "op12_suffix_dedup"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for of in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {of} AS SELECT * FROM '{SF}/{of}.parquet'")
    result = con.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = driver.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_all_operators_are_registered():
    numbers = [int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in driver.queries()) if m]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in driver.queries()


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def test_token_digests(spark):
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("expected", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary), special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    for r in driver.queries()["op10_byte_bpe"](spark, SF).collect():
        ids = encoding.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["decoded_sha256"]) == (len(ids), sha(texts[r["doc_id"]].encode()))
        assert r["ids_sha256"] == sha(b"".join(i.to_bytes(4, "little") for i in ids))


def test_secret_digests(spark):
    """The base kinds by plain patterns, each scanned on its own and cut to its least length afterwards."""
    patterns = {
        "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    larger = SF.replace("sf0.001", "sf0.01")  # the smallest table holds no secrets
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, larger, "documents").collect()}
    found = driver.queries()["op7_secret_scan"](spark, larger).collect()
    for r in found:
        spans = [(m.start(), k, kind, m.end()) for k, (kind, (p, ok)) in enumerate(patterns.items()) for m in re.finditer(p, texts[r["doc_id"]], re.ASCII) if ok(m)]
        assert r["base_sha256"] == sha(",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)).encode())
        assert [r[f"n_{kind}"] for kind in patterns] == [sum(s[2] == kind for s in spans) for kind in patterns]
    assert sum(r["n_assign"] for r in found)


def test_scan_of_made_up_secrets():
    from ledgerloom.llm import secret_scan as ss

    encoding = ss._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

    def kinds(text):
        return [(k, text[a:b]) for k, a, b in ss.find_spans(text, encoding, ss.MAX_CHARS_PER_TOKEN)]

    assert kinds("é password: 'abcdef' and PASSWD=x1") == [("assign", "password: 'abcdef")]
    assert kinds("secret=ab token:abcdefg") == [("assign", "token:abcdefg")]
    assert kinds("password:token :abcdefgh") == []
    assert kinds("key q8Zr3vTn0KxWm7LpYc2Hs5Jd end") == [("random", "q8Zr3vTn0KxWm7LpYc2Hs5Jd")]
    for known in ("d41d8cd98f00b204e9800998ecf8427E".upper(), "123e4567-E89B-12d3-a456-426614174000", "internationalization_of_identifiers", "20240101-20240102-20240103", "docs/getting-started/installation"):
        assert not [k for k, _ in kinds(f"see {known} there") if k == "random"], known
    assert ss.mask_spans("a token=abcdef0123456789abcdef012345 b", ss.find_spans("a token=abcdef0123456789abcdef012345 b", encoding, 2.0)) == "a [assign] b"


def test_scan_of_random_values_after_an_equals_sign():
    from ledgerloom.llm import secret_scan as ss

    encoding = ss._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    value = "Zx81kQpLm39fTTuv82AbXcQ9"
    for before, after in [("client_key=", ""), ("https://a.example/x?sig=", "&n=1"), ("AWS_SECRET_ACCESS_KEY=", " end"), ("name = ", "=="), ("a=b=", "")]:
        text = before + value + after
        assert [(k, text[a:b].rstrip("=")) for k, a, b in ss.find_spans(text, encoding, ss.MAX_CHARS_PER_TOKEN)] == [("random", value)], text
        assert value not in ss.mask_spans(text, ss.find_spans(text, encoding, ss.MAX_CHARS_PER_TOKEN))
    for plain in ("name=internationalization_of_identifiers", "a_long_name_of_a_setting=some_long_value_of_a_setting"):
        assert ss.find_spans(plain, encoding, ss.MAX_CHARS_PER_TOKEN) == []


def test_scan_of_random_strings_without_mixed_parts():
    from ledgerloom.llm import secret_scan as ss

    encoding = ss._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

    def kinds(text):
        return [(k, text[a:b]) for k, a, b in ss.find_spans(text, encoding, ss.MAX_CHARS_PER_TOKEN)]

    for secret in ("qzxkvjwpfmtbhgdrnlsyqkjx", "QZXKVJWPFMTBHGDRNLSYQKJX", "XKCD-QWZP-JVBN-RTGF-PLMN", "QZKV-48213975-XJWP-75391846", "4821-9375-1028-5566-7391"):
        assert kinds(f"key {secret} end") == [("random", secret)]
    for plain in (
        "MAX_CHARS_PER_TOKEN_LIMIT", "version-1-2-3-20240101", "2024-01-01_12-30-45-123456", "31-12-2024/01-01-2025/15-02-2025", "20240101T123045-20240102T093000Z", "12345678901234567890123",
        "AWS_SECRET_ACCESS_KEY", "--------------------------", "________________________==", "Donaudampfschifffahrtsgesellschaft",
    ):
        assert kinds(f"see {plain} there") == [], plain
    digits = "0123456789abcdef01234567"
    run = f"Zx81kQpLm39f-{digits}Q-TTuv82AbXcQ9"
    assert kinds(f"key {run} end") == [("random", run), ("hex", digits)]
    assert ss.mask_spans(f"key {run} end", ss.find_spans(f"key {run} end", encoding, 2.0)) == "key [random] end"
    assert kinds(f"at https://a.example/docs/getting-started/{digits} there") == [("hex", digits)]
    assert kinds(f"name my_secret_token={digits}") == [("assign", f"secret_token={digits}"[7:]), ("hex", digits)]
