"""Secret scans: patterns for known forms, and a token-efficiency test for random strings.

A tokenizer's vocabulary holds what is frequent in real text, so words cost few tokens and
random strings many. A run of key-like characters whose characters per token fall below a
threshold is reported, unless by its form it is a digest of a known length, a UUID, a number or dates, or
it is an identifier: words that by themselves are above the threshold, and fewer digits than letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import tidy

KINDS = ("assign", "access", "hex", "random")  # spans with equal starts come in this order
MIN_RANDOM_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.0
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)  # hexadecimal digits of md5, sha1, sha224, sha256, sha384, sha512

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_MIN = 6
# A run that is too short holds no longer run, so the least length can stand in the pattern here.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# What follows "=" is a value; "=" itself belongs to a run as its padding only.
_KEY_LIKE = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_RANDOM_CHARS},}}(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?")
_UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}")
_MONTH, _DAY = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
_TIME = "(?:[01][0-9]|2[0-3])[-_]?[0-5][0-9](?:[-_]?[0-5][0-9](?:[-_]?[0-9]{1,9})?)?Z?"
# Years, months, days in either order, and times behind days.
_DATE = re.compile(
    rf"(?<![A-Za-z0-9])(?:(?:19|20)[0-9]{{2}}(?:[-_/]?{_MONTH}[-_/]?{_DAY}(?:[-_T]?{_TIME})?|[-_/]{_MONTH})?|[0-3]?[0-9][-_/][0-3]?[0-9][-_/](?:19|20)[0-9]{{2}})(?![A-Za-z0-9])"
)


@lru_cache(maxsize=2)
def _encoding(vocabulary: str, pattern: str):
    import base64

    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def is_known(run: str) -> bool:
    """Digests, UUIDs, numbers and dates by their form."""
    body = run.rstrip("=")
    if body.isdigit() or _UUID.fullmatch(body) or (len(body) in DIGEST_LENGTHS and _HEX_ONLY.fullmatch(body)):
        return True
    return not _DATE.sub("", body).strip("-_/+")


def is_identifier(run: str, encoding, max_chars_per_token: float) -> bool:
    """Words of real text, dates and short numbers, with more letters than digits outside dates."""
    parts = [p for p in re.split(r"[-_/+]+", _DATE.sub("", run.rstrip("="))) if p]
    words = [p for p in parts if not p.isdigit()]
    letters = sum(map(len, words))
    if not all(_PART.fullmatch(p) for p in parts) or sum(map(len, parts)) >= 2 * max(1, letters):
        return False
    return letters >= max_chars_per_token * sum(len(encoding.encode_ordinary(w)) for w in words)


def _is_random(pieces: list[str], encoding, max_chars_per_token: float) -> bool:
    """Whether a run's pieces together have few characters a token; known forms and identifiers don't count."""
    tokens = [len(encoding.encode_ordinary(p)) for p in pieces]
    if sum(map(len, pieces)) >= max_chars_per_token * sum(tokens):
        return False
    return any(not is_known(p) and not is_identifier(p, encoding, max_chars_per_token) for p in pieces)


def _outside(text: str, start: int, end: int, base: list[tuple[int, int]]) -> list[str]:
    """The pieces of a run that no base finding covers; all of it if there is none."""
    pieces, at = [], start
    for low, high in base:
        if low < end and at < high:
            pieces.append(text[at : max(at, low)])
            at = high
    if at == start:
        return [text[start:end]]
    pieces.append(text[at:end])
    return [p for p in pieces if p.strip("-_/+=")]


def find_spans(text: str, encoding, max_chars_per_token: float) -> list[tuple[str, int, int]]:
    """Kind, start and end in code points of all findings, by start and then in the order of KINDS."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_MIN]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    base = sorted((start, end) for _, start, end in found)
    for m in _KEY_LIKE.finditer(text):
        # Base findings inside a run don't hide the rest of it: that decides, and the run is reported whole.
        if _is_random(_outside(text, m.start(), m.end(), base), encoding, max_chars_per_token):
            found.append(("random", m.start(), m.end()))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def mask_spans(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(
    df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", max_chars_per_token: float = MAX_CHARS_PER_TOKEN
) -> DataFrame:
    """``id_col`` and ``spans`` of every row: kind, start and end (code points, end exclusive).

    ``vocabulary`` is a tiktoken rank file that every executor can read, ``pattern`` its split pattern. The token test looks at
    runs of ``MIN_RANDOM_CHARS`` characters and more: the fewer characters, the more words and names have as few for each token.
    Null and empty texts have no spans; rows are independent, so repeated rows and null ids give a row
    each. Other columns of any name are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(t.as_py() or "", encoding, max_chars_per_token)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(tidy(run), f"id {source.schema['id'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def mask_secrets(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """All rows and columns of ``df``, with every finding in ``text_col`` replaced by its kind in brackets.

    A null text stays null, and a text without findings stays as it is.
    """
    names = df.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        for batch in batches:
            column = batch.column(at)
            texts = [t if t is None else mask_spans(t, find_spans(t, encoding, max_chars_per_token)) for t in column.to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))

    return df.mapInArrow(tidy(run), df.schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
