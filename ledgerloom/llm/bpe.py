"""Byte-level BPE encoding and decoding by DuckDB's recursive queries inside each task.

Every task encodes the distinct pieces of its texts; words it has met before are known by a 64-bit hash,
and since ids must decode to the text's own bytes, a wrong match can't go unnoticed. A piece that is a token is that token. Of the
others, each step of the recursion holds one row per token position, with the token after it and the
merge that the two would make; it contracts each piece's leftmost pair of least rank until no pair of
the piece is in the merge table. Decoding joins ids to the vocabulary's bytes and aggregates them in
order of position.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import bound_batches
from ledgerloom.llm.words import flat_bytes, give_back, span_hashes, tidy

KEPT_WORDS = 800_000  # words whose ids a task keeps from batch to batch, about 60 MB
_TEXT_BYTES = 1 << 20  # of texts taken at once
_STATE_ROWS = 3_000_000  # rows that one recursion holds at most, over all its steps
_PIECES = 20_000

_SPACED = re.compile(r"\s ")

_DIRECT = "SELECT w, id FROM pieces JOIN vocabulary ON token = piece"

_MERGE = """
WITH RECURSIVE step(n, w, p, l, r, id) AS (
  SELECT 0, s.w, s.p, s.l, s.r, m.id FROM start s LEFT JOIN merges m ON m.l = s.l AND m.r = s.r
  UNION ALL
  (WITH best AS (SELECT w, min(id::BIGINT << 32 | p) AS best FROM step WHERE id IS NOT NULL AND n < {steps} GROUP BY w),
   cut AS (SELECT w, (best >> 32)::INT AS x, (best & 4294967295)::INT AS place FROM best),
   kept AS (
     SELECT n + 1 AS n, s.w, p - (p > place)::INT AS p, CASE WHEN p = place + 1 THEN x ELSE l END AS l, CASE WHEN p = place - 1 THEN x ELSE r END AS r
     FROM step s JOIN cut ON s.w = cut.w WHERE p <> place)
   SELECT k.n, k.w, k.p, k.l, k.r, m.id FROM kept k LEFT JOIN merges m ON m.l = k.l AND m.r = k.r)
)
SELECT s.w, s.l AS id, s.id IS NOT NULL AS more
FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) ended ON s.w = ended.w AND s.n = ended.n
ORDER BY s.w, s.p
"""

_DECODE = "SELECT unhex(string_agg(hex, '' ORDER BY p)) AS bytes FROM encoded JOIN vocabulary USING (id) GROUP BY w ORDER BY w"


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _positions(lengths: np.ndarray) -> np.ndarray:
    return (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)


class Ragged:
    """Sequences of one type, one after another in a growing array."""

    def __init__(self, dtype):
        self.flat, self.ends, self.n = np.zeros(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0

    def used(self) -> int:
        return int(self.ends[self.n - 1]) if self.n else 0

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used, n = self.used(), self.n + len(lengths)
        if used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(used // 2 + 2 * len(flat), self.flat.dtype)])
        if n > len(self.ends):
            self.ends = np.concatenate([self.ends[: self.n], np.zeros(n, np.int64)])
        self.flat[used : used + len(flat)] = flat
        self.ends[self.n : n] = used + np.cumsum(lengths)
        self.n = n

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences numbered ``at``, one after another, and their lengths."""
        ends = self.ends[at]
        starts = np.where(at > 0, self.ends[np.maximum(at, 1) - 1], 0)
        lengths = ends - starts
        return self.flat[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())], lengths


def _grouped(lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Sums of lengths over consecutive groups of so many."""
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.cumsum(groups)
    return total[ends] - total[ends - groups]


class Codec:
    """Vocabulary and merge table in an in-memory DuckDB database of one task."""

    def __init__(self, vocabulary: str, pattern: str):
        ranks = read_ranks(vocabulary)
        merges = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pattern = regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        self.db.register("ranks", pa.table({"token": pa.array(list(ranks), pa.binary()), "id": pa.array(list(ranks.values()), pa.int32())}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT token, id, hex(token) AS hex FROM ranks")
        self.db.register("pairs", pa.table({k: pa.array([m[j] for m in merges], pa.int32()) for j, k in enumerate(("l", "r", "id"))}))
        self.db.execute("CREATE TABLE merges AS SELECT l, r, id FROM pairs")
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes of kept words, sorted
        self.ids, self.bytes = Ragged(np.int32), Ragged(np.uint8)

    def _rows(self, sql: str, **tables: dict) -> pa.Table:
        for name, columns in tables.items():
            self.db.register(name, pa.table(columns))
        return self.db.sql(sql).to_arrow_table()

    def _contracted(self, w: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fixpoints of token sequences, given and returned as rows of number and token in order."""
        done = []
        while len(w):
            lengths = np.diff(np.append(np.flatnonzero(np.diff(w, prepend=-1)), len(w)))
            steps = np.cumsum(lengths * np.minimum(lengths, 64))
            taken = max(1, min(_PIECES, int(np.searchsorted(steps, _STATE_ROWS))))
            n = int(lengths[:taken].sum())
            right = np.append(ids[1:n], np.int32(-1))
            right[np.cumsum(lengths[:taken]) - 1] = -1
            start = {"w": w[:n], "p": _positions(lengths[:taken]), "l": ids[:n], "r": right}
            found = self._rows(_MERGE.format(steps=max(4, _STATE_ROWS // n)), start=start)
            found_w, found_id, more = (found.column(c).to_numpy() for c in ("w", "id", "more"))
            open_rows = np.isin(found_w, found_w[more]) if more.any() else more
            done.append((found_w[~open_rows], found_id[~open_rows]))
            w, ids = np.concatenate([found_w[open_rows], w[n:]]), np.concatenate([found_id[open_rows], ids[n:]])
        return tuple(np.concatenate(c) for c in zip(*done, strict=True)) if done else (w, ids)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces, none of them empty, one after another, and how many each has."""
        number = np.arange(len(pieces), dtype=np.int32)
        direct = self._rows(_DIRECT, pieces={"w": number, "piece": pa.array(pieces, pa.binary())})
        known_w, known_id = direct.column("w").to_numpy(), direct.column("id").to_numpy()
        lengths = np.array([len(p) for p in pieces], np.int64)
        w = np.repeat(number, lengths)
        rest = ~np.isin(number, known_w)[w]
        w, ids = self._contracted(w[rest], self.byte[np.frombuffer(b"".join(pieces), np.uint8)[rest]])
        w, ids = np.concatenate([w, known_w]), np.concatenate([ids, known_id])
        return ids[np.argsort(w, kind="stable")], np.bincount(w, minlength=len(pieces))

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of sequences of ids, none of them empty."""
        rows = {"w": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), "p": _positions(lengths), "id": ids}
        return self._rows(_DECODE, encoded=rows).column("bytes").to_pylist()

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts of the texts begin that the pattern splits as it splits the whole.

        A space after anything but white space begins a match, and the match before it has ended; a text
        is cut at its spaces if it has no others. Otherwise its parts are the matches.
        """
        spaces = np.flatnonzero(raw == 32)
        cuts, apart = [offsets[:-1][np.diff(offsets) > 0], spaces], []
        for k in range(len(offsets) - 1):
            value = raw[offsets[k] : offsets[k + 1]].tobytes()
            if b"  " in value or value[:1] == b" " or value[-1:] == b" " or _SPACED.search(value.decode()):
                matches = self.pattern.findall(value.decode())
                apart.append(k)
                cuts.append(offsets[k] + np.cumsum([0, *(len(m.encode()) for m in matches[:-1])]))
        if apart:
            inside = np.isin(np.searchsorted(offsets, spaces, side="right") - 1, apart)
            cuts[1] = spaces[~inside]
        return np.unique(np.concatenate(cuts))

    def learn(self, words: list[str]) -> None:
        """Encodes and decodes words not seen before, and appends them to the kept ones."""
        pieces: dict[str, int] = {}
        split, counts = [], []
        for word in words:
            found = self.pattern.findall(word)
            split += [pieces.setdefault(p, len(pieces)) for p in found]
            counts.append(len(found))
        ids, lengths = self.encode_pieces([p.encode() for p in pieces])
        decoded = self.decode(ids, lengths)
        of_piece = Ragged(np.int32), Ragged(np.uint8)
        of_piece[0].extend(ids, lengths)
        of_piece[1].extend(np.frombuffer(b"".join(decoded), np.uint8), np.array([len(d) for d in decoded], np.int64))
        for kept, piece in zip((self.ids, self.bytes), of_piece, strict=True):
            flat, each = piece.take(np.array(split, np.int64))
            kept.extend(flat, _grouped(each, np.array(counts, np.int64)))

    def _placed(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word among the kept ones; new ones are learnt."""
        hashes, first, of = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            number = self.ids.n + np.arange(new.sum())
            self.learn([raw[starts[k] : ends[k]].tobytes().decode() for k in first[new].tolist()])
            known, place = np.concatenate([self.known, hashes[new]]), np.concatenate([self.place, number])
            order = np.argsort(known, kind="stable")
            self.known, self.place = known[order], place[order]
            at = np.searchsorted(self.known, hashes)
        return self.place[at][of]

    def run(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Token ids of all texts and the bytes that they decode to, both one after another with their lengths."""
        if self.ids.n > KEPT_WORDS:
            self.forget()
        starts = self._cuts(raw, offsets)
        at = self._placed(raw, starts, np.append(starts[1:], len(raw)))
        counts = np.diff(np.searchsorted(starts, offsets))
        out = []
        for kept in (self.ids, self.bytes):
            flat, each = kept.take(at)
            out.append((flat, _grouped(each, counts)))
        if not np.array_equal(out[1][0], raw):  # two words with one hash
            return self._without_hashes(raw, offsets)
        return out

    def _without_hashes(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """As :meth:`run`, from the matches themselves."""
        matches = [self.pattern.findall(raw[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        pieces = {p: k for k, p in enumerate(dict.fromkeys(p for m in matches for p in m))}
        ids, lengths = self.encode_pieces([p.encode() for p in pieces])
        decoded = self.decode(ids, lengths)
        out, counts = [], np.array([len(m) for m in matches], np.int64)
        at = np.array([pieces[p] for m in matches for p in m], np.int64)
        for flat, each in ((ids, lengths), (np.frombuffer(b"".join(decoded), np.uint8), np.array([len(d) for d in decoded], np.int64))):
            store = Ragged(flat.dtype)
            store.extend(flat, each)
            taken, each = store.take(at)
            out.append((taken, _grouped(each, counts)))
        return out


def _binary(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(flat)
    offsets = np.concatenate(([0], np.cumsum(lengths * flat.itemsize))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat.view(np.uint8))])


def encode_decode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` and ``decoded`` of every row: the text's token ids as little-endian unsigned
    32-bit integers, and the bytes that they decode to.

    ``vocabulary`` is a rank file that every executor can read, ``pattern`` splits texts before merging;
    there are no special tokens. Null and empty texts have no ids. Rows are independent, so repeated
    rows and null ids give a row each; other columns are not read. The time for one match of the
    pattern grows with the square of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary, pattern)
        give_back()
        try:
            for batch in batches:
                raw, offsets = flat_bytes(batch.column(1))
                at = 0
                while at < batch.num_rows:
                    upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TEXT_BYTES, side="right")) - 1)
                    (ids, n_ids), (decoded, n_bytes) = codec.run(raw[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at])
                    columns = [batch.column(0).slice(at, upto - at), _binary(ids.astype("<u4"), n_ids), _binary(decoded, n_bytes)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"])
                    at = upto
                give_back()
        finally:
            codec.db.close()

    bound_batches(df.sparkSession)
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(tidy(run), f"id {source.schema['id'].dataType.simpleString()}, ids binary, decoded binary").withColumnRenamed("id", id_col)
