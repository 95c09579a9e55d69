"""Quality classifier from positive and unlabelled texts.

Trusted positives are rows labelled 1; unlabelled web text is a sample of all documents. A logistic
model on statistics of the text minimises the non-negative unbiased risk

    prior * E+[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E+[loss(-)])

with the prior estimated as the share of 1 among the labelled training rows. Both samples are bounded
(parameters); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerloom.llm.words import flat_bytes, shingle_hashes, span_hashes, tidy, word_spans

POSITIVES = 6000  # labelled rows in the sample at most
UNLABELLED = 12_000  # unlabelled rows in the sample, about
THRESHOLD = 0.3
_TEXT_BYTES = 1 << 20

_SYMBOLS = b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"


def _byte_classes() -> np.ndarray:
    classes = np.zeros((256, 7 + len(_SYMBOLS)), np.float64)
    classes[ord("A") : ord("Z") + 1, 0] = 1
    classes[ord("a") : ord("z") + 1, 1] = 1
    classes[ord("0") : ord("9") + 1, 2] = 1
    classes[128:, 3] = 1
    classes[[ord("."), ord(",")], 4] = 1
    classes[ord("\n"), 5] = 1
    classes[:32, 6] = 1
    for k, symbol in enumerate(_SYMBOLS):
        classes[symbol, 7 + k] = 1
    return classes


_CLASSES = _byte_classes()
_UPPER, _LOWER_CASE = _CLASSES[:, 0].astype(bool), _CLASSES[:, 1].astype(bool)
_SYMBOL = _CLASSES[:, 7:].any(axis=1)


def _distinct(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(values[a:b])) for a, b in zip(begin[:-1], begin[1:], strict=True)], np.float64)


def _sums(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return (total[begin[1:]] - total[begin[:-1]]).astype(np.float64)


def _features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.repeat(np.arange(n, dtype=np.int64) * 256, size)
    histogram = np.bincount(text + raw, minlength=256 * n).reshape(n, 256)
    starts, ends, first = word_spans(raw, offsets)
    words = span_hashes(raw, starts, ends, lower=True)
    count = np.diff(first).astype(np.float64)
    some = np.maximum(count, 1)
    shingles, begin = shingle_hashes(words, first, 3)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    inside = first[:-1][first[:-1] < len(words)]
    same[inside] = False
    upper, lower = (np.concatenate(([0], np.cumsum(flag[raw]))) for flag in (_UPPER, _LOWER_CASE))
    shouted = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])
    length = (ends - starts).astype(np.float64)
    last_symbol = _SYMBOL[raw[ends - 1]] if len(ends) else np.zeros(0, bool)
    columns = [
        np.log1p(count),
        _sums(length, first) / some,
        _sums(same, first) / some,
        _distinct(words, first) / some,
        _distinct(shingles, begin) / np.maximum(np.diff(begin), 1),
        _sums(shouted, first) / some,
        _sums(last_symbol, first) / some,
        _sums(last_symbol & (length == 1), first) / some,
    ]
    return np.column_stack([*columns, histogram @ _CLASSES / np.maximum(size, 1)[:, None]])


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of statistics for each text: words, repetition, capitals, symbols and kinds of bytes."""
    raw, offsets = flat_bytes(texts)
    out, at = [np.zeros((0, 8 + _CLASSES.shape[1]))], 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TEXT_BYTES, side="right")) - 1)
        out.append(_features(raw[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]))
        at = upto
    return np.concatenate(out)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, start: int = 300, rate: float = 0.05, decay: float = 1e-3, slack: float = 0.01
) -> Model:
    """Logistic model of least non-negative risk, by Adam.

    The first ``start`` steps take the logistic loss, whose gradient reaches far, the others the sigmoid loss, which
    bounds what one text weighs. Where the risk of the negative part falls below ``-slack``, which no true risk does,
    its gradient is turned round.
    """
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-4)
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def mean_gradient(x, error):
        return np.append(x.T @ error, error.sum()) / len(x)

    for step in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        if step <= start:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            of_positive, of_negative = prior * mean_gradient(p, sp - 1), mean_gradient(u, su) - prior * mean_gradient(p, sp)
        else:
            negative = su.mean() - prior * sp.mean()
            of_positive = -prior * mean_gradient(p, sp * (1 - sp))
            of_negative = mean_gradient(u, su * (1 - su)) + of_positive
        gradient = of_positive + of_negative if negative >= -slack else -of_negative
        gradient[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return Model(mean, scale, w, float(b), prior)


def held_out(identifier: Column) -> Column:
    return F.coalesce(F.crc32(identifier.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), or None without a positive row.

    Only labels of rows that aren't held out are looked at, and no held-out text. An id with both labels
    isn't trusted. The samples are the rows with the least hashes of their ids, at most ``positives`` labelled
    rows and about ``unlabelled`` others, whose statistics are gathered.
    """
    order = F.xxhash64(F.lit("quality"), F.col("doc_id").cast("string"))
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    share, n = known.agg(F.avg(F.col("quality").cast("double")), F.count("*")).first()
    total = docs.count()
    if not share or not total:
        return None
    trusted = known.where("quality = 1").orderBy(order, "doc_id").limit(positives).select("doc_id", F.lit(True).alias("positive"))
    share = min(share, 1 - 1 / (n + 2))  # Laplace: labelled rows of one class don't make the other impossible
    span = min(1.0, unlabelled / total)
    drawn = order < F.lit(int(-(2**63) + span * (2**64 - 1)) if span < 1 else 2**63 - 1)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(~held_out(F.col("doc_id")))
    # At most `positives` rows of an id and a flag: small enough to broadcast at any size of input.
    sample = rows.join(F.broadcast(trusted), "doc_id", "left").select("text", F.coalesce("positive", F.lit(False)).alias("positive"), drawn.alias("drawn")).where("positive or drawn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = pa.array(list(text_features(batch.column(0))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([features, batch.column(1), batch.column(2)], names=["features", "positive", "drawn"])

    found = sample.mapInArrow(tidy(run), "features array<double>, positive boolean, drawn boolean").toArrow()
    if not found.num_rows:
        return None
    features = np.array(found.column("features").to_pylist(), np.float64)
    positive, chosen = (np.array(found.column(c).to_pylist(), bool) for c in ("positive", "drawn"))
    if not positive.any() or not chosen.any():
        return None
    # Rows come in any order; the sums of the fit shouldn't depend on it.
    order_of = lambda x: x[np.lexsort(x.T)]
    return fit_pu(order_of(features[positive]), order_of(features[chosen]), share)


def score(df: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``df`` and ``score_col``, 0 to 1; without a model it is 0.5.

    Null texts count as empty, and an empty text has a score as any other. A column of the name of
    ``score_col`` is replaced.
    """
    if model is None:
        return df.withColumn(score_col, F.lit(0.5))
    rows = df.drop(score_col)
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(text_features(batch.column(at).cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_col])

    return rows.mapInArrow(tidy(run), StructType([*rows.schema.fields, StructField(score_col, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (1 from a score of 0.3 on) and ``held_out``; learns from ``labels``.

    Null and empty texts, null ids, repeated rows and further columns give a row each as they are; columns
    of these three names are replaced. An empty table gives an empty result.
    """
    scored = score(docs, train(docs, labels))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).withColumn("held_out", held_out(F.col("doc_id")))
