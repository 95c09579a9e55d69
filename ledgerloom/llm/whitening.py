"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the matrix of centred rows, the iteration builds orthonormal right vectors v and left vectors u by alternating products,
    alpha_k u_k = X v_k - beta_(k-1) u_(k-1)        beta_k v_(k+1) = X' u_k - alpha_k v_k,
each fully reorthogonalised. A left vector has an entry for each row of X, so it is never gathered: it is kept as the
combination of columns that gives it, u_k = X p_k, and both products of a step are taken in one distributed pass, in which
each task turns its rows into entries X p and adds up its part of X'(X p). The driver holds numbers whose count depends on the vectors' length alone.

The small bidiagonal matrix's singular vectors, taken back by the right vectors, are the components, and its
singular values over sqrt(n) their deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from ledgerloom.llm.tables import Scratch
from ledgerloom.llm.words import tidy

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000  # Fixed values: entries become floor(SCALE * c) + SHIFT.
TOLERANCE = 1e-13  # of a component's residual, as a share of the largest singular value
_TINY = 1e-12  # of a product's norm, as a share of the largest: nothing but rounding is left
_NO_VARIANCE = 1e-8  # of a deviation, as a share of the largest
_LARGEST = 1 << 30  # entries from here on count as not finite, so that exact squares fit a decimal
_SEED = 20_240_613


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _sums(rows: DataFrame, column: str, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum, over all rows, of a vector of ``width`` numbers that ``of`` gives for each block of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["at", "value"])

    parts = rows.select(column).mapInArrow(tidy(run), "at int, value double")
    out = np.zeros(width)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():  # ``width`` rows
        out[row["at"]] = row["value"]
    return out


def _without(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``w`` without its part in the span of the orthonormal columns of ``basis``; twice, for rounding."""
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def bidiagonalise(gram_product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of X and its right singular vectors (columns).

    ``gram_product`` gives X'(X p). A start vector finds one vector of each singular value. Hence once the wanted values
    have converged, a new random start, orthogonal to what was found, goes on until those values
    stay as they are; the same happens where a product vanishes. After ``width`` steps everything is found.
    """
    rng = np.random.default_rng(_SEED)
    right = np.zeros((width, 0))  # v
    left = np.zeros((width, 0))  # p, so that u = X p
    images = np.zeros((width, 0))  # X' u
    alphas: list[float] = []
    betas: list[float] = []  # beta_k couples steps k and k + 1

    def fresh() -> np.ndarray:
        v = _without(rng.standard_normal(width), right)
        return v / np.linalg.norm(v)

    def triplets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        small = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)
        u, s, vt = np.linalg.svd(small)
        return u, s, vt

    v, beta, largest, settled = fresh(), 0.0, 0.0, None
    while right.shape[1] < width:
        right = np.column_stack([right, v])
        p = v - beta * left[:, -1] if beta else v.copy()
        image = gram_product(p)
        # The left vectors' inner products with the new one, and again what they leave.
        for _ in range(2):
            c = left.T @ image if left.shape[1] else np.zeros(0)
            p, image = p - left @ c, image - images @ c
        alpha = float(np.sqrt(max(p @ image, 0.0)))
        largest = max(largest, alpha)
        if alpha <= _TINY * largest or alpha == 0.0:
            # X v lies in the span of the left vectors: nothing new, and no coupling to go on from.
            left, images = np.column_stack([left, np.zeros(width)]), np.column_stack([images, np.zeros(width)])
            alphas.append(0.0)
            beta = 0.0
        else:
            left, images = np.column_stack([left, p / alpha]), np.column_stack([images, image / alpha])
            alphas.append(alpha)
            w = _without(images[:, -1] - alpha * v, right)
            beta = float(np.linalg.norm(w))
            largest = max(largest, beta)
            if beta <= _TINY * largest:
                beta = 0.0
        restart = not beta
        u, s, _ = triplets()
        if len(alphas) > wanted and (beta * np.abs(u[-1, :wanted]) <= TOLERANCE * s[0]).all():
            if settled is not None and np.allclose(s[:wanted], settled, rtol=1e-13, atol=1e-14 * s[0]):
                break
            settled, restart = s[:wanted].copy(), True
        if right.shape[1] == width:
            break
        if restart:
            beta, v = 0.0, fresh()
        else:
            v = w / beta
        betas.append(beta)
    _, s, vt = triplets()
    return s[:wanted], right @ vt[:wanted].T


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each vector on the ``components`` directions of greatest variance, scaled to variance 1.

    Returns, for each remaining row and component, ``id_col``, ``component`` (from 1, by falling variance), ``n``
    (vectors), ``deviation`` (the exact sum over dimensions of (n * x - S)^2, decimal), ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null, empty, or holds null or non-finite entries (or some of 2^30 and more) go; so do vectors whose
    length isn't the most frequent one (of equally frequent ones, the greatest). Each entry c of the others becomes the
    whole number x = floor(1024 * c) + 100000; S are the sums of x, V is their covariance with divisor n, centred before it is
    multiplied. Components without variance are left out, so that one vector, or equal ones only, give
    no rows, and so does an empty table. Ids, null or repeated, are handed through; other columns aren't read.
    """
    scratch = Scratch(df.sparkSession, "whitening")
    source = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    def fine(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST)

    whole = source.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fine))
    entries = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = scratch.write(whole.select("id", entries.alias("x")))
    schema = StructType(
        [
            StructField(id_col, df.schema[id_col].dataType),
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", DecimalType(38, 0)),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).take(1)
    if not lengths:
        return df.sparkSession.createDataFrame([], schema)
    width, n = lengths[0]["size"], lengths[0]["count"]
    rows = rows.where(F.size("x") == width)
    # Whole sums and extremes: exact.
    by_place = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    places = {r["at"]: r for r in by_place.collect()}  # ``width`` rows
    sums = np.array([places[k]["s"] for k in range(width)], np.int64)
    spread = max(max(n * places[k]["hi"] - int(sums[k]), int(sums[k]) - n * places[k]["lo"]) for k in range(width))
    mean = sums / n

    def centred(x: np.ndarray) -> np.ndarray:
        return x - mean

    variances = _sums(rows, "x", width, lambda x: (centred(x) ** 2).sum(axis=0)) / n

    def gram_product(p: np.ndarray) -> np.ndarray:
        return _sums(rows, "x", width, lambda x: centred(x).T @ (centred(x) @ p))

    trace = float(variances.sum())
    if not trace:
        return df.sparkSession.createDataFrame([], schema)
    values, directions = bidiagonalise(gram_product, width, min(components, width))
    keep = values > _NO_VARIANCE * values[0]
    values, directions = values[keep], directions[:, keep]
    eigenvalues = values**2 / n
    scaled = directions / np.sqrt(eigenvalues)
    k = len(values)
    means = _sums(rows, "x", k, lambda x: (centred(x) @ scaled).sum(axis=0)) / n

    def products(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled - means
        return (z.T @ z).ravel()

    error = float(np.abs(_sums(rows, "x", k * k, products).reshape(k, k) / n - np.eye(k)).max())
    explained = eigenvalues / trace
    exact_in_longs = spread**2 * width < 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            off = n * x - sums
            deviations = (off * off).sum(axis=1).tolist() if exact_in_longs else (off.astype(object) ** 2).sum(axis=1).tolist()
            m = len(x)
            from_row = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column(0).take(from_row),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()),
                pa.array(deviations, pa.decimal128(38, 0)).take(from_row),
                pa.array((centred(x) @ scaled).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(tidy(run), schema)
