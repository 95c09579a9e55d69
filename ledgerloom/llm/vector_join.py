"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

1. Equal vectors count as one, with their number.
2. Centres, fitted on a bounded sample, deal vectors into cells. If u lies nearest to centre i and v
   nearer to centre j by a margin, then |u - v| is at least margin / |cj - ci|; v is also sent to cell i
   when that leaves room for a similar u. A pair of different cells is compared in the lower one.
3. A cell's own vectors and its guests are cut into blocks; a tile is a pair of blocks, one at least of own
   vectors since two guests meet elsewhere, and multiplies their vectors quantised to int8.
   Each vector knows the length of its quantisation error, which bounds how far a product can be off.
   Pairs that may reach the threshold are recomputed in double precision.
4. A tile returns the number of links of each vector, and links enough to connect what is connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ledgerloom.llm.components import connected_components, local_stars
from ledgerloom.llm.signature_tree import Forest
from ledgerloom.llm.tables import Scratch

SAMPLE = 4096  # vectors on which centres are fitted, at most
MOST_CENTRES = 512
CELL = 4000  # vectors in a cell that the number of centres aims at
BLOCK = 4096  # vectors in a block, about
_ROWS = 256  # of a tile that are multiplied at once
_SLACK = 1e-5  # beyond what single precision loses on bounds of about 1


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales, lengths of the quantised vectors and lengths of the errors, of rows of length 1."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.linalg.norm(near, axis=1), np.linalg.norm(unit - near, axis=1)


def possible_pairs(a, b, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two quantised blocks whose cosine may reach the threshold.

    With x = qx + ex for each vector, x.y - qx.qy = qx.ey + ex.y, of which the first is at most |qx||ey|
    and the second, y being of length 1, at most |ex|. Products of codes are whole numbers below 2**24
    for up to 1040 dimensions, and so exact in single precision; for more, double precision is used.
    """
    (ca, sa, na, ea), (cb, sb, _, eb) = a, b
    exact = np.float32 if ca.shape[1] <= 1040 else np.float64
    most = ca.astype(exact) @ cb.astype(exact).T
    most *= sa.astype(exact)[:, None]
    most *= sb.astype(exact)[None, :]
    most += ea.astype(exact)[:, None]
    most += (na.max() * eb).astype(exact)[None, :]
    return np.nonzero(most >= threshold - _SLACK)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision; large and small components don't leave its range."""
    x, y = (v / np.abs(v).max(axis=1)[:, None] for v in (x, y))
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def fit_centres(unit: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """``n`` centres of length 1 for rows of length 1; what they are decides only how much work there is."""
    centres = unit[np.linspace(0, len(unit) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    return centres


def cells(unit: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether it is the row's own cell, for every cell that a row is sent to."""
    near = unit @ centres.T
    own = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    reach = np.sqrt(2 - 2 * threshold) + _SLACK
    margin = near[np.arange(len(unit)), own][:, None] - near
    sent = (margin <= reach * apart[own] + _SLACK) & (np.arange(len(centres)) < own[:, None])
    row, cell = np.nonzero(sent)
    return np.concatenate([np.arange(len(unit)), row]), np.concatenate([own, cell]), np.concatenate([np.ones(len(unit), bool), np.zeros(len(row), bool)])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length, without nulls, as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _deal(centres: np.ndarray | None, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == size)))
                if centres is not None and centres.shape[1] == size:
                    row, cell, own = cells(_unit(_matrix(part.column("vector"))), centres, threshold)
                else:  # a length of which the sample had none, or few: one cell
                    row, cell, own = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), np.ones(part.num_rows, bool)
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("copies"), part.column("vector"), pa.array(np.full(len(row), size), pa.int32()), pa.array(cell, pa.int32()), pa.array(own)],
                    names=["id", "copies", "vector", "size", "cell", "own"],
                )

    return run


def _tile(threshold: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        left, right = key[2].as_py(), key[3].as_py()
        block = rows.column("block").to_numpy()
        ids, copies = (rows.column(c).to_numpy() for c in ("id", "copies"))
        vectors = _matrix(rows.column("vector"))
        order = np.argsort(ids, kind="stable")  # links are the same whatever order the rows came in
        ids, copies, block, vectors = ids[order], copies[order], block[order], vectors[order]
        quantised = quantise(_unit(vectors))
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
        for at in range(0, len(a), _ROWS):
            part = a[at : at + _ROWS]
            i, j = possible_pairs([q[part] for q in quantised], [q[b] for q in quantised], threshold)
            i, j = part[i], b[j]
            if left == right:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 100_000):
                pi, pj = i[k : k + 100_000], j[k : k + 100_000]
                linked = cosine(vectors[pi], vectors[pj]) >= threshold
                pi, pj = pi[linked], pj[linked]
                np.add.at(links, pi, copies[pj])
                np.add.at(links, pj, copies[pi])
                for m in range(0, len(pi), 4096):
                    forest.union_all(pi[m : m + 4096], pj[m : m + 4096])
        found = np.flatnonzero(links)
        pairs = np.array(forest.links, np.int64).reshape(-1, 2)
        a, b = local_stars(ids[pairs[:, 0]], ids[pairs[:, 1]])
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids[found], a]), pa.int64()),
                "links": pa.array(np.concatenate([links[found], np.zeros(len(a), np.int64)]), pa.int64()),
                "other": pa.array([None] * len(found) + b.tolist(), pa.int64()),
            }
        )

    return run


def near_vectors(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row: how many other rows have a cosine of at least
    ``threshold`` with it, the smallest id reachable by such links, and whether that is its own.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing, nor do
    vectors of different lengths. A row with a null id has no links, a null component and isn't kept.
    Repeated rows are rows: they link with each other, and of several with one id each counts. Other columns
    aren't read. An empty table gives an empty result. No link is lost, whatever the centres are.
    """
    scratch = Scratch(df.sparkSession, "vectors")
    element = df.schema[vector_col].dataType.elementType
    kind = f"array<{element.simpleString() if isinstance(element, FloatType) else 'double'}>"
    vector = F.col(vector_col).cast(kind)
    usable = F.col(id_col).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    # Zeros of either sign are one number.
    plain = F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0).cast(kind[6:-1])).otherwise(x))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(F.coalesce(usable, F.lit(False)), plain).alias("vector"))
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    classes = scratch.write(rows.where("vector is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")))

    total = classes.count()
    sample = classes.orderBy("h1", "h2").limit(SAMPLE).select("vector").toArrow().column("vector").to_pylist()
    sizes = [len(v) for v in sample]
    usual = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    matrix = np.array([v for v in sample if len(v) == usual], np.float64)
    centres = fit_centres(_unit(matrix), min(MOST_CENTRES, len(matrix), total // CELL + 1)) if len(matrix) else None

    dealt = classes.select(F.col("rep").alias("id"), "copies", "vector")
    dealt = scratch.write(dealt.mapInArrow(_deal(centres, threshold), f"id long, copies long, vector {kind}, size int, cell int, own boolean"))
    blocks = F.ceil(F.count_if("own") / BLOCK).cast("int").alias("n_own"), F.ceil(F.count_if(~F.col("own")) / BLOCK).cast("int").alias("n_guests")
    counts = dealt.groupBy("size", "cell").agg(*blocks)
    # Blocks of own vectors are numbered from 0, those of guests from -1 down.
    hashed = F.xxhash64("id")
    block = F.when(F.col("own"), F.pmod(hashed, F.greatest("n_own", F.lit(1)))).otherwise(-1 - F.pmod(hashed, F.greatest("n_guests", F.lit(1)))).cast("int")
    with_own = F.sequence(F.lit(0), F.col("n_own") - 1)
    with_guests = F.when(F.col("own") & (F.col("n_guests") > 0), F.sequence(-F.col("n_guests"), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    # Without own vectors no pair of the cell is looked at here.
    tiles = dealt.join(counts, ["size", "cell"]).where("n_own > 0").withColumn("block", block).withColumn("other", F.explode(F.concat(with_own, with_guests)))
    tiles = tiles.withColumns({"left": F.greatest("block", "other"), "right": F.least("block", "other")})
    found = scratch.write(
        tiles.select("size", "cell", "left", "right", "id", "copies", "vector", "block").groupBy("size", "cell", "left", "right").applyInArrow(_tile(threshold), "id long, links long, other long")
    )

    links = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "of")
    joined = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")), scratch)
    of_class = (
        classes.join(links, F.col("rep") == F.col("of"), "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    # A vector that links with nothing has no class, whatever null hashes to.
    keys = [F.when(F.col("vector").isNotNull(), F.col(h)).alias(h) for h in ("h1", "h2")]
    out = rows.select("id", *keys).join(of_class, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
