"""Connected components of an edge list, as joins and groupings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each reaches over the given edges, for all but those smallest nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = np.split(at, 2)
    label = np.arange(len(nodes))
    while (label[i] != label[j]).any():
        least = np.minimum(label[i], label[j])
        for ends in (i, j, label[i], label[j]):
            np.minimum.at(label, ends, least)
        label = label[label]
    while (label[label] != label).any():
        label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``, long), component
    being the smallest node reachable.

    Alternates large-star and small-star steps: each turns every node's neighbourhood into a
    star around its smallest member, so that the number of rounds grows with the logarithm of
    the longest path. Smallest members come from partial aggregation and are joined back, so a
    hub with any number of edges is never gathered. Each round's edges are written to the shared
    folder. Edges with a null end and loops are ignored; an empty edge list gives an empty result.
    """
    current, state = _written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), scratch
    )
    while state[0]:
        following, then = _written(_small_star(_large_star(current)), scratch)
        scratch.drop(current)
        current = following
        if then == state:
            break
        state = then
    centres = current.select(F.col("lo").alias("node")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))
    )


def _written(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their number and two checksums, taken while they are written."""
    seen = Observation()
    sums = F.bit_xor(F.xxhash64("hi", "lo")).alias("x"), F.bit_xor(F.xxhash64("lo", "hi")).alias("y")
    written = scratch.write(edges.observe(seen, F.count("*").alias("n"), *sums))
    return written, (seen.get["n"], seen.get["x"], seen.get["y"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    to_centre = smallest.select("hi", F.col("m").alias("lo"))
    others = edges.join(smallest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return to_centre.unionAll(others).distinct()
