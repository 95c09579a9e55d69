"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source are dealt by hash into blocks. A source's target decides how many blocks
the mix draws from it: all of them for every full pass, and for the rest of a pass a permuted part, the
last block of it in part. A binary tree over the output shards splits the vector of the sources' block
counts: each inner node draws, for its left half, a multivariate-hypergeometric share of the vector it
got, so that the leaves together hold exactly the counts of the root, as a uniform shuffle of all blocks
would have it. The leaves' counts cut each source's permuted blocks into disjoint ranges, and every
shard orders its documents by a hash.

Only sums by source and by block are gathered: a source has at most ``MAX_BLOCKS`` blocks, so these
tables don't grow with the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
BLOCK_WORDS = 50_000
MAX_BLOCKS = 4096  # of one source; beyond it blocks hold more words
SHARDS = 32  # at least
SHARD_WORDS = 4_000_000  # of a shard on average, once there are more shards
_FILLERS = 32  # documents chosen by size for the block taken in part

_RUNS = "array<struct<first:long,last:long,least:long,most:long>>"
_DRAWS = "array<struct<epoch:int,shard:int,place:bigint>>"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """``source, source_size`` with ``number`` (order by code point, null last), ``weight`` and ``target``.

    Targets share ``percent`` % of all sizes by weight; a share above ``most`` times its source's size
    stops there and the rest is shared again. That ends where every source has ``weight`` times one
    level or its limit, and the level is found among the sources in order of limit by weight. Ranks
    and sums run over one row per source.
    """
    in_order = Window.orderBy(F.asc_nulls_last("source"))
    numbered = totals.withColumn("number", F.row_number().over(in_order).cast("int") - 1)
    cycle = F.array(*map(F.lit, weights))
    numbered = numbered.withColumn("weight", F.element_at(cycle, F.col("number") % len(weights) + 1).cast("long")).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    budget = F.sum("source_size").over(whole) * percent / 100
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levelled = numbered.withColumn("level", level)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    found = levelled.withColumn("level", F.first(reached, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit").cast("double")))
    return found.withColumn("target", target).drop("level", "limit")


def split_quotas(quotas: np.ndarray, shards: int, left: int, seed: Sequence[int]) -> np.ndarray:
    """The left part's share of the quotas of a node with ``shards`` shards, ``left`` of them on its left."""
    total = int(quotas.sum())
    return np.random.default_rng(list(seed)).multivariate_hypergeometric(quotas, total * left // shards, method="marginals")


def _split_level(seed: int):
    def split(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("number")
        lo, hi = int(node["lo"].iloc[0]), int(node["hi"].iloc[0])
        if hi - lo == 1:
            return node
        middle = (lo + hi) // 2
        share = split_quotas(node["quota"].to_numpy(), hi - lo, middle - lo, (seed, lo, hi))
        return pd.concat([node.assign(hi=middle, quota=share), node.assign(lo=middle, quota=node["quota"] - share)])

    return split


def _walk(hashes: np.ndarray, sizes: np.ndarray, picked: np.ndarray, left: float) -> tuple[list[tuple[int, int, int]], float]:
    """Picks, in order of hash, each document with words that still fits. Returns runs of them and the words left.

    A run is its first and last hash and the largest size that it takes. One ends at a document of at most that size that
    no longer fits; there are fewer of those than the root of twice the block's words.
    """
    runs, at = [], 0
    while at < len(sizes):
        fit = at + np.flatnonzero(~picked[at:] & (sizes[at:] > 0) & (sizes[at:] <= left))
        if not len(fit):
            break
        sums = sizes[fit].cumsum()
        n = int(np.searchsorted(sums, left, side="right"))
        picked[fit[:n]] = True
        runs.append((int(hashes[fit[0]]), int(hashes[fit[n - 1]]), int(left)))
        left -= float(sums[n - 1])
        at = int(fit[n]) + 1 if n < len(fit) else len(sizes)
    return runs, left


def _choose(hashes: np.ndarray, sizes: np.ndarray, wanted: float) -> tuple[np.ndarray, list[tuple[int, int, int, int]], list[int]]:
    """Which documents, by rising hash, make up the words wanted, also as runs (first and last hash, least and largest size) and single hashes.

    What is still missing then is less than the least document left out, or that one is nearer and taken as well.
    """
    picked = np.zeros(len(sizes), bool)
    # Documents without words are drawn like others, by their part of the block.
    part = int(len(sizes) * min(1.0, wanted / max(1.0, float(sizes.sum()))))
    picked[:part] = sizes[:part] == 0
    runs = [(int(hashes[0]), int(hashes[part - 1]), 0, 0)] if part else []
    # Room for some documents is left to those that fit best, else only what no one else took remains to choose from.
    room = min(0.3 * wanted, 0.5 * _FILLERS * float(sizes.mean()))
    found, left = _walk(hashes, sizes, picked, wanted - room)
    runs, left, fillers = runs + [(a, b, 1, c) for a, b, c in found], left + room, []
    while left > 0 and len(fillers) < _FILLERS:
        fit = np.flatnonzero(~picked & (sizes > 0) & (sizes <= left))
        if not len(fit):
            break
        pick = int(fit[sizes[fit].argmax()])
        picked[pick] = True
        fillers.append(int(hashes[pick]))
        left -= float(sizes[pick])
    found, left = _walk(hashes, sizes, picked, left)
    runs += [(a, b, 1, c) for a, b, c in found]
    rest = np.flatnonzero(~picked & (sizes > 0))
    if left > 0 and len(rest):
        pick = int(rest[sizes[rest].argmin()])
        if sizes[pick] - left < left:
            picked[pick] = True
            fillers.append(int(hashes[pick]))
    return picked, runs, fillers


def _fill(part: pd.DataFrame) -> pd.DataFrame:
    """Which documents of one source's last block make up the words left: runs of hashes and sizes, and single hashes."""
    number, block, wanted = int(part["number"].iloc[0]), int(part["block"].iloc[0]), float(part["words_left"].iloc[0])
    part = part.groupby("h2").agg(size=("size", "sum"), rows=("size", "size")).reset_index().sort_values("h2")
    hashes, several = part["h2"].to_numpy(), part["rows"].to_numpy() > 1
    picked, runs, fillers = _choose(hashes, part["size"].to_numpy(), wanted)
    # Runs go by the size of a row; rows with one id go together.
    taken, left_out = hashes[picked & several].tolist(), hashes[~picked & several].tolist()
    named = [dict(zip(("first", "last", "least", "most"), run, strict=True)) for run in runs]
    return pd.DataFrame({"number": [number], "block": [block], "runs": [named], "fillers": [fillers + taken], "left_out": [left_out]})


def mix_sources(
    df: DataFrame,
    seed: int = 1,
    shards: int | None = None,
    weights: Sequence[int] = WEIGHTS,
    percent: int = 150,
    most: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every row of ``df`` as struct ``row``, with ``size`` (words of the text), ``source_size``, ``target``
    and ``draws``: epoch, shard and place in the shard of each time the mix takes the document. Without ``shards``, their
    number follows from the words of the mix.

    A document is taken whole, at most once in a pass and ``most`` times in all; each source's taken words
    miss its target by less than the least document left out of the block taken in part, or pass it by less than half
    of the last one taken. The same rows give the same mix, in any order and
    partitioning. A null source is a source of its own, after the others. Null and empty texts have size 0,
    and are drawn like others. Rows with one id are drawn together. An empty table gives an empty result.
    Columns of any name are kept inside ``row``.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    identity = F.col(id_col).cast("string")
    every = df.select(
        F.struct("*").alias("row"),
        count_words(F.col(text_col).cast("string")).alias("size"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.lit(seed), identity).alias("h1"),
        F.xxhash64(F.lit(seed + 1), identity).alias("h2"),
    )
    light = scratch.write(every.drop("row"))

    totals = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = scratch.write(
        source_targets(totals, weights, percent, most)
        .withColumn("n_blocks", F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("int"))
        .withColumn("passes", passes)
        .withColumn("words_over", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    if shards is None:
        words = sources.agg(F.sum("target")).first()[0] or 0
        shards = max(SHARDS, math.ceil(words / SHARD_WORDS))
    block = F.pmod("h1", "n_blocks").cast("int")
    of_source = sources.select(F.col("source").alias("_source"), "number", "n_blocks")
    blocked = light.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).select("number", block.alias("block"), "size", "h2")
    sums = blocked.groupBy("number", "block").agg(F.sum("size").alias("words"))

    # A source's draws, in order: its permuted blocks for every full pass, then those of the pass in part.
    epochs = sources.select("number", "n_blocks", "passes", "words_over", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("epoch"))
    permuted = Window.partitionBy("number", "epoch").orderBy(F.xxhash64(F.lit(seed), "number", "epoch", "block"), "block")
    placed = epochs.join(sums, "number").withColumn("words_before", F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_part = F.col("epoch") == F.col("passes")
    draws = (
        placed.where(~in_part | (F.col("words_before") < F.col("words_over")))
        .withColumn("words_left", F.when(in_part & (F.col("words_before") + F.col("words") > F.col("words_over")), F.col("words_over") - F.col("words_before")))
        .withColumn("draw", F.row_number().over(Window.partitionBy("number").orderBy("epoch", "words_before", F.xxhash64(F.lit(seed), "number", "epoch", "block"), "block")) - 1)
        .select("number", "block", "epoch", "draw", "words_left")
    )
    draws = scratch.write(draws)

    node = draws.groupBy("number").agg(F.count("*").alias("quota")).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "number", "quota")
    for _ in range((shards - 1).bit_length()):
        node = node.groupBy("lo", "hi").applyInPandas(_split_level(seed), "lo int, hi int, number int, quota long")
    upto = Window.partitionBy("number").orderBy("lo")
    ranges = node.select("number", F.col("lo").alias("shard"), F.sum("quota").over(upto).alias("end"), "quota")
    dealt = draws.join(ranges, "number").where((F.col("draw") < F.col("end")) & (F.col("draw") >= F.col("end") - F.col("quota")))

    last = dealt.where("words_left is not null").select("number", "block", "words_left")
    fill = blocked.join(last, ["number", "block"]).groupBy("number").applyInPandas(_fill, f"number int, block int, runs {_RUNS}, fillers array<long>, left_out array<long>")
    of_block = dealt.groupBy("number", "block").agg(F.collect_list(F.struct("epoch", "shard", F.col("words_left").isNotNull().alias("in_part"))).alias("taken"))
    of_block = scratch.write(of_block.join(fill, ["number", "block"], "left"))

    in_run = F.exists("runs", lambda r: F.col("h2").between(r["first"], r["last"]) & F.col("size").between(r["least"], r["most"]))
    picked = (in_run & ~F.array_contains("left_out", F.col("h2"))) | F.array_contains("fillers", F.col("h2"))
    place = F.transform(
        F.filter("taken", lambda t: ~t["in_part"] | picked),
        lambda t: F.struct(t["epoch"].alias("epoch"), t["shard"].alias("shard"), F.xxhash64(F.lit(seed), t["shard"], t["epoch"], "h2").alias("place")),
    )
    of_source = sources.select(F.col("source").alias("_source"), F.col("number").alias("_number"), "n_blocks", "source_size", "target")
    return (
        every.join(of_source, F.col("source").eqNullSafe(F.col("_source")))
        .join(of_block.withColumnRenamed("block", "_block"), (F.col("_number") == F.col("number")) & (block == F.col("_block")), "left")
        .select("row", "size", "source_size", "target", F.coalesce(F.array_sort(place), F.array().cast(_DRAWS)).alias("draws"))
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The rows that the mix takes, once for each time, dealt by shard and in each shard's order."""
    drawn = mixed.select("row", F.explode("draws").alias("draw"))
    return drawn.repartition("draw.shard").sortWithinPartitions("draw.shard", "draw.place").select("row.*")
