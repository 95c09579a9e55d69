"""Similarity join of whole texts by the Jaccard similarity of their word shingles.

1. One pass over the texts gives each document its shingle set's size and identifier, and keys of
   the set: hashed partitions of the set, one more (and some) than two similar sets can differ in.
   Two similar sets hence agree in a whole non-empty partition, whatever else they share; a passage
   or line that many documents have in common makes no key.
2. Equal keys, sorted, give runs of sets. Keys are dealt by range of (key, set), so that a key which a third
   of all documents share is spread over many tasks. Runs of the same sets count once. Similar sets agree in more
   partitions than one, so that each set can do without a few of its keys: without those of long runs, most often all
   of which come from one line or passage. Only what large groups of similar texts share stays in long runs.
3. Within a run, a pair stays a candidate if its sketches allow for it: a sketch holds the parity of the
   tokens of each slot, so that two sets differ in at least as many tokens as their sketches in bits. What is left
   connects the sets into candidate groups; only of their members are texts looked at again. A run that is still
   very long is a candidate as a whole.
4. A candidate group is cut, in order of size, into blocks of bounded size. Signature trees find the
   links of a block, with one set of the group in all blocks of like sizes.
5. What that has left unconnected is compared across blocks of compatible sizes, again by trees.

Documents with equal sets count as one set throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components, local_stars
from ledgerloom.llm.signature_tree import tree_links
from ledgerloom.llm.tables import Scratch, likely_among
from ledgerloom.llm.words import flat_bytes, mix64, shingle_hashes, span_hashes, tidy, word_spans

BLOCK_SHINGLES = 2_000_000  # shingles in a block on average: 16 MB of hashes
_TEXT_BYTES = 1 << 20  # of texts whose words are taken at once
_SEEN = 200_000  # set identifiers that a task remembers, to give keys of equal sets once
_LONG = 256  # sets in a run from which on its key is one that sets do without if they can
_WHOLE = 4096  # sets in a run, after that, from which on its pairs aren't looked at one by one
_RUN_ROWS, _RUN_BYTES = 20_000, 1 << 24  # of runs that are looked at together
_CLASSES = 64  # of sizes; a key's last bits are its class


def token_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; A-Z count as lower case."""
    all_raw, all_offsets = flat_bytes(texts)
    out = []
    while len(out) < len(texts):
        at = len(out)
        upto = max(at + 1, int(np.searchsorted(all_offsets, all_offsets[at] + _TEXT_BYTES, side="right")) - 1)
        raw, offsets = all_raw[all_offsets[at] : all_offsets[upto]], all_offsets[at : upto + 1] - all_offsets[at]
        starts, ends, first = word_spans(raw, offsets)
        shingles, begin = shingle_hashes(span_hashes(raw, starts, ends, lower=True), first, n)
        out += [np.unique(shingles[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    return out


def set_identifier(tokens: np.ndarray) -> int:
    return int(mix64(np.sum(mix64(tokens), dtype=np.uint64) + np.uint64(len(tokens))).view(np.int64))


def most_differing(size: int, percent: int) -> int:
    """Most tokens that only one of two similar sets has, the smaller one having ``size``."""
    return (size + 100 * size // percent) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=8)
def size_classes(percent: int, upto: int) -> list[tuple[int, int, int, int]]:
    """Ranges of sizes, as first size, end, number of partitions and empty partitions allowed for."""
    out, lo = [], 1
    while lo <= upto:
        end = max(lo + 1, lo * 3 // 2)
        differing = most_differing(end - 1, percent)
        spare = 0
        while spare < 64:
            k = differing + 1 + spare
            empty = k * (1 - 1 / k) ** lo
            if spare >= empty + 3 * empty**0.5:
                break
            spare += 1
        out.append((lo, end, differing + 1 + spare if differing else 0, spare))
        lo = end
    return out


def set_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set; two different sets at least ``percent`` % similar share one. See :func:`class_keys`."""
    return np.concatenate([np.zeros(0, np.uint64), *(keys for keys, _ in class_keys(tokens, percent).values())])


def class_keys(tokens: np.ndarray, percent: int) -> dict[int, tuple[np.ndarray, int]]:
    """For each size class of a set, its keys and how many of them it can do without.

    In the size class of the smaller set, k partitions by hash leave at least spare + 1 equal ones. A
    set with no more than spare empty partitions so agrees in one with tokens, and its empty ones need
    no key; a set with more gives keys to the empty ones too.

    With e empty partitions it agrees in spare + 1 - e with tokens. So it can do without its first spare - e keys in
    any order that is the same for all sets: the last key that two sets share isn't among those of either.
    """
    size = len(tokens)
    out = {}
    for number, (lo, end, k, spare) in enumerate(size_classes(percent, 1 << max(8, size.bit_length()))):
        if lo > size:
            break
        if not k or 100 * (end - 1) // percent < size:
            continue
        part = ((tokens >> np.uint64(17)) % np.uint64(k)).astype(np.int64)
        sums = np.zeros(k, np.uint64)
        np.add.at(sums, part, tokens)
        keys = mix64(sums + mix64((np.arange(k) + (number << 40)).astype(np.uint64)))
        keys = keys // np.uint64(_CLASSES) * np.uint64(_CLASSES) + np.uint64(number)
        filled = np.bincount(part, minlength=k) > 0
        empty = k - int(np.count_nonzero(filled))
        out[number] = keys[filled] if empty <= spare else keys, max(0, spare - empty)
    return out


def set_sketch(tokens: np.ndarray) -> bytes:
    """The parity of the tokens in each slot; slots are a power of two, at least as many as tokens, 64 to 16,384.

    With half as many, sets without a token in common differ by little more than similar ones may.
    """
    slots = min(16_384, max(64, 1 << (len(tokens) - 1).bit_length()))
    counts = np.bincount(((tokens >> np.uint64(40)) % np.uint64(slots)).astype(np.int64), minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _signatures(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, identifiers, keys, spare, sketches = [], [], [], [], []
            for doc, tokens in zip(batch.column(0).to_pylist(), token_sets(batch.column(1), n), strict=True):
                sizes.append(len(tokens))
                identifiers.append(set_identifier(tokens) if len(tokens) and doc is not None else None)
                if identifiers[-1] is None or identifiers[-1] in seen:
                    for column in (keys, spare, sketches):
                        column.append(None)
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(identifiers[-1])
                of_class = class_keys(tokens, percent)
                keys.append(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in of_class.values())]).view(np.int64))
                spare.append([(number, n) for number, (_, n) in of_class.items()])
                sketches.append(set_sketch(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(identifiers, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(spare, pa.map_(pa.int32(), pa.int32())), pa.array(sketches, pa.binary())],
                names=["id", "text_key", "n_shingles", "set_id", "keys", "spare", "sketch"],
            )

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, set): ``run, a`` for the members of each run of equal keys, runs of the same sets once a batch;
    and ``key, a`` for those of runs that are long or at an end of the partition."""

    def out(run, a, key) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (run, a, key)], names=["run", "a", "key"])

    def once(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        return key[new], node[new]

    def by_key(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return out(pa.nulls(len(key)), node, key)

    def members(key: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(begin, len(key)))
        long = np.repeat(length > _LONG, length)
        if long.any():
            yield by_key(key[long], node[long])
        run = mix64(np.add.reduceat(mix64(node.view(np.uint64)), begin) + length.astype(np.uint64))
        first = np.zeros(len(begin), bool)
        first[np.unique(run, return_index=True)[1]] = True
        first &= (length > 1) & (length <= _LONG)
        row = np.repeat(first, length)
        yield out(np.repeat(run, length)[row].view(np.int64), node[row], pa.nulls(int(np.count_nonzero(row))))

    held = np.zeros(0, np.int64), np.zeros(0, np.int64)  # rows of the run that may go on
    cut = True  # whether that is the partition's first run, or has been given out in part
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = once(*(np.concatenate((held[k], batch.column(k).to_numpy())) for k in (0, 1)))
        end = int(np.searchsorted(key, key[0], side="right"))
        if cut and end < len(key):
            yield by_key(key[:end], node[:end])
            key, node, cut = key[end:], node[end:], False
        last = int(np.searchsorted(key, key[-1], side="left"))
        if last:
            yield from members(key[:last], node[:last])
        held = key[last:], node[last:]
        if len(held[0]) > _LONG:
            yield by_key(*held)
            held, cut = (held[0][-1:], held[1][-1:]), True
    yield by_key(*held)


class _Sketches:
    """The sketches of rows, for comparing pairs of rows given by positions."""

    def __init__(self, sizes: np.ndarray, sketches: list[bytes], percent: int):
        self.sizes, self.percent = sizes, percent
        self.width = np.array([8 * len(x) for x in sketches], np.int64)
        self.rows_of, self.place = {}, {}
        for w in np.unique(self.width).tolist():
            # Sketches of this width, and of the next one folded to it.
            own, wider = np.flatnonzero(self.width == w), np.flatnonzero(self.width == 2 * w)
            bits, twice = (np.frombuffer(b"".join(sketches[k] for k in x.tolist()), np.uint64) if len(x) else np.zeros(0, np.uint64) for x in (own, wider))
            bits, twice = bits.reshape(-1, w // 64), twice.reshape(-1, 2, w // 64)
            self.rows_of[w], self.place[w] = np.concatenate((bits, twice[:, 0] ^ twice[:, 1])), np.full(len(sketches), -1)
            self.place[w][np.concatenate((own, wider))] = np.arange(len(own) + len(wider))

    def fits(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sizes allow the pairs to be similar."""
        return (100 * self.sizes[i] >= self.percent * self.sizes[j]) & (100 * self.sizes[j] >= self.percent * self.sizes[i])

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sketches do."""
        common = np.minimum(self.width[i], self.width[j])
        out = np.maximum(self.width[i], self.width[j]) > 2 * common  # can't be, with similar sizes, but for rounding
        far = out.copy()
        for w in np.unique(common[~far]).tolist():
            at = np.flatnonzero((common == w) & ~far)
            for cut in range(0, len(at), max(1, (1 << 22) // w)):
                part = at[cut : cut + max(1, (1 << 22) // w)]
                x, y = i[part], j[part]
                differ = np.bitwise_count(self.rows_of[w][self.place[w][x]] ^ self.rows_of[w][self.place[w][y]]).sum(axis=1, dtype=np.int64)
                # At least percent % of the union in common leaves at most this many tokens that only one has.
                out[part] = differ * (100 + self.percent) <= (self.sizes[x] + self.sizes[y]) * (100 - self.percent)
        return out


def sketch_pairs(run: np.ndarray, sizes: np.ndarray, sketches: list[bytes], percent: int, node: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of rows of one run (sorted by it) that sizes and sketches allow to be similar.

    With ``node``, the number of each row's set, pairs that connect the same sets as all do: sets that are already
    connected aren't compared, so that a group of similar sets costs little more than its rows, in all its runs together.
    """
    rows = _Sketches(sizes, sketches, percent)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    begin = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    longest = int(np.diff(np.append(begin, len(run))).max(initial=0))
    label = None if node is None else np.unique(node, return_inverse=True)[1]  # of each row
    for step in range(1, longest):
        i = np.flatnonzero(run[step:] == run[:-step])
        if label is not None:
            i = i[label[i] != label[i + step]]
        i = i[rows.fits(i, i + step)]
        i = i[rows.near(i, i + step)]
        left.append(i)
        right.append(i + step)
        if label is not None and len(i):
            to = np.arange(len(run))
            moved, least = local_stars(label[i], label[i + step])
            to[moved] = least
            label = to[label]
    return np.concatenate(left), np.concatenate(right)


def _candidates(percent: int):
    """What candidate pairs connect among rows (run, set_id, n_shingles, sketch) sorted by run: each set with the smallest it reaches."""

    def stars(rows: pa.Table) -> pa.RecordBatch:
        run, node, size = (rows.column(k).to_numpy() for k in range(3))
        i, j = sketch_pairs(run, size, rows.column(3).to_pylist(), percent, node)
        return pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()) for ends in local_stars(node[i], node[j])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= _RUN_ROWS or sum(b.nbytes for b in held) >= _RUN_BYTES:
                rows = pa.Table.from_batches(held)
                key = rows.column(0).to_numpy()
                last = int(np.searchsorted(key, key[-1], side="left"))
                if last:
                    yield stars(rows.slice(0, last))
                held = rows.slice(last).combine_chunks().to_batches()
        if held:
            yield stars(pa.Table.from_batches(held))

    return run


def _block_links(n: int, percent: int):
    """Links of each block among rows (cluster, block, set_id, text, joined, side) sorted by block."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        ids = block.column("set_id").to_numpy()
        sets = token_sets(block.column("text"), n)
        # A document whose id another text also has may come with a text that isn't the set's.
        right = [k for k, (i, s) in enumerate(zip(ids.tolist(), sets, strict=True)) if len(s) and set_identifier(s) == i]
        joined, side = (block.column(c).to_numpy()[right] if block.column(c).null_count == 0 else None for c in ("joined", "side"))
        found = np.array(tree_links([sets[k] for k in right], percent, joined, side), np.int64).reshape(-1, 2)
        stars = local_stars(*(ids[right][found[:, k]] for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()) for ends in stars], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            where = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1).tolist(), len(where)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != tuple(where[a].tolist()):
                    yield links(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield links(held)

    return run


def _linked(rows: DataFrame, n: int, percent: int) -> DataFrame:
    dealt = rows.select("cluster", "block", "set_id", "text", "joined", "side").repartition("cluster", "block").sortWithinPartitions("cluster", "block")
    return dealt.mapInArrow(tidy(_block_links(n, percent)), "a long, b long")


def ngram_components(df: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row: the size of the text's set of distinct
    ``words``-word shingles, and the smallest id reachable by links, the row's own included.

    See :func:`ngram_groups`.
    """
    return ngram_groups(df, words, percent, id_col, text_col).select(id_col, "n_shingles", "component_id")


def ngram_groups(df: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_key, n_shingles, group, component_id`` of every row: xxHash64 of the text, and the linked texts' common
    ``group``, null for a text without shingles or a row without an id.

    Words are runs of characters other than space and U+0009 to U+000D, with A-Z in lower case. A text
    with fewer words has its whole sequence as its one shingle. Two rows are linked when 100 * common
    shingles >= ``percent`` * shingles of either; no link is lost. Null texts and texts without words
    have no shingles and no links. Rows with a null id have no links and a null component. Repeated
    rows and equal texts are linked; where one id has several texts, each row follows its own text.
    Other columns are not read. An empty table gives an empty result. Shingles and sets are compared by
    64-bit hashes.
    """
    scratch = Scratch(df.sparkSession, "ngram")
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed_rows = source.select("id", "text", F.xxhash64("text").alias("text_key"))
    with_keys = scratch.write(keyed_rows.mapInArrow(tidy(_signatures(words, percent)), "id long, text_key long, n_shingles long, set_id long, keys array<long>, spare map<int,int>, sketch binary"))
    signatures = scratch.write(with_keys.select("id", "text_key", "n_shingles", "set_id"))

    keyed = with_keys.where("keys is not null").select(F.explode("keys").alias("key"), "set_id")
    runs = scratch.write(keyed.repartitionByRange("key", "set_id").sortWithinPartitions("key", "set_id").mapInArrow(tidy(_runs), "run long, a long, key long"))
    of_set = with_keys.where("sketch is not null").groupBy("set_id")
    keyed = runs.where("key is not null").select("key", F.col("a").alias("set_id")).distinct()
    needed = scratch.write(_needed(keyed, of_set.agg(F.first("spare").alias("spare"))))
    long = needed.join(needed.groupBy("key").agg(F.count("*").alias("n"), F.min("set_id").alias("first")).where("n > 1"), "key")
    whole = long.where(F.col("n") > _WHOLE).select(F.col("set_id").alias("a"), F.col("first").alias("b"))
    members = runs.where("run is not null").select("run", F.col("a").alias("set_id")).repartition("set_id").distinct()
    members = members.unionByName(long.where(F.col("n") <= _WHOLE).select(F.col("key").alias("run"), "set_id"))
    sketches = of_set.agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    dealt = members.join(sketches, "set_id").select("run", "set_id", "n_shingles", "sketch").repartition("run").sortWithinPartitions("run", "set_id")
    pairs = scratch.write(dealt.mapInArrow(tidy(_candidates(percent)), "a long, b long"))
    clusters = scratch.write(connected_components(pairs.unionAll(whole), scratch).withColumnsRenamed({"node": "set_id", "component": "cluster"}))
    for done in (with_keys, runs, needed, pairs):
        scratch.drop(done)

    sets = scratch.write(signatures.where("set_id is not null").groupBy("set_id").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles")))
    candidates = scratch.write(_in_blocks(clusters.join(sets, "set_id")))
    texts = likely_among(source, candidates)
    alone = {"joined": F.lit(None).cast("long"), "side": F.lit(None).cast("long")}
    links = scratch.write(_linked(_with_hubs(candidates, percent).join(texts, "id").withColumns(alone), words, percent))

    final = scratch.write(connected_components(links, scratch))
    rest = scratch.write(_across_blocks(candidates, final, percent))
    if not rest.isEmpty():
        more = _linked(rest.join(likely_among(source, rest), "id"), words, percent)
        final = connected_components(final.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more), scratch)
    named = final.join(sets, final["node"] == sets["set_id"]).select("set_id", "component", "id")
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_set = sets.join(named.join(smallest, "component").select("set_id", "component", "component_id"), "set_id", "left")
    of_set = of_set.select("set_id", F.coalesce("component", "set_id").alias("group"), F.coalesce("component_id", "id").alias("component_id"))
    return (
        signatures.join(of_set, "set_id", "left")
        .select("id", "text_key", "n_shingles", "group", F.coalesce("component_id", "id").alias("component_id"))
        .withColumnRenamed("id", id_col)
    )


def _needed(keyed: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, set_id`` without the keys that sets can do without; ``sets`` has how many, by size class."""
    size_class = F.pmod("key", F.lit(_CLASSES)).cast("int")
    place = F.row_number().over(Window.partitionBy("set_id", size_class).orderBy("key"))
    return keyed.join(sets, "set_id").withColumn("place", place).where(F.col("place") > F.col("spare")[size_class]).select("key", "set_id")


def _in_blocks(sized: DataFrame) -> DataFrame:
    """``cluster, block, set_id, id, n_shingles``: a group's sets in order of size, cut into blocks of about
    ``BLOCK_SHINGLES``; of a size that fills several, by hash."""
    by_size = sized.groupBy("cluster", "n_shingles").agg(F.sum("n_shingles").alias("held"))
    before = Window.partitionBy("cluster").orderBy("n_shingles").rowsBetween(Window.unboundedPreceding, -1)
    first = F.floor(F.coalesce(F.sum("held").over(before), F.lit(0)) / BLOCK_SHINGLES).cast("int")
    layout = by_size.select("cluster", "n_shingles", first.alias("first"), F.ceil(F.col("held") / BLOCK_SHINGLES).cast("int").alias("n"))
    block = F.col("first") + F.pmod(F.xxhash64("set_id"), F.col("n")).cast("int")
    return sized.join(layout, ["cluster", "n_shingles"]).select("cluster", block.alias("block"), "set_id", "id", "n_shingles")


def _compatible(lo, hi, other_lo, other_hi, percent: int):
    """Whether sets of two ranges of sizes may be similar."""
    return (100 * F.col(hi) >= percent * F.col(other_lo)) & (100 * F.col(other_hi) >= percent * F.col(lo))


def _ranges(sets: DataFrame, *more) -> DataFrame:
    return sets.groupBy("cluster", "block").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"), *more)


def _with_hubs(candidates: DataFrame, percent: int) -> DataFrame:
    """``cluster, block, set_id, id``: every set in its block, and one set of each group in all blocks of like sizes."""
    hubs = candidates.where("set_id = cluster").select("cluster", "set_id", "id", F.col("n_shingles").alias("n"), F.col("block").alias("own"))
    copies = hubs.join(_ranges(candidates), "cluster").where((F.col("block") != F.col("own")) & _compatible("lo", "hi", "n", "n", percent))
    names = ["cluster", "block", "set_id", "id"]
    return candidates.select(*names).unionByName(copies.select(*names))


def _across_blocks(candidates: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Sets once for each pair of blocks in which a pair of sets may be left to look at.

    Blocks are paired if their sizes are compatible; a set doesn't go to a block that is wholly of its component.
    """
    known = candidates.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("joined", F.coalesce("component", "set_id"))
    whole = F.when(F.min("joined") == F.max("joined"), F.min("joined")).alias("whole")
    blocks = _ranges(known, whole)

    def level(size: str, more: int):
        return F.floor(F.log(F.col(size)) / F.log(F.lit(100 / percent))).cast("int") + more

    # Similar sizes are at most one level apart; a second makes up for rounding.
    left = blocks.select("cluster", "block", "lo", "hi", F.explode(F.sequence(level("lo", 0), level("hi", 0))).alias("level"))
    right = blocks.select("cluster", F.col("block").alias("other"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"), "whole", F.explode(F.sequence(level("lo", -2), level("hi", 2))).alias("level"))
    pairs = left.join(right, ["cluster", "level"]).where((F.col("block") != F.col("other")) & _compatible("lo", "hi", "other_lo", "other_hi", percent))
    pairs = pairs.select("cluster", "block", "other", "whole").distinct()
    open_rows = known.join(pairs, ["cluster", "block"]).where(F.col("whole").isNull() | (F.col("whole") != F.col("joined")))
    pair = F.least("block", "other").cast("long") * 2**31 + F.greatest("block", "other")
    return open_rows.select("cluster", pair.alias("block"), "set_id", "id", "joined", F.col("block").cast("long").alias("side"))
