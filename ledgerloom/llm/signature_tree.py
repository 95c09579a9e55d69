"""Signature tree over the token sets of one block, and its traversal against itself.

A node holds the bitwise OR of its sets' token bitmaps, the range of their sizes and the largest
excess (tokens beyond the bits they set). No two sets below two nodes share more tokens than the
bits that both nodes have set plus the lesser excess, so a pair of nodes whose bound is under the
overlap that the similarity needs is pruned with everything below it. Pairs that are already in one
component are pruned as well: the join reports components, not pairs. The pairs of a small subtree come before those
of larger ones, so that what a subtree has connected is known when it meets others.
"""

from __future__ import annotations

import numpy as np

FAN_OUT = 8
_PAIRS_AT_ONCE = 1 << 15  # of sets
_NODES_AT_ONCE = 1 << 9


def overlap_suffices(overlap, a, b, percent: int):
    """Whether ``overlap`` shared tokens make sets of ``a`` and ``b`` tokens at least ``percent`` % similar."""
    return 100 * overlap >= percent * (a + b - overlap)


class Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def roots(self) -> np.ndarray:
        root = np.array(self.parent, np.int64)
        while (root[root] != root).any():
            root = root[root]
        return root

    def union_all(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.roots()
        apart = root[a] != root[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            self.union(x, y)

    def union(self, a: int, b: int, linked: bool = True) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            if linked:
                self.links.append((a, b))


def _bitmaps(ids: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    rows, step = [], max(1, (1 << 22) // bits)
    for at in range(0, len(offsets) - 1, step):
        part = offsets[at : at + step + 1]
        flags = np.zeros((len(part) - 1, bits), np.uint8)
        flags[np.repeat(np.arange(len(part) - 1), np.diff(part)), ids[part[0] : part[-1]] % np.uint64(bits)] = 1
        rows.append(np.packbits(flags, axis=1).view(np.uint64))
    return np.concatenate(rows)


def _levels(bitmaps: np.ndarray, sizes: np.ndarray, excess: np.ndarray, groups: np.ndarray) -> list[dict]:
    """From the sets themselves up to one root; a node's group is that of all its sets, or -1."""
    levels = [{"bits": bitmaps, "lo": sizes, "hi": sizes, "excess": excess, "group": groups}]
    while len(levels[-1]["lo"]) > 1:
        below = levels[-1]
        at = np.arange(0, len(below["lo"]), FAN_OUT)
        low, high = np.minimum.reduceat(below["group"], at), np.maximum.reduceat(below["group"], at)
        levels.append(
            {
                "bits": np.bitwise_or.reduceat(below["bits"], at, axis=0),
                "lo": np.minimum.reduceat(below["lo"], at),
                "hi": np.maximum.reduceat(below["hi"], at),
                "excess": np.maximum.reduceat(below["excess"], at),
                "group": np.where(low == high, low, -1),
            }
        )
    return levels


def _regroup(levels: list[dict], groups: np.ndarray) -> None:
    """Takes over what has been connected since the levels were made."""
    levels[0]["group"] = groups
    for below, level in zip(levels[:-1], levels[1:], strict=True):
        at = np.arange(0, len(below["lo"]), FAN_OUT)
        low, high = np.minimum.reduceat(below["group"], at), np.maximum.reduceat(below["group"], at)
        level["group"] = np.where(low == high, low, -1)


def _surviving(level: dict, i: np.ndarray, j: np.ndarray, percent: int, root: np.ndarray) -> np.ndarray:
    lo_i, lo_j, hi_i, hi_j = level["lo"][i], level["lo"][j], level["hi"][i], level["hi"][j]
    alive = (100 * hi_i >= percent * lo_j) & (100 * hi_j >= percent * lo_i)
    group_i, group_j = level["group"][i], level["group"][j]
    alive &= (group_i < 0) | (group_j < 0) | (root[group_i] != root[group_j])
    at = np.flatnonzero(alive)
    i, j = i[at], j[at]
    common = np.bitwise_count(level["bits"][i] & level["bits"][j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(common + np.minimum(level["excess"][i], level["excess"][j]), np.minimum(level["hi"][i], level["hi"][j]))
    alive[at] = (100 + percent) * most >= percent * (level["lo"][i] + level["lo"][j])
    return alive


def tree_links(sets: list[np.ndarray], percent: int, joined: np.ndarray | None = None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between positions of ``sets`` (sorted distinct hashes, none empty) that give the same
    components as all pairs at least ``percent`` % similar.

    ``joined`` has a component number for each set; sets that share one need no link. With ``side``,
    only pairs of different sides are looked at.
    """
    n = len(sets)
    if n < 2:
        return []
    # Similar sets tend to share their least hash, so this order puts them below one node.
    first = np.array([s[0] for s in sets], np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((sizes, first))
    sets = [sets[k] for k in order]
    sizes = sizes[order]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate(sets)
    universe, dense = np.unique(flat, return_inverse=True)
    tokens = [dense[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    mark = np.zeros(len(universe), bool)
    forest = Forest(n)
    if joined is not None:
        at: dict[int, int] = {}
        for k, group in enumerate(joined[order].tolist()):
            forest.union(at.setdefault(group, k), k, linked=False)
    sides = None if side is None else side[order].tolist()

    def verify(k: int, others) -> None:
        found = False
        for other in others:
            if forest.find(k) == forest.find(other) or (sides and sides[k] == sides[other]):
                continue
            if not found:
                mark[tokens[k]] = found = True
            if overlap_suffices(int(np.count_nonzero(mark[tokens[other]])), int(sizes[k]), int(sizes[other]), percent):
                forest.union(k, other)
        if found:
            mark[tokens[k]] = False

    bits = int(min(16384, max(512, 1 << int(4 * np.median(sizes)).bit_length())))
    bitmaps = _bitmaps(flat, offsets, bits)
    excess = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
    levels = _levels(bitmaps, sizes, excess, forest.roots())
    children = np.arange(FAN_OUT)
    for top in range(1, len(levels)):
        # Pairs below one node of this level that no lower node has both of.
        _regroup(levels, forest.roots())
        nodes = np.arange(len(levels[top]["lo"]))
        left, right = (nodes[:, None, None] * FAN_OUT + np.broadcast_to(c, (FAN_OUT, FAN_OUT)) for c in (children[:, None], children))
        keep = (left < right) & (right < len(levels[top - 1]["lo"]))
        stack = [(top - 1, left[keep], right[keep])]
        while stack:
            height, i, j = stack.pop()
            most = _NODES_AT_ONCE if height else _PAIRS_AT_ONCE
            if len(i) > most:
                stack += [(height, i[k : k + most], j[k : k + most]) for k in range(0, len(i), most)]
                continue
            alive = _surviving(levels[height], i, j, percent, forest.roots())
            i, j = i[alive], j[alive]
            if height:
                left, right = (x[:, None, None] * FAN_OUT + np.broadcast_to(c, (FAN_OUT, FAN_OUT)) for x, c in ((i, children[:, None]), (j, children)))
                keep = (left < len(levels[height - 1]["lo"])) & (right < len(levels[height - 1]["lo"]))
                if keep.any():
                    stack.append((height - 1, left[keep], right[keep]))
                continue
            cut = np.flatnonzero(np.diff(i)) + 1
            for part_i, part_j in zip(np.split(i, cut), np.split(j, cut), strict=True):
                if len(part_i):
                    verify(int(part_i[0]), part_j.tolist())
    return [(int(order[a]), int(order[b])) for a, b in forest.links]
