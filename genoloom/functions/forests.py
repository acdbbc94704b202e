"""Tree ensembles of any size as flat arrays, evaluated without conditions.

A condition ``feature <= threshold`` that fails rules out the leaves of its left subtree: a mask of bits, one a leaf, from
left to right. A row's leaf in a tree is the lowest bit left after all masks of failed conditions. Sorted by threshold,
the failed conditions of a feature are always a first part of the list, so the AND of every first part is tabulated: a row
looks up its place among a feature's thresholds once, gathers one line of masks of all trees, and ANDs one line for each
feature. Work and memory follow from the number of features and leaves, not from paths, and nothing depends on depth.
Trees are dealt into groups, so that a group's table stays below ``table_bytes`` however many thresholds there are. A
group's table grows with the square of its trees, so small groups make all tables together small, and each fits the cache.
"""

from __future__ import annotations

import numpy as np


class FlatForest:
    """The mean of the leaves of ``trees``: node tables, where a node is (feature, threshold, left, right), left where
    feature <= threshold, or (leaf,), and node 0 is the root. Null and NaN go right. ``features`` are the names in the
    order of the columns that are given to the call."""

    def __init__(self, trees: list[dict[int, tuple]], features: list[str] | None = None, table_bytes: int = 1 << 22):
        self.features = list(features or sorted({n[0] for t in trees for n in t.values() if len(n) > 1}))
        self.trees = len(trees)
        at = {f: i for i, f in enumerate(self.features)}
        self.groups: list[dict] = []
        held, conditions, words = [], 0, 0
        for t in map(lambda t: _leaves(t, at), trees):
            own = -(-len(t[0]) // 64)
            if held and (conditions + len(t[1]) + len(at)) * (words + own) * 8 > table_bytes:
                self.groups.append(_tables(held, len(at)))
                held, conditions, words = [], 0, 0
            held.append(t)
            conditions, words = conditions + len(t[1]), words + own
        if held:
            self.groups.append(_tables(held, len(at)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for g in self.groups:
            step = max(16, (1 << 20) // max(1, g["words"]))
            for lo in range(0, len(x), step):
                part = x[lo : lo + step]
                left = np.broadcast_to(g["all"], (len(part), g["words"])).copy()
                for f, (thresholds, masks) in g["by_feature"].items():
                    left &= masks[np.searchsorted(thresholds, part[:, f], side="left")]  # NaN comes after all thresholds
                rows = np.arange(len(part))
                for first, last, leaves in g["of_tree"]:
                    own = left[:, first:last]
                    word = (own != 0).argmax(1) if last - first > 1 else 0
                    bits = own[rows, word]
                    total[lo : lo + step] += leaves[64 * word + np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))]
        return total / max(1, self.trees)


def _leaves(tree: dict[int, tuple], at: dict[str, int]) -> tuple[list[float], list[tuple[int, float, int, int]]]:
    """Leaf values from left to right, and conditions (feature, threshold, first and end of the leaves on their left)."""
    leaves, conditions = [], []
    stack: list[tuple] = [(0, None)]
    while stack:
        node, opened = stack.pop()
        if opened is not None:  # the left subtree is done
            feature, threshold, first = opened
            conditions.append((at[feature], float(threshold), first, len(leaves)))
        elif len(tree[node]) == 1:
            leaves.append(float(tree[node][0]))
        else:
            feature, threshold, left, right = tree[node]
            stack += [(right, None), (node, (feature, threshold, len(leaves))), (left, None)]
    return leaves, conditions


def _tables(trees: list[tuple], features: int) -> dict:
    """The masks of a group of trees, each tree in words of its own."""
    starts = np.cumsum([0, *(-(-len(leaves) // 64) for leaves, _ in trees)])
    every = np.zeros(starts[-1], np.uint64)
    of_tree = []
    by: list[list] = [[] for _ in range(features)]
    for (leaves, conditions), first, last in zip(trees, starts, starts[1:]):
        bits = (1 << len(leaves)) - 1
        every[first:last] = [(bits >> (64 * i)) & 0xFFFFFFFFFFFFFFFF for i in range(last - first)]
        of_tree.append((int(first), int(last), np.array(leaves)))
        for f, threshold, a, b in conditions:
            by[f].append((threshold, int(first), a, b))
    by_feature = {}
    for f, own in enumerate(by):
        if not own:
            continue
        own.sort(key=lambda c: c[0])
        thresholds = np.unique([c[0] for c in own])
        masks = np.full((len(thresholds) + 1, len(every)), ~np.uint64(0))
        line = np.searchsorted(thresholds, [c[0] for c in own]) + 1
        for (_, first, a, b), i in zip(own, line.tolist()):
            for word in range(a // 64, (b - 1) // 64 + 1):
                lo, hi = max(a, 64 * word) - 64 * word, min(b, 64 * word + 64) - 64 * word
                masks[i, first + word] &= np.uint64(0xFFFFFFFFFFFFFFFF ^ (((1 << (hi - lo)) - 1) << lo))
        np.bitwise_and.accumulate(masks, axis=0, out=masks)
        by_feature[f] = (thresholds, masks)
    return {"words": int(starts[-1]), "all": every, "by_feature": by_feature, "of_tree": of_tree}
