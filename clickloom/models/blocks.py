"""The part of boosting that runs in tasks: rows of a batch, trees on bins, order of doubles.

It imports numpy only, because every Python worker of an executor imports it first.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

BINS = 32  # of a feature at most, as in Spark's trees


@dataclass
class Grown:
    """A tree on bins: node 1 is the root, nodes 2v and 2v + 1 are the children of v.

    ``feature`` is -1 where a node has no children; rows up to bin ``cut`` go left. The rows
    of such a node are found at its leftmost descendant of the last level, where ``step``
    has what the leaf adds to the prediction.
    """

    feature: np.ndarray
    cut: np.ndarray
    step: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> Grown:
        return Grown(np.full(2 << depth, -1), np.zeros(2 << depth, dtype=np.int64), np.zeros(2 << depth))

    def places(self, bins: np.ndarray, starts: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node of every row after so many levels; bins of a row begin at its start."""
        feature, cut = np.maximum(self.feature, 0), np.where(self.feature >= 0, self.cut, BINS)
        at = np.ones(len(starts), dtype=np.int64)
        for _ in range(len(feature).bit_length() - 2 if levels is None else levels):
            at = 2 * at + (bins[starts + feature[at]] > cut[at])
        return at


@dataclass(frozen=True)
class Batch:
    """Rows of a batch; ``used`` and ``at`` have a column per fit, a row's bins of all fits lie together."""

    label: np.ndarray
    used: np.ndarray
    bins: np.ndarray
    starts: list[np.ndarray]
    at: np.ndarray

    def moved(self, trees: list[Grown]) -> Batch:
        """The rows with what a tree per fit adds to their predictions."""
        steps = [tree.step[self.places(tree, i)] for i, tree in enumerate(trees)]
        return replace(self, at=self.at + np.stack(steps, axis=1))

    def residual(self, fit: int) -> np.ndarray:
        return self.label - self.at[:, fit]

    def places(self, tree: Grown, fit: int, levels: int | None = None) -> np.ndarray:
        return tree.places(self.bins, self.starts[fit], levels)


def order_bits(v: np.ndarray) -> np.ndarray:
    """Longs that order like the doubles, with equal zeros."""
    k = (v + 0.0).view(np.int64)
    return np.where(k < 0, k ^ np.int64(2**63 - 1), k)


def among(key: np.ndarray, prefix: np.ndarray, known: dict[int, int]) -> np.ndarray:
    """Where the prefix is the one known for the key."""
    keys = np.array(sorted(known))
    wanted = np.array([known[k] for k in keys.tolist()])
    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return (keys[place] == key) & (wanted[place] == prefix)
