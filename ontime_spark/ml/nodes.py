"""A forest as arrays of its nodes, which take a batch of rows down every tree at once.

A model walks its trees row by row, from object to object. Here a step moves all rows of a batch one level
down a tree, whose arrays are small enough to stay near the processor.
The predictions are the model's own, to the last bit: trees are added up in their order.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

NEVER = np.iinfo(np.int32).max
BLOCK_ROWS = 16_384


class Tree:
    """One tree. A node's children lie side by side, a leaf is its own child, and both are places in arrays.

    Numbers are compared by their codes, the place of a value among the forest's thresholds. ``limit`` is the
    last code that goes left; below zero it says where the node's categories are, a bit for each that goes left.
    """

    def __init__(self, rows: dict[str, np.ndarray], lists: Sequence, features: np.ndarray, codes: np.ndarray):
        count = len(rows["node"])
        inner = np.flatnonzero(features >= 0)
        place = np.zeros(count, np.int64)  # of each node, by its number; the root is 0
        place[rows["left"][inner]] = 1 + 2 * np.arange(len(inner))
        place[rows["right"][inner]] = 2 + 2 * np.arange(len(inner))
        self.first, self.limit = np.arange(count), np.full(count, NEVER, np.int32)
        self.feature, self.value = np.zeros(count, np.int64), np.zeros(count)
        self.value[place] = rows["prediction"]
        at = place[inner]
        self.first[at] = place[rows["left"][inner]]
        self.feature[at], self.limit[at] = features[inner], codes[inner]
        kinds = [i for i in inner.tolist() if lists[i] is not None]
        parts = []
        for i in kinds:
            mine = np.zeros(max(lists[i], default=0) + 1, np.uint8)
            mine[lists[i]] = 1
            self.limit[place[i]] = -1 - len(parts)
            parts.append(np.packbits(mine, bitorder="little"))
        sizes = np.array([len(p) for p in parts], np.int64)
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes
        self.bits = np.concatenate([*parts, np.zeros(1, np.uint8)])
        self.depth, level = 0, np.zeros(1, np.int64)
        while len(level := level[self.first[level] != level]):
            level = np.concatenate([self.first[level], self.first[level] + 1])
            self.depth += 1

    def predict(self, codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The leaves' values. ``codes`` are flat; ``rows`` says where each row begins."""
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            code = codes.take(rows + self.feature.take(node))
            limit = self.limit.take(node)
            right = code > limit
            listed = np.flatnonzero(limit < 0)
            if len(listed):
                part, mine = -1 - limit[listed].astype(np.int64), code[listed].astype(np.int64)
                byte = mine >> 3
                known = byte < self.sizes[part]
                held = self.bits[np.where(known, self.starts[part] + byte, len(self.bits) - 1)]
                right[listed] = (held >> (mine & 7)) & 1 == 0
            node = self.first.take(node) + right
        return self.value.take(node)


class Forest:
    """The trees of a node table (:func:`ontime_spark.ml.forest.node_table`), in their order."""

    def __init__(self, table: pa.Table, inputs: Sequence[str]):
        table = table.sort_by([("tree", "ascending"), ("node", "ascending")])
        held = {name: table[name].to_numpy() for name in ("tree", "node", "prediction")}
        for name in ("left", "right"):
            held[name] = table[name].fill_null(0).to_numpy().astype(np.int64)
        number = {name: i for i, name in enumerate(inputs)}
        features = np.array([-1 if f is None else number[f] for f in table["feature"].to_pylist()], np.int64)
        threshold = table["threshold"].to_numpy()  # NaN where there is none
        lists = [None if c is None else [int(x) for x in c] for c in table["categories"].to_pylist()]
        measured = ~np.isnan(threshold)
        self.edges = [np.unique(threshold[measured & (features == f)]) for f in range(len(inputs))]
        self.listed = sorted({int(f) for f, c in zip(features, lists) if c is not None})
        codes = np.full(len(features), NEVER, np.int32)
        for f, edges in enumerate(self.edges):
            mine = measured & (features == f)
            codes[mine] = np.searchsorted(edges, threshold[mine])
        cuts = np.flatnonzero(np.diff(held["tree"], prepend=-1)).tolist() + [len(features)]
        self.trees = [
            Tree({name: of[a:b] for name, of in held.items()}, lists[a:b], features[a:b], codes[a:b])
            for a, b in zip(cuts[:-1], cuts[1:])
        ]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean of all trees for each row of ``x``, whose columns are the vector's inputs."""
        codes = np.empty(x.shape, np.int32)
        for f, edges in enumerate(self.edges):
            # A value is at most the jth threshold where its code is at most j; NaN is beyond all.
            codes[:, f] = x[:, f] if f in self.listed else np.searchsorted(edges, x[:, f])
        flat, rows = codes.reshape(-1), np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for tree in self.trees:
            total += tree.predict(flat, rows)
        return total / len(self.trees)

    def predict_lists(self, features: pa.Array) -> pa.Array:
        """The same for an Arrow array of lists of equal length."""
        done = [np.zeros(0)]
        for start in range(0, len(features), BLOCK_ROWS):
            part = features.slice(start, BLOCK_ROWS)
            done.append(self.predict(part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)))
        return pa.array(np.concatenate(done), pa.float64())
