"""Sums of distances to many points of the line or the plane, without all pairs.

Points lie in the leaves of a k-d tree. What is far from a box, measured by the
sizes of both, sees the box's points as weights at its Chebyshev nodes, and
sums at its own nodes are carried on to its parts and at last to its points, so
boxes of all sizes meet, not only leaves: |x - y| is smooth there, so
``NODES`` nodes a side are right to about the last digits of a double. Leaves
that are near each other meet point by point. A block is a subtree, or a part
of one; it gets the nodes and points that some leaf of it needs, once, so what
travels grows about as the rows do. The tree is bounded (``LEAVES``) and made of
a sample; that moves work only, as every row is in a leaf and boxes are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.operators.strips import TILE, hold_and_stream, pack, sq_distances, tasks_wanted, unpack
from segmint.session import materialize

NODES = 12
APART = 2.0
LEAVES = 1 << 14


class Tree:
    """Node i has the parts 2i + 1 and 2i + 2; the last level are the leaves."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.dim, self.at = depth, np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        parts = [sample]
        for i in range(len(self.dim)):
            x = parts[i]
            low, high = x, x[:0]
            if len(x):
                k = int((x.max(axis=0) - x.min(axis=0)).argmax())
                v = np.sort(x[:, k])
                cut = v[len(v) // 2]
                if cut == v[0]:  # a value that half of the points share
                    more = v[v > cut]
                    cut = more[0] if len(more) else np.inf
                self.dim[i], self.at[i] = k, cut
                low, high = x[x[:, k] < cut], x[x[:, k] >= cut]
            parts += [low, high]
            parts[i] = x[:0]
        self.centre = self.half = np.zeros((0, sample.shape[1]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        i = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            i = 2 * i + 1 + (x[np.arange(len(x)), self.dim[i]] >= self.at[i])
        return i

    def set_boxes(self, leaf: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> None:
        low, high = (np.full(((2 << self.depth) - 1, lo.shape[1]), v) for v in (np.inf, -np.inf))
        self.n = np.zeros(len(low), np.int64)
        low[leaf], high[leaf], self.n[leaf] = lo, hi, n
        for i in range(len(self.dim) - 1, -1, -1):
            low[i], high[i] = np.minimum(low[2 * i + 1], low[2 * i + 2]), np.maximum(high[2 * i + 1], high[2 * i + 2])
            self.n[i] = self.n[2 * i + 1] + self.n[2 * i + 2]
        empty = self.n == 0
        low[empty], high[empty] = 0.0, 0.0
        self.centre, self.half = low / 2 + high / 2, high / 2 - low / 2
        self.centre[low == high], self.half[low == high] = low[low == high], 0.0

    def far(self, leaves: np.ndarray, node: int) -> np.ndarray:
        """Which leaves are far from a node; then they are from its parts too."""
        gap = np.abs(self.centre[leaves] - self.centre[node]) - self.half[leaves] - self.half[node]
        gap = np.sqrt((np.maximum(gap, 0.0) ** 2).sum(axis=1))
        return gap >= APART * np.maximum(self.half[leaves].max(axis=1), self.half[node].max())

    def nodes(self, node: int) -> np.ndarray:
        """The Chebyshev nodes of a box; one in a direction without extent."""
        sides = [c + h * _ROOTS if h > 0 else np.array([c]) for c, h in zip(self.centre[node], self.half[node], strict=True)]
        return np.stack([g.ravel() for g in np.meshgrid(*sides, indexing="ij")], axis=1)

    def shares(self, node: int, x: np.ndarray) -> np.ndarray:
        """How much of each point in the box falls to each node (points x nodes)."""
        out = np.ones((len(x), 1))
        for k, (c, h) in enumerate(zip(self.centre[node], self.half[node], strict=True)):
            if h > 0:
                t = np.arccos(np.clip((x[:, k] - c) / h, -1.0, 1.0))
                side = np.cos(t[:, None] * np.arange(NODES)) @ _COSINES
                out = (out[:, :, None] * side[:, None, :]).reshape(len(x), -1)
        return out

    def wanted(self, under: int) -> list[tuple[int, bool, int]]:
        """(node, whether as points, subtree): what some leaf of each subtree of
        level ``under`` needs."""
        first, span = (1 << self.depth) - 1, 1 << (self.depth - under)
        leaves = np.arange(first, 2 * first + 1)
        leaves, out, todo = leaves[self.n[leaves] > 0], [], []
        todo.append((0, leaves))
        while todo:
            node, near = todo.pop()
            if not self.n[node] or not len(near):
                continue
            far = self.far(near, node)
            out += [(node, False, int(s)) for s in np.unique((near[far] - first) // span)]
            if node >= first:
                out += [(node, True, int(s)) for s in np.unique((near[~far] - first) // span)]
            else:
                todo += [(2 * node + 1, near[~far]), (2 * node + 2, near[~far])]
        return out


_ANGLES = (np.arange(NODES) + 0.5) * np.pi / NODES
_ROOTS = np.cos(_ANGLES)
_COSINES = np.cos(np.arange(NODES)[:, None] * _ANGLES) * np.where(np.arange(NODES) == 0, 1.0, 2.0)[:, None] / NODES


def weights_of(x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different points, clusters as labeling << 32 | cluster, how often each
    point is in each cluster). Labels below 0 are none."""
    y, same = np.unique(x, axis=0, return_inverse=True)
    point, labeling = np.nonzero(labels >= 0)
    keys, which = np.unique((labeling.astype(np.int64) << 32) | labels[point, labeling], return_inverse=True)
    hot = np.zeros((len(y), len(keys)))
    np.add.at(hot, (same.reshape(-1)[point], which.reshape(-1)), 1.0)
    return y, keys, hot


def _merged(a: tuple | None, keys: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if a is None:
        return keys, w
    every = np.union1d(a[0], keys)
    out = np.zeros((len(w), len(every)))
    out[:, np.searchsorted(every, a[0])] = a[1]
    out[:, np.searchsorted(every, keys)] += w
    return every, out


def moments(chunks: DataFrame, shared) -> DataFrame:
    """(node, n, keys, w): weights of the clusters at the nodes of every box. A
    box whose rows come by in several tasks has several rows, to be added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, now = shared.value, {}  # level -> (node, keys, weights)

        def close(level: int):
            node, keys, w = now.pop(level)
            if level:
                up = (node - 1) // 2
                yield from put(level - 1, up, keys, tree.shares(up, tree.nodes(node)).T @ w)
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([len(w)], pa.int32()), pa.array([keys.tobytes()]),
                                              pa.array([np.ascontiguousarray(w).tobytes()])], ["node", "n", "keys", "w"])

        def put(level: int, node: int, keys, w):
            if level in now and now[level][0] != node:
                yield from close(level)
            now[level] = (node, *_merged(now[level][1:] if level in now else None, keys, w))

        for b in batches:
            for r in b.to_pylist():
                y, keys, hot = weights_of(np.frombuffer(r["x"], "<f8").reshape(r["n"], -1), np.frombuffer(r["labels"], "<i4").reshape(r["n"], -1))
                if len(keys):
                    yield from put(tree.depth, r["leaf"], keys, tree.shares(r["leaf"], y).T @ hot)
        for level in range(tree.depth, -1, -1):
            if level in now:
                yield from close(level)

    return chunks.select("leaf", "n", "x", "labels").mapInArrow(run, "node int, n int, keys binary, w binary")


class Sums:
    """Sums of distances from the held points to every cluster; ``finish`` of a
    subclass finds them in ``sums``, a line for each held row."""

    def __init__(self, held: list[dict], tree: Tree, keys: np.ndarray):
        self.tree, self.keys = tree, keys
        leaf = np.repeat([r["leaf"] for r in held], [r["n"] for r in held]).astype(np.float64)
        points, self.same = np.unique(np.column_stack([leaf, unpack(held, "x", "<f8")]), axis=0, return_inverse=True)
        self.x = np.ascontiguousarray(points[:, 1:])
        self.leaves, self.first = np.unique(points[:, 0].astype(np.int64), return_index=True)
        self.ends = np.append(self.first, len(points))
        self.sums = np.zeros((len(points), len(keys)))
        # the held leaves, then the boxes that hold them, level by level up to the whole
        self.levels, self.under = [self.leaves], []
        while self.levels[-1][0]:
            boxes, first = np.unique((self.levels[-1] - 1) // 2, return_index=True)
            self.levels.append(boxes)
            self.under.append(first)
        self.offs = np.cumsum([0] + [len(boxes) for boxes in self.levels])
        at = [tree.nodes(i) for boxes in self.levels for i in boxes]
        self.node_ends = np.cumsum([0] + [len(a) for a in at])
        self.at = np.concatenate(at)
        self.fields = np.zeros((len(self.at), len(keys)))
        self.near: dict[int, np.ndarray] = {}

    def _near(self, node: int) -> np.ndarray:
        """Which held leaves are far neither from a node nor from one that holds
        it: rounding can make a leaf far from a box and not from its parts."""
        if node not in self.near:
            far = self.tree.far(self.leaves, node)
            self.near[node] = ~far & self._near((node - 1) // 2) if node else ~far
        return self.near[node]

    def _largest(self, leaves: np.ndarray, node: int) -> np.ndarray:
        """The largest boxes that are far from a node and hold none but the
        given leaves (a flag for each), which they hold all together."""
        out, use = [], leaves
        for boxes, first in zip(self.levels[1:], self.under, strict=True):
            over = np.logical_and.reduceat(use, first)
            if over.any():
                over &= self.tree.far(boxes, node)
            out.append(use & ~np.repeat(over, np.diff(np.append(first, len(use)))))
            use = over
            if not use.any():
                break
        else:
            out.append(use)
        return np.flatnonzero(np.concatenate(out))

    def add(self, row: dict) -> None:
        node = row["node"]
        if row["w"] is None:
            use = np.flatnonzero(self._near(node))
            y, keys, w = weights_of(np.frombuffer(row["x"], "<f8").reshape(row["n"], -1), np.frombuffer(row["labels"], "<i4").reshape(row["n"], -1))
            x, ends, out = self.x, self.ends, self.sums
        else:
            use = self._largest(~self._near(node) & self._near((node - 1) // 2) if node else ~self._near(0), node)
            keys = np.frombuffer(row["keys"], "<i8")
            y, w = self.tree.nodes(node), np.frombuffer(row["w"], "<f8").reshape(row["n"], -1)
            x, ends, out = self.at, self.node_ends, self.fields
        if not len(use) or not len(keys):
            return
        at = np.searchsorted(self.keys, keys)
        lines = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in use])
        for s in range(0, len(lines), 2 * TILE):
            some = lines[s:s + 2 * TILE]
            d = sq_distances(x[some], y)
            out[some[:, None], at] += np.sqrt(d, out=d) @ w

    def whole(self) -> np.ndarray:
        for level in range(len(self.under), 0, -1):
            first = self.under[level - 1]
            for i, (box, a, b) in enumerate(zip(self.levels[level], first, np.append(first[1:], len(self.levels[level - 1])), strict=True)):
                k = self.offs[level] + i
                lo, hi = (self.node_ends[self.offs[level - 1] + j] for j in (a, b))
                self.fields[lo:hi] += self.tree.shares(box, self.at[lo:hi]) @ self.fields[self.node_ends[k]:self.node_ends[k + 1]]
        for i, leaf in enumerate(self.leaves):
            a, b = self.ends[i], self.ends[i + 1]
            self.sums[a:b] += self.tree.shares(leaf, self.x[a:b]) @ self.fields[self.node_ends[i]:self.node_ends[i + 1]]
        return self.sums[self.same.reshape(-1)]


def held_and_streamed(points: DataFrame, n: int, d: int, rows: int, start, schema: str, leaf: int = 512) -> DataFrame:
    """``start(held, tree)`` and then its ``add`` and ``finish`` over all points,
    held in blocks of about ``rows``. ``points``: _row, _x, labels, ids."""
    spark = points.sparkSession
    depth = max(1, min(int(math.log2(LEAVES)), round(math.log2(max(2.0, n / leaf)))))
    share = min(1.0, 16 * (1 << depth) / n)
    drawn = points.where(F.pmod(F.xxhash64(F.lit(7), "_row"), F.lit(1 << 20)) < F.lit(max(1, math.ceil(share * (1 << 20)))))
    drawn = drawn.select(*[F.col("_x")[i].alias(f"x{i}") for i in range(d)]).toArrow()  # 16 for each leaf
    tree = Tree(np.stack([c.to_numpy() for c in drawn.columns], axis=1).reshape(-1, d), depth)

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.leaf_of(x), pa.int32())], [*b.schema.names, "leaf"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = points.mapInArrow(place, f"{kinds}, leaf int").repartitionByRange(parts, "leaf", "_row").sortWithinPartitions("leaf", "_x")
    chunks = materialize(pack(placed, {"labels": "<i4"}, by=("leaf",), payload="ids", size=2048).drop("rows"), "field-points")

    def boxes(batches):
        for b in batches:
            for r in b.to_pylist():
                x = np.frombuffer(r["x"], "<f8").reshape(r["n"], -1)
                yield pa.RecordBatch.from_arrays([pa.array([r["leaf"]], pa.int32()), pa.array([r["n"]], pa.int32()),
                                                  *(pa.array([v]) for v in [*x.min(axis=0), *x.max(axis=0)])], ["leaf", "n", *lows, *highs])

    lows, highs = [f"lo{i}" for i in range(d)], [f"hi{i}" for i in range(d)]
    found = chunks.select("leaf", "n", "x").mapInArrow(boxes, "leaf int, n int, " + ", ".join(f"{c} double" for c in [*lows, *highs]))
    found = found.groupBy("leaf").agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]).toArrow()  # one row a leaf
    side = lambda cs: np.stack([found.column(c).to_numpy() for c in cs], axis=1)
    tree.set_boxes(found.column("leaf").to_numpy(), side(lows), side(highs), found.column("n").to_numpy())
    shared = spark.sparkContext.broadcast(tree)  # boxes of a bounded number of nodes

    level = min(depth, math.ceil(math.log2(max(2.0, n / rows, min(tasks_wanted(points), 64)))))
    subtrees = np.arange((1 << level) - 1, (2 << level) - 1)
    pieces = np.maximum(1, -(-tree.n[subtrees] // (2 * rows)))  # a leaf of many copies has several blocks
    offs = np.concatenate([[0], np.cumsum(pieces)])
    of = spark.createDataFrame(pa.table({"subtree": pa.array(np.arange(len(subtrees)), pa.int32()), "off": pa.array(offs[:-1]), "pieces": pa.array(pieces)}))
    subtree = ((F.col("leaf") - F.lit((1 << depth) - 1)) / F.lit(1 << (depth - level))).cast("int")
    held = chunks.withColumn("subtree", subtree).join(F.broadcast(of), "subtree")  # one row a subtree
    held = held.withColumn("block", F.col("off") + F.pmod(F.xxhash64("chunk"), F.col("pieces"))).drop("subtree", "off", "pieces")
    node, points_too, to = (np.array(v) for v in zip(*tree.wanted(level), strict=True))
    wanted = spark.createDataFrame(pa.table({"node": pa.array(node, pa.int32()), "raw": pa.array(points_too, pa.bool_()), "subtree": pa.array(to, pa.int32())}))
    wanted = wanted.join(F.broadcast(of), "subtree").select("node", "raw", F.explode(F.sequence(F.col("off"), F.col("off") + F.col("pieces") - 1)).alias("block"))
    none = F.lit(None).cast("binary")
    items = chunks.select(F.col("leaf").alias("node"), F.lit(True).alias("raw"), "chunk", "n", "x", "labels", none.alias("keys"), none.alias("w"))
    far = materialize(moments(chunks, shared), "field-moments")
    items = items.unionByName(far.select("node", F.lit(False).alias("raw"), (-F.col("node")).cast("long").alias("chunk"), "n", none.alias("x"), none.alias("labels"), "keys", "w"))
    streamed = items.join(wanted, ["node", "raw"]).drop("raw")
    return hold_and_stream(held, streamed, int(offs[-1]), lambda rows: start(rows, shared.value), schema)
