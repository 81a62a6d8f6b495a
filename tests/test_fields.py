"""Distance sums by boxes against brute force."""

import numpy as np
import pytest

from segmint.operators import fields
from segmint.operators import metrics as M
from test_rows import brute_silhouette


@pytest.mark.parametrize("dims", [1, 2])
def test_silhouette_by_boxes(spark, dims, monkeypatch):
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(size=(900, dims)), rng.normal(size=(500, dims)) * 0.01 + 5, np.full((300, dims), 2.5), np.full((1, dims), 4e3)])
    if dims == 2:
        x[::3, 0] = np.round(x[::3, 0])
    lab = np.stack([rng.integers(-1, 4, len(x)), (x[:, 0] > 1).astype(int), np.zeros(len(x), int)], axis=1)
    lab[5, 0] = 9  # alone
    cols, labels = list("ab")[:dims], ["l0", "l1", "l2"]
    rows = [(str(i) if i % 50 else None, *map(float, p), *(int(c) if c >= 0 else None for c in q)) for i, (p, q) in enumerate(zip(x, lab))]
    df = spark.createDataFrame(rows, "customerID string, " + ", ".join(f"{c} double" for c in cols) + ", " + ", ".join(f"{c} int" for c in labels)).repartition(5)
    monkeypatch.setattr(M, "_silhouettes", lambda *a: pytest.fail("all pairs"))
    got = M.silhouette_samples(df, cols, labels, leaf=32).collect()
    for k in range(3):
        want = sorted((str(rows[i][0]), int(lab[i, k]), *t) for i, t in ((i, tuple(-9.0 if v is None else v for v in t)) for i, t in brute_silhouette(x, lab[:, k]).items()))
        mine = sorted((str(r.customerID), r.cluster_id, r.a, -9.0 if r.b is None else r.b, r.silhouette) for r in got if r.labeling == f"l{k}")
        assert [w[:2] for w in want] == [m[:2] for m in mine]
        by = lambda rows: np.array(sorted([tuple(np.round(r[2:], 5)) + r[2:] for r in rows]))[:, 3:]
        np.testing.assert_allclose(by(mine), by(want), rtol=1e-9, atol=1e-9)


def test_far_boxes_are_few_and_right():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(20_000, 2))
    tree = fields.Tree(x[:4000], 8)
    leaf = tree.leaf_of(x)
    at = np.unique(leaf)
    tree.set_boxes(at, np.array([x[leaf == i].min(axis=0) for i in at]), np.array([x[leaf == i].max(axis=0) for i in at]), np.array([(leaf == i).sum() for i in at]))
    sub = [n for n, raw, s in tree.wanted(8) if s == 100 and raw]
    assert len(sub) < 60  # of 256 leaves the near ones only
    t, node = at[100], next(int(i) for i in at if tree.far(np.array([at[100]]), int(i))[0])
    y, z = x[leaf == t], x[leaf == node]
    direct = np.sqrt(((y[:, None] - z[None]) ** 2).sum(axis=2)).sum(axis=1)
    w = tree.shares(node, z).sum(axis=0)
    mid = np.sqrt(((tree.nodes(t)[:, None] - tree.nodes(node)[None]) ** 2).sum(axis=2)) @ w
    np.testing.assert_allclose(tree.shares(t, y) @ mid, direct, rtol=1e-10)


def test_blocks_do_not_grow_with_shuffle_partitions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x, lab = rng.normal(size=(2000, 3)), rng.integers(0, 3, 2000)
    df = spark.createDataFrame([(str(i), *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, lab))], "customerID string, a double, b double, c double, cluster_id int")
    seen, to_all, before = [], M.to_all, spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(M, "to_all", lambda chunks, blocks: seen.append(blocks) or to_all(chunks, blocks))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = M.silhouette_score(df, list("abc")).first().silhouette
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] <= 2 * spark.sparkContext.defaultParallelism
    assert got == pytest.approx(np.mean([t[2] for t in brute_silhouette(x, lab).values()]), abs=1e-9)


def _sums_by_boxes(x, lab, depth, tree_class=fields.Tree):
    """(sums of the held rows, their points): the leaves of one subtree get what
    they want, as in a task."""
    tree = tree_class(x[::5], depth)
    leaf = tree.leaf_of(x)
    at = np.unique(leaf)
    tree.set_boxes(at, np.array([x[leaf == i].min(axis=0) for i in at]), np.array([x[leaf == i].max(axis=0) for i in at]), np.array([(leaf == i).sum() for i in at]))
    row = lambda i: dict(leaf=int(i), node=int(i), n=int((leaf == i).sum()), x=x[leaf == i].tobytes(), labels=lab[leaf == i].tobytes(), w=None, keys=None)
    keys, w = np.unique(lab), {}
    for i in at:
        y, k, hot = fields.weights_of(x[leaf == i], lab[leaf == i])
        full = np.zeros((len(y), len(keys)))
        full[:, np.searchsorted(keys, k)] = hot
        w[int(i)] = tree.shares(i, y).T @ full
    for i in range((1 << depth) - 2, -1, -1):
        parts = [j for j in (2 * i + 1, 2 * i + 2) if j in w]
        if parts:
            w[i] = sum(tree.shares(i, tree.nodes(j)).T @ w[j] for j in parts)
    held = [int(i) for i in at if (i - (1 << depth) + 1) >> (depth - 2) == 1]
    work = fields.Sums([row(i) for i in held], tree, keys.astype(np.int64))
    for node, raw, sub in tree.wanted(2):
        if sub == 1:
            work.add(row(node) if raw else dict(node=node, n=len(w[node]), w=w[node].tobytes(), keys=keys.astype("<i8").tobytes()))
    return work.whole(), np.concatenate([x[leaf == i] for i in held])


class _Rounded(fields.Tree):
    """Some boxes that are far by their sizes are taken for near ones, as rounding can do."""

    def far(self, leaves, node):
        return super().far(leaves, node) & ((np.asarray(leaves) * 31 + node * 17) % 3 > 0)


@pytest.mark.parametrize("tree_class", [fields.Tree, _Rounded])
def test_every_point_is_counted_once(tree_class):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 72, 6000) / 24.5, np.round(rng.uniform(0.6, 4.0, 6000), 2)])
    lab = rng.integers(0, 3, (6000, 1)).astype("<i4")
    got, points = _sums_by_boxes(x, lab, 7, tree_class)
    d = np.sqrt(((points[:, None] - x[None]) ** 2).sum(axis=2))
    np.testing.assert_allclose(got, d @ np.eye(3)[lab[:, 0]], rtol=1e-10)


def test_large_boxes_meet_large_boxes(monkeypatch):
    rng = np.random.default_rng(4)
    x, lab, pairs = rng.uniform(size=(20_000, 2)), np.zeros((20_000, 1), "<i4"), [0]
    keep = fields.sq_distances
    monkeypatch.setattr(fields, "sq_distances", lambda a, b: pairs.__setitem__(0, pairs[0] + len(a) * len(b)) or keep(a, b))
    _sums_by_boxes(x, lab, 7)
    assert pairs[0] < 28_000_000  # of 100 million
