import numpy as np
import pytest

from segmint.llm import vector_join as V


def vectors(n=700, d=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for i in range(n // 2, n):  # near copies at all distances
        x[i] = x[int(rng.integers(0, n // 4))] + rng.random() * 0.6 * rng.standard_normal(d)
    x[n - 40:] = x[0] + 0.05 * rng.standard_normal((40, d))
    return x.astype(np.float32)


def brute(x, cosine=0.9):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= cosine
    np.fill_diagonal(link, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(link, root[None, :], len(x)).min(axis=1))
        if (new == root).all():
            return link, root
        root = new


@pytest.mark.parametrize("chunk", [1024, 16])
def test_links_and_components(spark, chunk):
    x = vectors()
    link, root = brute(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted(V.vector_components(df, chunk=chunk).collect())
    n = np.array([r.n_links for r in got])
    assert (n <= link.sum(axis=1)).all()
    assert n.sum() >= 0.99 * link.sum()
    if (n == link.sum(axis=1)).all():
        assert [r.component_id for r in got] == root.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_at_the_cosine_itself():
    f, d = V.Filters(code=128), 32
    least, books = V.threshold(f, d), V.codebooks(f, d)
    rng = np.random.default_rng(99)
    met = 0
    for _ in range(1000):
        u = rng.standard_normal(d)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(d)
        w -= w @ u * u
        v = 0.9 * u + np.sqrt(1 - 0.81) * w / np.linalg.norm(w)
        met += any(len(np.intersect1d(V.decode(u @ c, u @ e, least), V.decode(v @ c, v @ e, least))) for c, e in books)
    assert met >= 975


def test_decoding_lists_all_filters():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.standard_normal(40), rng.standard_normal(40)
        least = float(rng.random() * 3)
        assert V.decode(a, b, least).tolist() == np.flatnonzero((a[:, None] + b[None, :] >= least).ravel()).tolist()


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]),
            (7, [None, 1.0, 0.0]), (8, []), (9, [1.0, 0.0]), (None, [1.0, 0.001, 0.0]), (10, [-1.0, 0.0, -0.0]), (11, [-1.0, 0.0, 0.0]), (12, [1e300, 0.0, 1e299])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, node string, raw string")
    got = V.vector_components(df).collect()
    assert len(got) == len(rows)
    links = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in got)
    assert links == [(0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), *((i, 0, i, True) for i in range(3, 10)),
                     (10, 1, 10, True), (11, 1, 10, False), (12, 4, 1, False)]
    assert V.vector_components(df.limit(0)).count() == 0
