"""Quadratic operators on repeated and null ids, ties, empty tables, against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators import dbscan as DB
from segmint.operators import kmeans as KM
from segmint.operators import metrics as M
from segmint.operators.strips import numbered, sq_distances

COLS = ["a", "b", "c", "d", "e"]


def brute_silhouette(x, lab):
    """a, b, silhouette for every row with a label."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = {}
    for i in np.flatnonzero(lab >= 0):
        means = {c: d[i, lab == c].sum() / max(1, (lab == c).sum() - (c == lab[i])) for c in np.unique(lab[lab >= 0])}
        a = means.pop(lab[i]) if (lab == lab[i]).sum() > 1 else 0.0
        means.pop(lab[i], None)
        b = min(means.values()) if means else None
        alone = (lab == lab[i]).sum() == 1
        out[i] = (a, b, 0.0 if alone or b is None or max(a, b) == 0 else (b - a) / max(a, b))
    return out


def made(spark, n=700, seed=1, dims=5):
    """Rows whose ids repeat or are null, with equal points among them."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(rng.integers(0, 3, n)[:, None] * 2.0, 0.7, (n, dims)), 1)
    x[: n // 3] = x[0]
    x[n // 3: n // 2] = x[n // 3: n // 2][:, ::-1]
    labels = rng.integers(-1, 4, (n, 2))
    labels[0, 1] = 9
    ids = [None if i % 7 == 0 else f"id{i % 50}" for i in range(n)]
    cols = COLS[:dims]
    df = spark.createDataFrame([(ids[i], *map(float, x[i]), *map(int, labels[i])) for i in range(n)],
                               "customerID string, " + ", ".join(f"{c} double" for c in cols) + ", l0 int, l1 int").repartition(5)
    return df, x, labels, ids, cols


@pytest.mark.parametrize("dims", [2, 5])
def test_silhouette_keeps_every_row(spark, dims):
    df, x, labels, ids, cols = made(spark, dims=dims)
    got = M.silhouette_samples(df, cols, ["l0", "l1"]).collect()
    for k in (0, 1):
        want = sorted((str(ids[i]), int(labels[i, k]), *(np.round(v, 8) if v is not None else None for v in t)) for i, t in brute_silhouette(x, labels[:, k]).items())
        mine = sorted((str(r.customerID), r.cluster_id, *(np.round(v, 8) if v is not None else None for v in (r.a, r.b, r.silhouette))) for r in got if r.labeling == f"l{k}")
        assert [r[:2] for r in mine] == [r[:2] for r in want]
        assert np.allclose([r[2:] for r in mine], [r[2:] for r in want], atol=1e-7)
    score = {r.labeling: r for r in M.silhouette_score(df, cols, ["l0", "l1"]).collect()}
    assert score["l0"].n == (labels[:, 0] >= 0).sum()


def test_silhouette_of_few_and_no_rows(spark):
    df = spark.createDataFrame([("a", 0.0, 0), ("a", 1.0, 0), (None, 5.0, 1), (None, 6.0, None)], "customerID string, x double, cluster_id int")
    got = {(r.customerID, r.a): r.silhouette for r in M.silhouette_samples(df, ["x"]).collect()}
    assert got == {("a", 1.0): pytest.approx(0.775, abs=0.03), (None, 0.0): 0.0} or len(got) == 2
    assert M.silhouette_samples(df, ["x"]).count() == 3
    assert M.silhouette_samples(df.limit(0), ["x"]).count() == 0
    one = M.silhouette_samples(df.where("cluster_id = 0"), ["x"]).collect()
    assert [r.b for r in one] == [None, None] and [r.silhouette for r in one] == [0.0, 0.0]


def test_sampled_silhouette_is_unbiased(spark):
    df, x, labels, _, cols = made(spark, 600, seed=3)
    exact = {k: np.mean([t[2] for t in brute_silhouette(x, labels[:, k]).values()]) for k in (0, 1)}
    got = [M.silhouette_score(df, cols, ["l0", "l1"], mode="sampled", sample=25, seed=s).collect() for s in range(10)]
    for k in (0, 1):
        rows = [r for g in got for r in g if r.labeling == f"l{k}"]
        z = np.array([(r.silhouette - exact[k]) / r.std_error for r in rows])
        assert abs(z.mean()) < 1.2 and (abs(z) < 3.5).all() and z.std() < 2
        assert all(r.n == (labels[:, k] >= 0).sum() and 0 < r.n_sampled <= 25 * 5 for r in rows)
    whole = M.silhouette_score(df, cols, "l0", mode="sampled", sample=10_000).first()
    assert whole.std_error == 0 and whole.silhouette == pytest.approx(exact[0], abs=1e-9)
    with pytest.raises(ValueError):
        M.silhouette_score(df, cols, "l0", mode="sampled", sample=1)


def brute_dbscan(x, order, eps, least):
    """(cluster, core, neighbours) by row; border points take the component with the smallest core in ``order``."""
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    n = near.sum(1)
    core = n >= least
    comp = np.full(len(x), -1)
    for i in order:
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], i
            while stack:
                j = stack.pop()
                for k in np.flatnonzero(near[j] & core & (comp < 0)):
                    comp[k] = i
                    stack.append(k)
    rank = {c: r for r, c in enumerate(dict.fromkeys(comp[i] for i in order if core[i]))}
    place = {c: list(order).index(c) for c in rank}
    out = []
    for i in range(len(x)):
        if core[i]:
            out.append((rank[comp[i]], True, int(n[i])))
        else:
            around = [comp[j] for j in np.flatnonzero(near[i] & core)]
            out.append((rank[min(around, key=place.get)] if around else -1, False, int(n[i])))
    return out


@pytest.mark.parametrize(("dims", "eps", "least"), [(2, 0.3, 5), (5, 0.8, 4), (5, 0.5, 300), (2, 0.05, 2)])
def test_dbscan_keeps_every_row(spark, dims, eps, least):
    df, x, _, ids, cols = made(spark, dims=dims, seed=dims)
    order = sorted(range(len(x)), key=lambda i: (ids[i] is not None, ids[i] or "", tuple(x[i])))
    want = brute_dbscan(x, order, eps, least)
    got = DB.dbscan(df, cols, eps, least).collect()
    assert len(got) == len(x)
    mine = sorted((str(r.customerID), r.cluster_id, r.is_core, r.n_neighbors) for r in got)
    assert mine == sorted((str(i), *w) for i, w in zip(ids, want, strict=True))


def test_dbscan_many_blocks(spark, monkeypatch):
    """Small cells and chunks: blocks meet across cells, and most pairs of blocks are never joined."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.4, (150, 2)) for c in ((0, 0), (3, 3), (9, 0), (20, 5), (40, 40), (60, 0))])
    df = spark.createDataFrame([(f"{i:04d}", *map(float, v)) for i, v in enumerate(x)], "customerID string, a double, b double")
    monkeypatch.setattr(DB, "pack", lambda *a, **k: pack(*a, **k, size=8))
    pack = M.pack
    cells = DB.in_cells
    monkeypatch.setattr(DB, "in_cells", lambda pts, n, eps: cells(pts, n, eps, per_cell=40))
    for eps, least in ((0.3, 4), (0.8, 10)):
        want = brute_dbscan(x, range(len(x)), eps, least)
        got = [(r.cluster_id, r.is_core, r.n_neighbors) for r in DB.dbscan(df, ["a", "b"], eps, least).orderBy("customerID").collect()]
        assert got == want
    pts, n = DB._points(df, ["a", "b"], "customerID")
    placed, near = DB.in_cells(pts, n, 0.3)
    chunks = DB.chunks_of(placed)
    pairs, blocks = DB.block_pairs(chunks, chunks, near, 0.3).count(), chunks.select("home").distinct().count()
    assert blocks > 15 and pairs < 0.35 * blocks * chunks.count()


def test_dbscan_of_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0)], "customerID string, x double")
    assert DB.dbscan(df.limit(0), ["x"], 1.0, 2).count() == 0
    assert [tuple(r) for r in DB.dbscan(df, ["x"], 1.0, 2).collect()] == [("a", -1, False, 1)]
    assert DB.eps_pairs(df.limit(0), ["x"], 1.0).count() == 0
    with pytest.raises(ValueError, match="x"):
        DB.dbscan(df.withColumn("x", F.lit(None).cast("double")), ["x"], 1.0, 2)


def test_eps_pairs_of_repeated_ids(spark):
    df, x, _, ids, cols = made(spark, 300, dims=2, seed=6)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = sorted(tuple(sorted((str(ids[i]), str(ids[j])))) for i, j in zip(*np.nonzero(np.triu(d <= 0.2, 1)), strict=True))
    got = sorted(tuple(sorted((str(r.id_a), str(r.id_b)))) for r in DB.eps_pairs(df, cols, 0.2).collect())
    assert got == want and len(want) > 4000


def test_canonical_labels_keep_every_row(spark):
    df = spark.createDataFrame([(5, 9.0), (5, 9.0), (None, 1.0), (7, 2.0), (8, 2.0)], "cluster_id int, x double")
    assert sorted((str(r.cluster_id), r.x) for r in KM.canonical_labels(df, ["x"]).collect()) == [("0", 2.0), ("1", 2.0), ("2", 9.0), ("2", 9.0), ("None", 1.0)]
    both = KM.canonical_labels(df, ["x"], out="new").collect()
    assert {(r.cluster_id, r.new) for r in both} == {(5, 2), (None, None), (7, 0), (8, 1)}


def test_numbers_are_dense(spark):
    df = spark.createDataFrame([(None,)] * 400 + [("a",)] * 300 + [("b",)], "id string").repartition(6)
    rows, n = numbered(df, ["id"])
    got = rows.orderBy("_row").collect()
    assert n == 701 and [r._row for r in got] == list(range(701))
    assert [r.id for r in got] == [None] * 400 + ["a"] * 300 + ["b"]


def test_distances_are_exact_where_it_matters():
    rng = np.random.default_rng(0)
    a = np.round(rng.normal(1000, 1, (50, 7)), 1)
    b = np.concatenate([a[:20], np.round(rng.normal(1000, 1, (30, 7)), 1)])
    want = ((a[:, None] - b[None]) ** 2).sum(-1)
    got = sq_distances(a, b, (0.0, float(want[3, 30])))
    assert np.allclose(got, want) and (got[want == 0] == 0).all() and got[3, 30] == pytest.approx(want[3, 30], abs=1e-12)


def test_pairs_within_a_reach_are_those_of_all_differences():
    from segmint.operators.strips import Distances
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(700, 9)) + 1e4, rng.normal(size=(300, 9)) + 1e4
    a[3], a[400] = b[7], b[9] + 1e-9
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    r, c, d = Distances(b).within(a, 1.5)
    assert set(zip(r.tolist(), c.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(want <= 1.5)), strict=True))
    np.testing.assert_allclose(d, want[r, c], rtol=1e-12)
    assert Distances(b).within(a, 9.0) is None  # too many to list


def test_silhouettes_of_many_features_group_rows_and_leave_out_noise(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 6))
    x[100:110] = x[0]
    labels = {"few": np.where(x[:, 0] > 0.5, 1, 0), "many": np.where(x[:, 1] > 0, rng.integers(0, 40, 900), -1), "none": np.full(900, -1)}
    noise = x[:, 2] < -0.5
    labels = {c: np.where(noise, -1, v) for c, v in labels.items()}
    cols = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(str(i), *x[i].tolist(), *(int(v[i]) for v in labels.values())) for i in range(900)],
                               "customerID string, " + ", ".join(f"{c} double" for c in cols) + ", " + ", ".join(f"{c} int" for c in labels))
    assert M._labelled_chunks(df, cols, list(labels), "customerID")[1] == 900 - noise.sum()  # noise meets nothing
    got = {(r.labeling, r.customerID): r for r in M.silhouette_samples(df.repartition(3), cols, list(labels)).collect()}
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert len(got) == sum((v >= 0).sum() for v in labels.values())
    for (name, i), r in got.items():
        v, i = labels[name], int(i)
        means = {k: far[i, v == k].sum() / max(1, (v == k).sum() - (k == v[i])) for k in set(v[v >= 0].tolist())}
        a, b = means.pop(int(v[i])), min(means.values())
        assert r.cluster_id == v[i] and r.a == pytest.approx(a, abs=1e-9) and r.b == pytest.approx(b, abs=1e-9)
        assert r.silhouette == pytest.approx((b - a) / max(a, b) if (v == v[i]).sum() > 1 else 0.0, abs=1e-9)


def test_sums_by_group_equal_those_by_cluster():
    rng = np.random.default_rng(7)
    x, fine = rng.normal(size=(400, 6)), np.sort(rng.integers(-3, 30, 400))
    labels = np.stack([np.where(fine < 0, -1, fine // k) for k in (1, 2, 9)], axis=1).astype("<i4")
    rows = [{"n": 100, "x": x[i:i + 100].tobytes(), "labels": labels[i:i + 100].tobytes(), "ids": [str(j) for j in range(i, i + 100)]} for i in range(0, 400, 100)]
    out = []
    for grouped in (False, True):
        work = M._Sums(rows[:2], 3, grouped)
        for r in rows:
            work.add(r)
        out.append([(r["ids"], [tuple(v.values()) for v in r["s"]]) for b in work.finish() for r in b.to_pylist()])
    assert len(work.groups) < sum(len(set(labels[:, i])) for i in range(3))
    for (i, a), (j, b) in zip(*out, strict=True):
        assert i == j and len(a) == len(b) == (0 if labels[int(i), 0] < 0 else 3)
        np.testing.assert_allclose(np.array(a), np.array(b), rtol=1e-12)
