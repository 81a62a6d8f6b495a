"""Sparse encoding and projection against dense numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators.sparse import fit_vocabulary, sparse_pca, sparse_rows


def test_rows_equal_dense_dummies(spark):
    rows = [("a", 1.5, "x", "p"), ("a", 0.0, "y", None), (None, None, "z", "q"), ("b", -2.0, None, "p"), ("b", -2.0, None, "p"), ("c", 3.0, "x", "new")]
    df = spark.createDataFrame(rows, "customerID string, n double, s string, t string")
    vocab, size = fit_vocabulary(df.where("customerID is null or customerID <> 'c'"), ["t", "s"])
    assert [(r.column, r.value, r["index"]) for r in vocab.orderBy("index").collect()] == [("t", "q", 0), ("s", "y", 1), ("s", "z", 2)] and size == 3
    got = sorted((str(r.customerID), r.indices, [str(v) for v in r["values"]]) for r in sparse_rows(df, ["n"], ["s", "t"], vocab).collect())
    assert got == [("None", [0, 1, 3], ["nan", "1.0", "1.0"]), ("a", [0], ["1.5"]), ("a", [2], ["1.0"]), ("b", [0], ["-2.0"]), ("b", [0], ["-2.0"]), ("c", [0], ["3.0"])]
    whole, n = fit_vocabulary(df, ["s"], drop_first=False)
    assert n == 3 and sparse_rows(df, [], ["s"], whole).where("size(indices) = 0").count() == 2
    assert fit_vocabulary(df.limit(0), ["s"])[1] == 0


def test_projection_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 30)) @ np.diag(np.linspace(3, 0.2, 30)) * (rng.random((200, 30)) < 0.5)
    df = spark.createDataFrame([(str(i % 50), np.flatnonzero(v).tolist(), v[v != 0].tolist()) for i, v in enumerate(x)], "customerID string, indices array<int>, values array<double>")
    out, load, ratio = sparse_pca(df.repartition(4), 30, 2)
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    sign = np.sign(vt[[0, 1], np.abs(vt[:2]).argmax(1)])
    assert np.allclose(load, (vt[:2] * sign[:, None]).T, atol=1e-6) and np.allclose(ratio, (s ** 2 / (s ** 2).sum())[:2])
    got = np.array(sorted((r.pc_1, r.pc_2) for r in out.collect()))
    assert np.allclose(got, sorted(map(tuple, u[:, :2] * s[:2] * sign)), atol=1e-6)
    with pytest.raises(ValueError):
        sparse_pca(df.limit(0), 30)


def test_a_hundred_thousand_features(spark):
    d, n = 100_000, 3000
    df = spark.range(n).selectExpr("cast(id as string) customerID", f"sort_array(array_distinct(array(0, cast(1 + id % 7 as int), cast(10 + pmod(hash(id), {d - 10}) as int)))) indices",
                                   "array(cast(id % 2 * 10 as double), 3D, 1D) values")
    out, load, ratio = sparse_pca(df, d, 1, max_iter=4)
    assert load.shape == (d, 1) and abs(load[0, 0]) > 0.99 and 0.5 < ratio[0] < 1 and out.count() == n


def test_rows_are_never_broadcast(spark):
    df = spark.createDataFrame([(str(i), f"v{i % 3}") for i in range(50)], "customerID string, c string")
    vocab, _ = fit_vocabulary(df, ["c"])
    out = sparse_rows(df, [], ["c"], vocab).select("customerID", F.explode("indices").alias("feature"))
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "_row" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    assert out.count() == 33


def test_the_vocabulary_is_broadcast_or_merged_but_not_the_rows(spark, monkeypatch):
    from segmint.operators import sparse
    words = spark.range(5000).selectExpr("'c' customerID", "concat('v', id) c")
    vocab, n = fit_vocabulary(words, ["c"], drop_first=False)
    few = words.limit(7)  # a smaller file than the vocabulary's
    for most, kind in ((n, "BroadcastHashJoin"), (n - 1, "SortMergeJoin")):
        monkeypatch.setattr(sparse, "_SMALL", most, raising=False)
        out = sparse_rows(few, [], ["c"], vocab)
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        joins = [line for line in plan if "Join" in line and "value#" in line]
        assert joins and all(kind in line and "BuildLeft" not in line for line in joins)
        assert out.selectExpr("sum(size(indices))").first()[0] == 7
