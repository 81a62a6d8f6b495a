"""Inputs that are made once: an accumulator counts the rows that a step asks for."""

import numpy as np
from pyspark.sql import functions as F

from segmint.operators import fields
from segmint.operators import kmeans as KM
from segmint.operators import metrics as M
from segmint.operators import profile as P
from segmint.operators import split as SP


def counted(spark, df):
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), made


def test_plot_data_makes_the_silhouettes_once(spark):
    rows = [(f"{i:03d}" if i % 7 else None, i % 3, ((i * 37) % 100) / 100) for i in range(300)]
    df, made = counted(spark, spark.createDataFrame(rows, "customerID string, cluster_id int, silhouette double"))
    got = P.silhouette_plot_data(df).collect()
    assert made.value == 300
    assert [sorted(r.rank_in_cluster for r in got if r.cluster_id == c) for c in range(3)] == [list(range(100))] * 3


def test_split_makes_its_rows_once(spark):
    df, made = counted(spark, spark.createDataFrame([(f"{i:03d}", "Yes" if i % 4 == 0 else None) for i in range(200)], "customerID string, Churn string"))
    got = SP.split_stratified(df).collect()
    assert made.value == 200
    assert sorted((r.split, r["count"]) for r in spark.createDataFrame(got).groupBy("split").count().collect()) == [("test", 40), ("train", 120), ("validation", 40)]


def test_starts_share_the_vectors(spark):
    rng = np.random.default_rng(2)
    df, made = counted(spark, spark.createDataFrame([(float(v), float(v)) for v in rng.normal(size=150)], "a double, b double"))
    model, cost, _ = KM.kmeans_fit(KM.as_vectors(df, ["a", "b"]), 2, n_init=3)
    assert made.value <= 300  # the check and the one table
    assert cost > 0 and len(model.clusterCenters()) == 2


def test_a_mean_silhouette_carries_no_ids(spark, monkeypatch):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([("x" * 40, *map(float, p), int(i % 2)) for i, p in enumerate(rng.normal(size=(900, 2)))], "customerID string, a double, b double, cluster_id int")
    seen, keep = [], fields.materialize
    monkeypatch.setattr(fields, "materialize", lambda t, name: seen.append(keep(t, name)) or seen[-1])
    got = M.silhouette_score(df, ["a", "b"], leaf=32).first()
    points = seen[0]
    assert "rows" not in points.columns and points.select(F.explode("ids").alias("i")).where("i IS NOT NULL").isEmpty()
    want = M.silhouette_samples(df, ["a", "b"], leaf=32).agg(F.avg("silhouette"), F.count(F.lit(1))).first()
    assert got.n == want[1] == 900 and abs(got.silhouette - want[0]) < 1e-12


def test_inertias_of_many_labelings_share_two_passes(spark):
    rng = np.random.default_rng(9)
    rows = [(*map(float, p), int(i % 3), None if i % 7 == 0 else int(i % 5), 4) for i, p in enumerate(rng.normal(size=(200, 2)))]
    df, made = counted(spark, spark.createDataFrame(rows, "a double, b double, l0 int, l1 int, l2 int"))
    got = {r.labeling: r.inertia for r in M.inertia(df, ["a", "b"], ["l0", "l1", "l2"]).collect()}
    assert made.value <= 400
    for name in ("l0", "l1", "l2"):
        assert abs(got[name] - M.inertia(df, ["a", "b"], name).first().inertia) < 1e-9
