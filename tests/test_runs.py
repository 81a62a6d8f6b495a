"""Long runs and saved state: resume, model versions, streams, ML persistence, fused fits, quantiles, splits."""
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from segmint.operators import eda as E
from segmint.operators import features as FT
from segmint.operators import kmeans as KM
from segmint.operators import protocol as PT
from segmint.operators import scorer as S
from segmint.operators import split as SP
from segmint.operators.quantiles import quantile_values
from segmint.operators.stages import Stages, fingerprint
from segmint.plans import q_score
from segmint.plans.q_features import fitted_model
from segmint.sources import fixtures as fx
from segmint.streaming import stream as ST


def test_quantiles_by_brackets(spark):
    """Small bounds, so that brackets are sketched again and again."""
    rng = np.random.default_rng(0)
    many = np.concatenate([np.round(rng.normal(0, 1, 3000), 3), np.full(1500, 0.25), [np.inf, -np.inf, 7.0, 7.0]])
    few = rng.integers(0, 3, len(many)).astype(float)
    rows = [(float(a), float(b), None if i % 3 else float(a)) for i, (a, b) in enumerate(zip(many, few, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    qs = [0.01, 0.25, 0.5, 0.5001, 0.75, 0.99]
    got, row = quantile_values(df, {"a": F.col("a"), "b": F.col("b"), "c": F.col("c"), "none": F.lit(None).cast("double")}, qs,
                               also=[F.count(F.lit(1)).alias("n")], limit=20, accuracy=100)
    assert row["n"] == len(many) and got["none"] == [None] * 6
    for name, x in (("a", many), ("b", few), ("c", many[::3])):
        assert np.allclose(got[name], np.quantile(x, qs, method="linear"), atol=1e-12), name
    assert np.allclose(quantile_values(df, {"a": F.col("a")}, qs)[0]["a"], got["a"])


def test_fused_fits_equal_plain_lloyd(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.5, (60, 6)) for c in (0, 3, 6)])
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], [f"c{i}" for i in range(6)]).repartition(5)
    points = df.select(F.array(*df.columns).alias("_x"))
    starts = [x[[0, 1, 2]], x[[5, 70, 130]], np.vstack([x[[0, 60]], np.full((1, 6), 99.0)])]
    for got, c in zip(KM.lloyd(points, starts, max_iter=50, tol=0.0), starts, strict=True):
        steps = 0
        while True:
            at = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            new = np.array([x[at == k].mean(0) if (at == k).any() else c[k] for k in range(len(c))])
            steps, same, c = steps + 1, np.allclose(new, c, atol=1e-12), new
            if same:
                break
        assert np.allclose(got.centers, c) and abs(got.n_iter - steps) <= 1
        assert got.inertia == pytest.approx(((x[:, None] - c[None]) ** 2).sum(-1).min(1).sum())
    best = KM.fit_many(df, df.columns, [3, 2], n_init=3)
    again = KM.fit_many(df.repartition(2).orderBy(F.desc("c1")), df.columns, [3, 2], n_init=3)
    assert best[3].inertia < best[2].inertia and best[3].inertia < 6 * 0.3 * len(x)
    assert all(np.allclose(best[k].centers, again[k].centers) for k in (2, 3))
    few = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], ["x"])
    assert KM.fit_many(few, ["x"], [3], n_init=2)[3].inertia == 0
    with pytest.raises(ValueError):
        KM.fit_many(few.limit(0), ["x"], [2])


def test_repeated_ids_split_exactly(spark):
    rows = [(f"id{i % 20}" if i % 5 else None, "Yes" if i % 4 == 0 else "No") for i in range(100)]
    out = SP.split_stratified(spark.createDataFrame(rows, "customerID string, Churn string").repartition(3))
    n = {(r.Churn, r.split): r["count"] for r in out.groupBy("Churn", "split").count().collect()}
    assert n == {("Yes", "train"): 15, ("Yes", "validation"): 5, ("Yes", "test"): 5, ("No", "train"): 45, ("No", "validation"): 15, ("No", "test"): 15}
    assert out.columns == ["customerID", "Churn", "split"]


def test_feature_stage_saves_and_loads_in_a_pipeline(spark, tmp_path):
    train = fx.subscribers(spark, SF_SMALL)
    stage = FT.SegmentFeatures(quantile=0.5)
    names = fitted_model(spark, SF_SMALL).feature_names
    pipe = Pipeline(stages=[stage, VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")])
    pipe.write().overwrite().save(str(tmp_path / "pipe"))
    again = Pipeline.load(str(tmp_path / "pipe"))
    assert again.getStages()[0].uid == stage.uid and again.getStages()[0].getOrDefault("quantile") == 0.5
    model = again.fit(train)
    model.write().overwrite().save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    assert back.stages[0].state == pipe.fit(train).stages[0].state
    assert back.transform(train).select("customerID", "features").exceptAll(model.transform(train).select("customerID", "features")).isEmpty()
    with pytest.raises(ValueError, match="holds"):
        FT.SegmentFeatures.load(str(next((tmp_path / "model" / "stages").glob("0_*"))))
    with pytest.raises(ValueError, match="InternetService"):
        FT.SegmentFeatures(max_categories=2).fit(train)


def test_crosstab_has_every_pair(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", None), (None, "z")], "r string, c string")
    assert sorted(tuple(r) for r in E.crosstab_row_pct(df, "r", "c").collect()) == [("a", "x", 2, 100.0), ("a", "y", 0, 0.0), ("b", "x", 0, 0.0), ("b", "y", 1, 100.0)]


def test_stages_go_on_where_they_stopped(spark, tmp_path):
    made = []

    def table(n):
        made.append(n)
        return spark.range(n)

    for digest in ("one", "one", "two"):
        st = Stages(spark, str(tmp_path / "run"), digest)
        assert st.table("a", lambda: table(3)).count() == 3 and st.value("v", lambda: made.append("v") or {"x": 1}) == {"x": 1}
    assert made == [3, "v", 3, "v"]
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert fingerprint(df, k=1) == fingerprint(df.orderBy(F.desc("i")), k=1) != fingerprint(df, k=2)
    assert fingerprint(df) != fingerprint(df.limit(1))


def test_pipeline_resumes_with_the_same_result(spark, tmp_path, monkeypatch):
    customers = fx.subscribers(spark, SF_SMALL)
    args = {"k": 3}
    folder = str(tmp_path / "stages")
    with monkeypatch.context() as m:
        m.setattr(PT.ST, "anova_f", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            PT.run_pipeline(spark, customers, folder=folder, **args)
    with monkeypatch.context() as m:  # nothing that was done is done again
        for module, name in ((PT.SP, "split_stratified"), (PT.FT, "transform_splits"), (PT.KM, "fit_many"), (PT.P, "cluster_profiles")):
            m.setattr(module, name, lambda *a, **k: (_ for _ in ()).throw(AssertionError("done before")))
        out = PT.run_pipeline(spark, customers, out=str(tmp_path / "out"), folder=folder, **args)
    straight = PT.run_pipeline(spark, customers, **args)
    for a, b in ((out.profiling.profiles, straight.profiling.profiles), (out.profiling.actions, straight.profiling.actions), (out.target_rates, straight.target_rates)):
        assert a.drop("descriptors").toPandas().sort_values("cluster_id").round(6).equals(b.drop("descriptors").toPandas().sort_values("cluster_id").round(6))
    scorer = S.load_scorer(spark, str(tmp_path / "out" / "model"))
    test = out.protocol.labelled_test.select("customerID", "cluster_id")
    scored = scorer.score(customers.join(test.select("customerID"), "customerID", "left_semi")).select("customerID", "cluster_id")
    assert scored.exceptAll(test).isEmpty() and scored.count() == test.count()


def test_stream_restarts_and_takes_new_versions(spark, tmp_path):
    customers = fx.subscribers(spark, SF_SMALL)
    model, named_actions = fitted_model(spark, SF_SMALL), q_score._tables(spark, SF_SMALL)
    centers = q_score.given_centers(spark, SF_SMALL)
    folder, out, chk, src = (str(tmp_path / n) for n in ("models", "out", "chk", "in"))
    assert S.latest_version(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        S.load_scorer(spark, folder)
    assert S.publish(folder, model, centers, *named_actions) == 1
    parts = customers.randomSplit([0.5, 0.5], seed=1)
    run = lambda: ST.score_stream(spark.readStream.schema(customers.schema).parquet(src), folder, out, chk)
    parts[0].write.mode("append").parquet(src)
    first = run()
    assert {r.model_version for r in first.collect()} == {1}
    assert S.publish(folder, model, centers[::-1], *named_actions) == 2
    parts[1].write.mode("append").parquet(src)
    both = run()
    assert both.count() == customers.count() and both.select("customerID").distinct().count() == customers.count()
    assert {r.model_version: r["count"] for r in both.groupBy("model_version").count().collect()} == {1: parts[0].count(), 2: parts[1].count()}
    assert run().count() == customers.count()  # nothing new: nothing repeated
    batch = S.load_scorer(spark, folder, 2).score(parts[1])
    assert both.where("model_version = 2").exceptAll(batch.select(*both.columns)).isEmpty()
    # a batch that ran but was not recorded runs again and replaces its rows
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch=*"))
    for kind in ("commits",):
        for name in (f"{last}", f".{last}.crc"):
            (tmp_path / "chk" / kind / name).unlink(missing_ok=True)
    assert run().count() == customers.count()
