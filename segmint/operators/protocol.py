"""Compositions: model selection, the training protocol, profiling, and the
whole pipeline from raw records to saved tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.operators import dbscan as DB
from segmint.operators import features as FT
from segmint.operators import hierarchy as H
from segmint.operators import kmeans as KM
from segmint.operators import metrics as M
from segmint.operators import profile as P
from segmint.operators import split as SP
from segmint.operators import stats as ST
from segmint.operators.stages import Stages, fingerprint
from segmint.spec import DEFAULT_SPEC, SegmentSpec


class Selection(NamedTuple):
    kmeans: DataFrame
    agglomerative: DataFrame
    dbscan: DataFrame
    comparison: DataFrame
    choice: DataFrame


def run_selection(df: DataFrame, cols: list[str], k_range=range(2, 11), linkages=H.LINKAGES, eps_list=(0.3, 0.5, 0.7, 1.0),
                  min_samples_list=(3, 5, 7, 10), id_col: str = "customerID", n_init: int = 10, stages: Stages | None = None) -> Selection:
    """All configurations of the three algorithms, their comparison, and the
    choice by the business rules (always K-Means)."""
    st = stages or Stages(df.sparkSession)
    points = st.table("selection-points", lambda: df.select(id_col, *[f"`{c}`" for c in cols]))
    sweep = st.table("selection-kmeans", lambda: KM.kmeans_sweep(points, cols, k_range, id_col, n_init=n_init))
    trees = st.table("selection-trees", lambda: H.agglomerative_sweep(points, cols, linkages, k_range, id_col))
    grid = st.table("selection-dbscan", lambda: DB.dbscan_grid(points, cols, eps_list, min_samples_list, id_col))
    return Selection(sweep, trees, grid, KM.algorithm_comparison(sweep, trees, grid), KM.select_k_business_rules(sweep))


class Protocol(NamedTuple):
    features: FT.SegmentFeaturesModel
    centers: list[list[float]]
    internal: DataFrame
    labelled_test: DataFrame
    labelled_train_val: DataFrame


def train_protocol(splits: DataFrame, k: int, spec: SegmentSpec = DEFAULT_SPEC, split_col: str = "split", n_init: int = 10,
                   seed: int = 42, stages: Stages | None = None) -> Protocol:
    """Fits on train and scores validation, then refits on train and
    validation and scores test. Feature state is of the training rows in both.
    ``internal`` has a row for each stage: silhouette, Davies-Bouldin,
    Calinski-Harabasz, inertia and iterations of its fit."""
    st = stages or Stages(splits.sparkSession)
    fit = lambda: FT.SegmentFeatures(spec, ignore=(split_col, "cluster_id")).fit(splits.where(F.col(split_col) == "train")).state
    model = FT.SegmentFeaturesModel(st.value("protocol-state", fit), spec)
    feats = st.table("protocol-features", lambda: FT.transform_splits(model, splits, split_col))
    names, rows = model.feature_names, None
    for stage, fit_on, score_on in (("validation", ("train",), "validation"), ("test", ("train", "validation"), "test")):
        def fitted():
            best = KM.fit_many(feats.where(F.col(split_col).isin(*fit_on)), names, [k], n_init, seed)[k]
            return [KM.canonical_centers(best.centers), best.inertia, best.n_iter]

        def scored_rows():
            return KM.kmeans_assign(feats.where(F.col(split_col) == score_on), names, centers)

        centers, cost, iters = st.value(f"protocol-fit-{stage}", fitted)
        scored = st.table(f"protocol-scored-{stage}", scored_rows)
        row = M.internal_metrics(scored, names, "cluster_id", spec.id).select(
            F.lit(stage).alias("stage"), "*", F.lit(float(cost)).alias("inertia"), F.lit(int(iters)).alias("n_iter"))
        rows = row if rows is None else rows.unionByName(row)
    both = KM.kmeans_assign(feats.where(F.col(split_col).isin("train", "validation")), names, centers)
    return Protocol(model, centers, st.table("protocol-internal", lambda: rows), scored, both)


class Profiling(NamedTuple):
    profiles: DataFrame
    actions: DataFrame
    anova: DataFrame
    importance: DataFrame


def run_profiling(labelled: DataFrame, features: DataFrame | None = None, feature_names: list[str] | None = None,
                  cluster_col: str = "cluster_id", spec: SegmentSpec = DEFAULT_SPEC, stages: Stages | None = None) -> Profiling:
    """Named profiles and actions of labelled raw records, and the ANOVA of
    the numerical columns, or of all fitted features where they are given."""
    st = stages or Stages(labelled.sparkSession)
    named = st.table("profiles", lambda: P.assign_names(P.cluster_profiles(labelled, cluster_col, spec)))
    on = labelled if features is None else features
    anova = st.table("anova", lambda: ST.anova_f(on, list(feature_names or [*spec.raw_numerical, "SeniorCitizen"]), cluster_col))
    return Profiling(named, st.table("actions", lambda: P.business_actions(named)), anova, ST.feature_importance(anova))


class Result(NamedTuple):
    selection: Selection | None
    protocol: Protocol
    profiling: Profiling
    target_rates: DataFrame
    association: DataFrame


def run_pipeline(spark: SparkSession, customers: DataFrame, out: str | None = None, k: int | None = None,
                 spec: SegmentSpec = DEFAULT_SPEC, folder: str | None = None, **selection) -> Result:
    """Raw records to segments: split, features, selection (unless ``k`` is
    given), training protocol, validation against the target, profiles and
    actions; result tables go to ``out``, and a version of the scoring model to
    ``out``/model.

    With ``folder`` (shared) every stage is kept there: a run that was stopped
    goes on after the last whole stage, with the same result; other input or
    parameters start anew."""
    from segmint.operators.scorer import publish
    from segmint.sources.customers import save_actions, save_profiles, save_table
    st = Stages(spark, folder, fingerprint(customers, k=k, spec=spec, selection=selection) if folder else "")
    splits = st.table("pipeline-splits", lambda: SP.split_stratified(customers, spec.target, spec.id))
    chosen = None
    if k is None:
        train = splits.where("split = 'train'")
        model = FT.SegmentFeaturesModel(st.value("selection-state", lambda: FT.SegmentFeatures(spec).fit(train).state), spec)
        val = model.transform(splits.where("split = 'validation'"))
        chosen = run_selection(val, model.feature_names, id_col=spec.id, stages=st, **selection)
        k = int(st.value("selection-k", lambda: int(chosen.choice.first()["final_k"])))
    protocol = train_protocol(splits, k, spec, stages=st)

    # labels go back to the records by id: repeated ids get each record once for each of their segments
    raw = st.table("pipeline-labelled", lambda: splits.join(protocol.labelled_train_val.select(spec.id, "cluster_id").distinct(), spec.id))
    prof = run_profiling(raw, protocol.labelled_train_val, protocol.features.feature_names, spec=spec, stages=st)
    test = st.table("pipeline-test", lambda: SP.binarize_target(splits.where("split = 'test'"), spec.target).join(
        protocol.labelled_test.select(spec.id, "cluster_id").distinct(), spec.id))
    if out:
        save_profiles(prof.profiles, f"{out}/profiles")
        save_actions(prof.actions, f"{out}/actions")
        save_table(prof.anova, f"{out}/anova", "csv")
        publish(f"{out}/model", protocol.features, protocol.centers, prof.profiles, prof.actions)
    return Result(chosen, protocol, prof, ST.target_rate_by_cluster(test), ST.chi_square(test, "cluster_id", spec.target))
