"""K-Means fitting, sweeps and model selection.

``fit_many`` runs Lloyd's iterations of all K and all starts together: one pass
over packed points adds up the partial sums of every model, so a sweep costs as
many passes as its slowest model has iterations, and the same rows give the
same result. ``kmeans_fit`` is Spark ML's estimator (k-means|| start), for one
K as a pipeline stage. Everything after a fit works on the k x d centroid table
(bounded by K), so assignment is a column expression and never a join against
the data.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmint.operators import metrics as M
from segmint.operators.strips import pack, sq_distances
from segmint.session import materialize


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def check_features(df: DataFrame, cols: list[str]) -> None:
    """Raises with the columns and counts of null or NaN features."""
    bad = [F.sum(F.when(F.col(_q(c)).isNull() | F.isnan(F.col(_q(c)).cast("double")), 1).otherwise(0)).alias(c) for c in cols]
    row = df.agg(*bad).first()
    found = {c: row[i] for i, c in enumerate(cols) if row[i]}
    if found:
        raise ValueError(f"null or NaN features: {found}; set them apart with split_valid() or impute them")


def split_valid(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be clustered, rows with a null or NaN feature)."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(_q(c)).isNotNull() & ~F.isnan(F.col(_q(c)).cast("double"))
    return df.where(ok), df.where(~ok)


def as_vectors(df: DataFrame, cols: list[str], out: str = "features", keep=()) -> DataFrame:
    """One vector column. Rows with a null or NaN feature are an error, never
    left out."""
    check_features(df, cols)
    va = VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error")
    return va.transform(df.select(*[F.col(_q(c)) for c in keep], *[F.col(_q(c)) for c in cols])).select(
        *[F.col(_q(c)) for c in keep], out)


def kmeans_fit(vectors: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300,
               tol: float = 1e-4, features: str = "features") -> tuple[KMeansModel, float, int]:
    """Best of ``n_init`` runs by training cost: (model, inertia, iterations).
    The vectors are written once, so that no run makes them again."""
    vectors, best = materialize(vectors.select(features), "kmeans-vectors"), None
    for i in range(n_init):
        km = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tol, featuresCol=features,
                    predictionCol="_pred", initMode="k-means||")
        m = km.fit(vectors)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost, m.summary.numIter)
    return best


def canonical_centers(centers) -> list[list[float]]:
    """Centroids in lexicographic order: cluster ids independent of the
    random start."""
    return sorted([list(map(float, c)) for c in centers])


def kmeans_assign(df: DataFrame, cols: list[str], centers, out: str = "cluster_id") -> DataFrame:
    """Nearest centroid, ties to the lowest id (centroids as literals)."""
    return df.withColumn(out, M.assign_nearest(cols, centers))


def canonical_labels(df: DataFrame, cols: list[str], label: str = "cluster_id", out: str = "cluster_id") -> DataFrame:
    """Relabel clusters so ids follow the lexicographic order of their
    centroids, equal ones by the old label. Rows with a null label keep a null
    one, and no other row is dropped or repeated."""
    cents = M.centroids(df.where(F.col(_q(label)).isNotNull()), cols, label)
    order = [F.col(f"c_{i}") for i in range(len(cols))]
    ranked = cents.select(F.col("cluster_id").alias("_old"),  # one row per cluster
                          (F.row_number().over(Window.orderBy(*order, "cluster_id")) - 1).cast("int").alias("_new"))
    j = df.withColumn("_was", F.col(_q(label))).join(ranked, F.col("_was") == F.col("_old"), "left").drop("_old", "_was")
    return j.drop(out).withColumnRenamed("_new", out)


def start_centers(points: DataFrame, ks: list[int], n_init: int, seed: int = 42, sample: int = 1024) -> list[np.ndarray]:
    """k-means++ starts, ``n_init`` for each k, drawn from the ``sample`` rows
    with the smallest hash of their coordinates: the bound of what the driver
    sees. The same rows give the same starts in any order and partitioning.
    Fewer different points than k: the rest are repeated."""
    rows = points.select("_x").distinct().select("_x", F.xxhash64(F.lit(seed), "_x").alias("_h")).orderBy("_h", "_x").limit(sample).collect()
    x = np.array([r["_x"] for r in rows], float)
    out = []
    for k in ks:
        for i in range(n_init):
            rng = np.random.default_rng([seed, k, i])
            chosen = [int(rng.integers(len(x)))]
            d = ((x - x[chosen[0]]) ** 2).sum(axis=1)
            while len(chosen) < k:
                chosen.append(int(rng.choice(len(x), p=d / d.sum())) if d.sum() > 0 else chosen[-1])
                d = np.minimum(d, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
            out.append(x[chosen])
    return out


def _lloyd_pass(chunks: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(sums, counts, inertia) of every model's clusters, from one pass over the
    chunks: a task adds up all models, and the partial sums of a model meet in
    one row. Equal distances go to the first center."""
    flat = np.concatenate(models)
    edges = np.cumsum([0] + [len(m) for m in models])
    d = flat.shape[1]

    def run(batches):
        sums, counts, cost = np.zeros((len(flat), d)), np.zeros(len(flat)), np.zeros(len(edges) - 1)
        for b in batches:
            for n, raw in zip(b.column("n").to_pylist(), b.column("x").to_pylist(), strict=True):
                x = np.frombuffer(raw, "<f8").reshape(n, -1)
                g = sq_distances(x, flat)
                hot = np.zeros(g.shape)
                for m in range(len(edges) - 1):
                    at = g[:, edges[m]:edges[m + 1]].argmin(axis=1) + edges[m]
                    hot[np.arange(n), at] = 1.0
                    cost[m] += g[np.arange(n), at].sum()
                sums += hot.T @ x
                counts += hot.sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(edges) - 1), pa.int32()), pa.array([sums[i:j].tobytes() for i, j in zip(edges, edges[1:], strict=False)]),
            pa.array([counts[i:j].tobytes() for i, j in zip(edges, edges[1:], strict=False)]), pa.array(cost)], ["m", "sums", "counts", "cost"])

    def add(batches):
        total = {}
        for b in batches:
            for r in b.to_pylist():
                s, c = np.frombuffer(r["sums"]), np.frombuffer(r["counts"])
                old = total.get(r["m"])
                total[r["m"]] = (s, c, r["cost"]) if old is None else (old[0] + s, old[1] + c, old[2] + r["cost"])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v[0].tobytes() for v in total.values()]),
                                              pa.array([v[1].tobytes() for v in total.values()]), pa.array([v[2] for v in total.values()])],
                                             ["m", "sums", "counts", "cost"])

    schema = "m int, sums binary, counts binary, cost double"
    parts = min(len(models), int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = {r["m"]: r for r in chunks.select("n", "x").mapInArrow(run, schema).repartition(parts, "m").mapInArrow(add, schema).collect()}  # a row per model
    return [(np.frombuffer(rows[m]["sums"]).reshape(-1, d), np.frombuffer(rows[m]["counts"]), rows[m]["cost"]) for m in range(len(models))]


class Fit(NamedTuple):
    centers: np.ndarray
    inertia: float
    n_iter: int


def lloyd(points: DataFrame, starts: list[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """Lloyd's iterations from every given start, all models in one pass over
    the points at a time, so a sweep takes as many jobs as its slowest model
    has iterations. ``points`` has ``_x``. A model ends when its centers move
    by no more than ``tol`` times the mean variance (squared, all together), or
    after ``max_iter``; an empty cluster keeps its center."""
    d = len(starts[0][0])
    spread = points.agg(*[F.var_pop(F.col("_x")[i]) for i in range(d)]).first()
    limit = tol * float(np.mean([v or 0.0 for v in spread]))
    # equal points travel once, but sums must not depend on how rows are dealt: chunks are made of sorted rows
    rows = points.select("_x", F.lit(0).cast("long").alias("_row"))
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = materialize(pack(rows.repartitionByRange(parts, "_x").sortWithinPartitions("_x"), size=2048), "lloyd-points")
    models, iters = [np.array(s, float) for s in starts], [0] * len(starts)
    going = list(range(len(starts)))
    for _ in range(max_iter):
        if not going:
            break
        still = []
        for m, (sums, counts, _) in zip(going, _lloyd_pass(chunks, [models[m] for m in going]), strict=True):
            new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], models[m])
            moved = ((new - models[m]) ** 2).sum()
            models[m], iters[m] = new, iters[m] + 1
            if moved > limit:
                still.append(m)
        going = still
    return [Fit(c, float(cost), n) for c, n, (_, _, cost) in zip(models, iters, _lloyd_pass(chunks, models), strict=True)]


def fit_many(df: DataFrame, cols: list[str], ks: list[int], n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> dict[int, Fit]:
    """For each k the best of ``n_init`` fits by inertia (the first of equal
    ones). Rows with a null or NaN feature are an error, no rows too."""
    check_features(df, cols)
    points = materialize(df.select(F.array(*[F.col(_q(c)).cast("double") for c in cols]).alias("_x")), "kmeans-points")
    if points.isEmpty():
        raise ValueError("no rows to cluster")
    fits = lloyd(points, start_centers(points, list(ks), n_init, seed), max_iter, tol)
    return {k: min(fits[i * n_init:(i + 1) * n_init], key=lambda f: f.inertia) for i, k in enumerate(ks)}


def kmeans_sweep(df: DataFrame, cols: list[str], k_range=range(2, 11), id_col: str = "customerID", seed: int = 42,
                 n_init: int = 10, silhouette_mode: str = "exact", **sil_kw) -> DataFrame:
    """(k, silhouette, davies_bouldin, calinski_harabasz, inertia, n_iter)
    per K, fitted and scored on ``df``. All fits advance together, all K
    labelings are attached as columns and their silhouettes share ONE distance
    pass. The same rows give the same result in any order."""
    spark = df.sparkSession
    labelled = materialize(df.select(_q(id_col), *[F.col(_q(c)) for c in cols]), "sweep-points")
    best = fit_many(labelled, cols, list(k_range), n_init, seed)
    for k, f in best.items():
        labelled = labelled.withColumn(f"k_{k}", M.assign_nearest(cols, canonical_centers(f.centers)))
    labelled = materialize(labelled, "sweep-labels")  # every metric below starts from a plain scan
    names = [f"k_{k}" for k in best]
    sil = M.silhouette_score(labelled, cols, names, id_col, mode=silhouette_mode, **sil_kw)
    other = M.db_ch_multi(labelled, cols, names)
    rows = spark.createDataFrame([(k, f.inertia, f.n_iter) for k, f in best.items()], "k int, inertia double, n_iter int")
    kk = F.expr("cast(substring(labeling, 3) as int)").alias("k")
    return (rows.join(sil.select(kk, "silhouette"), "k").join(other.select(kk, "davies_bouldin", "calinski_harabasz"), "k")
            .select("k", "silhouette", "davies_bouldin", "calinski_harabasz", "inertia", "n_iter").orderBy("k"))


def elbow_curve(sweep: DataFrame) -> DataFrame:
    return sweep.select("k", "inertia").orderBy("k")


def argmax_first(df: DataFrame, score: str, order: str) -> DataFrame:
    """Row with the highest score; ties go to the first by ``order``. Null and
    NaN scores never win."""
    w = Window.orderBy(F.desc(score), F.col(order))
    return df.where(F.col(score).isNotNull() & ~F.isnan(score)).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def select_k_business_rules(sweep: DataFrame, min_k: int = 3, max_k: int = 6, k2_tolerance: float = 0.05,
                            algorithm: str = "K-Means") -> DataFrame:
    """One row: mathematical optimum (argmax silhouette, first K on ties) and
    the final K after the business rules:
      best K = 1 -> first K >= min_k;
      best K = 2 -> first K >= min_k with silhouette >= best - tolerance, else min_k;
      best K > max_k -> best K <= max_k by silhouette (may be 2);
      otherwise no override. The algorithm is always K-Means."""
    s = sweep.select(F.col("k").cast("int").alias("k"), F.col("silhouette").cast("double").alias("silhouette"))
    best = argmax_first(s, "silhouette", "k").select(F.col("k").alias("opt_k"), F.col("silhouette").alias("opt_sil"))
    j = s.crossJoin(best)  # the sweep has one row per K
    agg = j.agg(
        F.first("opt_k").alias("opt_k"), F.first("opt_sil").alias("opt_sil"),
        F.min(F.when(F.col("k") >= min_k, F.col("k"))).alias("first_ge_min"),
        F.min(F.when((F.col("k") >= min_k) & (F.col("opt_sil") - F.col("silhouette") <= k2_tolerance),
                     F.col("k"))).alias("first_close"),
        F.max_by(F.col("k"), F.when(F.col("k") <= max_k,
                                    F.struct(F.col("silhouette"), -F.col("k")))).alias("best_small"))
    opt = F.col("opt_k")
    final = (F.when(opt == 1, F.col("first_ge_min"))
             .when(opt == 2, F.coalesce(F.col("first_close"), F.lit(min_k)))
             .when(opt > max_k, F.col("best_small"))
             .otherwise(opt))
    reason = (F.when(opt == 1, F.format_string("One group is no segmentation; K=%d is the smallest that the business can act on.", final))
              .when((opt == 2) & F.col("first_close").isNotNull(),
                    F.format_string("Two groups score best (%.3f) but tell high from low value only; K=%d scores nearly as "
                                    "well and tells more.", F.col("opt_sil"), final))
              .when(opt == 2, F.lit(f"Two groups are too coarse and no larger K is close; K={min_k} is taken."))
              .when(opt > max_k, F.format_string("%d groups are more than campaigns can serve; K=%d is the best that is not.",
                                                 opt, final)))
    return agg.select(F.lit(algorithm).alias("final_algorithm"), F.col("opt_k").alias("mathematical_optimum_k"),
                      F.col("opt_sil").alias("mathematical_optimum_sil"), final.cast("int").alias("final_k"),
                      (final != opt).alias("business_override"), reason.alias("override_reason"))


def best_linkage(agg_sweep: DataFrame, linkages=("ward", "complete", "average")) -> DataFrame:
    """Best (linkage, k) by silhouette; strictly greater wins, so ties keep
    the earlier linkage, then the lower K."""
    order = F.array_position(F.array(*[F.lit(x) for x in linkages]), F.col("linkage"))
    w = Window.orderBy(F.desc("silhouette"), order, F.col("k"))
    return agg_sweep.where(F.col("silhouette").isNotNull() & ~F.isnan("silhouette")).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def algorithm_comparison(kmeans_sweep_df: DataFrame, agg_sweep: DataFrame | None = None,
                         dbscan_grid_df: DataFrame | None = None) -> DataFrame:
    """Best silhouette per algorithm (DBSCAN floored at 0), best flagged."""
    parts = [argmax_first(kmeans_sweep_df, "silhouette", "k").select(
        F.lit(0).alias("_o"), F.lit("K-Means").alias("algorithm"), F.col("silhouette"),
        F.concat(F.lit("k="), F.col("k")).alias("config"))]
    if agg_sweep is not None:
        parts.append(best_linkage(agg_sweep).select(
            F.lit(1).alias("_o"), F.lit("Agglomerative").alias("algorithm"), "silhouette",
            F.concat(F.col("linkage"), F.lit(", k="), F.col("k")).alias("config")))
    if dbscan_grid_df is not None:
        b = dbscan_grid_df.where("is_best").agg(  # one row, also without a best setting
            F.greatest(F.coalesce(F.max("silhouette"), F.lit(0.0)), F.lit(0.0)).alias("silhouette"),
            F.max(F.format_string("eps=%s, min_samples=%d", F.col("eps").cast("string"), F.col("min_samples"))).alias("config"))
        parts.append(b.select(F.lit(2).alias("_o"), F.lit("DBSCAN").alias("algorithm"), "silhouette", "config"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.orderBy(F.desc("silhouette"), "_o")  # at most three rows; equal scores: the first algorithm
    return out.withColumn("is_best", F.row_number().over(w) == 1).drop("_o")


def silhouette_curve(kmeans: DataFrame, trees: DataFrame | None = None, linkages=("ward", "complete", "average")) -> DataFrame:
    """(algorithm, linkage, k, silhouette, is_best, rank_by_max, rank_by_mean)
    of all configurations. ``is_best`` marks each curve's highest score (the
    first K of equal ones). Curves are ranked by their highest and by their
    mean score, which need not agree; equal ones go by the order K-Means, then
    ``linkages``. Null or NaN scores are not counted and are never the best."""
    rows = kmeans.select(F.lit("K-Means").alias("algorithm"), F.lit(None).cast("string").alias("linkage"), F.col("k").cast("int").alias("k"), "silhouette")
    if trees is not None:
        rows = rows.unionByName(trees.select(F.lit("Agglomerative").alias("algorithm"), "linkage", F.col("k").cast("int").alias("k"), "silhouette"))
    s = rows.withColumn("silhouette", F.when(~F.isnan("silhouette"), F.col("silhouette")))
    # one row per configuration in all windows below
    own = Window.partitionBy("algorithm", "linkage").orderBy(F.col("silhouette").desc_nulls_last(), "k")
    s = s.withColumn("is_best", (F.row_number().over(own) == 1) & F.col("silhouette").isNotNull())
    place = F.coalesce(F.array_position(F.array(*map(F.lit, linkages)), F.col("linkage")), F.lit(0))
    per = s.groupBy("algorithm", "linkage").agg(F.max("silhouette").alias("top"), F.avg("silhouette").alias("mean")).withColumn("place", place)
    by = lambda c: F.row_number().over(Window.orderBy(F.col(c).desc_nulls_last(), "place", "linkage"))
    per = per.select(F.col("algorithm").alias("_a"), F.col("linkage").alias("_l"), by("top").alias("rank_by_max"), by("mean").alias("rank_by_mean"))
    return s.join(per, (F.col("algorithm") == F.col("_a")) & F.col("linkage").eqNullSafe(F.col("_l"))).drop("_a", "_l")


def save_model(model: KMeansModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> KMeansModel:
    return KMeansModel.load(path)
