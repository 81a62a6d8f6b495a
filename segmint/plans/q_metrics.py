"""Registered queries: internal clustering metrics on the fixed labels.

Points are the two scaled coordinates of the fixture (x0 = tenure / 24.5,
x1 = MonthlyCharges / 30); the oracle computes the exact silhouette with a
plain self-join of all points."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmint.operators import metrics as M
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes
XY = ["x0", "x1"]
CENTS = [[t / fx.FIXED_SCALE[0], m / fx.FIXED_SCALE[1]] for t, m in fx.FIXED_CENTROIDS]


def points(spark, sf):
    lab = fx.labelled(spark, sf)
    return lab.select("customerID", "cluster_id", "Contract", *fx.fixed_point_columns())


_PTS = """pts AS (SELECT customerID AS id, cluster_id AS c, Contract,
    CAST(tenure AS DOUBLE) / 24.5 AS x0, MonthlyCharges / 30.0 AS x1 FROM labelled),
cen AS (SELECT c, count(*) AS n, avg(x0) AS c0, avg(x1) AS c1 FROM pts GROUP BY c)"""
_D2 = "((p.x0 - q.x0) * (p.x0 - q.x0) + (p.x1 - q.x1) * (p.x1 - q.x1))"


def _sil_ctes(label: str = "c", tag: str = "") -> str:
    return f"""sums{tag} AS (SELECT p.id, p.{label} AS own, q.{label} AS other, sum(sqrt({_D2})) AS s
    FROM pts p CROSS JOIN pts q GROUP BY 1, 2, 3),
sz{tag} AS (SELECT {label} AS c, count(*) AS nc FROM pts GROUP BY 1),
ab{tag} AS (SELECT id, own, max(CASE WHEN other = own THEN CASE WHEN nc > 1 THEN s / (nc - 1) ELSE 0.0 END END) AS a,
    min(CASE WHEN other <> own THEN s / nc END) AS b, max(CASE WHEN other = own THEN nc END) AS nown
    FROM sums{tag} JOIN sz{tag} ON sz{tag}.c = sums{tag}.other GROUP BY 1, 2),
sil{tag} AS (SELECT id AS customerID, own AS cluster_id, coalesce(a, 0.0) AS a, b,
    CASE WHEN nown <= 1 OR b IS NULL THEN 0.0 WHEN greatest(coalesce(a, 0.0), b) = 0 THEN 0.0
         ELSE (b - coalesce(a, 0.0)) / greatest(coalesce(a, 0.0), b) END AS silhouette FROM ab{tag})"""


_DB = """sc AS (SELECT p.c, avg(sqrt((x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1))) AS s
    FROM pts p JOIN cen USING (c) GROUP BY p.c),
cc AS (SELECT cen.*, s FROM cen JOIN sc USING (c)),
dbr AS (SELECT a.c, max(CASE WHEN d = 0 THEN 'inf'::DOUBLE ELSE (a_s + b_s) / d END) AS r,
        max(a_s + b_s) AS ss, max(d) AS dmax FROM (
    SELECT a.c, a.s AS a_s, b.s AS b_s, sqrt((a.c0 - b.c0) * (a.c0 - b.c0) + (a.c1 - b.c1) * (a.c1 - b.c1)) AS d
    FROM cc a JOIN cc b ON a.c <> b.c) a GROUP BY a.c),
db AS (SELECT CASE WHEN max(ss) = 0 OR max(dmax) = 0 THEN 0.0 ELSE avg(r) END AS davies_bouldin FROM dbr)"""

_CH = """wss AS (SELECT sum((x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1)) AS w FROM pts p JOIN cen USING (c)),
g AS (SELECT sum(n * c0) / sum(n) AS g0, sum(n * c1) / sum(n) AS g1 FROM cen),
bss AS (SELECT sum(n * ((c0 - g0) * (c0 - g0) + (c1 - g1) * (c1 - g1))) AS b, sum(n) AS n, count(*) AS k
        FROM cen CROSS JOIN g),
ch AS (SELECT CASE WHEN w = 0 THEN 1.0 ELSE b * (n - k) / (w * (k - 1)) END AS calinski_harabasz
       FROM bss CROSS JOIN wss)"""


@register("centroids", W("SELECT c AS cluster_id, n, c0 AS c_0, c1 AS c_1 FROM cen", extra=_PTS),
          doubles=("c_0", "c_1"))
def q_centroids(spark, sf):
    return M.centroids(points(spark, sf), XY)


@register("inertia", W("SELECT sum((x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1)) AS inertia FROM pts JOIN cen USING (c)",
                       extra=_PTS), doubles=("inertia",))
def q_inertia(spark, sf):
    return M.inertia(points(spark, sf), XY)


@register("davies_bouldin", W("SELECT * FROM db", extra=_PTS + ",\n" + _DB), doubles=("davies_bouldin",))
def q_davies_bouldin(spark, sf):
    return M.davies_bouldin(points(spark, sf), XY)


@register("calinski_harabasz", W("SELECT * FROM ch", extra=_PTS + ",\n" + _CH), doubles=("calinski_harabasz",))
def q_calinski_harabasz(spark, sf):
    return M.calinski_harabasz(points(spark, sf), XY)


@register("silhouette_samples", W("SELECT customerID, 'cluster_id' AS labeling, cluster_id, a, b, silhouette FROM sil",
                                  extra=_PTS + ",\n" + _sil_ctes()), doubles=("a", "b", "silhouette"))
def q_silhouette_samples(spark, sf):
    """Exact per-point silhouette (blocked all-pairs, no pair emitted)."""
    return M.silhouette_samples(points(spark, sf), XY, "cluster_id")


@register("silhouette_score", W("""SELECT 'cluster_id' AS labeling, avg(silhouette) AS silhouette, count(*) AS n,
  'exact' AS mode FROM sil""", extra=_PTS + ",\n" + _sil_ctes()), doubles=("silhouette",))
def q_silhouette_score(spark, sf):
    return M.silhouette_score(points(spark, sf), XY, "cluster_id")


@register("silhouette_any_ids", W("""SELECT CASE WHEN Contract = 'One year' THEN NULL ELSE Contract END AS customerID, cluster_id, a, b, silhouette
  FROM sil JOIN (SELECT id AS customerID, Contract FROM pts) q USING (customerID)""", extra=_PTS + ",\n" + _sil_ctes()), doubles=("a", "b", "silhouette"))
def q_silhouette_any_ids(spark, sf):
    """Rows that share an id or have none keep their own values: the contract in the id's place."""
    pts = points(spark, sf).withColumn("customerID", F.when(F.col("Contract") != "One year", F.col("Contract")))
    return M.silhouette_samples(pts, XY, "cluster_id").drop("labeling")


@register("silhouette_sampled")
def q_silhouette_sampled(spark, sf):
    """The estimate of the mean from 500 rows of every cluster, with its standard error."""
    return M.silhouette_score(points(spark, sf), XY, "cluster_id", mode="sampled")


def _contract_label():
    return (F.when(F.col("Contract") == "Month-to-month", 0).when(F.col("Contract") == "One year", 1)
            .otherwise(2)).alias("contract_id")


@register("silhouette_multi", W("""SELECT 'cluster_id' AS labeling, avg(silhouette) AS silhouette, count(*) AS n,
  'exact' AS mode FROM sil
  UNION ALL SELECT 'contract_id', avg(silhouette), count(*), 'exact' FROM sil2""",
                                extra=_PTS.replace("Contract,", "Contract, CASE Contract WHEN 'Month-to-month' THEN 0 "
                                                               "WHEN 'One year' THEN 1 ELSE 2 END AS k2,")
                                + ",\n" + _sil_ctes() + ",\n" + _sil_ctes("k2", "2")), doubles=("silhouette",))
def q_silhouette_multi(spark, sf):
    """Two labelings of the same points scored in ONE distance pass."""
    pts = points(spark, sf).withColumn("contract_id", _contract_label())
    return M.silhouette_score(pts, XY, ["cluster_id", "contract_id"])


@register("internal_metrics", W("""SELECT (SELECT avg(silhouette) FROM sil) AS silhouette, db.davies_bouldin,
  ch.calinski_harabasz, (SELECT count(*) FROM pts) AS n_samples, (SELECT count(DISTINCT c) FROM pts) AS n_clusters,
  CASE WHEN (SELECT avg(silhouette) FROM sil) > 0.5 THEN 'strong' WHEN (SELECT avg(silhouette) FROM sil) > 0.25
       THEN 'reasonable' ELSE 'weak' END AS structure
  FROM db CROSS JOIN ch""", extra=_PTS + ",\n" + _sil_ctes() + ",\n" + _DB + ",\n" + _CH),
          doubles=("silhouette", "davies_bouldin", "calinski_harabasz"))
def q_internal_metrics(spark, sf):
    return M.internal_metrics(points(spark, sf), XY, "cluster_id")


def _assign_sql() -> str:
    d = [f"((x0 - {c0!r}) * (x0 - {c0!r}) + (x1 - {c1!r}) * (x1 - {c1!r}))" for c0, c1 in CENTS]
    return f"(CASE WHEN {d[0]} <= {d[1]} AND {d[0]} <= {d[2]} THEN 0 WHEN {d[1]} <= {d[2]} THEN 1 ELSE 2 END)"


@register("kmeans_assign", W(f"SELECT id AS customerID, {_assign_sql()} AS cluster_id FROM pts", extra=_PTS))
def q_kmeans_assign(spark, sf):
    """Nearest of three given centroids, ties to the lowest id."""
    return points(spark, sf).select("customerID", M.assign_nearest(XY, CENTS).alias("cluster_id"))


def _own_d2() -> str:
    parts = " ".join(f"WHEN {i} THEN (x0 - {c0!r}) * (x0 - {c0!r}) + (x1 - {c1!r}) * (x1 - {c1!r})"
                     for i, (c0, c1) in enumerate(CENTS))
    return f"(CASE k {parts} END)"


@register("lloyd_step", W(f"""SELECT k AS cluster_id, count(*) AS n, avg(x0) AS c_0, avg(x1) AS c_1,
  sum({_own_d2()}) AS inertia_before FROM (SELECT x0, x1, {_assign_sql()} AS k FROM pts) a GROUP BY k""",
                          extra=_PTS), doubles=("c_0", "c_1", "inertia_before"))
def q_lloyd_step(spark, sf):
    return M.lloyd_step(points(spark, sf), XY, CENTS)


@register("silhouette_plot_data", W("""SELECT customerID, cluster_id, silhouette,
  CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY round(silhouette, 9), customerID) - 1 AS INTEGER)
    AS rank_in_cluster,
  CAST(y_lower + row_number() OVER (PARTITION BY cluster_id ORDER BY round(silhouette, 9), customerID) - 1 AS BIGINT)
    AS y,
  (SELECT avg(silhouette) FROM sil) AS average
  FROM sil JOIN (SELECT cluster_id, 10 + coalesce(sum(n + 10) OVER (ORDER BY cluster_id ROWS BETWEEN UNBOUNDED
      PRECEDING AND 1 PRECEDING), 0) AS y_lower FROM (SELECT cluster_id, count(*) AS n FROM sil GROUP BY 1) s) o
  USING (cluster_id)""", extra=_PTS + ",\n" + _sil_ctes()), doubles=("silhouette", "average"))
def q_silhouette_plot_data(spark, sf):
    from segmint.operators.profile import silhouette_plot_data
    smp = M.silhouette_samples(points(spark, sf), XY, "cluster_id").select("customerID", "cluster_id", "silhouette")
    return silhouette_plot_data(smp)
