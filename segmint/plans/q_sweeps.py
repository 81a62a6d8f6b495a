"""Registered queries on score tables: selection rules, curves, comparisons.

K-Means starts are random, so SQL cannot follow a real sweep. Here the scored
partitions are given ones (bands of tenure and of monthly charge, 2 to 8 of
each, in the place of K-Means or of two linkages); the silhouettes, inertias
and every rule are computed by the library and by SQL on all accounts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from segmint.operators import kmeans as KM
from segmint.operators import metrics as M
from segmint.operators import dbscan as DB
from segmint.plans.q_metrics import XY
from segmint.plans.registry import register
from segmint.session import materialize
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes
KS = range(2, 9)
_BANDS = {"a": "least(12, floor(tenure / 6))", "b": "least(12, floor(MonthlyCharges / 10))"}


@lru_cache(maxsize=4)
def _scores(spark, sf):
    """(family, k, silhouette, inertia) of the given partitions."""
    lab = fx.labelled(spark, sf)
    pts = lab.select("customerID", *fx.fixed_point_columns(), *[F.expr(f"cast(floor({band} * {k} / 13) as int)").alias(f"{f}_{k}") for f, band in _BANDS.items() for k in KS])
    pts = materialize(pts, "given-partitions")
    names = [f"{f}_{k}" for f in _BANDS for k in KS]
    rows = M.inertia(pts, XY, names)
    sil = M.silhouette_score(pts, XY, names).select("labeling", "silhouette")
    part = F.split("labeling", "_")
    return materialize(sil.join(rows, "labeling").select(part[0].alias("family"), part[1].cast("int").alias("k"), F.col("silhouette"), F.col("inertia")), "given-scores")


def _family(spark, sf, name):
    return _scores(spark, sf).where(F.col("family") == name).drop("family")


def _trees(spark, sf):
    """The two families as two linkages."""
    s = _scores(spark, sf)
    return s.select(F.when(F.col("family") == "a", "complete").otherwise("ward").alias("linkage"), "k", "silhouette")


_ALL_K = " UNION ALL ".join(f"SELECT {k} AS k" for k in KS)
SCORES = f"""bp AS (SELECT customerID AS id, CAST(tenure AS DOUBLE) / 24.5 AS x0, MonthlyCharges / 30.0 AS x1,
    CAST(least(12, floor(tenure / 6)) AS INT) AS a, CAST(least(12, floor(MonthlyCharges / 10)) AS INT) AS b FROM labelled),
ks AS ({_ALL_K}),
s0 AS (SELECT p.id, q.a, q.b, sum(sqrt((p.x0 - q.x0) * (p.x0 - q.x0) + (p.x1 - q.x1) * (p.x1 - q.x1))) AS s, count(*) AS n
    FROM bp p CROSS JOIN bp q GROUP BY 1, 2, 3),
s1 AS (SELECT id, 'a' AS family, k, a * k // 13 AS other, sum(s) AS s, sum(n) AS n FROM s0 CROSS JOIN ks GROUP BY ALL
    UNION ALL SELECT id, 'b', k, b * k // 13, sum(s), sum(n) FROM s0 CROSS JOIN ks GROUP BY ALL),
own AS (SELECT id, 'a' AS family, k, a * k // 13 AS c, x0, x1 FROM bp CROSS JOIN ks UNION ALL SELECT id, 'b', k, b * k // 13, x0, x1 FROM bp CROSS JOIN ks),
ab AS (SELECT id, family, k, max(CASE WHEN other = c THEN n END) AS m, max(CASE WHEN other = c AND n > 1 THEN s / (n - 1) ELSE 0.0 END) AS a,
    min(CASE WHEN other <> c THEN s / n END) AS b FROM s1 JOIN own USING (id, family, k) GROUP BY ALL),
sils AS (SELECT family, k, avg(CASE WHEN m <= 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY ALL),
ins AS (SELECT family, k, sum((x0 - m0) * (x0 - m0) + (x1 - m1) * (x1 - m1)) AS inertia
    FROM (SELECT *, avg(x0) OVER (PARTITION BY family, k, c) AS m0, avg(x1) OVER (PARTITION BY family, k, c) AS m1 FROM own) GROUP BY ALL),
scores AS (SELECT family, k, silhouette, inertia FROM sils JOIN ins USING (family, k)),
trees AS (SELECT CASE family WHEN 'a' THEN 'complete' ELSE 'ward' END AS linkage, k, silhouette FROM scores)"""


def sql(text: str, more: str = "") -> str:
    return W(text, extra=SCORES + (",\n" + more if more else ""))


@register("elbow_curve", W("SELECT k, inertia FROM ins WHERE family = 'a'", extra=SCORES), doubles=("inertia",))
def q_elbow_curve(spark, sf):
    """Inertia for each number of tenure bands."""
    return KM.elbow_curve(_family(spark, sf, "a"))


_SELECT = """best AS (SELECT k AS opt, silhouette AS top FROM scores WHERE family = '{f}' ORDER BY silhouette DESC, k LIMIT 1),
facts AS (SELECT opt, top, min(CASE WHEN k >= 3 THEN k END) AS first_large, min(CASE WHEN k >= 3 AND top - silhouette <= 0.05 THEN k END) AS first_close,
    arg_max(k, CASE WHEN k <= 6 THEN silhouette - k * 1e-12 END) AS best_small FROM scores CROSS JOIN best WHERE family = '{f}' GROUP BY ALL),
final AS (SELECT *, CASE WHEN opt = 1 THEN first_large WHEN opt = 2 THEN coalesce(first_close, 3) WHEN opt > 6 THEN best_small ELSE opt END AS k FROM facts)"""
_REASON = """CASE WHEN opt = 1 THEN format('One group is no segmentation; K={} is the smallest that the business can act on.', k)
    WHEN opt = 2 AND first_close IS NOT NULL THEN format('Two groups score best ({:.3f}) but tell high from low value only; K={} scores nearly as well and tells more.', top, k)
    WHEN opt = 2 THEN 'Two groups are too coarse and no larger K is close; K=3 is taken.'
    WHEN opt > 6 THEN format('{} groups are more than campaigns can serve; K={} is the best that is not.', opt, k) END"""


def _select_sql(family: str) -> str:
    return sql(f"""SELECT 'K-Means' AS final_algorithm, opt AS mathematical_optimum_k, top AS mathematical_optimum_sil, k AS final_k,
  k <> opt AS business_override, {_REASON} AS override_reason FROM final""", _SELECT.replace("{f}", family))


@register("select_k_business_rules", _select_sql("a"), doubles=("mathematical_optimum_sil",))
def q_select_k(spark, sf):
    """The choice among numbers of tenure bands."""
    return KM.select_k_business_rules(_family(spark, sf, "a"))


@register("select_k_monthly_bands", _select_sql("b"), doubles=("mathematical_optimum_sil",))
def q_select_k_b(spark, sf):
    """The choice among numbers of monthly charge bands."""
    return KM.select_k_business_rules(_family(spark, sf, "b"))


@register("best_linkage", sql("SELECT linkage, k, silhouette FROM trees ORDER BY silhouette DESC, linkage DESC, k LIMIT 1"), doubles=("silhouette",))
def q_best_linkage(spark, sf):
    return KM.best_linkage(_trees(spark, sf))


_CURVE = """rowsof AS (SELECT 'K-Means' AS algorithm, NULL AS linkage, k, silhouette FROM scores WHERE family = 'b'
    UNION ALL SELECT 'Agglomerative', linkage, k, silhouette FROM trees),
marked AS (SELECT *, row_number() OVER (PARTITION BY algorithm, linkage ORDER BY silhouette DESC, k) = 1 AS is_best FROM rowsof),
per AS (SELECT algorithm, linkage, max(silhouette) AS top, avg(silhouette) AS mean, CASE linkage WHEN 'ward' THEN 1 WHEN 'complete' THEN 2 ELSE 0 END AS place
    FROM rowsof GROUP BY ALL),
ranks AS (SELECT algorithm AS ra, linkage AS rl, row_number() OVER (ORDER BY round(top, 12) DESC, place) AS rank_by_max, row_number() OVER (ORDER BY round(mean, 12) DESC, place) AS rank_by_mean FROM per)"""


@register("silhouette_curve", sql("""SELECT algorithm, linkage, k, silhouette, is_best, rank_by_max, rank_by_mean
  FROM marked JOIN ranks ON ra = algorithm AND rl IS NOT DISTINCT FROM linkage""", _CURVE), doubles=("silhouette",))
def q_silhouette_curve(spark, sf):
    """Curves of one K-Means and two linkage stand-ins, ranked by their highest and by their mean score."""
    return KM.silhouette_curve(_family(spark, sf, "b"), _trees(spark, sf))


def _grid(spark, sf):
    """The scores as a density grid: eps 0.3 or 0.5 by family, min_samples from k."""
    s = _scores(spark, sf).select(F.when(F.col("family") == "a", 0.3).otherwise(0.5).alias("eps"), (F.col("k") + 1).alias("min_samples"), "silhouette")
    top = s.agg(F.max("silhouette").alias("top"))
    return s.crossJoin(top).withColumn("is_best", F.col("silhouette") == F.col("top")).drop("top")  # one row


@register("dbscan_pivot", sql("""SELECT k + 1 AS min_samples, max(CASE WHEN family = 'a' THEN silhouette END) AS "0.3",
  max(CASE WHEN family = 'b' THEN silhouette END) AS "0.5" FROM scores GROUP BY k"""), doubles=("0.3", "0.5"))
def q_dbscan_pivot(spark, sf):
    """Silhouettes by min_samples and eps."""
    return DB.dbscan_pivot(_grid(spark, sf), [0.3, 0.5])


_COMPARE = """cand AS (SELECT 0 AS o, 'K-Means' AS algorithm, silhouette, 'k=' || k AS config FROM (SELECT * FROM scores WHERE family = 'a' ORDER BY silhouette DESC, k LIMIT 1)
    UNION ALL SELECT 1, 'Agglomerative', silhouette, linkage || ', k=' || k FROM (SELECT * FROM trees ORDER BY silhouette DESC, linkage DESC, k LIMIT 1)
    UNION ALL SELECT 2, 'DBSCAN', greatest(silhouette, 0.0), 'eps=' || CASE family WHEN 'a' THEN '0.3' ELSE '0.5' END || ', min_samples=' || (k + 1)
      FROM (SELECT * FROM scores ORDER BY silhouette DESC, family LIMIT 1))"""


@register("algorithm_comparison", sql("""SELECT algorithm, silhouette, config, row_number() OVER (ORDER BY round(silhouette, 12) DESC, o) = 1 AS is_best FROM cand""",
                                      _COMPARE), doubles=("silhouette",))
def q_algorithm_comparison(spark, sf):
    """The best score of each algorithm; equal ones go to the first."""
    return KM.algorithm_comparison(_family(spark, sf, "a"), _trees(spark, sf), _grid(spark, sf))


# three Lloyd iterations from given centers, unrolled
def _lloyd_sql(rounds: int = 3) -> str:
    from segmint.plans.q_metrics import CENTS
    near = "row_number() OVER (PARTITION BY id ORDER BY (x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1), c)"
    ctes = ["m0 AS (" + " UNION ALL ".join(f"SELECT {i} AS c, {a!r}::DOUBLE AS c0, {b!r}::DOUBLE AS c1" for i, (a, b) in enumerate(CENTS)) + ")"]
    for r in range(rounds + 1):
        ctes.append(f"""l{r} AS (SELECT * FROM (SELECT id, x0, x1, c, (x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1) AS d, {near} AS rn FROM bp CROSS JOIN m{r}) q WHERE rn = 1)""")
        ctes.append(f"m{r + 1} AS (SELECT c, avg(x0) AS c0, avg(x1) AS c1 FROM l{r} GROUP BY c)")
    bp = "bp AS (SELECT customerID AS id, CAST(tenure AS DOUBLE) / 24.5 AS x0, MonthlyCharges / 30.0 AS x1 FROM labelled)"
    return W(f"SELECT CAST(c AS INT) AS cluster_id, c0 AS c_0, c1 AS c_1, (SELECT sum(d) FROM l{rounds}) AS inertia FROM m{rounds}", extra=bp + ",\n" + ",\n".join(ctes))


@register("kmeans_given_starts", _lloyd_sql(), doubles=("c_0", "c_1", "inertia"))
def q_kmeans_given_starts(spark, sf):
    """Three iterations of the fused fit from given centers."""
    from segmint.plans.q_metrics import CENTS
    pts = fx.labelled(spark, sf).select(*fx.fixed_point_columns()).select(F.array(*XY).alias("_x"))
    fit = KM.lloyd(pts, [CENTS], max_iter=3, tol=0.0)[0]
    return spark.createDataFrame([(i, float(c[0]), float(c[1]), fit.inertia) for i, c in enumerate(fit.centers)], "cluster_id int, c_0 double, c_1 double, inertia double")


_CANON = """cen AS (SELECT 7 - cluster_id * 2 AS old, avg(CAST(tenure AS DOUBLE) / 24.5) AS c0, avg(MonthlyCharges / 30.0) AS c1 FROM labelled WHERE Contract <> 'One year' GROUP BY 1)"""


@register("canonical_labels", W("""SELECT customerID, CAST(coalesce(r, -1) AS INT) AS cluster_id FROM labelled
  LEFT JOIN (SELECT old, row_number() OVER (ORDER BY c0, c1) - 1 AS r FROM cen) q ON old = 7 - cluster_id * 2 AND Contract <> 'One year'""", extra=_CANON))
def q_canonical_labels(spark, sf):
    """Labels 7, 5, 3, null for one contract (-1 here), renamed by the order of their centroids."""
    lab = fx.labelled(spark, sf).select("customerID", *fx.fixed_point_columns(), F.when(F.col("Contract") != "One year", 7 - F.col("cluster_id") * 2).alias("cluster_id"))
    return KM.canonical_labels(lab, XY).select("customerID", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))
