"""Registered queries: segment validation against churn (fixed labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmint.functions import special
from segmint.operators import stats as ST
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes
Z = special.z_value(0.95)
Z2 = Z * Z

_RATES_CTE = f"""g AS (SELECT cluster_id, count(*) AS n_samples,
    sum(CASE WHEN Churn='Yes' THEN 1 ELSE 0 END)::BIGINT AS n_churn FROM labelled GROUP BY 1),
w AS (SELECT *, CAST(n_churn AS DOUBLE) / n_samples AS p, CAST(n_samples AS DOUBLE) AS nd FROM g),
rates AS (SELECT cluster_id, n_samples, n_churn, p AS churn_rate,
    CASE WHEN n_samples = 0 THEN 0.0 ELSE greatest(0.0, (p + {Z2!r} / (2.0 * nd)) / (1.0 + {Z2!r} / nd)
      - {Z!r} * sqrt(p * (1.0 - p) / nd + {Z2!r} / (4.0 * nd * nd)) / (1.0 + {Z2!r} / nd)) END AS ci_lower,
    CASE WHEN n_samples = 0 THEN 0.0 ELSE least(1.0, (p + {Z2!r} / (2.0 * nd)) / (1.0 + {Z2!r} / nd)
      + {Z!r} * sqrt(p * (1.0 - p) / nd + {Z2!r} / (4.0 * nd * nd)) / (1.0 + {Z2!r} / nd)) END AS ci_upper,
    sum(n_churn) OVER () / sum(n_samples) OVER () AS overall_rate FROM w)"""


@register("target_rate_by_cluster", W("SELECT * FROM rates", extra=_RATES_CTE),
          doubles=("churn_rate", "ci_lower", "ci_upper", "overall_rate"))
def q_target_rate_by_cluster(spark, sf):
    return ST.target_rate_by_cluster(fx.labelled(spark, sf))


@register("wilson_interval", W("SELECT cluster_id, n_churn, n_samples, ci_lower, ci_upper FROM rates",
                               extra=_RATES_CTE), doubles=("ci_lower", "ci_upper"))
def q_wilson_interval(spark, sf):
    g = fx.labelled(spark, sf).groupBy("cluster_id").agg(
        F.sum(F.when(F.col("Churn") == "Yes", 1).otherwise(0)).cast("long").alias("n_churn"),
        F.count(F.lit(1)).alias("n_samples"))
    return ST.wilson_interval(g, "n_churn", "n_samples")


@register("churn_chart_data", W("""SELECT cluster_id, churn_rate, churn_rate - ci_lower AS err_lower,
  ci_upper - churn_rate AS err_upper, avg(churn_rate) OVER () AS mean_of_cluster_rates, overall_rate FROM rates""",
                                extra=_RATES_CTE),
          doubles=("churn_rate", "err_lower", "err_upper", "mean_of_cluster_rates", "overall_rate"))
def q_churn_chart_data(spark, sf):
    return ST.churn_chart_data(ST.target_rate_by_cluster(fx.labelled(spark, sf)))


@register("contingency", W("""SELECT r.cluster_id AS row_value, c.Churn AS col_value,
    count(l.cluster_id) AS n FROM (SELECT DISTINCT cluster_id FROM labelled) r CROSS JOIN (SELECT DISTINCT Churn FROM labelled) c
  LEFT JOIN labelled l ON l.cluster_id = r.cluster_id AND l.Churn = c.Churn GROUP BY 1, 2"""))
def q_contingency(spark, sf):
    return ST.contingency(fx.labelled(spark, sf), "cluster_id", "Churn", zeros=True)


def _v_sql() -> str:
    return """CASE WHEN least(kc - 1, rc - 1) > 0 THEN sqrt(greatest(0.0, chi2 / nd - (k - 1) * (r - 1) / (nd - 1))
      / least(kc - 1, rc - 1)) END"""


def _bands_sql() -> str:
    return """CASE WHEN cramers_v < 0.1 THEN 'negligible' WHEN cramers_v < 0.3 THEN 'small'
      WHEN cramers_v < 0.5 THEN 'medium' ELSE 'large' END AS v_band"""


_CHI_CTE = """obs AS (SELECT cluster_id AS a, Churn AS b, count(*) AS n FROM labelled GROUP BY 1, 2),
ra AS (SELECT a, sum(n) AS n_r FROM obs GROUP BY a), cb AS (SELECT b, sum(n) AS n_c FROM obs GROUP BY b),
tot AS (SELECT sum(n) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM obs),
grid AS (SELECT ra.a, cb.b, n_r, n_c, coalesce(obs.n, 0) AS o FROM ra CROSS JOIN cb
         LEFT JOIN obs ON obs.a = ra.a AND obs.b = cb.b),
chi AS (SELECT sum((o - e) * (o - e) / e) AS chi2 FROM
        (SELECT o, CAST(n_r AS DOUBLE) * n_c / (SELECT n FROM tot) AS e FROM grid) x),
st AS (SELECT chi2, CAST(n AS DOUBLE) AS nd, n, r, k, r - (r - 1.0) * (r - 1) / (n - 1.0) AS rc,
       k - (k - 1.0) * (k - 1) / (n - 1.0) AS kc FROM chi CROSS JOIN tot),
res AS (SELECT chi2, ((r - 1) * (k - 1))::BIGINT AS dof, n::BIGINT AS n, r::BIGINT AS n_rows, k::BIGINT AS n_cols,
  """ + _v_sql() + """ AS cramers_v FROM st)"""


@register("chi_square", W("""SELECT *, """ + _bands_sql() + """,
  CASE WHEN dof = 2 THEN exp(-chi2 / 2) END AS p_value,
  CASE WHEN exp(-chi2 / 2) < 0.001 THEN 'highly significant' WHEN exp(-chi2 / 2) < 0.05 THEN 'significant'
       ELSE 'not significant' END AS p_band FROM res""", extra=_CHI_CTE),
          doubles=("chi2", "cramers_v", "p_value"))
def q_chi_square(spark, sf):
    """Cluster x churn independence (3 x 2: dof 2, where p = exp(-chi2/2))."""
    return ST.chi_square(fx.labelled(spark, sf), "cluster_id", "Churn")


@register("cramers_v", W("SELECT n, n_rows, n_cols, cramers_v FROM res", extra=_CHI_CTE), doubles=("cramers_v",))
def q_cramers_v(spark, sf):
    return ST.chi_square(fx.labelled(spark, sf), "cluster_id", "Churn", with_p=False).select(
        "n", "n_rows", "n_cols", "cramers_v")


_YATES_SQL = """WITH obs AS (SELECT quality AS a, toxic AS b, count(*) AS n FROM labels GROUP BY 1, 2),
ra AS (SELECT a, sum(n) AS n_r FROM obs GROUP BY a), cb AS (SELECT b, sum(n) AS n_c FROM obs GROUP BY b),
tot AS (SELECT sum(n) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM obs),
grid AS (SELECT n_r, n_c, coalesce(obs.n, 0) AS o FROM ra CROSS JOIN cb LEFT JOIN obs ON obs.a = ra.a AND obs.b = cb.b),
cells AS (SELECT o, CAST(n_r AS DOUBLE) * n_c / (SELECT n FROM tot) AS e FROM grid),
adj AS (SELECT e, o + least(0.5, abs(e - o)) * sign(e - o) AS o2 FROM cells),
chi AS (SELECT sum((o2 - e) * (o2 - e) / e) AS chi2 FROM adj),
st AS (SELECT chi2, CAST(n AS DOUBLE) AS nd, n, r, k, r - (r - 1.0) * (r - 1) / (n - 1.0) AS rc,
       k - (k - 1.0) * (k - 1) / (n - 1.0) AS kc FROM chi CROSS JOIN tot),
res AS (SELECT chi2, ((r - 1) * (k - 1))::BIGINT AS dof, n::BIGINT AS n, r::BIGINT AS n_rows, k::BIGINT AS n_cols,
  """ + _v_sql() + """ AS cramers_v FROM st)
SELECT *, """ + _bands_sql() + " FROM res"


@register("chi_square_yates", _YATES_SQL, doubles=("chi2", "cramers_v"))
def q_chi_square_yates(spark, sf):
    """quality x toxic on ``labels``: 2 x 2, Yates-corrected."""
    labels = fx.read_table(spark, sf, "labels")
    return ST.chi_square(labels, "quality", "toxic", with_p=False)


_ANOVA_FEATURES = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]
_ANOVA_CTE = "g AS (" + " UNION ALL ".join(
    f"""SELECT cluster_id, '{f}' AS feature, count(x) AS n, avg(x) AS m, var_pop(x) AS v
  FROM (SELECT cluster_id, CAST("{f}" AS DOUBLE) AS x FROM labelled) t GROUP BY 1""" for f in _ANOVA_FEATURES) + """),
l AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g WHERE n > 0),
r AS (SELECT feature, sum(n * (m - grand) * (m - grand)) AS ssb, sum(n * v) AS ssw, sum(n) AS n, count(*) AS k
      FROM l GROUP BY feature),
anova AS (SELECT feature, CASE WHEN k - 1 > 0 AND n - k > 0 AND ssw > 0 THEN (ssb / (k - 1)) / (ssw / (n - k)) END
    AS f_statistic, (k - 1)::BIGINT AS df_between, (n - k)::BIGINT AS df_within FROM r)"""


@register("anova_f", W("""SELECT *, CASE WHEN df_between = 2 THEN power(1 + 2 * f_statistic / df_within, -df_within / 2.0)
  END AS p_value, power(1 + 2 * f_statistic / df_within, -df_within / 2.0) < 0.05 AS significant FROM anova""",
                       extra=_ANOVA_CTE), doubles=("f_statistic", "p_value"))
def q_anova_f(spark, sf):
    """One-way ANOVA of the raw numeric columns across the three fixed
    clusters (df_between = 2, so p has a closed form in the oracle)."""
    return ST.anova_f(fx.labelled(spark, sf), _ANOVA_FEATURES)


@register("top_features", W("""SELECT feature, f_statistic FROM anova ORDER BY f_statistic DESC NULLS LAST LIMIT 3""",
                            extra=_ANOVA_CTE), doubles=("f_statistic",))
def q_top_features(spark, sf):
    return ST.top_features(ST.anova_f(fx.labelled(spark, sf), _ANOVA_FEATURES, with_p=False), 3).select(
        "feature", "f_statistic")


_P = "power(1 + 2 * f_statistic / df_within, -df_within / 2.0)"


@register("feature_importance", W(f"""SELECT *, {_P} AS p_value, {_P} < 0.05 AS significant, 500 * (power(0.05, -2 / 1000.0) - 1) AS chart_threshold,
  df_within / 2.0 * (power(0.05, -2.0 / df_within) - 1) AS f_critical FROM (SELECT * FROM anova ORDER BY f_statistic DESC NULLS LAST, feature LIMIT 3) t""",
                                  extra=_ANOVA_CTE), doubles=("f_statistic", "p_value", "chart_threshold", "f_critical"))
def q_feature_importance(spark, sf):
    """The three most important features with both threshold lines (two
    degrees of freedom, so all have a closed form in the oracle)."""
    lab = fx.labelled(spark, sf)
    return ST.feature_importance(ST.anova_f(lab, _ANOVA_FEATURES), n=3)


@register("feature_table", W(f"""SELECT *, {_P} AS p_value, {_P} < 0.05 AS significant FROM anova ORDER BY f_statistic DESC NULLS LAST, feature LIMIT 15""",
                             extra=_ANOVA_CTE), doubles=("f_statistic", "p_value"))
def q_feature_table(spark, sf):
    """The table of the dashboard: the first 15 features."""
    from segmint.operators.score import feature_table
    return feature_table(ST.anova_f(fx.labelled(spark, sf), _ANOVA_FEATURES))
