"""Registered queries: fixtures, profiles, naming, actions, risk."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from segmint.functions import rules
from segmint.operators import profile as P
from segmint.plans import sqlkit as K
from segmint.plans.registry import register
from segmint.session import ensure_checkpoint_dir
from segmint.sources import customers as SRC
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes


@register("load_customers", W("SELECT * FROM subscribers", labelled=False),
          doubles=("MonthlyCharges", "TotalCharges"))
def q_load_customers(spark, sf):
    """The customer table written as CSV to the shared folder and loaded as a
    user would, with the fixed schema."""
    path = f"{ensure_checkpoint_dir(spark)}/csv/customers-{uuid.uuid4().hex[:12]}"
    SRC.save_table(fx.subscribers(spark, sf).withColumn("TotalCharges", F.col("TotalCharges").cast("string")), path, "csv")
    return SRC.load_customers(spark, path)


@register("subscribers", W("SELECT * FROM subscribers", labelled=False), doubles=("MonthlyCharges", "TotalCharges"))
def q_subscribers(spark, sf):
    """The 21-column customer table derived from orders x customer x lineitem."""
    return fx.subscribers(spark, sf)


@register("load_profiles", W("SELECT p.*, n.cluster_name FROM profiles p JOIN named n USING (cluster_id)",
                             extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE), doubles=K.PROFILE_DOUBLES)
def q_load_profiles(spark, sf):
    """Named profiles saved as CSV and loaded again."""
    named = P.assign_names(P.cluster_profiles(fx.labelled(spark, sf))).drop("descriptors")
    path = f"{ensure_checkpoint_dir(spark)}/csv/profiles-{uuid.uuid4().hex[:12]}"
    SRC.save_profiles(named, path)
    return SRC.load_profiles(spark, path, named.schema)


@register("labelled", W("SELECT * FROM labelled"), doubles=("MonthlyCharges", "TotalCharges"))
def q_labelled(spark, sf):
    return fx.labelled(spark, sf)


@register("cluster_profiles", W("SELECT * FROM profiles", extra=K.PROFILE_CTES), doubles=K.PROFILE_DOUBLES)
def q_cluster_profiles(spark, sf):
    return P.cluster_profiles(fx.labelled(spark, sf))


@register("cluster_mode", W(K.mode_cte("mm", "labelled", "PaymentMethod")[len("mm AS ("):-1]))
def q_cluster_mode(spark, sf):
    return P.cluster_mode(fx.labelled(spark, sf), "PaymentMethod")


@register("assign_names",
          W(f"SELECT cluster_id, cluster_name, {K.words_sql()} AS descriptor_words FROM named",
            extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE))
def q_assign_names(spark, sf):
    named = P.assign_names(P.cluster_profiles(fx.labelled(spark, sf)))
    return named.select("cluster_id", "cluster_name", F.concat_ws(" ", "descriptors").alias("descriptor_words"))


# Name uniqueness on a grouping where names repeat: clusters keyed by
# (contract, internet) pairs of the labelled table, named by their profile.
_PAIR_PROFILE_SQL = f"""pairs AS (
  SELECT dense_rank() OVER (ORDER BY Contract, InternetService) - 1 AS cluster_id, * EXCLUDE (cluster_id)
  FROM labelled),
pg AS (SELECT CAST(cluster_id AS INT) AS cluster_id, avg(tenure) AS tenure_mean,
              avg(MonthlyCharges) AS MonthlyCharges_mean FROM pairs GROUP BY 1),
pn AS (SELECT *, {K.name_sql()} AS base_name FROM pg)"""


@register("unique_names", W("""SELECT cluster_id, base_name,
  CASE WHEN row_number() OVER (PARTITION BY base_name ORDER BY cluster_id) > 1
       THEN base_name || ' (' || CAST(cluster_id AS VARCHAR) || ')' ELSE base_name END AS cluster_name
FROM pn""", extra=_PAIR_PROFILE_SQL))
def q_unique_names(spark, sf):
    keyed = _pair_keyed(fx.labelled(spark, sf).drop("cluster_id"))
    g = keyed.groupBy("cluster_id").agg(F.avg("tenure").alias("tenure_mean"),
                                        F.avg("MonthlyCharges").alias("MonthlyCharges_mean"))
    words = rules.descriptors("MonthlyCharges_mean", "tenure_mean", F.lit(None).cast("double"),
                              F.lit(None).cast("double"), F.lit(None).cast("string"))
    g = g.withColumn("base_name", rules.name_from_descriptors(words))
    return P.unique_names(g, "base_name").select("cluster_id", "base_name", "cluster_name")


def _pair_keyed(lab):
    """Cluster id = rank of the (Contract, InternetService) pair. The pair
    domain is tiny, so its ranking is computed on the distinct pairs and
    broadcast back (9 rows at most)."""
    from pyspark.sql import Window
    pairs = lab.select("Contract", "InternetService").distinct()
    ranked = pairs.withColumn("cluster_id", (F.dense_rank().over(
        Window.orderBy("Contract", "InternetService")) - 1).cast("int"))
    return lab.join(F.broadcast(ranked), ["Contract", "InternetService"])


_ACTIONS_SQL = W(f"""SELECT cluster_id, cluster_name, {K.insight_sql()} AS primary_insight,
  {K.marketing_sql()} AS marketing_action, {K.retention_sql()} AS retention_strategy FROM named""",
                 extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE)


@register("business_actions", _ACTIONS_SQL)
def q_business_actions(spark, sf):
    return P.business_actions(P.assign_names(P.cluster_profiles(fx.labelled(spark, sf))))


@register("load_actions", _ACTIONS_SQL)
def q_load_actions(spark, sf):
    """Business actions saved as CSV and loaded again."""
    path = f"{ensure_checkpoint_dir(spark)}/csv/actions-{uuid.uuid4().hex[:12]}"
    SRC.save_actions(P.business_actions(P.assign_names(P.cluster_profiles(fx.labelled(spark, sf)))), path)
    return SRC.load_actions(spark, path)


@register("primary_insight", W(f"SELECT cluster_id, {K.insight_sql()} AS primary_insight FROM profiles",
                               extra=K.PROFILE_CTES))
def q_primary_insight(spark, sf):
    p = P.cluster_profiles(fx.labelled(spark, sf))
    return p.select("cluster_id", rules.primary_insight().alias("primary_insight"))


@register("marketing_action", W(f"SELECT cluster_id, {K.marketing_sql()} AS marketing_action FROM profiles",
                                extra=K.PROFILE_CTES))
def q_marketing_action(spark, sf):
    p = P.cluster_profiles(fx.labelled(spark, sf))
    return p.select("cluster_id", rules.marketing_action().alias("marketing_action"))


@register("retention_strategy", W(f"SELECT cluster_id, {K.retention_sql()} AS retention_strategy FROM profiles",
                                  extra=K.PROFILE_CTES))
def q_retention_strategy(spark, sf):
    p = P.cluster_profiles(fx.labelled(spark, sf))
    return p.select("cluster_id", rules.retention_strategy().alias("retention_strategy"))


SEGMENT_REPORT_SQL = W(f"""SELECT n.cluster_id, size, size_pct, churn_rate, tenure_mean, MonthlyCharges_mean,
  cluster_name, {K.insight_sql('n.')} AS primary_insight, {K.marketing_sql('n.')} AS marketing_action,
  {K.retention_sql('n.')} AS retention_strategy, {K.risk_sql('churn_rate')} AS risk_level
FROM named n""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE)


@register("segment_report", SEGMENT_REPORT_SQL,
          doubles=("size_pct", "churn_rate", "tenure_mean", "MonthlyCharges_mean"))
def q_segment_report(spark, sf):
    """Flagship: which segments exist, how risky, what to do."""
    return P.segment_report(fx.labelled(spark, sf))


@register("risk_level", W(f"""SELECT cluster_id, churn_rate, {K.risk_sql('churn_rate')} AS risk_level
  FROM (SELECT cluster_id, avg(CASE WHEN Churn='Yes' THEN 1.0 ELSE 0.0 END) AS churn_rate
        FROM labelled GROUP BY cluster_id) r"""), doubles=("churn_rate",))
def q_risk_level(spark, sf):
    r = fx.labelled(spark, sf).groupBy("cluster_id").agg(
        F.avg(F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0)).alias("churn_rate"))
    return r.withColumn("risk_level", rules.risk_level("churn_rate"))


@register("attach_names", W(f"""SELECT customerID, l.cluster_id, cluster_name FROM labelled l
  LEFT JOIN named USING (cluster_id)""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE))
def q_attach_names(spark, sf):
    lab = fx.labelled(spark, sf)
    names = P.assign_names(P.cluster_profiles(lab)).select("cluster_id", "cluster_name")
    return P.attach_names(lab.select("customerID", "cluster_id"), names)


@register("cluster_size_share", W(f"""SELECT cluster_id, n, CAST(n AS DOUBLE) * 100 / sum(n) OVER () AS pct,
  cluster_name FROM (SELECT cluster_id, count(*) AS n FROM labelled GROUP BY 1) c
  LEFT JOIN named USING (cluster_id)""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE), doubles=("pct",))
def q_cluster_size_share(spark, sf):
    lab = fx.labelled(spark, sf)
    names = P.assign_names(P.cluster_profiles(lab)).select("cluster_id", "cluster_name")
    return P.cluster_size_share(lab, names)


_RADAR_F = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]


@register("radar_profile", W(" UNION ALL ".join(
    f"""SELECT cluster_id, '{f}' AS feature, avg(CAST("{f}" AS DOUBLE)) AS mean,
  (avg(CAST("{f}" AS DOUBLE)) - lo) / (hi - lo + 1e-10) AS scaled FROM labelled CROSS JOIN
  (SELECT min(CAST("{f}" AS DOUBLE)) AS lo, max(CAST("{f}" AS DOUBLE)) AS hi FROM labelled) r GROUP BY cluster_id, lo, hi"""
    for f in _RADAR_F)), doubles=("mean", "scaled"))
def q_radar_profile(spark, sf):
    return P.radar_profile(fx.labelled(spark, sf), _RADAR_F)


@register("centroid_heatmap", W("""SELECT cluster_id, feature, centroid, (centroid - avg(centroid) OVER (PARTITION BY feature)) /
  (stddev_pop(centroid) OVER (PARTITION BY feature) + 1e-10) AS z FROM m JOIN t USING (feature)""", extra="""v AS (SELECT feature, var FROM (""" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, var_pop(CAST("{f}" AS DOUBLE)) AS var FROM labelled""" for f in _RADAR_F) + """) x),
t AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY var DESC, feature) AS rk FROM v) y WHERE rk <= 3),
m AS (""" + " UNION ALL ".join(
    f"""SELECT cluster_id, '{f}' AS feature, avg(CAST("{f}" AS DOUBLE)) AS centroid FROM labelled GROUP BY 1"""
    for f in _RADAR_F) + ")"), doubles=("centroid", "z"))
def q_centroid_heatmap(spark, sf):
    return P.centroid_heatmap(fx.labelled(spark, sf), _RADAR_F, top=3)
