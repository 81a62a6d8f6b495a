"""Scoring new customers: validation, cluster assignment, profile and
action lookups, risk level. The same functions serve batch frames and
streaming frames (everything is a stateless projection plus joins against
k-row tables, broadcast because their size is bounded by the model's K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint import spec as S
from segmint.functions import rules
from segmint.spec import DEFAULT_SPEC, SegmentSpec


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def validation_errors(spec: SegmentSpec = DEFAULT_SPEC, domains: dict | None = None,
                      tenure_range=S.TENURE_RANGE, monthly_range=S.MONTHLY_RANGE) -> Column:
    """array<string> of problems of one record (empty when valid): values
    outside the allowed lists, tenure / monthly charge out of range, nulls."""
    domains = domains or S.DOMAINS
    checks = []
    for c, allowed in domains.items():
        ok = F.col(_q(c)).isin(*allowed)
        checks.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"{c}: not one of " + ", ".join(map(str, allowed)))))
    t = F.col(_q(spec.tenure))
    checks.append(F.when(~F.coalesce((t >= tenure_range[0]) & (t <= tenure_range[1]), F.lit(False)),
                         F.lit(f"{spec.tenure}: outside {tenure_range[0]}..{tenure_range[1]}")))
    m = F.col(_q(spec.monthly))
    checks.append(F.when(~F.coalesce((m >= monthly_range[0]) & (m <= monthly_range[1]), F.lit(False)),
                         F.lit(f"{spec.monthly}: outside {monthly_range[0]}..{monthly_range[1]}")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def validate_customers(df: DataFrame, spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """Adds ``errors``; ``good(df)`` / ``rejected(df)`` split on it."""
    return df.withColumn("errors", validation_errors(spec))


def good(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") == 0).drop("errors")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") > 0)


def approximate_total(df: DataFrame, spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """Unknown total -> monthly charge x (tenure + 1)."""
    est = F.col(_q(spec.monthly)) * (F.col(_q(spec.tenure)) + F.lit(1))
    return df.withColumn(spec.total, F.coalesce(F.col(_q(spec.total)).cast("double"), est.cast("double")))


def score_customers(df: DataFrame, features_model, centers, out: str = "cluster_id") -> DataFrame:
    """Fitted feature transform, then the nearest of the model's centroids."""
    from segmint.operators.metrics import assign_nearest
    feats = features_model.transform(df)
    return feats.withColumn(out, assign_nearest(features_model.feature_names, centers))


def lookup_profile(scored: DataFrame, profiles: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Name, churn rate and size share of the assigned cluster; a cluster
    without a profile row gets ``Cluster <id>``, 0, 0."""
    p = profiles.select(F.col("cluster_id").alias("_pid"), F.col("cluster_name").alias("_pname"),
                        F.col("churn_rate").alias("_prate"), F.col("size_pct").alias("_ppct"))
    j = scored.join(F.broadcast(p), F.col(_q(cluster_col)) == F.col("_pid"), "left")
    return j.select(*[F.col(_q(c)) for c in scored.columns],
                    F.coalesce(F.col("_pname"), F.concat(F.lit(S.DEFAULT_NAME_PREFIX),
                                                         F.col(_q(cluster_col)).cast("string"))).alias("cluster_name"),
                    F.coalesce(F.col("_prate"), F.lit(0.0)).alias("churn_rate"),
                    F.coalesce(F.col("_ppct"), F.lit(0.0)).alias("size_pct"))


def lookup_action(scored: DataFrame, actions: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Marketing action and retention strategy of the assigned cluster, with
    default texts when the cluster has none."""
    a = actions.select(F.col("cluster_id").alias("_aid"), F.col("marketing_action").alias("_mkt"),
                       F.col("retention_strategy").alias("_ret"))
    j = scored.join(F.broadcast(a), F.col(_q(cluster_col)) == F.col("_aid"), "left")
    return j.select(*[F.col(_q(c)) for c in scored.columns],
                    F.coalesce(F.col("_mkt"), F.lit(S.DEFAULT_MARKETING)).alias("marketing_action"),
                    F.coalesce(F.col("_ret"), F.lit(S.DEFAULT_RETENTION)).alias("retention_strategy"))


def with_risk(df: DataFrame, churn: str = "churn_rate") -> DataFrame:
    return df.withColumn("risk_level", rules.risk_level(churn))


def score_report(labelled: DataFrame, profiles: DataFrame, actions: DataFrame, id_col: str = "customerID",
                 cluster_col: str = "cluster_id") -> DataFrame:
    """(id, cluster, name, churn rate, size share, marketing, retention,
    risk) for already-assigned customers."""
    base = labelled.select(F.col(_q(id_col)), F.col(_q(cluster_col)).alias("cluster_id"))
    return with_risk(lookup_action(lookup_profile(base, profiles), actions))


def segment_overview(named_profiles: DataFrame) -> DataFrame:
    """id, name, size, share, churn %, mean tenure and monthly charge."""
    return named_profiles.select("cluster_id", "cluster_name", "size", "size_pct",
                                 (F.col("churn_rate") * 100).alias("churn_pct"), "tenure_mean",
                                 "MonthlyCharges_mean")


def feature_table(anova: DataFrame, n: int = 15) -> DataFrame:
    from segmint.operators.stats import top_features
    return top_features(anova, n)
