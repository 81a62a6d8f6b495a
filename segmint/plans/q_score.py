"""Registered queries: scoring (batch and streaming) with the fixed-label
segments."""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import functions as F

from segmint import spec as S
from segmint.operators import profile as P
from segmint.operators import score as SC
from segmint.operators.scorer import latest_version, load_scorer, publish
from segmint.plans import sqlkit as K
from segmint.plans.q_features import FEATS_CTE, FEATURE_NAMES, FIT_CTE, fitted_model
from segmint.plans.q_split import SPLIT_CTES, fixture_split
from segmint.plans.registry import register
from segmint.session import ensure_checkpoint_dir, materialize
from segmint.sources import fixtures as fx
from segmint.streaming import stream as ST

W = fx.with_fixture_ctes


@lru_cache(maxsize=4)
def _tables(spark, sf):
    """Named profiles and actions of the fixed-label segments (k rows)."""
    named = P.assign_names(P.cluster_profiles(fx.labelled(spark, sf))).cache()
    return named, P.business_actions(named).cache()


def _validation_sql() -> str:
    checks = [f"""CASE WHEN coalesce("{c}" IN ({', '.join(repr(v) for v in allowed)}), false) THEN NULL
      ELSE '{c}: not one of {", ".join(map(str, allowed))}' END""" for c, allowed in S.DOMAINS.items()]
    checks.append("CASE WHEN coalesce(tenure >= 0 AND tenure <= 72, false) THEN NULL ELSE 'tenure: outside 0..72' END")
    checks.append("CASE WHEN coalesce(MonthlyCharges >= 0.0 AND MonthlyCharges <= 150.0, false) THEN NULL "
                  "ELSE 'MonthlyCharges: outside 0.0..150.0' END")
    return checks


_CHECKS = _validation_sql()


@register("validate_customers", W("SELECT customerID, (" + " + ".join(f"(CASE WHEN ({c}) IS NULL THEN 0 ELSE 1 END)"
                                                                       for c in _CHECKS) +
                                  ")::INT AS n_errors, concat_ws('; ', " + ", ".join(_CHECKS) + ") AS errors "
                                  "FROM subscribers", labelled=False))
def q_validate_customers(spark, sf):
    v = SC.validate_customers(fx.subscribers(spark, sf))
    return v.select("customerID", F.size("errors").alias("n_errors"), F.concat_ws("; ", "errors").alias("errors"))


@register("approximate_total", W("""SELECT customerID, coalesce(TotalCharges, MonthlyCharges * (tenure + 1)) AS TotalCharges
  FROM subscribers""", labelled=False), doubles=("TotalCharges",))
def q_approximate_total(spark, sf):
    return SC.approximate_total(fx.subscribers(spark, sf)).select("customerID", "TotalCharges")


_LOOKUP = W(f"""SELECT l.customerID, l.cluster_id, coalesce(n.cluster_name, 'Cluster ' || CAST(l.cluster_id AS VARCHAR))
    AS cluster_name, coalesce(n.churn_rate, 0.0) AS churn_rate, coalesce(n.size_pct, 0.0) AS size_pct,
  coalesce({K.marketing_sql('n.')}, '{S.DEFAULT_MARKETING}') AS marketing_action,
  coalesce({K.retention_sql('n.')}, '{S.DEFAULT_RETENTION}') AS retention_strategy,
  {K.risk_sql('coalesce(n.churn_rate, 0.0)')} AS risk_level
FROM labelled l LEFT JOIN named n USING (cluster_id)""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE)


_F = FEATURE_NAMES
_CENTS = "cents AS (SELECT row_number() OVER (ORDER BY Contract) - 1 AS cid, " + ", ".join(
    f'avg(CAST(f."{c}" AS DOUBLE)) AS k_{i}' for i, c in enumerate(_F)) + """ FROM feats f
  JOIN (SELECT customerID, Contract FROM splits WHERE split = 'train') t USING (customerID) GROUP BY Contract)"""
_SCORED = "scored AS (SELECT customerID, CAST(cid AS INT) AS cluster_id FROM (SELECT f.customerID, cid, row_number() OVER (PARTITION BY f.customerID ORDER BY " + \
    " + ".join(f'(f."{c}" - k_{i}) * (f."{c}" - k_{i})' for i, c in enumerate(_F)) + ", cid) AS rn FROM feats f CROSS JOIN cents) q WHERE rn = 1)"
_REAL = W(_LOOKUP[_LOOKUP.index("SELECT l.customerID"):].replace("FROM labelled l", "FROM scored l"),
          extra=",\n".join([K.PROFILE_CTES, K.NAMED_CTE, SPLIT_CTES, FIT_CTE, FEATS_CTE, _CENTS, _SCORED]))


@lru_cache(maxsize=4)
def given_centers(spark, sf):
    """Centroids in feature space for the checks: means of the training rows
    of each contract (three rows of 35 numbers)."""
    m = fitted_model(spark, sf)
    train = fixture_split(spark, sf).where("split = 'train'")
    feats = m.transform(train).join(train.select("customerID", "Contract"), "customerID")
    rows = feats.groupBy("Contract").agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"k_{i}") for i, c in enumerate(m.feature_names)])
    return [[r[f"k_{i}"] for i in range(len(m.feature_names))] for r in rows.orderBy("Contract").collect()]


def _accounts(spark, sf):
    """All accounts, as the session's split has them: made once."""
    return fixture_split(spark, sf).drop("split")


def model_dir(spark, sf) -> str:
    """The session's model directory; a first version is published where there is none."""
    folder = f"{ensure_checkpoint_dir(spark)}/models/{hashlib.sha256(sf.encode()).hexdigest()[:16]}"
    if latest_version(spark, folder) is None:
        named = materialize(P.assign_names(P.cluster_profiles(fx.label_fixed(_accounts(spark, sf)))), "segments")
        publish(folder, fitted_model(spark, sf), given_centers(spark, sf), named, P.business_actions(named))
    return folder


def _score(spark, sf, customers):
    return load_scorer(spark, model_dir(spark, sf)).score(customers).drop("model_version")


@register("score_customers", _REAL, doubles=("churn_rate", "size_pct"))
def q_score_customers(spark, sf):
    """Every account scored by the saved model: fitted features, the nearest of
    its centroids, and the segment's name, churn, share, actions and risk level."""
    return _score(spark, sf, _accounts(spark, sf))


@register("score_report", _LOOKUP, doubles=("churn_rate", "size_pct"))
def q_score_report(spark, sf):
    """The same report for accounts that already have a segment."""
    named, actions = _tables(spark, sf)
    return SC.score_report(fx.labelled(spark, sf), named, actions)


@register("lookup_profile", W("""SELECT l.customerID, l.cluster_id,
    coalesce(n.cluster_name, 'Cluster ' || CAST(l.cluster_id AS VARCHAR)) AS cluster_name,
    coalesce(n.churn_rate, 0.0) AS churn_rate, coalesce(n.size_pct, 0.0) AS size_pct
  FROM (SELECT customerID, CASE WHEN Contract = 'Two year' THEN 3 ELSE cluster_id END AS cluster_id FROM labelled) l
  LEFT JOIN named n USING (cluster_id)""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE),
          doubles=("churn_rate", "size_pct"))
def q_lookup_profile(spark, sf):
    """Profile lookup where some accounts fall in a cluster (3) that has no
    profile row: they get the default name, 0, 0."""
    named, _ = _tables(spark, sf)
    lab = fx.labelled(spark, sf).select(
        "customerID", F.when(F.col("Contract") == "Two year", 3).otherwise(F.col("cluster_id")).alias("cluster_id"))
    return SC.lookup_profile(lab, named)


@register("lookup_action", W(f"""SELECT l.customerID, l.cluster_id,
    CASE WHEN n.cluster_id IS NULL THEN '{S.DEFAULT_MARKETING}' ELSE {K.marketing_sql('n.')} END AS marketing_action,
    CASE WHEN n.cluster_id IS NULL THEN '{S.DEFAULT_RETENTION}' ELSE {K.retention_sql('n.')} END AS retention_strategy
  FROM (SELECT customerID, CASE WHEN Contract = 'Two year' THEN 3 ELSE cluster_id END AS cluster_id FROM labelled) l
  LEFT JOIN named n USING (cluster_id)""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE))
def q_lookup_action(spark, sf):
    _, actions = _tables(spark, sf)
    lab = fx.labelled(spark, sf).select(
        "customerID", F.when(F.col("Contract") == "Two year", 3).otherwise(F.col("cluster_id")).alias("cluster_id"))
    return SC.lookup_action(lab, actions)


@register("segment_overview", W("""SELECT cluster_id, cluster_name, size, size_pct, churn_rate * 100 AS churn_pct,
  tenure_mean, MonthlyCharges_mean FROM named""", extra=K.PROFILE_CTES + ",\n" + K.NAMED_CTE),
          doubles=("size_pct", "churn_pct", "tenure_mean", "MonthlyCharges_mean"))
def q_segment_overview(spark, sf):
    named, _ = _tables(spark, sf)
    return SC.segment_overview(named)


@register("score_stream", _REAL, doubles=("churn_rate", "size_pct"))
def q_score_stream(spark, sf):
    """``score_customers`` as a Structured Streaming job: the orders file is
    the stream source, customers and line flags are static tables; each
    micro-batch loads the latest model version, and the written rows are read
    back."""
    sides = fx.static_sides(spark, sf)
    orders_schema = fx.read_table(spark, sf, "orders").schema
    src = (spark.readStream.schema(orders_schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "orders.parquet").parquet(sf))
    out = ST.score_stream(src, model_dir(spark, sf), *ST.stream_paths(spark), prepare=lambda orders: fx.subscribers_from_orders(spark, sf, orders, sides))
    return out.drop("model_version")
