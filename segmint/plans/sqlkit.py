"""Small SQL text builders shared by the oracle queries."""

from __future__ import annotations

from segmint import spec as S

YES = lambda c: f"(CASE WHEN \"{c}\"='Yes' THEN 1 ELSE 0 END)"


def service_sum(services=S.SERVICES) -> str:
    return "(" + " + ".join(YES(c) for c in services) + ")"


def mode_cte(name: str, table: str, col: str, key: str = "cluster_id", out: str | None = None) -> str:
    """Most frequent non-null value per key, ties -> lowest value."""
    out = out or f"{col}_mode"
    return f"""{name} AS (
  SELECT {key}, v AS "{out}" FROM (
    SELECT {key}, v, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v) AS rn
    FROM (SELECT {key}, "{col}" AS v, count(*) AS n FROM {table} WHERE "{col}" IS NOT NULL GROUP BY 1, 2) mc
  ) mr WHERE rn = 1)"""


PROFILE_CTES = f"""g AS (
  SELECT cluster_id, count(*) AS size,
         avg(CASE WHEN Churn='Yes' THEN 1.0 ELSE 0.0 END) AS churn_rate,
         avg(tenure) AS tenure_mean, stddev_samp(tenure) AS tenure_std,
         avg(MonthlyCharges) AS MonthlyCharges_mean, stddev_samp(MonthlyCharges) AS MonthlyCharges_std,
         avg(TotalCharges) AS TotalCharges_mean, stddev_samp(TotalCharges) AS TotalCharges_std,
         avg(sd) AS service_diversity_mean, stddev_samp(sd) AS service_diversity_std
  FROM (SELECT *, {service_sum()} AS sd FROM labelled) x GROUP BY cluster_id),
{mode_cte('m1', 'labelled', 'Contract', out='contract_mode')},
{mode_cte('m2', 'labelled', 'InternetService', out='internet_mode')},
{mode_cte('m3', 'labelled', 'PaymentMethod', out='payment_mode')},
profiles AS (
  SELECT g.cluster_id, size, CAST(size AS DOUBLE) * 100 / sum(size) OVER () AS size_pct, churn_rate,
         tenure_mean, tenure_std, MonthlyCharges_mean, MonthlyCharges_std, TotalCharges_mean, TotalCharges_std,
         service_diversity_mean, service_diversity_std, contract_mode, internet_mode, payment_mode
  FROM g JOIN m1 USING (cluster_id) JOIN m2 USING (cluster_id) JOIN m3 USING (cluster_id))"""

PROFILE_DOUBLES = ("size_pct", "churn_rate", "tenure_mean", "tenure_std", "MonthlyCharges_mean",
                   "MonthlyCharges_std", "TotalCharges_mean", "TotalCharges_std", "service_diversity_mean",
                   "service_diversity_std")


def name_sql(p: str = "") -> str:
    """cluster name (first two descriptor words) from profile columns."""
    spend = (f"CASE WHEN {p}MonthlyCharges_mean > 80 THEN 'Premium' WHEN {p}MonthlyCharges_mean > 55 "
             f"THEN 'Standard' ELSE 'Budget' END")
    ten = (f"CASE WHEN {p}tenure_mean < 15 THEN 'New' WHEN {p}tenure_mean < 45 THEN 'Established' "
           f"ELSE 'Loyal' END")
    return f"({spend} || ' ' || {ten})"


def words_sql(p: str = "") -> str:
    """All descriptor words joined by a space."""
    parts = [
        f"CASE WHEN {p}MonthlyCharges_mean > 80 THEN 'Premium' WHEN {p}MonthlyCharges_mean > 55 THEN 'Standard' ELSE 'Budget' END",
        f"CASE WHEN {p}tenure_mean < 15 THEN 'New' WHEN {p}tenure_mean < 45 THEN 'Established' ELSE 'Loyal' END",
        f"CASE WHEN {p}service_diversity_mean > 4 THEN 'Tech-Savvy' WHEN {p}service_diversity_mean < 2 THEN 'Basic' END",
        f"CASE WHEN {p}churn_rate > 0.40 THEN 'High-Risk' WHEN {p}churn_rate < 0.15 THEN 'Stable' END",
        f"CASE WHEN {p}contract_mode = 'Two year' THEN 'Committed' WHEN {p}contract_mode = 'Month-to-month' THEN 'Flexible' END",
    ]
    return "concat_ws(' ', " + ", ".join(parts) + ")"


def insight_sql(p: str = "") -> str:
    pct = f"CAST(CAST(round_even({p}churn_rate * 100, 0) AS BIGINT) AS VARCHAR)"
    parts = [
        f"CASE WHEN {p}churn_rate > 0.35 THEN 'High churn risk (' || {pct} || '%)' "
        f"WHEN {p}churn_rate < 0.15 THEN 'Low churn risk (' || {pct} || '%)' END",
        f"CASE WHEN {p}tenure_mean < 15 THEN 'New customers' WHEN {p}tenure_mean > 50 THEN 'Long-tenure loyal customers' END",
        f"CASE WHEN {p}MonthlyCharges_mean > 80 THEN 'High spenders' WHEN {p}MonthlyCharges_mean < 40 THEN 'Price-sensitive' END",
        f"CASE WHEN {p}service_diversity_mean > 4 THEN 'Heavy service users' "
        f"WHEN {p}service_diversity_mean < 2 THEN 'Basic service users' END",
    ]
    joined = "concat_ws('; ', " + ", ".join(parts) + ")"
    return f"(CASE WHEN {joined} = '' THEN 'Mixed characteristics' ELSE {joined} END)"


def marketing_sql(p: str = "") -> str:
    return (f"(CASE WHEN {p}churn_rate > 0.35 THEN '{S.MKT_URGENT}' WHEN {p}tenure_mean < 15 THEN '{S.MKT_ONBOARD}' "
            f"WHEN {p}MonthlyCharges_mean > 80 THEN '{S.MKT_PREMIUM}' WHEN {p}service_diversity_mean < 2 "
            f"THEN '{S.MKT_CROSS}' ELSE '{S.MKT_DEFAULT}' END)")


def retention_sql(p: str = "") -> str:
    return (f"(CASE WHEN {p}churn_rate > 0.40 THEN '{S.RET_IMMEDIATE}' WHEN {p}churn_rate > 0.25 "
            f"THEN '{S.RET_PROACTIVE}' WHEN {p}contract_mode = 'Month-to-month' THEN '{S.RET_CONVERT}' "
            f"ELSE '{S.RET_LOYALTY}' END)")


def risk_sql(c: str = "churn_rate") -> str:
    return f"(CASE WHEN {c} >= 0.40 THEN 'High' WHEN {c} >= 0.25 THEN 'Medium' ELSE 'Low' END)"


NAMED_CTE = f"""named0 AS (SELECT *, {name_sql()} AS base_name FROM profiles),
named AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY base_name ORDER BY cluster_id) > 1
                    THEN base_name || ' (' || CAST(cluster_id AS VARCHAR) || ')' ELSE base_name END AS cluster_name
          FROM named0)"""
