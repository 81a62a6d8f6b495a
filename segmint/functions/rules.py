"""Column expressions for the naming, insight, action and risk rules.

All rules are plain ``when`` chains over profile columns, so they stay inside
whole-stage codegen and work on a profile table of any size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segmint import spec as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def descriptors(monthly="MonthlyCharges_mean", tenure="tenure_mean", diversity="service_diversity_mean",
                churn="churn_rate", contract="contract_mode") -> Column:
    """All name words in rule order: spending, tenure, service, risk, contract.
    Missing inputs take the defaults 0 / 0 / 0 / 0 / Month-to-month."""
    m = F.coalesce(_c(monthly), F.lit(0.0))
    t = F.coalesce(_c(tenure), F.lit(0.0))
    d = F.coalesce(_c(diversity), F.lit(0.0))
    r = F.coalesce(_c(churn), F.lit(0.0))
    k = F.coalesce(_c(contract), F.lit("Month-to-month"))
    spend = F.lit(S.SPENDING_DEFAULT)
    for cut, word in reversed(S.SPENDING_WORDS):
        spend = F.when(m > cut, word).otherwise(spend)
    ten = F.lit(S.TENURE_DEFAULT)
    for cut, word in reversed(S.TENURE_WORDS):
        ten = F.when(t < cut, word).otherwise(ten)
    svc = F.when(d > S.SERVICE_HIGH, S.SERVICE_HIGH_WORD).when(d < S.SERVICE_LOW, S.SERVICE_LOW_WORD)
    risk = F.when(r > S.RISK_HIGH, S.RISK_HIGH_WORD).when(r < S.RISK_LOW, S.RISK_LOW_WORD)
    con = F.lit(None).cast("string")
    for value, word in S.CONTRACT_WORDS.items():
        con = F.when(k == value, word).otherwise(con)
    return F.filter(F.array(spend, ten, svc, risk, con), lambda x: x.isNotNull())


def name_from_descriptors(desc: Column, cluster_id="cluster_id") -> Column:
    """First two words joined by a space (one word alone, or ``Segment <id>``)."""
    return (F.when(F.size(desc) >= 2, F.concat_ws(" ", F.slice(desc, 1, 2)))
            .when(F.size(desc) == 1, F.element_at(desc, 1))
            .otherwise(F.concat(F.lit("Segment "), _c(cluster_id).cast("string"))))


def _pct0(x: Column) -> Column:
    """Percent with no decimals, rounding half to even like printf."""
    return F.bround(x * 100, 0).cast("long").cast("string")


def primary_insight(churn="churn_rate", tenure="tenure_mean", monthly="MonthlyCharges_mean",
                    diversity="service_diversity_mean") -> Column:
    r = F.coalesce(_c(churn), F.lit(0.0))
    t = F.coalesce(_c(tenure), F.lit(0.0))
    m = F.coalesce(_c(monthly), F.lit(0.0))
    d = F.coalesce(_c(diversity), F.lit(0.0))
    parts = F.array(
        F.when(r > S.INSIGHT_HIGH_CHURN, F.concat(F.lit("High churn risk ("), _pct0(r), F.lit("%)")))
         .when(r < S.INSIGHT_LOW_CHURN, F.concat(F.lit("Low churn risk ("), _pct0(r), F.lit("%)"))),
        F.when(t < S.INSIGHT_NEW_TENURE, S.TXT_NEW).when(t > S.INSIGHT_LOYAL_TENURE, S.TXT_LOYAL),
        F.when(m > S.INSIGHT_HIGH_SPEND, S.TXT_HIGH_SPEND).when(m < S.INSIGHT_LOW_SPEND, S.TXT_LOW_SPEND),
        F.when(d > S.INSIGHT_HEAVY_SERVICE, S.TXT_HEAVY).when(d < S.INSIGHT_BASIC_SERVICE, S.TXT_BASIC),
    )
    kept = F.filter(parts, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.concat_ws("; ", kept)).otherwise(F.lit(S.TXT_MIXED))


def marketing_action(churn="churn_rate", tenure="tenure_mean", monthly="MonthlyCharges_mean",
                     diversity="service_diversity_mean") -> Column:
    r = F.coalesce(_c(churn), F.lit(0.0))
    t = F.coalesce(_c(tenure), F.lit(0.0))
    m = F.coalesce(_c(monthly), F.lit(0.0))
    d = F.coalesce(_c(diversity), F.lit(0.0))
    return (F.when(r > S.INSIGHT_HIGH_CHURN, S.MKT_URGENT)
            .when(t < S.INSIGHT_NEW_TENURE, S.MKT_ONBOARD)
            .when(m > S.INSIGHT_HIGH_SPEND, S.MKT_PREMIUM)
            .when(d < S.INSIGHT_BASIC_SERVICE, S.MKT_CROSS)
            .otherwise(S.MKT_DEFAULT))


def retention_strategy(churn="churn_rate", contract="contract_mode") -> Column:
    r = F.coalesce(_c(churn), F.lit(0.0))
    k = F.coalesce(_c(contract), F.lit("Month-to-month"))
    return (F.when(r > S.RISK_HIGH, S.RET_IMMEDIATE)
            .when(r > S.MEDIUM_CHURN, S.RET_PROACTIVE)
            .when(k == "Month-to-month", S.RET_CONVERT)
            .otherwise(S.RET_LOYALTY))


def risk_level(churn="churn_rate") -> Column:
    """Inclusive thresholds: >= 0.40 High, >= 0.25 Medium, else Low."""
    r = _c(churn)
    return (F.when(r >= S.HIGH_CHURN, S.RISK_WORDS[0])
            .when(r >= S.MEDIUM_CHURN, S.RISK_WORDS[1])
            .otherwise(S.RISK_WORDS[2]))


def silhouette_band(s="silhouette") -> Column:
    x = _c(s)
    return (F.when(x > S.SILHOUETTE_STRONG, "strong")
            .when(x > S.SILHOUETTE_REASONABLE, "reasonable").otherwise("weak"))


def p_band(p="p_value") -> Column:
    x = _c(p)
    return (F.when(x < S.P_STRONG, "highly significant")
            .when(x < S.P_SIG, "significant").otherwise("not significant"))


def v_band(v="cramers_v") -> Column:
    x = _c(v)
    return (F.when(x < S.V_WEAK, "negligible")
            .when(x < S.V_MODERATE, "small")
            .when(x < S.V_STRONG, "medium").otherwise("large"))
