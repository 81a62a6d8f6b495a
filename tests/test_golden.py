"""Golden numbers of the published run and pinned semantics."""
import math

import pytest
from pyspark.sql import functions as F

from segmint.functions import special
from segmint.operators import kmeans as KM
from segmint.operators import profile as P
from segmint.operators import stats as ST


def test_chi2_and_f_tails():
    assert math.isclose(special.chi2_sf(196.1885, 2), 2.5015e-43, rel_tol=1e-3)
    assert math.isclose(special.f_sf(98.68, 2, 5631), 7.55e-43, rel_tol=1e-2)
    assert math.isclose(special.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(special.f_ppf(0.95, 2, 10), 4.102821015130399, rel_tol=1e-6)


def test_contingency_chi2_v_wilson(spark):
    # published test-set contingency: (cluster, churned) counts
    cells = [(0, 0, 384), (0, 1, 62), (1, 0, 289), (1, 1, 25), (2, 0, 362), (2, 1, 287)]
    rows = [(c, y) for c, y, n in cells for _ in range(n)]
    df = spark.createDataFrame(rows, "cluster_id int, churn int")
    r = ST.chi_square(df, "cluster_id", "churn").first()
    assert math.isclose(r.chi2, 196.19, abs_tol=0.01)
    assert r.dof == 2
    assert math.isclose(r.p_value, 2.50e-43, rel_tol=1e-2)
    assert math.isclose(r.cramers_v, 0.371, abs_tol=5e-4)
    rates = {x.cluster_id: x for x in ST.target_rate_by_cluster(df, target="churn", positive=1).collect()}
    assert (round(rates[0].ci_lower * 100, 1), round(rates[0].ci_upper * 100, 1)) == (11.0, 17.4)
    assert (round(rates[1].ci_lower * 100, 1), round(rates[1].ci_upper * 100, 1)) == (5.5, 11.5)
    assert (round(rates[2].ci_lower * 100, 1), round(rates[2].ci_upper * 100, 1)) == (40.4, 48.1)


def test_wilson_edges(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10)], "s long, n long")
    out = ST.wilson_interval(df, "s", "n").collect()
    assert (out[0].ci_lower, out[0].ci_upper) == (0.0, 0.0)
    assert abs(out[1].ci_lower) < 1e-12 and abs(out[2].ci_upper - 1.0) < 1e-12


SWEEP = [(2, 0.2450), (3, 0.2524), (4, 0.2401), (5, 0.1965), (6, 0.1922), (7, 0.1854), (8, 0.1920),
         (9, 0.1894), (10, 0.1707)]


def test_business_rules_published_sweep(spark):
    r = KM.select_k_business_rules(spark.createDataFrame(SWEEP, "k int, silhouette double")).first()
    assert (r.mathematical_optimum_k, r.final_k, r.business_override) == (3, 3, False)


@pytest.mark.parametrize("scores,final", [
    ([(2, 0.30), (3, 0.27), (4, 0.1)], 3),   # K=2 best, K=3 within 0.05
    ([(2, 0.30), (3, 0.20), (4, 0.26)], 4),   # first K>=3 inside the tolerance
    ([(2, 0.30), (3, 0.10), (4, 0.1)], 3),    # none close -> 3
    ([(2, 0.25), (3, 0.2), (7, 0.4)], 2),     # K>6 -> best K<=6, may be 2
    ([(4, 0.3), (5, 0.3)], 4),                # tie -> lowest K
])
def test_business_rules_cases(spark, scores, final):
    r = KM.select_k_business_rules(spark.createDataFrame(scores, "k int, silhouette double")).first()
    assert r.final_k == final


# published segment profiles (cluster, size, churn, tenure, monthly, diversity, contract)
PROFILES = [
    (0, 1939, 0.15317173800928313, 56.01083032490975, 88.89938112429088, 3.9473955647240846, "Two year"),
    (1, 1218, 0.0722495894909688, 30.236453201970445, 21.14889162561576, 0.0008210180623973727, "Two year"),
    (2, 2477, 0.44812272910779166, 15.174808235769076, 67.69485264432781, 1.5906338312474768, "Month-to-month"),
]
# published actions for those profiles
ACTIONS = {
    0: ("Premium Loyal", "Long-tenure loyal customers; High spenders", "Premium upselling and loyalty rewards",
        "Loyalty rewards: referral bonuses, exclusive benefits"),
    1: ("Budget Established", "Low churn risk (7%); Price-sensitive; Basic service users",
        "Cross-selling campaign for add-on services", "Loyalty rewards: referral bonuses, exclusive benefits"),
    2: ("Standard Established", "High churn risk (45%); Basic service users",
        "Urgent retention campaign with personalized offers",
        "Immediate intervention: dedicated retention team, contract incentives"),
}


def test_names_and_actions_match_published(spark):
    df = spark.createDataFrame(PROFILES, "cluster_id int, size long, churn_rate double, tenure_mean double, "
                                         "MonthlyCharges_mean double, service_diversity_mean double, "
                                         "contract_mode string")
    named = P.assign_names(df.withColumn("size_pct", F.lit(0.0)))
    got = {r.cluster_id: (r.cluster_name, r.primary_insight, r.marketing_action, r.retention_strategy)
           for r in P.business_actions(named).collect()}
    assert got == ACTIONS


def test_unique_names(spark):
    df = spark.createDataFrame([(0, "A"), (1, "A"), (2, "B"), (3, "A")], "cluster_id int, base string")
    got = {r.cluster_id: r.cluster_name for r in P.unique_names(df, "base").collect()}
    assert got == {0: "A", 1: "A (1)", 2: "B", 3: "A (3)"}


def test_mode_tie_lowest(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (0, "b"), (0, "a")], "cluster_id int, v string")
    assert P.cluster_mode(df, "v").first()["v_mode"] == "a"
