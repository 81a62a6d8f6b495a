"""Registered queries: exact stratified split and split reports.

The registered form orders rows by customer id inside each stratum (the
deterministic variant the oracle can express); the library default orders
by ``xxhash64(seed, id)``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from segmint.operators import split as SP
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes


def split_ctes(src: str = "subscribers", stratum: str = "Churn", order: str = "customerID",
               test: float = 0.2, val_adj: float = 0.25) -> str:
    return f"""strata AS (SELECT {stratum}, count(*) AS n_c FROM {src} GROUP BY {stratum}),
t1 AS (SELECT *, sum(n_c) OVER () AS n FROM strata),
t2 AS (SELECT *, n - CAST(ceil(CAST({test} AS DOUBLE) * n) AS BIGINT) AS n_draw FROM t1),
t3 AS (SELECT *, CAST(n_c AS DOUBLE) / CAST(n AS DOUBLE) * CAST(n_draw AS DOUBLE) AS cont FROM t2),
q1 AS (SELECT {stratum}, n_c, CAST(floor(cont) + CASE WHEN row_number() OVER (ORDER BY cont - floor(cont) DESC, {stratum})
                 <= n_draw - sum(floor(cont)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_keep FROM t3),
u1 AS (SELECT {stratum}, n_keep AS m_c, sum(n_keep) OVER () AS m FROM q1),
u2 AS (SELECT *, m - CAST(ceil(CAST({val_adj} AS DOUBLE) * m) AS BIGINT) AS m_draw FROM u1),
u3 AS (SELECT *, CAST(m_c AS DOUBLE) / CAST(m AS DOUBLE) * CAST(m_draw AS DOUBLE) AS cont FROM u2),
u4 AS (SELECT {stratum}, CAST(floor(cont) + CASE WHEN row_number() OVER (ORDER BY cont - floor(cont) DESC, {stratum})
                 <= m_draw - sum(floor(cont)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM u3),
quotas AS (SELECT q1.{stratum}, n_c, n_keep, n_train FROM q1 JOIN u4 USING ({stratum})),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY s.{stratum} ORDER BY {order}) - 1 AS rk FROM {src} s),
splits AS (SELECT r.* EXCLUDE (rk), CASE WHEN rk >= n_keep THEN 'test' WHEN rk >= n_train THEN 'validation'
                  ELSE 'train' END AS split FROM ranked r JOIN quotas q USING ({stratum}))"""


SPLIT_CTES = split_ctes()


@lru_cache(maxsize=4)
def fixture_split(spark, sf):
    """subscribers with a ``split`` column (id-ordered variant). Computed once
    per session and persisted: every split-consuming query reuses it."""
    from pyspark import StorageLevel
    return SP.split_stratified(fx.subscribers(spark, sf), order_key=F.col("customerID")).persist(
        StorageLevel.MEMORY_AND_DISK)


@register("binarize_target", W("SELECT customerID, CASE WHEN Churn='Yes' THEN 1 ELSE 0 END AS target FROM subscribers",
                               labelled=False))
def q_binarize_target(spark, sf):
    return SP.binarize_target(fx.subscribers(spark, sf)).select("customerID", "target")


@register("split_quotas", W("SELECT Churn, n_c, n_keep, n_train FROM quotas", labelled=False, extra=SPLIT_CTES))
def q_split_quotas(spark, sf):
    s = fx.subscribers(spark, sf)
    strata = s.groupBy("Churn").agg(F.count(F.lit(1)).alias("n_c"))
    return SP.split_quotas(strata, "Churn", 0.6, 0.2, 0.2)


@register("split_stratified", W("SELECT customerID, Churn, split FROM splits", labelled=False, extra=SPLIT_CTES))
def q_split_stratified(spark, sf):
    return fixture_split(spark, sf).select("customerID", "Churn", "split")


@register("split_summary", W("""SELECT coalesce(split, 'overall') AS split, n,
    CAST(n AS DOUBLE) * 100 / max(CASE WHEN split IS NULL THEN n END) OVER () AS pct, target_rate_pct
  FROM (SELECT split, count(*) AS n, avg(CASE WHEN Churn='Yes' THEN 1.0 ELSE 0.0 END) * 100 AS target_rate_pct
        FROM splits GROUP BY ROLLUP (split)) r""", labelled=False, extra=SPLIT_CTES),
          doubles=("pct", "target_rate_pct"))
def q_split_summary(spark, sf):
    return SP.split_summary(fixture_split(spark, sf))


@register("split_integrity", W("""SELECT sum(CASE WHEN ns > 1 THEN 1 ELSE 0 END)::BIGINT AS overlapping_ids,
    sum(nr)::BIGINT AS n_rows, count(*) AS n_distinct_ids, sum(nr) = count(*) AS complete,
    (sum(CASE WHEN ns > 1 THEN 1 ELSE 0 END) = 0 AND sum(nr) = count(*)) AS valid
  FROM (SELECT customerID, count(DISTINCT split) AS ns, count(*) AS nr FROM splits GROUP BY 1) p""",
                                labelled=False, extra=SPLIT_CTES))
def q_split_integrity(spark, sf):
    return SP.split_integrity(fixture_split(spark, sf))


@register("split_overlap", W("""SELECT a.sa AS split_a, a.sb AS split_b, count(s.customerID) AS n_overlap
  FROM (VALUES ('train','validation'), ('train','test'), ('validation','test')) a(sa, sb)
  LEFT JOIN (SELECT x.customerID, x.split AS sa, y.split AS sb FROM splits x JOIN splits y USING (customerID)) s
    ON s.sa = a.sa AND s.sb = a.sb GROUP BY 1, 2""", labelled=False, extra=SPLIT_CTES))
def q_split_overlap(spark, sf):
    return SP.split_overlap_pairs(fixture_split(spark, sf))


@register("train_val_union", W("SELECT customerID, split FROM splits WHERE split IN ('train', 'validation')",
                               labelled=False, extra=SPLIT_CTES))
def q_train_val_union(spark, sf):
    return SP.train_val_union(fixture_split(spark, sf)).select("customerID", "split")


def _top_sql(col: str) -> str:
    return f"""top_{col} AS (SELECT split, v AS "{col}_top", n * 100.0 / tot AS "{col}_top_pct" FROM (
  SELECT split, v, n, sum(n) OVER (PARTITION BY split) AS tot,
         row_number() OVER (PARTITION BY split ORDER BY n DESC, v) AS rn
  FROM (SELECT split, "{col}" AS v, count(*) AS n FROM splits WHERE "{col}" IS NOT NULL GROUP BY 1, 2) c) t
  WHERE rn = 1)"""


_SPLIT_PROFILE_SQL = W("""SELECT m.*, top_Contract.* EXCLUDE (split), top_InternetService.* EXCLUDE (split),
    top_PaymentMethod.* EXCLUDE (split)
  FROM (SELECT split, count(*) AS n, avg(tenure) AS tenure_mean, avg(MonthlyCharges) AS MonthlyCharges_mean,
               avg(TotalCharges) AS TotalCharges_mean, 19 AS n_features FROM splits GROUP BY split) m
  LEFT JOIN top_Contract USING (split) LEFT JOIN top_InternetService USING (split)
  LEFT JOIN top_PaymentMethod USING (split)""", labelled=False,
                       extra=SPLIT_CTES + ",\n" + ",\n".join(_top_sql(c) for c in
                                                               ["Contract", "InternetService", "PaymentMethod"]))


@register("split_profile", _SPLIT_PROFILE_SQL,
          doubles=("tenure_mean", "MonthlyCharges_mean", "TotalCharges_mean", "Contract_top_pct",
                   "InternetService_top_pct", "PaymentMethod_top_pct"))
def q_split_profile(spark, sf):
    return SP.split_profile(fixture_split(spark, sf))


_REPEATED = split_ctes("rep", "Churn", "customerID")


@register("split_repeated_ids", W("SELECT Churn, split, count(*) AS n FROM splits GROUP BY ALL", labelled=False,
                                  extra="rep AS (SELECT Churn, CASE WHEN Contract = 'One year' THEN NULL ELSE Contract END AS customerID FROM subscribers),\n" + _REPEATED))
def q_split_repeated_ids(spark, sf):
    """Quotas hold where many rows share an id or have none: the contract in the id's place."""
    df = fx.subscribers(spark, sf).select("Churn", F.when(F.col("Contract") != "One year", F.col("Contract")).alias("customerID"))
    return SP.split_stratified(df).groupBy("Churn", "split").agg(F.count(F.lit(1)).alias("n"))
