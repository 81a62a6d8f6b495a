"""Registered queries: the feature pipeline (fit on the training split,
apply to every account)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from segmint import spec as S
from segmint.operators import features as FT
from segmint.plans import sqlkit as K
from segmint.plans.q_split import SPLIT_CTES, fixture_split
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes

_TC = "(CASE WHEN TotalCharges IS NULL OR isnan(TotalCharges) OR tenure = 0 THEN MonthlyCharges ELSE TotalCharges END)"
_NUMS = {"tenure": "CAST(tenure AS DOUBLE)", "MonthlyCharges": "MonthlyCharges", "TotalCharges": _TC,
         "avg_monthly_spend": f"({_TC} / (tenure + 1))", "service_diversity": f"CAST({K.service_sum()} AS DOUBLE)"}
_VOCAB = {c: sorted(S.DOMAINS[c]) for c in S.CATEGORICAL}

FIT_CTE = "fit AS (SELECT quantile_cont(MonthlyCharges, 0.75) AS t_m, quantile_cont(CAST(tenure AS DOUBLE), 0.75) AS t_t, " + \
    ", ".join(f"avg({e}) AS m_{c}, CASE WHEN coalesce(stddev_pop({e}), 0) = 0 THEN 1 ELSE stddev_pop({e}) END AS s_{c}"
              for c, e in _NUMS.items()) + " FROM splits WHERE split = 'train')"

_TG = ("(CASE WHEN tenure >= 0 AND tenure <= 12 THEN 0 WHEN tenure > 12 AND tenure <= 48 THEN 1 "
       "WHEN tenure > 48 AND tenure <= 72 THEN 2 END)")
_ENG = {
    "avg_monthly_spend": f"({_TC} / (tenure + 1))",
    "tenure_group": _TG,
    "service_diversity": K.service_sum(),
    "contract_commitment": "(CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 END)",
    "auto_payment": "(CASE WHEN PaymentMethod IN ('Bank transfer (automatic)', 'Credit card (automatic)') THEN 1 ELSE 0 END)",
    "high_value_flag": "(CASE WHEN MonthlyCharges > t_m AND tenure > t_t THEN 1 ELSE 0 END)",
    "family_status": "((CASE WHEN Partner='Yes' THEN 1 ELSE 0 END) + 2 * (CASE WHEN Dependents='Yes' THEN 1 ELSE 0 END))",
}


def _dummy_sql() -> list[str]:
    return [f"""(CASE WHEN "{c}" = '{v}' THEN 1 ELSE 0 END) AS "{c}_{v}" """ for c, values in _VOCAB.items()
            for v in values[1:]]


def _binary_sql() -> list[str]:
    return [f"""(CASE WHEN "{c}" = 'Yes' THEN 1 WHEN "{c}" = 'No' THEN 0 END) AS "{c}" """ for c in S.BINARY_YES_NO]


def _scaled(c: str) -> str:
    return f'(({_NUMS[c]} - m_{c}) / s_{c}) AS "{c}"'


def _feature_select() -> str:
    names = FT.fitted_feature_names(S.RAW_COLUMNS, _VOCAB)
    exprs = {"SeniorCitizen": "SeniorCitizen"}
    for c in S.BINARY_YES_NO:
        exprs[c] = f"""(CASE WHEN "{c}" = 'Yes' THEN 1 WHEN "{c}" = 'No' THEN 0 END) AS "{c}" """
    for c in _NUMS:
        exprs[c] = _scaled(c)
    for c, e in _ENG.items():
        if c not in exprs:
            exprs[c] = f'{e} AS "{c}"'
    for c, values in _VOCAB.items():
        for v in values[1:]:
            exprs[f"{c}_{v}"] = f"""(CASE WHEN "{c}" = '{v}' THEN 1 ELSE 0 END) AS "{c}_{v}" """
    return ", ".join(exprs[n] for n in names) + ", customerID, Churn"


@lru_cache(maxsize=8)
def _model(spark, sf):
    return FT.SegmentFeatures().fit(fixture_split(spark, sf).where("split = 'train'"))


def fitted_model(spark, sf):
    return _model(spark, sf)


@register("impute_total_charges", W(f"SELECT customerID, {_TC} AS TotalCharges FROM subscribers", labelled=False),
          doubles=("TotalCharges",))
def q_impute_total_charges(spark, sf):
    return FT.impute_total_charges(fx.subscribers(spark, sf)).select("customerID", "TotalCharges")


@register("fit_high_value_thresholds", W("SELECT t_m AS monthly_threshold, t_t AS tenure_threshold FROM fit",
                                         labelled=False, extra=SPLIT_CTES + ",\n" + FIT_CTE),
          doubles=("monthly_threshold", "tenure_threshold"))
def q_fit_high_value_thresholds(spark, sf):
    return FT.fit_high_value_thresholds(fixture_split(spark, sf).where("split = 'train'"))


@register("engineer_features", W("SELECT customerID, " + ", ".join(f'{e} AS "{c}"' for c, e in _ENG.items()) +
                                 " FROM subscribers CROSS JOIN fit", labelled=False,
                                 extra=SPLIT_CTES + ",\n" + FIT_CTE), doubles=("avg_monthly_spend",))
def q_engineer_features(spark, sf):
    st = fitted_model(spark, sf).state
    df = FT.engineer_features(fx.subscribers(spark, sf), st["monthly_threshold"], st["tenure_threshold"])
    return df.select("customerID", *FT.ENGINEERED)


_VOCAB_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT "{c}") AS n_values,
  array_to_string(list_sort(list(DISTINCT CAST("{c}" AS VARCHAR))), '|') AS "values"
  FROM splits WHERE split = 'train'""" for c in S.CATEGORICAL)


@register("fit_onehot_vocab", W(_VOCAB_SQL, labelled=False, extra=SPLIT_CTES))
def q_fit_onehot_vocab(spark, sf):
    v = FT.fit_onehot_vocab(fixture_split(spark, sf).where("split = 'train'"), S.CATEGORICAL)
    return v.select("column", F.size("values").cast("long").alias("n_values"),
                    F.concat_ws("|", "values").alias("values"))


@register("one_hot_drop_first", W("SELECT customerID, " + ", ".join(_dummy_sql()) + " FROM subscribers",
                                  labelled=False))
def q_one_hot_drop_first(spark, sf):
    vocab = fitted_model(spark, sf).state["vocab"]
    return FT.one_hot_drop_first(fx.subscribers(spark, sf).select("customerID", *S.CATEGORICAL), vocab)


@register("encode_binary", W("SELECT customerID, SeniorCitizen, " + ", ".join(_binary_sql()) + " FROM subscribers",
                             labelled=False))
def q_encode_binary(spark, sf):
    return FT.encode_binary(fx.subscribers(spark, sf).select("customerID", "SeniorCitizen", *S.BINARY_YES_NO),
                            S.BINARY_YES_NO)


_SCALER_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", avg({e}) AS mean, stddev_pop({e}) AS std FROM splits WHERE split = 'train'"""
    for c, e in _NUMS.items())


@register("fit_scaler", W(_SCALER_SQL, labelled=False, extra=SPLIT_CTES), doubles=("mean", "std"))
def q_fit_scaler(spark, sf):
    train = fixture_split(spark, sf).where("split = 'train'")
    return FT.fit_scaler(FT.numeric_frame(train), list(_NUMS))


@register("apply_scaler", W("SELECT customerID, " + ", ".join(_scaled(c) for c in _NUMS) +
                            " FROM subscribers CROSS JOIN fit", labelled=False, extra=SPLIT_CTES + ",\n" + FIT_CTE),
          doubles=tuple(_NUMS))
def q_apply_scaler(spark, sf):
    m = fitted_model(spark, sf).state["moments"]
    nf = fx.subscribers(spark, sf).select("customerID", *_numeric_exprs())
    return FT.apply_scaler(nf, {c: tuple(v) for c, v in m.items()})


def _numeric_exprs():
    total = FT.imputed_total()
    return [F.col("tenure").cast("double").alias("tenure"), F.col("MonthlyCharges").cast("double").alias("MonthlyCharges"),
            total.alias("TotalCharges"), FT.avg_monthly_spend(total, F.col("tenure")).alias("avg_monthly_spend"),
            FT.service_diversity(S.SERVICES).cast("double").alias("service_diversity")]


_FEATURE_DOUBLES = tuple(_NUMS)


@register("segment_features", W("SELECT " + _feature_select() + " FROM subscribers CROSS JOIN fit", labelled=False,
                                extra=SPLIT_CTES + ",\n" + FIT_CTE), doubles=_FEATURE_DOUBLES)
def q_segment_features(spark, sf):
    """Fit on train, transform every account: 35 features + id + target."""
    return fitted_model(spark, sf).transform(fx.subscribers(spark, sf))


@register("iqr_outliers", W(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", sum(CASE WHEN x < lo OR x > hi THEN 1 ELSE 0 END)::BIGINT AS n_outliers,
  CAST(sum(CASE WHEN x < lo OR x > hi THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS pct_outliers,
  lo AS lower_bound, hi AS upper_bound, min(CASE WHEN x < lo OR x > hi THEN x END) AS min_outlier,
  max(CASE WHEN x < lo OR x > hi THEN x END) AS max_outlier
  FROM (SELECT CAST("{c}" AS DOUBLE) AS x FROM splits WHERE split = 'train') t CROSS JOIN
   (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
     (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.25) AS q1, quantile_cont(CAST("{c}" AS DOUBLE), 0.75) AS q3
      FROM splits WHERE split = 'train') q0) q GROUP BY lo, hi""" for c in S.RAW_NUMERICAL),
    labelled=False, extra=SPLIT_CTES),
    doubles=("pct_outliers", "lower_bound", "upper_bound", "min_outlier", "max_outlier"))
def q_iqr_outliers(spark, sf):
    return FT.iqr_outliers(fixture_split(spark, sf).where("split = 'train'"), S.RAW_NUMERICAL)


FEATS_CTE = "feats AS (SELECT " + _feature_select() + " FROM subscribers CROSS JOIN fit)"
FEATURE_NAMES = FT.fitted_feature_names(S.RAW_COLUMNS, _VOCAB)


@register("assemble_features", W("SELECT customerID, Churn, unnest(range(%d))::INT AS pos, unnest([%s]) AS value FROM feats" % (
    len(FEATURE_NAMES), ", ".join(f'CAST("{c}" AS DOUBLE)' for c in FEATURE_NAMES)), labelled=False,
    extra=SPLIT_CTES + ",\n" + FIT_CTE + ",\n" + FEATS_CTE), doubles=("value",))
def q_assemble_features(spark, sf):
    """The features vector of every account, element by element."""
    m = fitted_model(spark, sf)
    v = m.assemble(m.transform(fx.subscribers(spark, sf)))
    return v.select("customerID", "Churn", F.posexplode(vector_to_array("features")).alias("pos", "value"))


@register("transform_splits", W("SELECT f.*, s.split FROM feats f JOIN splits s USING (customerID)", labelled=False,
                                extra=SPLIT_CTES + ",\n" + FIT_CTE + ",\n" + FEATS_CTE), doubles=_FEATURE_DOUBLES)
def q_transform_splits(spark, sf):
    return FT.transform_splits(fitted_model(spark, sf), fixture_split(spark, sf))


_ENGINEERED_CTE = "eng AS (SELECT cluster_id, " + ", ".join(f"{_ENG[c]} AS {c}" for c in ("tenure_group", "high_value_flag", "auto_payment", "family_status")) + \
    " FROM labelled CROSS JOIN fit)"


def _mode_sql(c: str) -> str:
    return f"""(SELECT cluster_id, {c} AS {c}_mode FROM (SELECT cluster_id, {c}, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, {c}) AS rn
      FROM eng WHERE {c} IS NOT NULL GROUP BY 1, 2) q WHERE rn = 1) m_{c}"""


@register("engineered_profile_stats", W(f"""SELECT cluster_id, tenure_group_mode, high_value_pct, auto_payment_pct, family_status_mode
  FROM (SELECT cluster_id, avg(high_value_flag) * 100 AS high_value_pct, avg(auto_payment) * 100 AS auto_payment_pct FROM eng GROUP BY 1) e
  LEFT JOIN {_mode_sql("tenure_group")} USING (cluster_id) LEFT JOIN {_mode_sql("family_status")} USING (cluster_id)""",
                                        extra=SPLIT_CTES + ",\n" + FIT_CTE + ",\n" + _ENGINEERED_CTE), doubles=("high_value_pct", "auto_payment_pct"))
def q_engineered_profile_stats(spark, sf):
    """Profile statistics of the engineered columns."""
    from segmint.operators.profile import cluster_profiles
    st = fitted_model(spark, sf).state
    df = FT.engineer_features(fx.labelled(spark, sf), st["monthly_threshold"], st["tenure_threshold"])
    return cluster_profiles(df).select("cluster_id", "tenure_group_mode", "high_value_pct", "auto_payment_pct", "family_status_mode")


_PAIRS = " UNION ALL ".join(f"""SELECT {i} AS place, '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value, customerID FROM {{src}} WHERE "{c}" IS NOT NULL""" for i, c in enumerate(S.CATEGORICAL))


@register("sparse_one_hot", W("""SELECT customerID, CAST(idx AS INT) AS feature FROM pairs JOIN vocab USING (place, value)""", labelled=False, extra=SPLIT_CTES + f""",
pairs AS ({_PAIRS.replace("{src}", "subscribers")}),
known AS (SELECT DISTINCT place, value FROM ({_PAIRS.replace("{src}", "(SELECT * FROM splits WHERE split = 'train') t")}) q),
vocab AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS idx FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY value) AS rn FROM known) q WHERE rn > 1)"""))
def q_sparse_one_hot(spark, sf):
    """The dummies of every account as numbers of features, from a vocabulary table."""
    from segmint.operators.sparse import fit_vocabulary, sparse_rows
    vocab, _ = fit_vocabulary(fixture_split(spark, sf).where("split = 'train'"), S.CATEGORICAL)
    rows = sparse_rows(fx.subscribers(spark, sf), [], S.CATEGORICAL, vocab)
    return rows.select("customerID", F.explode("indices").alias("feature"))


@register("sparse_projection")
def q_sparse_projection(spark, sf):
    """Two components of the tenure, the monthly charge and all dummies, from sparse rows."""
    from segmint.operators.sparse import fit_vocabulary, sparse_pca, sparse_rows
    df = fx.subscribers(spark, sf)
    vocab, n = fit_vocabulary(df, S.CATEGORICAL)
    df = df.withColumns({"tenure": F.col("tenure") / 24.5, "MonthlyCharges": F.col("MonthlyCharges") / 30.0})
    rows = sparse_rows(df, ["tenure", "MonthlyCharges"], S.CATEGORICAL, vocab)
    return sparse_pca(rows, 2 + n)[0].select("customerID", "pc_1", "pc_2")
