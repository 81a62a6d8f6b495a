"""Registered queries: data quality reports on the customer table."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmint import spec as S
from segmint.operators import quality as Q
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes

_DTYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double", "TotalCharges": "double"}
_SCHEMA_ROWS = ", ".join(
    f"('{c}', {i}, '{_DTYPES.get(c, 'string')}', '{'numeric' if c in _DTYPES else 'categorical'}')"
    for i, c in enumerate(S.RAW_COLUMNS))


@register("schema_report", W(f"""SELECT v.*, n.n_rows FROM (VALUES {_SCHEMA_ROWS}) v("column", ordinal, dtype, kind)
  CROSS JOIN (SELECT count(*) AS n_rows FROM subscribers) n""", labelled=False))
def q_schema_report(spark, sf):
    return Q.schema_report(fx.subscribers(spark, sf))


_MISSING_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS n_missing,
  CAST(count(*) - count("{c}") AS DOUBLE) * 100 / count(*) AS pct_missing FROM subscribers"""
    for c in S.RAW_COLUMNS)


@register("missing_report", W(_MISSING_SQL, labelled=False), doubles=("pct_missing",))
def q_missing_report(spark, sf):
    return Q.missing_report(fx.subscribers(spark, sf))


_NO_ID = [c for c in S.RAW_COLUMNS if c != "customerID"]
_NO_ID_SQL = ", ".join(f'"{c}"' for c in _NO_ID)


@register("duplicate_rows", W(f"""SELECT sum(c)::BIGINT AS n_rows, count(*) AS n_distinct_rows,
  sum(c - 1)::BIGINT AS n_duplicates FROM (SELECT {_NO_ID_SQL}, count(*) AS c FROM subscribers GROUP BY {_NO_ID_SQL}) g""",
                              labelled=False))
def q_duplicate_rows(spark, sf):
    """Duplicate records once the account id is dropped (ids are unique)."""
    return Q.duplicate_rows(fx.subscribers(spark, sf).drop("customerID"))


@register("value_counts", W("""SELECT PaymentMethod AS value, count(*) AS n,
  CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct
  FROM subscribers WHERE PaymentMethod IS NOT NULL GROUP BY 1""", labelled=False), doubles=("pct",))
def q_value_counts(spark, sf):
    return Q.value_counts(fx.subscribers(spark, sf), "PaymentMethod")


@register("tenure_charge_consistency", W("""SELECT
  sum(CASE WHEN tenure = 0 THEN 1 ELSE 0 END)::BIGINT AS zero_tenure,
  sum(CASE WHEN TotalCharges IS NULL OR isnan(TotalCharges) THEN 1 ELSE 0 END)::BIGINT AS null_total,
  sum(CASE WHEN tenure = 0 AND (TotalCharges IS NULL OR isnan(TotalCharges)) THEN 1 ELSE 0 END)::BIGINT
    AS zero_tenure_null_total FROM subscribers""", labelled=False))
def q_tenure_charge_consistency(spark, sf):
    return Q.tenure_charge_consistency(fx.subscribers(spark, sf))


_STR_COLS = [c for c in S.RAW_COLUMNS if c not in _DTYPES]
_STR_NO_ID = [c for c in _STR_COLS if c != "customerID"]
_DOMAIN_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value, count(*) AS n FROM subscribers GROUP BY 2"""
    for c in _STR_NO_ID)


@register("category_domain", W(_DOMAIN_SQL, labelled=False))
def q_category_domain(spark, sf):
    return Q.category_domain(fx.subscribers(spark, sf), _STR_NO_ID)


_CARD_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT coalesce(CAST("{c}" AS VARCHAR), chr(0))) AS n_unique
  FROM subscribers""" for c in _STR_COLS)


@register("category_cardinality", W(_CARD_SQL, labelled=False))
def q_category_cardinality(spark, sf):
    return Q.category_cardinality(fx.subscribers(spark, sf), _STR_COLS)


_NUM = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
_NUM_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min(CAST("{c}" AS DOUBLE)) AS "min", max(CAST("{c}" AS DOUBLE)) AS "max",
  avg(CAST("{c}" AS DOUBLE)) AS mean, quantile_cont(CAST("{c}" AS DOUBLE), 0.5) AS median,
  stddev_samp(CAST("{c}" AS DOUBLE)) AS std FROM subscribers""" for c in _NUM)


@register("numeric_summary", W(_NUM_SQL, labelled=False), doubles=("min", "max", "mean", "median", "std"))
def q_numeric_summary(spark, sf):
    return Q.numeric_summary(fx.subscribers(spark, sf), _NUM)


def _text_total(df):
    """TotalCharges as the raw file has it: text, blank when never billed,
    and an unparseable marker on every 7th account."""
    txt = (F.when(F.col("customerID").cast("long") % 7 == 0, F.lit("n/a"))
           .otherwise(F.coalesce(F.col("TotalCharges").cast("string"), F.lit(" "))))
    return df.select("customerID", txt.alias("TotalCharges"))


@register("coerce_numeric", W("""SELECT customerID, TRY_CAST(trim(CASE WHEN CAST(customerID AS BIGINT) % 7 = 0 THEN 'n/a'
  ELSE coalesce(CAST(TotalCharges AS VARCHAR), ' ') END) AS DOUBLE) AS TotalCharges FROM subscribers""",
                              labelled=False), doubles=("TotalCharges",))
def q_coerce_numeric(spark, sf):
    return Q.coerce_numeric(_text_total(fx.subscribers(spark, sf)), ["TotalCharges"])
