"""Registered queries: exploratory aggregates on the customer table."""

from __future__ import annotations

from segmint import spec as S
from segmint.operators import eda as E
from segmint.plans.q_split import fixture_split
from segmint.plans.registry import register
from segmint.sources import fixtures as fx

W = fx.with_fixture_ctes


def _hist_sql(col: str, bins: int = 30) -> str:
    return W(f"""SELECT CAST(g.bin AS INT) AS bin, lo0 + g.bin * span / {bins} AS lo,
    lo0 + (g.bin + 1) * span / {bins} AS hi, coalesce(c.n, 0)::BIGINT AS n
  FROM range(0, {bins}) g(bin) CROSS JOIN st
  LEFT JOIN (SELECT CAST(least(floor((CAST("{col}" AS DOUBLE) - lo0) * {bins} / span), {bins - 1}) AS INT) AS bin,
                    count(*) AS n
             FROM subscribers CROSS JOIN st WHERE "{col}" IS NOT NULL GROUP BY 1) c ON c.bin = g.bin""",
             labelled=False, extra=f"""st AS (SELECT CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS lo0,
    CASE WHEN mx > mn THEN mx - mn ELSE 1.0 END AS span
  FROM (SELECT min(CAST("{col}" AS DOUBLE)) AS mn, max(CAST("{col}" AS DOUBLE)) AS mx FROM subscribers) m)""")


@register("histogram", _hist_sql("tenure"), doubles=("lo", "hi"))
def q_histogram(spark, sf):
    return E.histogram(fx.subscribers(spark, sf), "tenure", 30)


@register("histogram_monthly", _hist_sql("MonthlyCharges"), doubles=("lo", "hi"))
def q_histogram_monthly(spark, sf):
    return E.histogram(fx.subscribers(spark, sf), "MonthlyCharges", 30)


@register("mean_marker", W("""SELECT 'tenure' AS "column", avg(CAST(tenure AS DOUBLE)) AS mean FROM subscribers
  UNION ALL SELECT 'MonthlyCharges', avg(MonthlyCharges) FROM subscribers""", labelled=False), doubles=("mean",))
def q_mean_marker(spark, sf):
    return E.mean_marker(fx.subscribers(spark, sf), ["tenure", "MonthlyCharges"])


@register("category_counts", W("""SELECT PaymentMethod AS value, count(*) AS n FROM subscribers
  WHERE PaymentMethod IS NOT NULL GROUP BY 1""", labelled=False))
def q_category_counts(spark, sf):
    return E.category_counts(fx.subscribers(spark, sf), "PaymentMethod")


@register("category_share", W("""SELECT Contract AS value, count(*) AS n,
  CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM subscribers
  WHERE Contract IS NOT NULL GROUP BY 1""", labelled=False), doubles=("pct",))
def q_category_share(spark, sf):
    return E.category_share(fx.subscribers(spark, sf), "Contract")


def _corr_sql(cols: list[str], src: str, expr=lambda c: f'CAST("{c}" AS DOUBLE)') -> str:
    parts = []
    for a in cols:
        for b in cols:
            x, y = sorted([a, b], key=cols.index)
            parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, corr({expr(x)}, {expr(y)}) AS "corr" FROM {src}""")
    return " UNION ALL ".join(parts)


_NUM = ["tenure", "MonthlyCharges", "TotalCharges"]


@register("correlation_matrix", W(_corr_sql(_NUM, "subscribers"), labelled=False), doubles=("corr",))
def q_correlation_matrix(spark, sf):
    return E.correlation_matrix(fx.subscribers(spark, sf), _NUM)


@register("service_correlation",
          W(_corr_sql(S.SERVICES, "subscribers", lambda c: f"""(CASE WHEN "{c}"='Yes' THEN 1 ELSE 0 END)"""),
            labelled=False), doubles=("corr",))
def q_service_correlation(spark, sf):
    return E.service_correlation(fx.subscribers(spark, sf), S.SERVICES)


@register("scatter_series", W("""SELECT Churn AS "group", CAST(tenure AS DOUBLE) AS x, MonthlyCharges AS y
  FROM subscribers""", labelled=False), doubles=("x", "y"))
def q_scatter_series(spark, sf):
    return E.scatter_series(fx.subscribers(spark, sf), "tenure", "MonthlyCharges", "Churn")


def _box_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(f"""SELECT '{c}' AS "column", count({x}) AS n, q1, med AS median, q3, q3 - q1 AS iqr,
    coalesce(min(CASE WHEN {x} >= q1 - 1.5 * (q3 - q1) THEN {x} END), q1) AS whisker_lo,
    coalesce(max(CASE WHEN {x} <= q3 + 1.5 * (q3 - q1) THEN {x} END), q3) AS whisker_hi,
    sum(CASE WHEN {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END)::BIGINT AS n_fliers
  FROM subscribers CROSS JOIN (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS med,
                                      quantile_cont({x}, 0.75) AS q3 FROM subscribers) q
  GROUP BY q1, med, q3""")
    return " UNION ALL ".join(parts)


@register("boxplot_stats", W(_box_sql(_NUM), labelled=False),
          doubles=("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"))
def q_boxplot_stats(spark, sf):
    return E.boxplot_stats(fx.subscribers(spark, sf), _NUM)


def _crosstab_sql(row: str, col: str) -> str:
    return f"""SELECT r AS row_value, c AS col_value, coalesce(m, 0) AS n, CAST(coalesce(m, 0) AS DOUBLE) * 100 / sum(coalesce(m, 0)) OVER (PARTITION BY r) AS row_pct
  FROM (SELECT DISTINCT {row} AS r FROM both_known) a CROSS JOIN (SELECT DISTINCT {col} AS c FROM both_known) b
  LEFT JOIN (SELECT {row} AS r, {col} AS c, count(*) AS m FROM both_known GROUP BY ALL) q USING (r, c)"""


def _both(row: str, col: str) -> str:
    return f"both_known AS (SELECT * FROM subscribers WHERE {row} IS NOT NULL AND {col} IS NOT NULL)"


@register("crosstab_zero_pairs", W(_crosstab_sql("tenure", "PaymentMethod"), labelled=False, extra=_both("tenure", "PaymentMethod")), doubles=("row_pct",))
def q_crosstab_zero_pairs(spark, sf):
    """Payment methods inside each month of tenure, with those that never occur."""
    return E.crosstab_row_pct(fx.subscribers(spark, sf), "tenure", "PaymentMethod")


@register("crosstab_pivot", W("""SELECT SeniorCitizen AS row_value, """ + ", ".join(
    f"""CAST(sum(CASE WHEN InternetService = '{v}' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS "{v}" """ for v in ("DSL", "Fiber optic", "No", "Satellite")) +
    " FROM both_known GROUP BY 1", labelled=False, extra=_both("SeniorCitizen", "InternetService")), doubles=("DSL", "Fiber optic", "No", "Satellite"))
def q_crosstab_pivot(spark, sf):
    """Wide form, with a value that no account has."""
    return E.crosstab_pivot(fx.subscribers(spark, sf), "SeniorCitizen", "InternetService", ["DSL", "Fiber optic", "No", "Satellite"])


@register("eda_report")
def q_eda_report(spark, sf):
    """All panels of the training split in one table."""
    return E.eda_table(E.eda_report(fixture_split(spark, sf).where("split = 'train'")))


@register("crosstab_row_pct", W(_crosstab_sql("SeniorCitizen", "InternetService"), labelled=False, extra=_both("SeniorCitizen", "InternetService")),
          doubles=("row_pct",))
def q_crosstab_row_pct(spark, sf):
    return E.crosstab_row_pct(fx.subscribers(spark, sf), "SeniorCitizen", "InternetService")


@register("rate_by_category", W("""SELECT PaymentMethod AS value, count(*) AS n,
  avg(CASE WHEN Churn='Yes' THEN 1 ELSE 0 END) * 100 AS rate_pct FROM subscribers
  WHERE PaymentMethod IS NOT NULL GROUP BY 1""", labelled=False), doubles=("rate_pct",))
def q_rate_by_category(spark, sf):
    return E.rate_by_category(fx.subscribers(spark, sf), "PaymentMethod")


@register("overall_rate", W("""SELECT count(*) AS n, avg(CASE WHEN Churn='Yes' THEN 1 ELSE 0 END) * 100 AS rate_pct
  FROM subscribers""", labelled=False), doubles=("rate_pct",))
def q_overall_rate(spark, sf):
    return E.overall_rate(fx.subscribers(spark, sf))
