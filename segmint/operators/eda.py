"""Exploratory aggregates: the data behind each chart panel.

Every function returns a small DataFrame (bins, categories, pairs of
columns) computed by one or two aggregate passes; no row-level data leaves
the executors. Whole-table statistics (min / max, quartiles) are one-row
aggregates that are cross joined back (a broadcast of one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmint.operators.quantiles import quantile_row


def _yes(col: str, positive: str = "Yes"):
    return F.when(F.col(col) == positive, 1).otherwise(0)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """(bin, lo, hi, n) for ``bins`` equal-width bins between min and max,
    empty bins included; the last bin is closed on the right. A constant
    column gets the range [x - 0.5, x + 0.5]. Nulls are skipped."""
    x = F.col(col).cast("double")
    stats = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    stats = stats.select(
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo0"),
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mx") - F.col("_mn")).otherwise(F.lit(1.0)).alias("_span"))
    b = F.least(F.floor((x - F.col("_lo0")) * bins / F.col("_span")), F.lit(bins - 1)).cast("int")
    counts = (df.where(x.isNotNull()).select(col).crossJoin(F.broadcast(stats))  # one-row side
              .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo0", "_span")
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (F.col("_lo0") + F.col("bin") * F.col("_span") / bins).alias("lo"),
                    (F.col("_lo0") + (F.col("bin") + 1) * F.col("_span") / bins).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def mean_marker(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, mean): the dashed mean line drawn on a histogram."""
    one = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("mean"))
                                          for c in cols])).alias("r")).select("r.*")


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) descending; nulls dropped."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value"))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """(value, n, pct): pie slices; the total is a one-row aggregate."""
    total = df.where(F.col(col).isNotNull()).agg(F.count(F.lit(1)).alias("_total"))
    c = category_counts(df, col).crossJoin(F.broadcast(total))
    return c.select("value", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (col_a, col_b, corr) of the Pearson matrix. Each pair uses
    the rows where both values are present (pairwise complete), all pairs
    in ONE aggregate pass."""
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j >= i:
                aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{i}_{j}"))
    one = df.agg(*aggs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            src = f"c_{min(i, j)}_{max(i, j)}"
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(src).alias("corr")))
    return one.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def service_flags(df: DataFrame, cols: list[str], positive: str = "Yes") -> DataFrame:
    return df.select(*[_yes(c, positive).alias(c) for c in cols])


def service_correlation(df: DataFrame, cols: list[str], positive: str = "Yes") -> DataFrame:
    """Correlation of the 0/1 'Yes' flags of the service columns."""
    return correlation_matrix(service_flags(df, cols, positive), cols)


def scatter_series(df: DataFrame, x: str, y: str, group: str) -> DataFrame:
    """(group, x, y) points for a scatter coloured by ``group``: a plain
    projection, every row kept."""
    return df.select(F.col(group).alias("group"), F.col(x).cast("double").alias("x"),
                     F.col(y).cast("double").alias("y"))


def boxplot_stats(df: DataFrame, cols: list[str], whis: float = 1.5, approx: bool = False,
                  accuracy: int = 100000) -> DataFrame:
    """(column, n, q1, median, q3, iqr, whisker_lo, whisker_hi, n_fliers).

    Quartiles by linear interpolation, exact (``quantile_row``); with
    ``approx=True`` by ``percentile_approx``.
    Whiskers are the most extreme values inside [q1 - whis*iqr, q3 + whis*iqr].
    Two passes: quartiles, then one conditional aggregate with the one-row
    quartile table broadcast."""
    probs = [0.25, 0.5, 0.75]
    if approx:
        quart = df.agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(*map(F.lit, probs)), accuracy).alias(f"q_{i}")
                         for i, c in enumerate(cols)])
    else:
        quart = quantile_row(df, {f"q_{i}": F.col(c) for i, c in enumerate(cols)}, probs)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        q1, q3 = F.col(f"q_{i}")[0], F.col(f"q_{i}")[2]
        lo = q1 - whis * (q3 - q1)
        hi = q3 + whis * (q3 - q1)
        aggs += [F.count(x).alias(f"n_{i}"),
                 F.min(F.when(x >= lo, x)).alias(f"wl_{i}"),
                 F.max(F.when(x <= hi, x)).alias(f"wh_{i}"),
                 F.sum(F.when((x < lo) | (x > hi), 1).otherwise(0)).cast("long").alias(f"f_{i}"),
                 F.first(F.col(f"q_{i}")).alias(f"qq_{i}")]
    one = df.select(*cols).crossJoin(F.broadcast(quart)).agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        q = F.col(f"qq_{i}")
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n_{i}").alias("n"), q[0].alias("q1"), q[1].alias("median"),
            q[2].alias("q3"), (q[2] - q[0]).alias("iqr"),
            F.coalesce(F.col(f"wl_{i}"), q[0]).alias("whisker_lo"),
            F.coalesce(F.col(f"wh_{i}"), q[2]).alias("whisker_hi"),
            F.col(f"f_{i}").alias("n_fliers")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def crosstab_row_pct(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long form (row_value, col_value, n, row_pct): share of each column
    value inside its row value, in percent. Every row value has every column
    value, with n and share 0 where the two never meet; rows with a null in
    either are left out."""
    cnt = (df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
           .groupBy(F.col(row).alias("row_value"), F.col(col).alias("col_value"))
           .agg(F.count(F.lit(1)).alias("n")))
    # the table itself: its rows are the distinct values of one by those of the other
    cells = cnt.select("row_value").distinct().crossJoin(cnt.select("col_value").distinct())
    full = cells.join(cnt, ["row_value", "col_value"], "left").na.fill(0, ["n"])
    return full.withColumn("row_pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("row_value")))


def crosstab_pivot(df: DataFrame, row: str, col: str, values: list | None = None) -> DataFrame:
    """Wide form of ``crosstab_row_pct``. Pass the column domain as ``values``
    to skip the distinct-value job; otherwise Spark collects it (bounded by
    ``spark.sql.pivotMaxValues``). A value of ``values`` that never occurs has
    0."""
    g = crosstab_row_pct(df, row, col).groupBy("row_value")
    p = g.pivot("col_value", values) if values is not None else g.pivot("col_value")
    return p.agg(F.first("row_pct")).na.fill(0.0)


def rate_by_category(df: DataFrame, cat: str, target: str = "Churn", positive: str = "Yes") -> DataFrame:
    """(value, n, rate_pct) ascending by rate; null categories dropped."""
    return (df.where(F.col(cat).isNotNull()).groupBy(F.col(cat).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"), (F.avg(_yes(target, positive)) * 100).alias("rate_pct"))
            .orderBy("rate_pct", "value"))


def overall_rate(df: DataFrame, target: str = "Churn", positive: str = "Yes") -> DataFrame:
    """(n, rate_pct): row-weighted share of positives, in percent."""
    return df.agg(F.count(F.lit(1)).alias("n"), (F.avg(_yes(target, positive)) * 100).alias("rate_pct"))


def eda_report(df: DataFrame, numeric=("tenure", "MonthlyCharges", "TotalCharges"),
               services=("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                         "StreamingMovies"), target: str = "Churn") -> dict[str, DataFrame]:
    """All panels as DataFrames (run on the training split); quartiles are
    computed at once, the rest when it is read."""
    return {
        "01_tenure_hist": histogram(df, "tenure"),
        "02_monthly_hist": histogram(df, "MonthlyCharges"),
        "01_02_means": mean_marker(df, ["tenure", "MonthlyCharges"]),
        "03_churn_share": category_share(df, target),
        "04_contract_share": category_share(df, "Contract"),
        "05_internet_counts": category_counts(df, "InternetService"),
        "06_payment_counts": category_counts(df, "PaymentMethod"),
        "07_numeric_corr": correlation_matrix(df, list(numeric)),
        "08_scatter": scatter_series(df, "tenure", "MonthlyCharges", target),
        "09_boxplots": boxplot_stats(df, list(numeric)),
        "10_senior_internet": crosstab_row_pct(df, "SeniorCitizen", "InternetService"),
        "11_churn_by_payment": rate_by_category(df, "PaymentMethod", target),
        "11_overall_rate": overall_rate(df, target),
        "12_service_corr": service_correlation(df, list(services)),
    }


def eda_table(panels: dict[str, DataFrame]) -> DataFrame:
    """The panels in one table (panel, position, cells): a row of a panel as
    JSON, in the order of the
    JSON text. Panels are small but for the scatter, whose rows
    are counted in its place."""
    out = None
    for name, p in sorted(panels.items()):
        if name.endswith("scatter"):
            p = p.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        p = p.select(F.lit(name).alias("panel"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in p.columns])).alias("cells"))
        p = p.withColumn("position", (F.row_number().over(Window.orderBy("cells")) - 1).cast("int")).select("panel", "position", "cells")
        out = p if out is None else out.unionByName(p)
    return out
