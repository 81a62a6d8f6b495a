"""Data quality reports. Each is one or two aggregate passes over the
table; wide per-column results are produced as one aggregate row and then
unpivoted, so the table is scanned once regardless of its width."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators.quantiles import quantile_row

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _unpivot_one_row(row_df: DataFrame, cols: list[str], prefixes: list[str], names: list[str]) -> DataFrame:
    """Turn a one-row frame with columns ``<prefix>__<col>`` into one row per
    column with fields ``names``."""
    parts = []
    for c in cols:
        parts.append(F.struct(F.lit(c).alias("column"),
                              *[F.col(_q(f"{p}__{c}")).alias(n) for p, n in zip(prefixes, names)]))
    return row_df.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def schema_report(df: DataFrame) -> DataFrame:
    """(column, ordinal, dtype, kind, n_rows); kind is numeric or categorical."""
    fields = df.schema.fields
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("ordinal"),
                              F.lit(f.dataType.simpleString()).alias("dtype"),
                              F.lit("numeric" if isinstance(f.dataType, NUMERIC_TYPES) else "categorical").alias("kind"))
                     for i, f in enumerate(fields)])
    return n.select(F.explode(rows).alias("r"), "n_rows").select("r.*", "n_rows")


def missing_report(df: DataFrame) -> DataFrame:
    """(column, n_missing, pct_missing) for every column; NaN counts as
    missing for floating columns."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in df.schema.fields:
        miss = F.col(_q(f.name)).isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            miss = miss | F.isnan(F.col(_q(f.name)))
        aggs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("long").alias(f"m__{f.name}"))
    one = df.agg(*aggs)
    long = _unpivot_one_row(one.withColumn("_n", F.col("__n")), df.columns, ["m"], ["n_missing"])
    total = one.select("__n")
    return long.crossJoin(total).select(  # total is a single row
        "column", "n_missing", (F.col("n_missing") * 100.0 / F.col("__n")).alias("pct_missing"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row (nulls compare equal)."""
    groups = df.groupBy(*[F.col(_q(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.sum("_c").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct_rows"),
                      F.sum(F.col("_c") - 1).cast("long").alias("n_duplicates"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, pct) descending by n; nulls are dropped from counts and
    from the denominator."""
    some = df.where(F.col(col).isNotNull())
    c = some.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = some.agg(F.count(F.lit(1)).alias("_total"))  # one row
    return c.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct")).orderBy(
        F.desc("n"), "value")


def tenure_charge_consistency(df: DataFrame, tenure: str = "tenure", total: str = "TotalCharges") -> DataFrame:
    z = F.col(tenure) == 0
    nt = F.col(total).isNull() | F.isnan(F.col(total))
    return df.agg(F.sum(F.when(z, 1).otherwise(0)).cast("long").alias("zero_tenure"),
                  F.sum(F.when(nt, 1).otherwise(0)).cast("long").alias("null_total"),
                  F.sum(F.when(z & nt, 1).otherwise(0)).cast("long").alias("zero_tenure_null_total"))


def category_domain(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form (column, value, n) of every value of every string column,
    null kept as a value. Fully distributed: no value list is collected."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("value"))
                                for c in cols]))
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))


def category_cardinality(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_unique): distinct values per string column, null counted
    as one value (like ``unique()``)."""
    dom = category_domain(df, cols)
    return dom.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def numeric_summary(df: DataFrame, cols: list[str], approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """(column, min, max, mean, median, std) with sample std; nulls and
    NaN skipped. ``approx=True`` uses ``percentile_approx`` for the median."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    aggs = []
    for c, x in clean.items():
        aggs += [F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}"), F.avg(x).alias(f"mean__{c}"), F.stddev_samp(x).alias(f"std__{c}")]
        if approx:
            aggs.append(F.percentile_approx(x, 0.5, accuracy).alias(f"median__{c}"))
    one = df.agg(*aggs)
    if not approx:
        half = quantile_row(df, clean, [0.5])
        one = one.crossJoin(half.select(*[F.col(f"`{c}`")[0].alias(f"median__{c}") for c in cols]))  # one row each
    names = ["min", "max", "mean", "median", "std"]
    return _unpivot_one_row(one, cols, names, names)


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text -> double; values that do not parse become null."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.expr(f"try_cast(trim({_q(c)}) AS DOUBLE)"))
    return out
