"""Cluster profiling, naming and business actions.

One ``groupBy(cluster)`` computes every per-cluster statistic (partial
aggregation map-side, so a cluster holding a third of the rows costs no more
than any other). Everything after that runs on the k-row profile table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmint import spec as S
from segmint.functions import rules
from segmint.operators.quantiles import modes
from segmint.session import materialize
from segmint.spec import DEFAULT_SPEC, SegmentSpec

KEY_FEATURES = ["tenure", "MonthlyCharges", "TotalCharges", "avg_monthly_spend", "service_diversity"]


def _is_yes(col: str, positive: str = "Yes"):
    return F.when(F.col(col) == positive, 1).otherwise(0)


def cluster_profiles(df: DataFrame, cluster_col: str = "cluster_id", spec: SegmentSpec = DEFAULT_SPEC,
                     key_features: list[str] | None = None) -> DataFrame:
    """Size, share, churn rate, mean / sample std of key features and modes
    of contract, internet and payment per cluster. ``service_diversity`` is
    derived from the service columns when absent. Engineered columns add
    their own statistics when present."""
    cols = set(df.columns)
    key_features = key_features or KEY_FEATURES
    aggs, tops = [F.count(F.lit(1)).alias("size")], []
    if spec.target in cols:
        aggs.append(F.avg(_is_yes(spec.target, spec.positive_value).cast("double")).alias("churn_rate"))
    for feat in key_features:
        if feat in cols:
            x = F.col(feat)
        elif feat == "service_diversity" and all(c in cols for c in spec.services):
            x = sum((_is_yes(c) for c in spec.services), F.lit(0))
        else:
            continue
        aggs += [F.avg(x).alias(f"{feat}_mean"), F.stddev_samp(x).alias(f"{feat}_std")]
    for src, name in [(spec.contract, "contract_mode"), (spec.internet, "internet_mode"),
                      (spec.payment, "payment_mode"), ("tenure_group", "tenure_group_mode")]:
        if src in cols:
            tops.append((src, name))
    if "high_value_flag" in cols:
        aggs.append((F.avg("high_value_flag") * 100).alias("high_value_pct"))
    if "auto_payment" in cols:
        aggs.append((F.avg("auto_payment") * 100).alias("auto_payment_pct"))
    if "family_status" in cols:
        tops.append(("family_status", "family_status_mode"))
    prof = df.groupBy(F.col(cluster_col).alias("cluster_id")).agg(*aggs)
    for src, name in tops:  # k rows each
        prof = prof.join(modes(df, src, F.col(cluster_col), name), F.col("cluster_id").eqNullSafe(F.col("_by")), "left").drop("_by")
    # k rows: the total over an unpartitioned window is a single tiny task
    total = F.sum("size").over(Window.partitionBy())
    prof = prof.withColumn("size_pct", F.col("size") * 100.0 / total)
    order = ["cluster_id", "size", "size_pct"] + [c for c in prof.columns
                                                 if c not in ("cluster_id", "size", "size_pct")]
    return prof.select(*order)


def cluster_mode(df: DataFrame, col: str, cluster_col: str = "cluster_id") -> DataFrame:
    """Most frequent value per cluster; ties take the lowest value."""
    every = df.select(F.col(cluster_col).alias("cluster_id")).distinct()
    top = modes(df, col, F.col(cluster_col), f"{col}_mode")
    return every.join(top, F.col("cluster_id").eqNullSafe(F.col("_by")), "left").drop("_by")


def assign_names(profiles: DataFrame) -> DataFrame:
    """Adds ``descriptors`` (all name words) and a unique ``cluster_name``:
    the first two words; a repeated name gets `` (<id>)`` from its second
    occurrence on, in cluster id order."""
    cols = set(profiles.columns)
    arg = lambda c: c if c in cols else None
    desc = rules.descriptors(
        monthly=F.col("MonthlyCharges_mean") if arg("MonthlyCharges_mean") else F.lit(None).cast("double"),
        tenure=F.col("tenure_mean") if arg("tenure_mean") else F.lit(None).cast("double"),
        diversity=F.col("service_diversity_mean") if arg("service_diversity_mean") else F.lit(None).cast("double"),
        churn=F.col("churn_rate") if arg("churn_rate") else F.lit(None).cast("double"),
        contract=F.col("contract_mode") if arg("contract_mode") else F.lit(None).cast("string"),
    )
    named = profiles.withColumn("descriptors", desc).withColumn(
        "base_name", rules.name_from_descriptors(F.col("descriptors")))
    return unique_names(named, "base_name").drop("base_name")


def unique_names(df: DataFrame, name_col: str, id_col: str = "cluster_id", out: str = "cluster_name") -> DataFrame:
    """Repeated names: the second and later (by id) get `` (<id>)``."""
    w = Window.partitionBy(name_col).orderBy(id_col)
    rn = F.row_number().over(w)
    return df.withColumn(out, F.when(rn > 1, F.concat(F.col(name_col), F.lit(" ("), F.col(id_col).cast("string"),
                                                      F.lit(")"))).otherwise(F.col(name_col)))


def _stat(cols: set, name: str, kind: str = "double"):
    return F.col(name) if name in cols else F.lit(None).cast(kind)


def business_actions(named_profiles: DataFrame) -> DataFrame:
    """Insight, marketing action and retention strategy per cluster."""
    cols = set(named_profiles.columns)
    churn = _stat(cols, "churn_rate")
    tenure = _stat(cols, "tenure_mean")
    monthly = _stat(cols, "MonthlyCharges_mean")
    div = _stat(cols, "service_diversity_mean")
    contract = _stat(cols, "contract_mode", "string")
    return named_profiles.select(
        "cluster_id", "cluster_name",
        rules.primary_insight(churn, tenure, monthly, div).alias("primary_insight"),
        rules.marketing_action(churn, tenure, monthly, div).alias("marketing_action"),
        rules.retention_strategy(churn, contract).alias("retention_strategy"),
    )


def segment_report(df: DataFrame, cluster_col: str = "cluster_id", spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """Which segments exist, how risky they are and what to do: profiles ->
    names -> actions -> risk level, one row per cluster."""
    named = assign_names(cluster_profiles(df, cluster_col, spec))
    actions = business_actions(named)
    return (named.select("cluster_id", "size", "size_pct", "churn_rate", "tenure_mean", "MonthlyCharges_mean")
            .join(actions, "cluster_id")
            .withColumn("risk_level", rules.risk_level("churn_rate")))


def attach_names(df: DataFrame, names: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """cluster id -> name. The name table has one row per cluster (k rows,
    bounded by the model), so it is broadcast."""
    small = names.select(F.col("cluster_id").alias(cluster_col), "cluster_name")
    return df.join(F.broadcast(small), cluster_col, "left")


def cluster_size_share(df: DataFrame, names: DataFrame | None = None, cluster_col: str = "cluster_id") -> DataFrame:
    out = (df.groupBy(F.col(cluster_col).alias("cluster_id")).agg(F.count(F.lit(1)).alias("n"))
           .withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())))
    if names is not None:
        out = attach_names(out, names)
    return out


def radar_profile(df: DataFrame, features: list[str], cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, feature, mean, scaled): cluster means of the given
    features scaled by the GLOBAL min / max of each feature (+1e-10). One
    groupBy for the means, one aggregate for min / max (one row, broadcast)."""
    means = df.groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        *[F.avg(F.col(f).cast("double")).alias(f"m_{i}") for i, f in enumerate(features)])
    rng = df.agg(*[F.min(F.col(f).cast("double")).alias(f"lo_{i}") for i, f in enumerate(features)],
                 *[F.max(F.col(f).cast("double")).alias(f"hi_{i}") for i, f in enumerate(features)])
    j = means.crossJoin(F.broadcast(rng))
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"m_{i}").alias("mean"),
                     ((F.col(f"m_{i}") - F.col(f"lo_{i}")) / (F.col(f"hi_{i}") - F.col(f"lo_{i}") + F.lit(1e-10)))
                     .alias("scaled")) for i, f in enumerate(features)]
    return j.select("cluster_id", F.explode(F.array(*rows)).alias("r")).select("cluster_id", "r.*")


def centroid_heatmap(df: DataFrame, features: list[str], cluster_col: str = "cluster_id", top: int = 15) -> DataFrame:
    """(cluster_id, feature, centroid, z): the ``top`` features by
    population variance, their per-cluster means, z-scored across clusters
    (population std + 1e-10). One aggregate for the variances, one groupBy
    for the means; the rest runs on k x top rows."""
    var = df.agg(*[F.var_pop(F.col(f"`{f}`").cast("double")).alias(f"v_{i}") for i, f in enumerate(features)])
    vlong = var.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"v_{i}").alias("var"))
                                           for i, f in enumerate(features)])).alias("r")).select("r.*")
    topf = vlong.withColumn("_rk", F.row_number().over(Window.orderBy(F.desc("var"), "feature"))).where(
        F.col("_rk") <= top)
    means = df.groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        *[F.avg(F.col(f"`{f}`").cast("double")).alias(f"m_{i}") for i, f in enumerate(features)])
    mlong = means.select("cluster_id", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                                    F.col(f"m_{i}").alias("centroid"))
                                                           for i, f in enumerate(features)])).alias("r")
                         ).select("cluster_id", "r.*")
    j = mlong.join(F.broadcast(topf.select("feature")), "feature")  # top rows
    w = Window.partitionBy("feature")
    return j.select("cluster_id", "feature", "centroid",
                    ((F.col("centroid") - F.avg("centroid").over(w)) /
                     (F.stddev_pop("centroid").over(w) + F.lit(1e-10))).alias("z"))


def silhouette_plot_data(samples: DataFrame, id_col: str = "customerID", digits: int = 9) -> DataFrame:
    """Per-sample silhouette ranked inside its cluster, the cluster's
    vertical offset in the plot (10 + sizes of earlier clusters + 10 per
    gap) and the average line.

    Values are ranked as rounded to ``digits`` (sums arrive in any order, which
    must not reorder equal values), then by id. The ranks come from a range
    partitioned sort and the partitions' counts, so a cluster that holds most
    rows is not sorted by one task."""
    spark = samples.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = 10.0 ** digits
    key = F.floor(F.col("silhouette") * F.lit(m) + F.lit(0.5))
    s = materialize(samples.withColumn("_v", key), "plot-values")  # the range sort reads its rows twice
    s = s.repartitionByRange(n_parts, "cluster_id", "_v", id_col)
    s = materialize(s.sortWithinPartitions("cluster_id", "_v", id_col).withColumn("_p", F.spark_partition_id()), "plot-samples")
    counts = s.groupBy("_p", "cluster_id").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_off", F.coalesce(F.sum("_n").over(  # partitions x clusters rows
        Window.partitionBy("cluster_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy("_p", "cluster_id").orderBy("_v", id_col)) - 1
    ranked = s.withColumn("_r", local).join(before.select("_p", "cluster_id", "_off"), ["_p", "cluster_id"])
    sizes = counts.groupBy("cluster_id").agg(F.sum("_n").alias("_n"))
    offs = sizes.withColumn("y_lower", F.lit(10) + F.coalesce(F.sum(F.col("_n") + 10).over(
        Window.orderBy("cluster_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    avg = s.agg(F.avg("silhouette").alias("average"))
    return (ranked.withColumn("rank_in_cluster", (F.col("_r") + F.col("_off")).cast("int")).drop("_r", "_off", "_p", "_v")
            .join(offs.select("cluster_id", "y_lower"), "cluster_id").crossJoin(F.broadcast(avg))  # one row
            .select(id_col, "cluster_id", "silhouette", "rank_in_cluster",
                    (F.col("y_lower") + F.col("rank_in_cluster")).cast("long").alias("y"), "average"))
