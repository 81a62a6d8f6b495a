"""Exact stratified train / validation / test split and split reports.

The split is exact per stratum (same quotas as a stratified shuffle split:
test first with ``ceil(test_ratio * n)`` rows, then validation as
``val / (train + val)`` of the rest, quotas per stratum by largest
remainder). Rows are ordered inside a stratum by ``xxhash64(seed, id)``
(or by a given key) and the first ones go to the training side.

Scale: the ordering is a range-partitioned sort of three narrow columns
(stratum, key, id), so a stratum holding most of the rows is spread over
many tasks. Only the two boundary keys per stratum are looked up; the full
table is then labelled by comparing each row with its stratum's boundaries
(a broadcast of 2 rows per stratum), so the wide table is never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.session import ensure_checkpoint_dir, materialize
from segmint.spec import DEFAULT_SPEC, SegmentSpec


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) >= 1e-6:
        raise ValueError(f"train, val and test must add up to 1, not {train + val + test}")


def binarize_target(df: DataFrame, target: str = "Churn", positive: str = "Yes", out: str = "target") -> DataFrame:
    """'Yes' -> 1, anything else -> 0; numeric targets pass through."""
    dtype = dict(df.dtypes)[target]
    if dtype == "string":
        return df.withColumn(out, F.when(F.col(target) == positive, 1).otherwise(0))
    return df.withColumn(out, F.col(target).cast("int"))


def _largest_remainder(counts: DataFrame, n_draws: Column, total: Column, stratum: str, out: str) -> DataFrame:
    """Per-stratum share of ``n_draws``: floor of the exact share plus one for
    the largest remainders (ties: lower stratum value first). ``counts`` has
    one row per stratum, so the unpartitioned windows here are tiny."""
    cont = F.col("n_c").cast("double") / total.cast("double") * n_draws.cast("double")
    c = counts.withColumn("_cont", cont).withColumn("_base", F.floor("_cont"))
    w_all = Window.partitionBy()
    c = c.withColumn("_need", n_draws - F.sum("_base").over(w_all))
    c = c.withColumn("_rr", F.row_number().over(Window.orderBy(F.desc(F.col("_cont") - F.col("_base")),
                                                               F.col(stratum))))
    return c.withColumn(out, (F.col("_base") + F.when(F.col("_rr") <= F.col("_need"), 1).otherwise(0))
                        .cast("long")).drop("_cont", "_base", "_need", "_rr")


def split_quotas(strata: DataFrame, stratum: str, train_ratio: float, val_ratio: float,
                 test_ratio: float) -> DataFrame:
    """(stratum, n_c, n_keep, n_train): rows [0, n_train) -> train,
    [n_train, n_keep) -> validation, [n_keep, n_c) -> test."""
    n = F.sum("n_c").over(Window.partitionBy())
    q = strata.withColumn("_n", n)
    q = q.withColumn("_n_test", F.ceil(F.lit(float(test_ratio)) * F.col("_n")))
    q = _largest_remainder(q, F.col("_n") - F.col("_n_test"), F.col("_n"), stratum, "n_keep")
    val_adj = val_ratio / (train_ratio + val_ratio)
    q2 = q.select(stratum, F.col("n_keep").alias("n_c"))
    m = F.sum("n_c").over(Window.partitionBy())
    q2 = q2.withColumn("_m", m).withColumn("_m_val", F.ceil(F.lit(float(val_adj)) * F.col("_m")))
    q2 = _largest_remainder(q2, F.col("_m") - F.col("_m_val"), F.col("_m"), stratum, "n_train")
    return q.select(stratum, "n_c", "n_keep").join(q2.select(stratum, "n_train"), stratum)


def _nth_keys(ordered: DataFrame, targets: DataFrame, stratum: str) -> DataFrame:
    """Key of the row at 0-based rank ``pos`` per (stratum, pos) target.

    ``ordered`` is range partitioned and sorted by (stratum, key, id) and
    carries ``_pid``. Partition counts give each partition's first rank; only
    the partitions holding a target rank are ranked locally."""
    counts = ordered.groupBy("_pid", stratum).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(stratum).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    hit = targets.join(offs, stratum).where((F.col("pos") >= F.col("_off")) &
                                           (F.col("pos") < F.col("_off") + F.col("_cnt")))
    hit = hit.select(stratum, "_pid", (F.col("pos") - F.col("_off")).alias("_local"), "pos", "which")
    # rows of the hit partitions only (at most 2 per stratum partitions)
    cand = ordered.join(F.broadcast(hit.select(stratum, "_pid").distinct()), [stratum, "_pid"])
    wl = Window.partitionBy("_pid", stratum).orderBy("_k", "_id")
    cand = cand.withColumn("_local", F.row_number().over(wl) - 1)
    # equal keys are in one partition
    cand = cand.withColumn("_ties", F.count(F.lit(1)).over(Window.partitionBy("_pid", stratum, "_k", "_id")))
    return cand.join(F.broadcast(hit), [stratum, "_pid", "_local"]).select(stratum, "which", "_k", "_id", "_ties")


def split_stratified(df: DataFrame, stratum: str = "Churn", id_col: str = "customerID",
                     train_ratio: float = 0.6, val_ratio: float = 0.2, test_ratio: float = 0.2,
                     seed: int = 42, order_key: Column | None = None, out: str = "split",
                     n_parts: int | None = None, negative="No") -> DataFrame:
    """Adds a ``split`` column ('train' / 'validation' / 'test'). Rows with a
    null stratum belong to the stratum ``negative``. Quotas hold exactly also
    where ids repeat or are null: rows that are equal in key and id are told
    apart by their place in the table, which is written once for it."""
    check_ratios(train_ratio, val_ratio, test_ratio)
    key = order_key if order_key is not None else F.xxhash64(F.lit(seed), F.col(id_col))
    # a null target counts as the other class, as in binarize_target
    value = F.when(F.col(stratum).isNull(), F.lit(negative).cast(dict(df.dtypes)[stratum])).otherwise(F.col(stratum))
    # written once: the strata, the boundaries and the labelled rows each read it
    base = materialize(df.withColumn("_k", key).withColumn("_id", F.struct(F.col(id_col))).withColumn("_stratum", value), "split-base")
    strata = base.groupBy("_stratum").agg(F.count(F.lit(1)).alias("n_c"))
    quotas = split_quotas(strata, "_stratum", train_ratio, val_ratio, test_ratio)
    n_parts = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = _boundaries(base, quotas, n_parts)
    if not b.where("_ties > 1").isEmpty():
        base = materialize(base.withColumn("_id", F.struct(F.col(id_col), F.monotonically_increasing_id().alias("place"))), "split-rows")
        b = _boundaries(base, quotas, n_parts)
    row = F.struct("_k", "_id")
    label = (F.when(F.col("_b_test").isNotNull() & (row >= F.col("_b_test")), "test")
             .when(F.col("_b_val").isNotNull() & (row >= F.col("_b_val")), "validation")
             .otherwise("train"))
    # strata x 2 boundary keys: bounded by the number of strata of the target
    return base.join(F.broadcast(b), "_stratum", "left").withColumn(out, label).drop("_k", "_id", "_b_val", "_b_test", "_ties", "_stratum")


def _boundaries(base: DataFrame, quotas: DataFrame, n_parts: int) -> DataFrame:
    """One row per stratum: the first key of validation and of test, and how
    many rows share one of them."""
    ensure_checkpoint_dir(base.sparkSession)
    ordered = (base.select("_stratum", "_k", "_id")
               .repartitionByRange(n_parts, "_stratum", "_k", "_id")
               .sortWithinPartitions("_stratum", "_k", "_id")
               .withColumn("_pid", F.spark_partition_id())
               .checkpoint(eager=True))
    targets = (quotas.select("_stratum", F.col("n_train").alias("pos"), F.lit("train").alias("which"))
               .unionByName(quotas.select("_stratum", F.col("n_keep").alias("pos"), F.lit("keep").alias("which"))))
    bounds = _nth_keys(ordered, targets, "_stratum")
    edge = lambda which: F.max(F.when(F.col("which") == which, F.struct("_k", "_id")))
    b = bounds.groupBy("_stratum").agg(edge("train").alias("_b_val"), edge("keep").alias("_b_test"), F.max("_ties").alias("_ties"))
    return materialize(b, "split-bounds")


def split_summary(df: DataFrame, split_col: str = "split", target: str = "Churn", positive: str = "Yes") -> DataFrame:
    """Rows, share of all rows and target rate per split plus an 'overall'
    row (rollup)."""
    flag = F.when(F.col(target) == positive, 1.0).otherwise(0.0)
    agg = df.rollup(split_col).agg(F.count(F.lit(1)).alias("n"), (F.avg(flag) * 100).alias("target_rate_pct"))
    total = F.max(F.when(F.col(split_col).isNull(), F.col("n"))).over(Window.partitionBy())
    return (agg.withColumn("pct", F.col("n") * 100.0 / total)
            .withColumn(split_col, F.coalesce(F.col(split_col), F.lit("overall")))
            .select(split_col, "n", "pct", "target_rate_pct"))


def split_integrity(df: DataFrame, split_col: str = "split", id_col: str = "customerID") -> DataFrame:
    """Overlapping ids between splits and completeness: one row with the
    number of ids in more than one split, rows, distinct ids, and a verdict."""
    per_id = df.groupBy(id_col).agg(F.countDistinct(split_col).alias("_ns"), F.count(F.lit(1)).alias("_nr"))
    out = per_id.agg(
        F.sum(F.when(F.col("_ns") > 1, 1).otherwise(0)).cast("long").alias("overlapping_ids"),
        F.sum("_nr").cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct_ids"))
    return out.withColumn("complete", F.col("n_rows") == F.col("n_distinct_ids")).withColumn(
        "valid", (F.col("overlapping_ids") == 0) & F.col("complete"))


def split_overlap_pairs(df: DataFrame, split_col: str = "split", id_col: str = "customerID",
                        names=("train", "validation", "test")) -> DataFrame:
    """Overlap count for each pair of splits (semi-join form of the id set
    intersections)."""
    out = None
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            ida = df.where(F.col(split_col) == a).select(id_col).distinct()
            idb = df.where(F.col(split_col) == b).select(id_col).distinct()
            cnt = ida.join(idb, id_col, "left_semi").agg(F.count(F.lit(1)).alias("n_overlap"))
            cnt = cnt.select(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), "n_overlap")
            out = cnt if out is None else out.unionByName(cnt)
    return out


def train_val_union(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Training plus validation rows (the refit set)."""
    return df.where(F.col(split_col).isin("train", "validation"))


def split_profile(df: DataFrame, split_col: str = "split", numeric: list[str] | None = None,
                  categorical: list[str] | None = None, spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """Per split: rows, feature count, mean of numeric columns, and per
    categorical column the top value and its share (tie -> lowest value)."""
    numeric = numeric or list(spec.raw_numerical)
    categorical = categorical or [spec.contract, spec.internet, spec.payment]
    means = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"),
                                      *[F.avg(c).alias(f"{c}_mean") for c in numeric])
    n_features = len([c for c in df.columns if c not in (spec.id, spec.target, split_col)])
    means = means.withColumn("n_features", F.lit(n_features))
    for c in categorical:
        cnt = df.groupBy(split_col, c).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(split_col).orderBy(F.desc("_n"), F.col(c))
        top = (cnt.where(F.col(c).isNotNull())
               .withColumn("_rn", F.row_number().over(w))
               .withColumn("_tot", F.sum("_n").over(Window.partitionBy(split_col)))
               .where("_rn = 1")
               .select(split_col, F.col(c).alias(f"{c}_top"), (F.col("_n") * 100.0 / F.col("_tot")).alias(f"{c}_top_pct")))
        means = means.join(top, split_col, "left")
    return means
