"""Session helpers: building a local session for tests and reading the
cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "segmint") -> SparkSession:
    """Return the active session, or build a local one for tests / benches.

    On a cluster the session already exists (spark-submit) and is returned
    unchanged; only when none is active do we build a local one.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("SEGMINT_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SEGMINT_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SEGMINT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``). Only when it is unset and the master is local
    do we set our own folder under the system temp dir; on a cluster that
    folder would be private to each machine, so we refuse."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local_dir = tempfile.mkdtemp(prefix="segmint-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def materialize(df, name: str = "t"):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back. Cuts the lineage like ``checkpoint()`` AND resets the plan
    statistics to the real file size (a checkpoint keeps the size estimate of
    the plan it replaces, which multiplies through iterated joins)."""
    import uuid
    spark = df.sparkSession
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/tables/{name}-{uuid.uuid4().hex[:16]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
