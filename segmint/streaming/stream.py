"""Structured Streaming form of scoring.

``run_stream`` applies a stateless transform to a file sink. ``score_stream``
scores with a model directory: each micro-batch loads the latest version, so a
new one takes effect without a restart, and writes its rows to a folder of its
own number, so a batch that runs again after a failure replaces its rows
instead of repeating them.

Checkpoint and output locations live under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) unless given explicitly."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segmint.operators.scorer import load_scorer
from segmint.session import ensure_checkpoint_dir


def stream_paths(spark: SparkSession, name: str = "score_stream") -> tuple[str, str]:
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"
    return base + "/out", base + "/chk"


def run_stream(spark: SparkSession, source: DataFrame, transform, out_path: str | None = None,
               checkpoint: str | None = None, fmt: str = "parquet", available_now: bool = True,
               query_name: str | None = None) -> DataFrame:
    """Apply ``transform`` to the streaming ``source`` and write it to a file
    sink. With ``available_now`` the stream processes everything present and
    stops; the written result is returned as a batch DataFrame."""
    if out_path is None or checkpoint is None:
        o, c = stream_paths(spark)
        out_path, checkpoint = out_path or o, checkpoint or c
    w = (transform(source).writeStream.format(fmt).option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if query_name:
        w = w.queryName(query_name)
    q = w.trigger(availableNow=True).start() if available_now else w.start()
    if available_now:
        q.awaitTermination()
        return spark.read.format(fmt).load(out_path)
    return q


def score_stream(source: DataFrame, model_dir: str, out_path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                 id_col: str = "customerID", available_now: bool = True):
    """Scores arriving rows by the latest version in ``model_dir`` and writes
    them under ``out_path``, a folder for each micro-batch. ``prepare`` makes
    customer records of a batch. With ``available_now`` what is present is
    processed and the written rows are returned, else the running query."""
    spark = source.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        scored = load_scorer(rows.sparkSession, model_dir).score(prepare(rows), id_col)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    w = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if not available_now:
        return w.start()
    w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out_path).drop("batch")
