"""Sparse encoding and projection for any number of categories.

The vocabulary is a table, not a list on the driver, and rows get their feature
numbers by a join, so neither the plan nor a task grows with the number of
categories. A sparse row is two arrays: feature numbers, ascending, and values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.operators.features import vocabulary_rows
from segmint.operators.strips import numbered
from segmint.session import materialize


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


#: Values of a vocabulary that every task may hold.
_SMALL = 100_000


def fit_vocabulary(df: DataFrame, cols: list[str], drop_first: bool = True) -> tuple[DataFrame, int]:
    """((column, value, index), how many): the distinct values, nulls left out,
    numbered from 0 in the order of ``cols``, then of values; without the first
    value of each column if ``drop_first``."""
    place = F.array_position(F.array(*map(F.lit, cols)), F.col("column"))
    rows = materialize(vocabulary_rows(df, cols).withColumn("place", place), "vocabulary")
    if drop_first:
        rows = rows.join(rows.groupBy("column").agg(F.min("value").alias("value")), ["column", "value"], "left_anti")  # one row per column
    vocab, n = numbered(rows, ["place", "value"], "index", "vocabulary-numbers")
    return vocab.select("column", "value", "index"), n


def sparse_rows(df: DataFrame, numeric: list[str], cols: list[str], vocab: DataFrame, keep: tuple[str, ...] = ("customerID",)) -> DataFrame:
    """(keep..., indices, values) of every row: the numeric columns that are not
    0 under their place in ``numeric``, then 1 under len(numeric) + index for
    each categorical value that the vocabulary has. Unknown values and nulls
    have no entry, a null number is one of NaN. Repeated rows stay rows. Spark
    would broadcast the smaller file, which can be that of the rows: so a
    vocabulary of up to ``_SMALL`` values is broadcast, a larger one merged."""
    base = materialize(df.select(*[F.col(_q(c)) for c in dict.fromkeys([*keep, *numeric, *cols])]).withColumn("_row", F.monotonically_increasing_id()), "sparse-base")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("value")) for c in cols]))
    found = base.select("_row", each.alias("p")).select("_row", "p.*").where("value is not null")
    found = found.join(vocab.hint("broadcast" if vocab.limit(_SMALL + 1).count() <= _SMALL else "merge"), ["column", "value"])
    found = found.groupBy("_row").agg(F.sort_array(F.collect_list((F.col("index") + len(numeric)).cast("int"))).alias("_cats"))  # one for each column at most
    number = [F.coalesce(F.col(_q(c)).cast("double"), F.lit(float("nan"))) for c in numeric]
    nums = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), x.alias("x")) for i, x in enumerate(number)]), lambda s: s["x"] != 0.0) if numeric else None
    cats = F.coalesce("_cats", F.array().cast("array<int>"))
    ones = F.transform(cats, lambda _: F.lit(1.0))
    out = base.join(found.hint("merge"), "_row", "left")  # rows on both sides: their files are small, they are not
    if nums is None:
        return out.select(*[F.col(_q(c)) for c in keep], cats.alias("indices"), ones.alias("values"))
    return out.withColumn("_nums", nums).select(*[F.col(_q(c)) for c in keep], F.concat(F.transform("_nums", lambda s: s["i"]), cats).alias("indices"),
                                                F.concat(F.transform("_nums", lambda s: s["x"]), ones).alias("values"))


_BLOCK = 8192


def _csr(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, feature, value)."""
    i, v = b.column("indices"), b.column("values")
    sizes = np.diff(i.offsets.to_numpy())
    return np.repeat(np.arange(b.num_rows), sizes), i.flatten().to_numpy(zero_copy_only=False), v.flatten().to_numpy(zero_copy_only=False).astype(float)


def _summed(rows: DataFrame, task, d: int, width: int) -> np.ndarray:
    """d x width numbers, added up over all tasks; ``task(batches)`` gives a
    task's share. Shares travel in blocks of features, so none but the result
    is whole anywhere."""
    def run(batches):
        share = task(batches)
        for at in range(0, d, _BLOCK):
            part = share[at:at + _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.tobytes()])], ["at", "part"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for at, part in zip(b.column("at").to_pylist(), b.column("part").to_pylist(), strict=True):
                total[at] = total.get(at, 0.0) + np.frombuffer(part)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()])], ["at", "part"])

    out = np.zeros((d, width))
    for r in rows.select("indices", "values").mapInArrow(run, "at int, part binary").repartition("at").mapInArrow(add, "at int, part binary").toLocalIterator():
        part = np.frombuffer(r["part"]).reshape(-1, width)
        out[r["at"]:r["at"] + len(part)] = part
    return out


def sparse_pca(rows: DataFrame, d: int, k: int = 2, extra: int = 16, max_iter: int = 50, tol: float = 1e-9, seed: int = 42) -> tuple[DataFrame, np.ndarray, list[float]]:
    """(``rows`` with pc_1 ... pc_k, loadings d x k, explained variance ratios)
    by a randomized range finder: ``k`` + ``extra`` random directions are
    multiplied by the covariance until the first k of the space they span no
    longer turn. One pass over the rows each time; rows are centred without
    being made dense, and the driver and a task hold d x (k + extra) numbers,
    not d x d. The sign makes each component's largest loading positive."""
    rows = materialize(rows, "sparse-rows")
    n, width = rows.count(), min(d, k + extra)
    if not n or width < k:
        raise ValueError(f"no {k} components of {n} rows and {d} features")

    def moments(batches):
        out = np.zeros((d, 2))
        for b in batches:
            _, i, v = _csr(b)
            out[:, 0] += np.bincount(i, v, d)
            out[:, 1] += np.bincount(i, v * v, d)
        return out

    sums = _summed(rows, moments, d, 2)
    if not np.isfinite(sums).all():
        raise ValueError("null or NaN features")
    mean = sums[:, 0] / n
    whole = float((sums[:, 1] / n - mean * mean).sum())
    w = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    sc = rows.sparkSession.sparkContext
    for _ in range(max_iter):
        shared = sc.broadcast(w)  # d x (k + extra)
        shift = mean @ w

        def multiplied(batches, shared=shared, shift=shift):
            w, out = shared.value, np.zeros((d, width))
            for b in batches:
                row, i, v = _csr(b)
                z = np.stack([np.bincount(row, v * w[i, c], b.num_rows) for c in range(width)], axis=1) - shift
                for c in range(width):
                    out[:, c] += np.bincount(i, v * z[row, c], d)
            return out

        cw = _summed(rows, multiplied, d, width) / n  # the centred rows' z sum to 0, so the mean needs no more
        shared.unpersist()
        values, turn = np.linalg.eigh(w.T @ cw)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        first = w @ turn[:, :k]
        rest = np.linalg.norm(cw @ turn[:, :k] - first * values[:k], axis=0)
        if (rest <= tol * max(values[0], 1e-300)).all():
            break
        w = np.linalg.qr(cw)[0]
    load = first * np.where(first[np.abs(first).argmax(axis=0), np.arange(k)] >= 0, 1.0, -1.0)
    final, centre = sc.broadcast(load), mean @ load
    fields = [f.name for f in rows.schema.fields]

    def project(batches):
        for b in batches:
            row, i, v = _csr(b)
            pcs = [np.bincount(row, v * final.value[i, c], b.num_rows) - centre[c] for c in range(k)]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, pcs)], [*fields, *[f"pc_{c + 1}" for c in range(k)]])

    schema = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields) + "".join(f", pc_{c + 1} double" for c in range(k))
    return rows.mapInArrow(project, schema), load, [float(v / whole) if whole else 0.0 for v in values[:k]]
