"""Row numbers, points in packed chunks, and tasks that hold one block of points
and stream others past it.

Quadratic operators work on rows by number, so repeated and null ids are rows
like any other. Points travel as chunks: one table row with the coordinates of
up to a thousand points in one binary value. A task holds the chunks of its
block and sees the streamed chunks one at a time; it gives back at most one row
for each point it holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmint.session import materialize


def tasks_wanted(df: DataFrame) -> int:
    spark = df.sparkSession
    return 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def numbered(df: DataFrame, order: list[str], out: str = "_row", name: str = "numbered") -> tuple[DataFrame, int]:
    """``df`` with a number from 0 without gaps for every row, in the order of
    some columns, and the number of rows. Rows that are equal in them are
    numbered in any order, which is fixed since the table is written."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.withColumn("_tie", F.monotonically_increasing_id())  # parts equal rows
    s = src.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    s = materialize(s.withColumn("_at", F.monotonically_increasing_id()), name)  # the partition above bit 33
    counts = s.groupBy(F.shiftright("_at", 33).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    offs = counts.select("_p", "_n", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    n = counts.agg(F.sum("_n")).first()[0] or 0
    rows = s.withColumn("_p", F.shiftright("_at", 33)).join(F.broadcast(offs.select("_p", "_off")), "_p")
    return rows.withColumn(out, F.col("_off") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_p", "_off", "_at"), int(n)


#: Rows of a tile of distances: 64 x 512 numbers stay in a core's cache.
TILE = 64


class Distances:
    """Squared distances of any points to the same ``b``: from differences for
    a few dimensions, else by one matrix product of centred points (the norms
    are two more columns of it), where entries so close to one of ``exact_at``
    that rounding could matter are computed from differences."""

    def __init__(self, b: np.ndarray, exact_at: tuple[float, ...] = (0.0,)):
        self.b, self.exact_at = b, exact_at
        if b.shape[1] <= 4:
            self.y = np.ascontiguousarray(b.T)
            return
        self.centre = b.mean(axis=0) if len(b) else 0.0
        y = b - self.centre
        square = np.einsum("ij,ij->i", y, y)
        self.top = float(square.max(initial=0.0))
        self.right = np.ascontiguousarray(np.concatenate([-2.0 * y, np.ones((len(y), 1)), square[:, None]], axis=1).T)

    def of(self, a: np.ndarray) -> np.ndarray:
        if a.shape[1] <= 4:
            y = self.y
            g = a[:, 0, None] - y[0]
            np.multiply(g, g, out=g)
            d = np.empty_like(g)
            for k in range(1, a.shape[1]):
                np.subtract(a[:, k, None], y[k], out=d)
                np.multiply(d, d, out=d)
                np.add(g, d, out=g)
            return g
        g, slack = self._product(a)
        if g.min(initial=np.inf) > max(self.exact_at) + slack:  # none is close, nor below 0
            return g
        for v in self.exact_at:
            r, c = np.nonzero(g <= slack if v == 0 else np.abs(g - v) <= slack)
            for s in range(0, len(r), 100_000):
                diff = a[r[s:s + 100_000]] - self.b[c[s:s + 100_000]]
                g[r[s:s + 100_000], c[s:s + 100_000]] = np.einsum("ij,ij->i", diff, diff)
        return np.maximum(g, 0.0, out=g)

    def _product(self, a: np.ndarray) -> tuple[np.ndarray, float]:
        """The product, and how far rounding can move an entry at most."""
        x = a - self.centre
        square = np.einsum("ij,ij->i", x, x)
        g = np.concatenate([x, square[:, None], np.ones((len(x), 1))], axis=1) @ self.right
        return g, 1e-9 * (1.0 + float(square.max(initial=0.0)) + self.top)

    def within(self, a: np.ndarray, most: float, share: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(row of ``a``, row of ``b``, distance from differences) of the pairs
        that are at most ``most`` apart, for more than four dimensions; None
        if so near by the product is more than one pair in ``share``."""
        found = []
        for s in range(0, len(a), 4 * TILE):
            g, slack = self._product(a[s:s + 4 * TILE])
            near = np.flatnonzero((g <= most * most + slack).ravel())
            if len(near) * share > g.size:
                return None
            r, c = np.divmod(near, len(self.b))
            diff = a[s + r] - self.b[c]
            d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            on = d <= most
            found.append((s + r[on], c[on], d[on]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else None


def sq_distances(a: np.ndarray, b: np.ndarray, exact_at: tuple[float, ...] = (0.0,)) -> np.ndarray:
    """``Distances`` of some points."""
    return Distances(b, exact_at).of(a)


def pack(points: DataFrame, extras: dict[str, str] | None = None, by: tuple[str, ...] = (), payload: str | None = None, span: str | None = None,
         size: int = 512) -> DataFrame:
    """(by..., chunk, n, rows, x, extras..., payload, lo, hi): up to ``size``
    points that are neighbours in a partition and equal in ``by``.

    ``points`` has ``_row`` (long), ``_x`` (array<double>) and an array column
    for each of ``extras`` (name -> numpy kind of its numbers); ``payload``, a
    string column, becomes an array; lo and hi are the least and the largest
    ``span``."""
    extras = extras or {}
    kinds = {c: points.schema[c].dataType.simpleString() for c in by}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in by:
                v = b.column(c).to_numpy(zero_copy_only=False)
                new[1:] |= v[1:] != v[:-1]
            edges = [0, *np.flatnonzero(new).tolist(), n]
            cuts = [i for e, f in zip(edges, edges[1:], strict=False) for i in range(e, f, size)] + [n]
            flat = lambda c, kind: np.ascontiguousarray(
                (b.column(c).flatten() if pa.types.is_list(b.column(c).type) else b.column(c)).to_numpy(zero_copy_only=False), kind)
            parts = {"rows": flat("_row", "<i8"), "x": flat("_x", "<f8"), **{c: flat(c, k) for c, k in extras.items()}}
            spans = list(zip(cuts, cuts[1:], strict=False))
            cols = {c: b.column(c).take(pa.array(cuts[:-1])) for c in by}
            cols["chunk"] = pa.array(base + made + np.arange(len(spans)))
            cols["n"] = pa.array([j - i for i, j in spans], pa.int32())
            for c, v in parts.items():
                w = len(v) // n
                cols[c] = pa.array([v[i * w:j * w].tobytes() for i, j in spans], pa.binary())
            if payload:
                cols[payload] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), b.column(payload))
            if span:
                v = b.column(span).to_numpy(zero_copy_only=False)
                cols["lo"], cols["hi"] = (pa.array(f.reduceat(v, cuts[:-1])) for f in (np.minimum, np.maximum))
            made += len(spans)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    schema = [f"`{c}` {k}" for c, k in kinds.items()] + ["chunk long, n int, rows binary, x binary", *[f"{c} binary" for c in extras]]
    schema += ([f"{payload} array<string>"] if payload else []) + (["lo double, hi double"] if span else [])
    return points.select(*by, "_row", "_x", *extras, *([payload] if payload else []), *([span] if span else [])).mapInArrow(run, ", ".join(schema))


def unpack(rows: list[dict], name: str, kind: str) -> np.ndarray:
    """One array of all the chunks, a line for each point."""
    out = np.concatenate([np.frombuffer(r[name], kind).reshape(r["n"], -1) for r in rows])
    return out[:, 0] if name == "rows" else out


def hold_and_stream(held: DataFrame, streamed: DataFrame, blocks: int, start: Callable, schema: str) -> DataFrame:
    """For each ``block`` (0 to ``blocks`` - 1) ``start(chunks)`` with the held
    chunks, then ``add(chunk)`` for each streamed one, in the order of chunk
    numbers, and ``finish()``; both may
    yield Arrow batches. Both tables have the columns of ``pack`` and
    ``block``; a block without held chunks gives nothing."""
    both = held.withColumn("_role", F.lit(0)).unionByName(streamed.withColumn("_role", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chunks, work = None, [], None
        for b in batches:
            for row in b.to_pylist():
                if row["block"] != block:
                    if chunks:
                        yield from (work or start(chunks)).finish()
                    block, chunks, work = row["block"], [], None
                if row["_role"] == 0:
                    chunks.append(row)
                elif chunks:
                    work = work or start(chunks)
                    yield from work.add(row) or ()
        if chunks:
            yield from (work or start(chunks)).finish()

    parts = max(1, min(blocks, 50_000))
    return both.repartitionById(parts, F.pmod("block", F.lit(parts)).cast("int")).sortWithinPartitions("block", "_role", "chunk").mapInArrow(run, schema)


def in_blocks(chunks: DataFrame, n: int, block_rows: int) -> tuple[DataFrame, int]:
    """``chunks`` with their ``block`` of about ``block_rows`` points, and the
    number of blocks."""
    nb = max(1, math.ceil(n / block_rows))
    place, number = F.shiftright("chunk", 32), F.col("chunk").bitwiseAND((1 << 32) - 1)
    parts = (chunks.agg(F.max(place)).first()[0] or 0) + 1  # partitions take turns, so blocks get about equal numbers
    return chunks.withColumn("block", F.pmod(number * parts + place, F.lit(nb)).cast("long")), nb


def to_all(chunks: DataFrame, blocks: int) -> DataFrame:
    """Every chunk once for each block."""
    return chunks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
