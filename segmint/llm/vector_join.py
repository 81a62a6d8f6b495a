"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction on the sphere; a vector is in the caps of all filters
whose product with it exceeds a threshold. The directions are random product
codes: a randomly turned space is cut in two halves with a codebook each, and
every pair of codewords is a filter; several turns make up for what one misses. Only the two codebooks are stored and
a vector's filters are list-decoded from its products with them. Vectors that
share a filter are compared exactly.

Equal vectors are one node. Filters with one first codeword are one bucket, so
a vector travels once for several filters; large buckets are cut into chunks
whose pairs are tasks of their own, and tasks give back counts and a spanning
forest, not pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.text import forest, grouped
from segmint.operators.components import connected_components
from segmint.session import materialize


class Filters(NamedTuple):
    """``turns`` random turns of the space, each with ``code`` codewords in
    each half; ``recall``: of pairs exactly at ``cosine`` the share that a
    trial of random pairs finds (closer pairs are found more often)."""
    cosine: float = 0.9
    code: int = 256
    turns: int = 6
    recall: float = 0.995
    seed: int = 7

    @property
    def number(self) -> str:
        """The type that holds a filter's number, (turn * code + i) * code + j."""
        return "<i4" if self.turns * self.code ** 2 < 2 ** 31 else "<i8"


@functools.lru_cache(16)
def codebooks(f: Filters, d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each turn both halves' codewords, turned back, as (d, code) matrices."""
    rng = np.random.default_rng([f.seed, d])
    out = []
    for _ in range(f.turns):
        turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
        books = []
        for half in (slice(0, (d + 1) // 2), slice((d + 1) // 2, d)):
            c = np.zeros((d, f.code))
            c[half] = rng.standard_normal((len(range(*half.indices(d))), f.code))
            norm = np.linalg.norm(c, axis=0)
            books.append(turn @ (c / np.where(norm > 0, norm, 1)))
        out.append((books[0], books[1]))
    return out


def decode(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """The filters i * code + j with a[i] + b[j] >= least, ascending. Only
    codewords that can reach it with the other half's best are paired."""
    i = np.flatnonzero(a >= least - b.max())
    j = np.flatnonzero(b >= least - a.max())
    x, y = np.nonzero(a[i][:, None] + b[j][None, :] >= least)
    return i[x].astype(np.int64) * len(b) + j[y]


@functools.lru_cache(16)
def threshold(f: Filters, d: int, trials: int = 1000) -> float:
    """The largest threshold (by bisection) that finds ``recall`` of random
    pairs at the cosine; depends on nothing but its arguments."""
    rng = np.random.default_rng([f.seed, d, 1])
    u = rng.standard_normal((trials, d))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((trials, d))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    norm = np.linalg.norm(w, axis=1, keepdims=True)
    w = np.where(norm > 1e-12, w / np.maximum(norm, 1e-12), u)
    v = f.cosine * u + np.sqrt(1 - f.cosine ** 2) * w
    products = [(u @ c, u @ e, v @ c, v @ e) for c, e in codebooks(f, d)]

    def meet(k: int, least: float) -> bool:
        for a, b, c, e in products:
            i = np.flatnonzero((a[k] >= least - b[k].max()) & (c[k] >= least - e[k].max()))
            if len(i):
                j = np.flatnonzero((b[k] >= least - a[k].max()) & (e[k] >= least - c[k].max()))
                if ((a[k][i][:, None] + b[k][j] >= least) & (c[k][i][:, None] + e[k][j] >= least)).any():
                    return True
        return False

    low, high = -2.0, 2.0
    for _ in range(10):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(meet(k, mid) for k in range(trials)) >= f.recall * trials else (low, mid)
    return low


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = np.stack([np.frombuffer(r, kind) for r in raw]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _code_for(vectors: int) -> int:
    """Codewords grow with the root of the number of vectors, so a filter's
    cap keeps about the same number of vectors that have nothing in common."""
    return 1 << max(6, int(np.ceil(np.log2(np.sqrt(max(1, vectors))))))


def _nodes(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, node, raw): node is a hash of the vector, null where it cannot
    link; raw its components as bytes."""
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    store = "<f4" if kind == "float" else "<f8"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in parts:
            node, raw = [], []
            for v in b.column("v").to_pylist():
                x = None if v is None or None in v else np.array(v, store)
                if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                    node.append(None)
                    raw.append(None)
                else:
                    raw.append((x + np.array(0, store)).tobytes())  # -0.0 becomes 0.0
                    node.append(xxhash.xxh3_64_intdigest(raw[-1]) - (1 << 63))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(node, pa.int64()), pa.array(raw, pa.binary())], ["vec_id", "node", "raw"])

    id_kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").alias("v")).mapInArrow(
        run, f"vec_id {id_kind}, node long, raw binary")


def _filtered(nodes: DataFrame, f: Filters, store: str) -> DataFrame:
    """(bucket, node, copies, raw, filters): one row for each turn and first
    codeword among a node's filters, with the filters up to there; the bucket
    also tells the number of components."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            raw = b.column("raw").to_pylist()
            at, buckets, lists = [], [], []
            for length in sorted({len(r) for r in raw}):
                own = [i for i, r in enumerate(raw) if len(r) == length]
                d = length // np.dtype(store).itemsize
                least = threshold(f, d)
                for first in range(0, len(own), 1024):
                    some = own[first:first + 1024]
                    x = unit([raw[i] for i in some], store)
                    both = [(x @ c, x @ e) for c, e in codebooks(f, d)]
                    for n, i in enumerate(some):
                        filters = np.concatenate([t * f.code ** 2 + decode(a[n], b[n], least) for t, (a, b) in enumerate(both)])
                        k = np.unique(filters // f.code)
                        at += [i] * len(k)
                        buckets += (d * f.turns * f.code + k).tolist()
                        lists += [filters[:e] for e in np.searchsorted(filters, (k + 1) * f.code)]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int64()), b.column("node").take(take), b.column("copies").take(take), b.column("raw").take(take),
                 pa.array([x.astype(f.number).tobytes() for x in lists], pa.binary())], ["bucket", "node", "copies", "raw", "filters"])
    return nodes.mapInArrow(run, "bucket long, node long, copies long, raw binary, filters binary")


def _shares(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether the lists of each pair have a member in common."""
    members = np.unique(np.concatenate(left + right))

    def marks(lists):
        m = np.zeros((len(lists), len(members)), np.float32)
        for r, x in enumerate(lists):
            m[r, np.searchsorted(members, x)] = 1
        return m
    return marks(left) @ marks(right).T > 0


def _compared(rows: DataFrame, f: Filters, store: str) -> DataFrame:
    """For each pair of chunks of a bucket: (node, links) counts, and (node,
    other) edges of a forest. A pair counts in the bucket of its first common
    filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("bucket", "a", "b")):
            k = group[0]["bucket"] % (f.turns * f.code)
            same = group[0]["a"] == group[0]["b"]
            left = [r for r in group if r["chunk"] == group[0]["a"]]
            right = left if same else [r for r in group if r["chunk"] == group[0]["b"]]
            if not left or not right or same and len(left) < 2:
                continue
            x = unit([r["raw"] for r in left], store)
            y = x if same else unit([r["raw"] for r in right], store)
            linked = x @ y.T >= f.cosine
            if same:
                linked = np.triu(linked, 1)
            p, q = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            if not len(p):
                continue
            lists = lambda rows, at: [np.frombuffer(rows[i]["filters"], f.number) for i in at]
            u, v = lists(left, p), lists(right, q)
            part = linked[np.ix_(p, q)]
            part &= _shares([z[z // f.code == k] for z in u], [z[z // f.code == k] for z in v])
            part &= ~_shares([z[z // f.code < k] for z in u], [z[z // f.code < k] for z in v])
            a_nodes, b_nodes = np.array([left[i]["node"] for i in p]), np.array([right[i]["node"] for i in q])
            a_copies, b_copies = np.array([left[i]["copies"] for i in p]), np.array([right[i]["copies"] for i in q])
            count = np.concatenate([part @ b_copies, a_copies @ part])
            nodes = np.concatenate([a_nodes, b_nodes])
            some = count > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(count[some].astype(np.int64))], ["node", "other", "links"])
            edges = forest(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_nodes[[e[0] for e in edges]].astype(np.int64)), pa.array(b_nodes[[e[1] for e in edges]].astype(np.int64)),
                 pa.nulls(len(edges), pa.int64())], ["node", "other", "links"])

    keys = ("bucket", "a", "b")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node long, other long, links long")


def vector_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", filters: Filters | None = None,
                      chunk: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links``: other rows with a cosine of ``filters.cosine`` or more, by
    double precision; pairs without a common filter are missed (at the cosine
    itself ``1 - filters.recall`` of them, fewer above), never added. Null,
    empty and zero vectors and those with null or non-finite components link
    with nothing, nor do vectors of different length. Repeated rows link with
    each other. A null id never is the smallest unless there is no other, and
    is kept only then. Other columns are not read. An empty table gives an
    empty table. Without ``filters``, the code grows with the number of rows.
    """
    store = "<f4" if vectors.schema[vec_col].dataType.elementType.simpleString() == "float" else "<f8"
    rows = materialize(_nodes(vectors, id_col, vec_col), "caps-nodes")
    nodes = materialize(rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")), "caps-distinct")
    f = filters or Filters(code=_code_for(nodes.count()))
    spread = materialize(_filtered(nodes, f, store), "caps-filters")
    sizes = materialize(spread.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")), "caps-buckets")
    cut = spread.join(sizes, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    pairs = cut.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns(
        {"a": F.least("chunk", "to"), "b": F.greatest("chunk", "to")}).drop("to", "chunks")
    found = materialize(_compared(pairs, f, store), "caps-links")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("other is not null"), "node", "other")
    about = nodes.select("node", "copies").join(links, "node", "left").join(comps, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    about = materialize(about, "caps-about")
    some = rows.where("node is not null").select("vec_id", "node").join(about, "node")
    least = materialize(some.groupBy("root").agg(F.min("vec_id").alias("component_id")), "caps-least")
    whole = some.join(least, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
