"""Internal clustering metrics over feature columns and label columns.

* inertia, Davies-Bouldin and Calinski-Harabasz: one groupBy(cluster) for the
  centroids (k rows, broadcast back: the size is bounded by the model's K),
  then one pass over the points.
* silhouette: exact, of all points against all. A task holds a block of points
  and streams all points past it in packed chunks (see ``strips``), so it ends
  with the whole sums of its points and gives back one row for each; several
  labelings share ONE distance pass. On the line and in the plane what is far
  comes as weights at the nodes of a box (see ``fields``), which is as right as
  doubles are and not quadratic; with more features it is quadratic by nature. Rows have no key, so ids may repeat or be
  null. ``silhouette_sampled`` is the estimator with a standard error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.functions import rules
from segmint.operators import fields
from segmint.operators.strips import TILE, Distances, hold_and_stream, in_blocks, pack, to_all, unpack
from segmint.session import materialize


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def centroids(df: DataFrame, cols: list[str], label: str = "cluster_id") -> DataFrame:
    """(cluster_id, n, c_0 .. c_{d-1}): cluster means."""
    return df.groupBy(F.col(_q(label)).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(_q(c)).cast("double")).alias(f"c_{i}") for i, c in enumerate(cols)])


def _sqdist(cols: list[str], prefix: str = "c_") -> Column:
    return sum(((F.col(_q(c)).cast("double") - F.col(f"{prefix}{i}")) ** 2 for i, c in enumerate(cols)), F.lit(0.0))


def _with_centroid(df: DataFrame, cols: list[str], label: str, cents: DataFrame | None = None) -> DataFrame:
    cents = cents if cents is not None else centroids(df, cols, label)
    return df.select(F.col(_q(label)).alias("cluster_id"), *[F.col(_q(c)) for c in cols]).join(
        F.broadcast(cents), "cluster_id")  # k rows


def inertia(df: DataFrame, cols: list[str], label: str | list[str] = "cluster_id", cents: DataFrame | None = None) -> DataFrame:
    """Sum of squared distances to the own centroid (cluster means unless
    ``cents`` is given). For a list of labelings (labeling, inertia), all from
    the same two passes; then ``cents`` has a column labeling too."""
    if not isinstance(label, str):
        xs = [f"x_{i}" for i in range(len(cols))]
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("labeling"), F.col(_q(c)).alias("cluster_id")) for c in label]))
        long = df.select(*[F.col(_q(c)).cast("double").alias(x) for c, x in zip(cols, xs, strict=True)], each.alias("_l")).select(*xs, "_l.labeling", "_l.cluster_id")
        if cents is None:
            cents = long.groupBy("labeling", "cluster_id").agg(*[F.avg(x).alias(f"c_{i}") for i, x in enumerate(xs)])
        own = long.join(F.broadcast(cents), ["labeling", "cluster_id"])  # labelings x k rows
        return own.groupBy("labeling").agg(F.sum(_sqdist(xs)).alias("inertia"))
    return _with_centroid(df, cols, label, cents).agg(F.sum(_sqdist(cols)).alias("inertia"))


def calinski_harabasz(df: DataFrame, cols: list[str], label: str = "cluster_id") -> DataFrame:
    """[B / (k - 1)] / [W / (n - k)]; 1.0 when W = 0."""
    cents = centroids(df, cols, label)
    w = _with_centroid(df, cols, label, cents).agg(F.sum(_sqdist(cols)).alias("w"))
    allw = Window.partitionBy()
    g = cents
    for i in range(len(cols)):
        g = g.withColumn(f"g_{i}", F.sum(F.col("n") * F.col(f"c_{i}")).over(allw) / F.sum("n").over(allw))
    b = g.agg(F.sum(F.col("n") * sum(((F.col(f"c_{i}") - F.col(f"g_{i}")) ** 2 for i in range(len(cols))),
                                      F.lit(0.0))).alias("b"),
              F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    return b.crossJoin(w).select(
        F.when(F.col("w") == 0, F.lit(1.0))
        .otherwise(F.col("b") * (F.col("n") - F.col("k")) / (F.col("w") * (F.col("k") - 1))).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cols: list[str], label: str = "cluster_id") -> DataFrame:
    """mean over clusters i of max over j != i of (s_i + s_j) / d(c_i, c_j),
    s = mean Euclidean distance to the centroid. The k x k step runs on the
    k-row centroid table."""
    cents = centroids(df, cols, label)
    s = (_with_centroid(df, cols, label, cents).groupBy("cluster_id")
         .agg(F.avg(F.sqrt(_sqdist(cols))).alias("s")))
    c = cents.join(s, "cluster_id")
    a = c.select(*[F.col(x).alias(f"a_{x}") for x in c.columns])
    b = c.select(*[F.col(x).alias(f"b_{x}") for x in c.columns])
    d = F.sqrt(sum(((F.col(f"a_c_{i}") - F.col(f"b_c_{i}")) ** 2 for i in range(len(cols))), F.lit(0.0)))
    pairs = a.join(F.broadcast(b), F.col("a_cluster_id") != F.col("b_cluster_id"))  # k x k, k = model size
    ratio = F.when(d == 0, F.lit(float("inf"))).otherwise((F.col("a_s") + F.col("b_s")) / d)
    per = pairs.groupBy("a_cluster_id").agg(F.max(ratio).alias("r"), F.max(F.col("a_s") + F.col("b_s")).alias("ss"),
                                            F.max(d).alias("dmax"))
    # all scatters 0 or all centroids equal -> 0
    return per.agg(F.when((F.max("ss") == 0) | (F.max("dmax") == 0), F.lit(0.0))
                   .otherwise(F.avg("r")).alias("davies_bouldin"))


def db_ch_multi(df: DataFrame, cols: list[str], labels: list[str]) -> DataFrame:
    """(labeling, davies_bouldin, calinski_harabasz, n_clusters) for many
    labelings of the same points in one pass: the labelings are exploded
    next to the points, so centroids, scatters and within sums of every
    labeling come from ONE groupBy(labeling, cluster); the k x k steps run on
    the (labelings x K)-row centroid table."""
    d = len(cols)
    long = df.select(F.array(*[F.col(_q(c)).cast("double") for c in cols]).alias("_x"),
                     F.posexplode(F.array(*[F.col(_q(c)).cast("int") for c in labels])).alias("_l", "_c")
                     ).where(F.col("_c") >= 0)
    cents = long.groupBy("_l", "_c").agg(F.count(F.lit(1)).alias("n"),
                                         *[F.avg(F.col("_x")[i]).alias(f"c_{i}") for i in range(d)])
    d2 = sum(((F.col("_x")[i] - F.col(f"c_{i}")) ** 2 for i in range(d)), F.lit(0.0))
    per = (long.join(F.broadcast(cents), ["_l", "_c"])  # labelings x K rows
           .groupBy("_l", "_c").agg(F.sum(d2).alias("w"), F.avg(F.sqrt(d2)).alias("s")))
    c = cents.join(per, ["_l", "_c"])
    lw = Window.partitionBy("_l")
    g = c
    for i in range(d):
        g = g.withColumn(f"g_{i}", F.sum(F.col("n") * F.col(f"c_{i}")).over(lw) / F.sum("n").over(lw))
    ch = g.groupBy("_l").agg(
        F.sum(F.col("n") * sum(((F.col(f"c_{i}") - F.col(f"g_{i}")) ** 2 for i in range(d)), F.lit(0.0))).alias("b"),
        F.sum("w").alias("w"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    ch = ch.select("_l", "k", F.when(F.col("w") == 0, F.lit(1.0)).otherwise(
        F.col("b") * (F.col("n") - F.col("k")) / (F.col("w") * (F.col("k") - 1))).alias("calinski_harabasz"))
    a = c.select(*[F.col(x).alias(f"a{x}" if x != "_l" else "_l") for x in c.columns])
    b = c.select(*[F.col(x).alias(f"b{x}" if x != "_l" else "_l") for x in c.columns])
    dist = F.sqrt(sum(((F.col(f"ac_{i}") - F.col(f"bc_{i}")) ** 2 for i in range(d)), F.lit(0.0)))
    pairs = a.join(b, "_l").where(F.col("a_c") != F.col("b_c"))
    ratio = F.when(dist == 0, F.lit(float("inf"))).otherwise((F.col("as") + F.col("bs")) / dist)
    pr = pairs.groupBy("_l", "a_c").agg(F.max(ratio).alias("r"), F.max(F.col("as") + F.col("bs")).alias("ss"),
                                        F.max(dist).alias("dmax"))
    db = pr.groupBy("_l").agg(F.when((F.max("ss") == 0) | (F.max("dmax") == 0), F.lit(0.0))
                              .otherwise(F.avg("r")).alias("davies_bouldin"))
    names = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("_l") + 1)
    return ch.join(db, "_l", "left").select(names.alias("labeling"), "davies_bouldin", "calinski_harabasz",
                                            F.col("k").alias("n_clusters"))


# ---------------------------------------------------------------------------
# Silhouette
# ---------------------------------------------------------------------------

_POINT = "ids string, s array<struct<l:int,c:int,a:double,b:double,silhouette:double>>"


class _Sums:
    """Sums of distances from the held points to every cluster of every
    labeling; label values < 0 belong to no cluster. Clusters get a line
    when they first come by, or with ``grouped`` every group of points that
    share their clusters in all labelings, whose sums meet in ``finish``."""

    grouped = False

    def __init__(self, held: list[dict], labelings: int, grouped: bool = False):
        self.labelings, self.grouped, self.group_of, self.groups = labelings, grouped, {}, []
        self.x, self.own = unpack(held, "x", "<f8"), unpack(held, "labels", "<i4").astype(np.int64)
        self.ids = [i for r in held for i in r["ids"]]
        self.keys, self.lines = np.zeros(0, np.int64), np.zeros(0, np.int64)  # ascending, and their lines
        self.sums, self.count = np.zeros((8, len(self.x))), np.zeros(8, np.int64)

    def _room(self, lines: int) -> None:
        if lines > len(self.sums):
            more = max(lines - len(self.sums), len(self.sums) // 2)
            self.sums = np.concatenate([self.sums, np.zeros((more, len(self.x)))])
            self.count = np.pad(self.count, (0, more))

    def _lines(self, keys: np.ndarray) -> np.ndarray:
        new = np.setdiff1d(keys, self.keys, assume_unique=True)
        if len(new):
            used = len(self.keys)
            self._room(used + len(new))
            at = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, at, new)
            self.lines = np.insert(self.lines, at, np.arange(used, used + len(new)))
        return self.lines[np.searchsorted(self.keys, keys)]

    def add(self, row: dict) -> None:
        """Neighbours that share a cluster in every labeling are added up
        first; chunks are in the order of the labels, so they are few."""
        y, c = np.frombuffer(row["x"], "<f8").reshape(row["n"], -1), np.frombuffer(row["labels"], "<i4").reshape(row["n"], -1)
        on = (c >= 0).any(axis=1)
        if not on.any():
            return
        y, c = y[on], c[on]
        first = np.flatnonzero(np.append(True, (c[1:] != c[:-1]).any(axis=1)))
        groups, size = c[first], np.diff(np.append(first, len(c)))
        far = Distances(y)
        hot = np.repeat(np.eye(len(size)), size, axis=0) if len(size) <= 8 else None
        part = np.empty((len(self.x), len(size)))
        tile = TILE if y.shape[1] <= 4 else 4 * TILE
        for s in range(0, len(self.x), tile):
            d = far.of(self.x[s:s + tile])
            np.sqrt(d, out=d)
            if hot is not None:
                np.matmul(d, hot, out=part[s:s + tile])
            else:
                np.add.reduceat(d, first, axis=1, out=part[s:s + tile])
        if self.grouped:
            for j, g in enumerate(groups):
                line = self.group_of.setdefault(g.tobytes(), len(self.groups))
                if line == len(self.groups):
                    self.groups.append(g)
                    self._room(line + 1)
                self.count[line] += size[j]
                self.sums[line] += part[:, j]
            return
        group, labeling = np.nonzero(groups >= 0)
        keys, which = np.unique((labeling.astype(np.int64) << 32) | groups[group, labeling], return_inverse=True)
        at = self._lines(keys)
        self.count[at] += np.bincount(which, size[group]).astype(np.int64)
        member = np.zeros((len(keys), len(size)))
        member[which, group] = 1.0
        for s in range(0, len(keys), 8):
            for line, more in zip(at[s:s + 8], member[s:s + 8] @ part.T, strict=True):
                self.sums[line] += more

    def _clusters(self, li: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(labels of a labeling, ascending, their sums, their sizes)."""
        if not self.grouped:
            lo, hi = np.searchsorted(self.keys, [li << 32, (li + 1) << 32])
            return self.keys[lo:hi] - (li << 32), self.sums[self.lines[lo:hi]], self.count[self.lines[lo:hi]]
        label = np.array([g[li] for g in self.groups], np.int64)
        by = np.argsort(label, kind="stable")
        by = by[np.searchsorted(label[by], 0):]
        if not len(by):
            return by, np.zeros((0, len(self.own))), by
        names, first = np.unique(label[by], return_index=True)
        return names, np.add.reduceat(self.sums[by], first, axis=0), np.add.reduceat(self.count[by], first)

    def finish(self):
        n = len(self.own)
        parts = []
        for li in range(self.labelings):
            on = np.flatnonzero(self.own[:, li] >= 0)
            names, sums, size = self._clusters(li)
            mine = np.searchsorted(names, self.own[on, li])
            sums = sums[:, on].T
            rows = np.arange(len(on))
            own = size[mine]
            a = np.where(own > 1, sums[rows, mine] / np.maximum(own - 1, 1), 0.0)
            means = sums / np.maximum(size, 1)
            if len(names) > 1:
                means[rows, mine] = np.inf
                b = means.min(axis=1)
            else:
                b = np.full(len(on), np.nan)
            top = np.maximum(a, b)
            s = np.where((own <= 1) | np.isnan(b) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))
            parts.append((on, np.full(len(on), li), self.own[on, li], a, b, s))
        point, li, c, a, b, s = (np.concatenate(p) for p in zip(*parts, strict=True))
        by = np.argsort(point, kind="stable")
        at = np.searchsorted(point[by], np.arange(n + 1))
        cells = pa.StructArray.from_arrays([pa.array(li[by], pa.int32()), pa.array(c[by], pa.int32()), pa.array(a[by]),
                                            pa.array(b[by], mask=np.isnan(b[by])), pa.array(s[by])], ["l", "c", "a", "b", "silhouette"])
        yield pa.RecordBatch.from_arrays([pa.array(self.ids, pa.string()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), cells)], ["ids", "s"])


class _FieldSums(_Sums):
    """The same from the boxes of a tree; the clusters and their sizes are known."""

    def __init__(self, held: list[dict], tree: fields.Tree, labelings: int, keys: np.ndarray, count: np.ndarray):
        self.labelings, self.keys, self.lines, self.count = labelings, keys, np.arange(len(keys)), count
        self.own, self.ids = unpack(held, "labels", "<i4").astype(np.int64), [i for r in held for i in r["ids"]]
        self.found = fields.Sums(held, tree, keys)

    def add(self, row: dict) -> None:
        self.found.add(row)

    def finish(self):
        self.sums = self.found.whole().T
        yield from super().finish()


def _field_silhouettes(pts: DataFrame, n: int, d: int, labelings: int, leaf: int) -> DataFrame:
    """``_silhouettes`` of all points on the line or in the plane."""
    sizes = pts.select(F.posexplode("labels").alias("l", "c")).where("c >= 0").groupBy("l", "c").agg(F.count(F.lit(1)).alias("n")).toArrow()  # one row a cluster
    keys = (sizes.column("l").to_numpy().astype(np.int64) << 32) | sizes.column("c").to_numpy().astype(np.int64)
    by = np.argsort(keys)
    keys, count = keys[by], sizes.column("n").to_numpy()[by]
    rows = max(64, (1 << 22) // (d + 2 * len(keys) + 1))
    return fields.held_and_streamed(pts, n, d, rows, lambda held, tree: _FieldSums(held, tree, labelings, keys, count), _POINT, leaf)


def _labelled_points(df: DataFrame, cols: list[str], labels: list[str], id_col: str) -> DataFrame:
    return df.select(F.col(_q(id_col)).cast("string").alias("ids"),
                     F.array(*[F.coalesce(F.col(_q(c)).cast("int"), F.lit(-1)) for c in labels]).alias("labels"),
                     F.array(*[F.col(_q(c)).cast("double") for c in cols]).alias("_x"))


def _labelled_chunks(df: DataFrame, cols: list[str], labels: list[str], id_col: str) -> tuple[DataFrame, int, int, bool]:
    """(chunks, points, clusters of all labelings or groups of points that
    share their clusters, if they are fewer, and whether they are); points
    without a cluster are left out."""
    pts = _labelled_points(df, cols, labels, id_col).where(F.exists("labels", lambda c: c >= 0)).withColumn("_row", F.monotonically_increasing_id())
    chunks = materialize(pack(pts.sortWithinPartitions("labels"), {"labels": "<i4"}, payload="ids").drop("rows"), "silhouette-points")
    n = chunks.agg(F.sum("n")).first()[0] or 0
    every = F.approx_count_distinct(F.xxhash64(*[F.col(_q(c)) for c in labels]))
    *known, groups = df.agg(*[F.approx_count_distinct(F.col(_q(c))).alias(f"k{i}") for i, c in enumerate(labels)], every).first()
    return chunks, int(n), int(min(sum(known), groups)), groups < sum(known)


def _silhouettes(held: DataFrame, chunks: DataFrame, n_held: int, d: int, labelings: int, clusters: int, grouped: bool = False) -> DataFrame:
    """One row for each held point: its id and (labeling, cluster, a, b,
    silhouette) of every labeling in which it has a cluster. A task keeps
    about eight million numbers whatever the number of clusters. Every block
    gets all chunks through the shuffle, so there are no more blocks than the
    cores and that bound ask for, and as many for every core."""
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    rows = max(64, min((1 << 23) // (d + clusters + 1), math.ceil(n_held / (2 * cores))))
    rows = max(64, math.ceil(n_held / (cores * max(1, math.ceil(n_held / (rows * cores))))))
    held, blocks = in_blocks(held, n_held, rows)
    streamed = to_all(chunks.select("chunk", "n", "x", "labels"), blocks)
    return hold_and_stream(held, streamed, blocks, lambda rows: _Sums(rows, labelings, grouped), _POINT)


def silhouette_samples(df: DataFrame, cols: list[str], labels: list[str] | str = "cluster_id",
                       id_col: str = "customerID", leaf: int = 512) -> DataFrame:
    """(id, labeling, cluster_id, a, b, silhouette) per row and labeling.

    Label values < 0 or null are noise: such rows get no value for that
    labeling and are not part of any cluster. A row alone in its cluster gets
    0. Repeated and null ids are rows like any other. Features must not be
    null. Each task holds a block of rows and streams all others past it, and
    gives back one row for each it holds. With one or two features and more than
    ``leaf`` * 8 rows, all finite, far rows come as boxes of about ``leaf`` rows
    or more; else the work is quadratic."""
    labels = [labels] if isinstance(labels, str) else list(labels)
    out = None
    if len(cols) <= 2:
        pts = materialize(_labelled_points(df, cols, labels, id_col), "silhouette-rows").withColumn("_row", F.monotonically_increasing_id())
        odd = F.exists("_x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > 1e100))
        n, bad = pts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(odd, 1)), F.lit(0))).first()
        if n > 8 * leaf and not bad:
            out = _field_silhouettes(pts, n, len(cols), len(labels), leaf)
    if out is None:
        chunks, n, clusters, grouped = _labelled_chunks(df, cols, labels, id_col)
        out = _silhouettes(chunks, chunks, n, len(cols), len(labels), clusters, grouped)
    out = out.select("ids", F.explode("s").alias("s"))
    return out.select(F.col("ids").alias(id_col), _named(labels, F.col("s.l")).alias("labeling"), F.col("s.c").alias("cluster_id"), "s.a", "s.b",
                      "s.silhouette")


def _named(labels: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in labels]), number + 1)


def silhouette_sampled(df: DataFrame, cols: list[str], labels: list[str] | str = "cluster_id", id_col: str = "customerID",
                       sample: int = 500, seed: int = 42) -> DataFrame:
    """(labeling, silhouette, std_error, n, n_sampled, mode) per labeling: an
    estimate of the mean from ``sample`` random rows of every cluster, whose
    own values are exact (against all rows).

    Clusters are strata: the estimate is the mean of their sample means by
    size, so it is unbiased, and ``std_error`` is the usual one of a
    stratified sample without replacement (0 where a cluster has no more than
    ``sample`` rows). The cost is linear in the rows for a number of clusters."""
    if sample < 2:
        raise ValueError("a standard error needs two rows of every cluster")
    labels = [labels] if isinstance(labels, str) else list(labels)
    x = [F.col(_q(c)).cast("double") for c in cols]
    pts = materialize(df.select(F.array(*[F.coalesce(F.col(_q(c)).cast("int"), F.lit(-1)) for c in labels]).alias("labels"), F.array(*x).alias("_x"),
                                F.monotonically_increasing_id().alias("_row")), "silhouette-points")
    own = pts.select("_row", F.posexplode("labels").alias("l", "c")).where("c >= 0")
    sizes = own.groupBy("l", "c").agg(F.count(F.lit(1)).alias("n"))
    # the first rows of every cluster by a hash; Spark limits the groups before it shuffles them
    first = Window.partitionBy("l", "c").orderBy(F.xxhash64(F.lit(seed), "_row", "l"), "_row")
    drawn = own.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= sample)
    drawn = drawn.groupBy("_row").agg(F.collect_set("l").alias("in"))
    some = materialize(pts.join(drawn, "_row").withColumn("ids", F.concat_ws(",", F.transform("in", lambda v: v.cast("string")))), "silhouette-sample")
    chunks = materialize(pack(pts, {"labels": "<i4"}), "silhouette-chunks")
    held = pack(some, {"labels": "<i4"}, payload="ids", size=256)
    known = sizes.count()
    out = _silhouettes(held, chunks, some.count(), len(cols), len(labels), known)
    out = out.select(F.split("ids", ",").alias("in"), F.explode("s").alias("s")).where(F.array_contains("in", F.col("s.l").cast("string")))
    per = out.groupBy(F.col("s.l").alias("l"), F.col("s.c").alias("c")).agg(
        F.count(F.lit(1)).alias("m"), F.avg("s.silhouette").alias("mean"), F.coalesce(F.var_samp("s.silhouette"), F.lit(0.0)).alias("v"))
    per = per.join(sizes, ["l", "c"])
    whole = F.sum("n")
    return per.groupBy("l").agg((F.sum(F.col("n") * F.col("mean")) / whole).alias("silhouette"),
                                (F.sqrt(F.sum(F.col("n") * (F.col("n") - F.col("m")) * F.col("v") / F.col("m"))) / whole).alias("std_error"),
                                whole.alias("n"), F.sum("m").alias("n_sampled")).select(
        _named(labels, F.col("l")).alias("labeling"), "silhouette", "std_error", "n", "n_sampled", F.lit("sampled").alias("mode"))


def silhouette_score(df: DataFrame, cols: list[str], labels: list[str] | str = "cluster_id",
                     id_col: str = "customerID", mode: str = "exact", **kw) -> DataFrame:
    """(labeling, silhouette, n, mode) per labeling.

    ``mode='exact'``: mean of ``silhouette_samples`` over all points.
    ``mode='sampled'``: ``silhouette_sampled``, with a standard error; never
    chosen by size.
    ``mode='squared'``: Spark's ClusteringEvaluator (squared Euclidean), a
    different number, linear cost, over all points too."""
    labels = [labels] if isinstance(labels, str) else list(labels)
    if mode == "exact":
        kept = dict.fromkeys([*cols, *labels])  # a mean needs no ids
        smp = silhouette_samples(df.select(F.lit(None).cast("string").alias("_none"), *[F.col(_q(c)) for c in kept]), cols, labels, "_none", **kw)
        return smp.groupBy("labeling").agg(F.avg("silhouette").alias("silhouette"),
                                           F.count(F.lit(1)).alias("n")).withColumn("mode", F.lit("exact"))
    if mode == "sampled":
        return silhouette_sampled(df, cols, labels, id_col, **kw)
    if mode == "squared":
        from pyspark.ml.evaluation import ClusteringEvaluator
        from pyspark.ml.feature import VectorAssembler
        spark = df.sparkSession
        rows = []
        for lab in labels:
            v = VectorAssembler(inputCols=cols, outputCol="_f").transform(
                df.where(F.col(_q(lab)) >= 0).select(*cols, F.col(_q(lab)).cast("double").alias("_p")))
            val = ClusteringEvaluator(featuresCol="_f", predictionCol="_p",
                                      distanceMeasure="squaredEuclidean").evaluate(v)
            rows.append((lab, float(val), None, "squared"))
        return spark.createDataFrame(rows, "labeling string, silhouette double, n long, mode string")
    raise ValueError(f"unknown silhouette mode {mode!r}")


def internal_metrics(df: DataFrame, cols: list[str], label: str = "cluster_id", id_col: str = "customerID",
                     mode: str = "exact", **kw) -> DataFrame:
    """One row: silhouette, davies_bouldin, calinski_harabasz, n_samples,
    n_clusters, structure band."""
    sil = silhouette_score(df, cols, label, id_col, mode=mode, **kw).select("silhouette")
    db = davies_bouldin(df, cols, label)
    ch = calinski_harabasz(df, cols, label)
    cnt = df.agg(F.count(F.lit(1)).alias("n_samples"), F.countDistinct(F.col(_q(label))).alias("n_clusters"))
    return (sil.crossJoin(db).crossJoin(ch).crossJoin(cnt)  # one-row frames
            .withColumn("structure", rules.silhouette_band("silhouette")))


# ---------------------------------------------------------------------------
# Nearest-centroid assignment and one Lloyd step
# ---------------------------------------------------------------------------

def assign_nearest(cols: list[str], cents: list[list[float]]) -> Column:
    """Index of the nearest centroid (squared Euclidean); ties go to the
    lowest index (``array_position`` finds the first minimum). The centroids
    are literals: k x d numbers, bounded by K; the expression is linear in k."""
    ds = [sum(((F.col(_q(c)).cast("double") - F.lit(float(v))) ** 2 for c, v in zip(cols, cent)), F.lit(0.0))
          for cent in cents]
    if len(ds) == 1:
        return F.lit(0).cast("int")
    arr = F.array(*ds)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def lloyd_step(df: DataFrame, cols: list[str], cents: list[list[float]]) -> DataFrame:
    """Assign to the given centroids, then recompute them:
    (cluster_id, n, c_0 .. c_{d-1}, inertia_before)."""
    lab = df.select(*[F.col(_q(c)) for c in cols], assign_nearest(cols, cents).alias("cluster_id"))
    arr = F.array(*[F.array(*[F.lit(float(v)) for v in cent]) for cent in cents])
    d_own = sum(((F.col(_q(c)).cast("double") - F.element_at(F.element_at(arr, F.col("cluster_id") + 1), i + 1)) ** 2
                 for i, c in enumerate(cols)), F.lit(0.0))
    return lab.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"),
                                         *[F.avg(F.col(_q(c)).cast("double")).alias(f"c_{i}") for i, c in enumerate(cols)],
                                         F.sum(d_own).alias("inertia_before"))
