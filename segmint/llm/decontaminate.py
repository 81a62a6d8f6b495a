"""Benchmark decontamination by greedy string tiling.

Seeds are windows of tokens that a document shares with a test item. A
fixed-size bitmap of the items' seeds lets every task keep only the covered
stretches of its documents; the kept seeds are joined with the items' seeds,
and each (document, item) pair is tiled: the longest run of matching windows
that touches no marked token is marked on both sides, again and again. What
the tiles cover of the item is its contamination, in whatever order its
passages stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.text import free_name, shingle_hashes, utf8, word_hashes
from segmint.session import materialize

#: ASCII punctuation separates words; only A-Z are lowered.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def tokens(text: bytes) -> np.ndarray:
    return word_hashes(text.translate(_PLAIN).split())


def running_hashes(t: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of n, by prefix sums modulo 2**64."""
    if len(t) < n:
        return np.zeros(0, np.uint64)
    up = np.cumprod(np.full(len(t), _BASE))
    down = np.cumprod(np.full(len(t), _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t * down)])
    return (sums[n:] - sums[:-n]) * up[n - 1:]


def tile(doc: np.ndarray, at: np.ndarray, item: np.ndarray, n: int, most_pairs: int = 20_000_000) -> list[tuple[int, int, int]]:
    """(position in the document, position in the item, length) of the tiles,
    longest first; of equal ones the first in the item, then in the document.

    ``doc`` holds the covered tokens and ``at`` their positions. In texts so
    repetitive that over ``most_pairs`` windows match, the same tiles are found
    without a list of the pairs.
    """
    n = min(n, len(item))
    if not n or len(doc) < n:
        return []
    hd, hi = running_hashes(doc, n), running_hashes(item, n)
    whole = at[n - 1:] - at[:len(at) - n + 1] == n - 1  # windows across a gap are none
    order = np.argsort(hi, kind="stable")
    left, right = np.searchsorted(hi[order], hd, "left"), np.searchsorted(hi[order], hd, "right")
    count = np.where(whole, right - left, 0)
    if count.sum() > most_pairs:
        return _tile_by_rows(doc, at, item, n)
    p = np.repeat(np.arange(len(hd)), count)
    q = order[np.concatenate([np.arange(a, a + c) for a, c in zip(left[count > 0], count[count > 0], strict=True)])] if len(p) else p
    real = np.ones(len(p), bool)
    for k in range(n):
        real &= doc[p + k] == item[q + k]
    p, q = p[real], q[real]
    by = np.lexsort((p, at[p] - q))
    p, q = p[by], q[by]
    tiles = []
    while len(p):
        joined = np.zeros(len(p), bool)
        joined[1:] = (at[p[1:]] - q[1:] == at[p[:-1]] - q[:-1]) & (at[p[1:]] == at[p[:-1]] + 1)
        first = np.flatnonzero(~joined)
        length = np.diff(np.concatenate([first, [len(p)]])) + n - 1
        best = np.lexsort((at[p[first]], q[first], -length))[0]
        a, b, size = int(p[first[best]]), int(q[first[best]]), int(length[best])
        tiles.append((int(at[a]), b, size))
        free = ((at[p] + n <= at[a]) | (at[p] >= at[a] + size)) & ((q + n <= b) | (q >= b + size))
        p, q = p[free], q[free]
    return tiles


def _tile_by_rows(doc: np.ndarray, at: np.ndarray, item: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """``tile`` with the match lengths of one item position at a time: memory
    of the document's size, whatever matches. All tiles of the greatest length
    are marked in one round, since those that don't overlap stay the longest."""
    md, mi = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    goes_on = np.append(np.diff(at) == 1, False)
    tiles = []
    while True:
        best, found = n, []
        run = np.zeros(len(doc) + 1, np.int64)
        for q in range(len(item) - 1, -1, -1):
            here = (doc == item[q]) & ~md if not mi[q] else np.zeros(len(doc), bool)
            run[:-1] = np.where(here, 1 + run[1:] * goes_on, 0)
            top = int(run.max())
            if top > best:
                best, found = top, []
            if top == best:
                found.append((q, np.flatnonzero(run[:-1] == top)))
        if not found:
            return tiles
        for q, places in reversed(found):
            if mi[q:q + best].any():
                continue
            for p in places.tolist():
                if not md[p:p + best].any():
                    md[p:p + best], mi[q:q + best] = True, True
                    tiles.append((int(at[p]), q, best))
                    break


def _items(benchmark: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(item, item_id, tokens, n_tokens, seeds): one row for each distinct id and
    text; a seed comes with the number of its places in the item."""
    src = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), utf8(text_col).alias("t")).distinct()
    src = src.withColumn("item", F.xxhash64("item_id", "t"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            ts = [tokens(t) for t in b.column("t").to_pylist()]
            seeds = [np.unique(s, return_counts=True) for s in shingle_hashes(ts, n)]
            seeds = [[{"seed": x, "places": c} for x, c in zip(u.view(np.int64).tolist(), m.tolist(), strict=True)] for u, m in seeds]
            yield pa.RecordBatch.from_arrays(
                [b.column("item"), b.column("item_id"), pa.array([t.tobytes() for t in ts], pa.binary()), pa.array([len(t) for t in ts], pa.int64()),
                 pa.array(seeds, pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.int64())])))], ["item", "item_id", "tokens", "n_tokens", "seeds"])

    kind = benchmark.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"item long, item_id {kind}, tokens binary, n_tokens long, seeds array<struct<seed:long,places:long>>")


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """Which of 2**bits places the seeds fall on: a size that no data changes."""
    place = F.col("seed").bitwiseAND((1 << bits) - 1)
    rows = seeds.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(32767).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("map")).collect()
    full = np.zeros(max(1, 1 << (bits - 15)) * 4096, np.uint8)
    for r in rows:
        full[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = np.frombuffer(r["map"], np.uint8)
    return full


def covered(docs: DataFrame, seeds: DataFrame, n: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, at, tokens, seeds) of documents with a seed on the bitmap."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_bitmap(seeds, bits).tobytes())
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(text_col).alias("t"))
    src = src.withColumn("key", F.xxhash64("doc_id", "t"))
    kind = docs.schema[id_col].dataType.simpleString()
    mask = np.uint64((1 << bits) - 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for b in parts:
            rows = []
            for i, text in enumerate(b.column("t").to_pylist()):
                t = tokens(text)
                s = shingle_hashes([t], n)[0]
                place = s & mask
                hit = (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if hit.any():
                    edge = np.zeros(len(t) + 1, np.int64)
                    at = np.flatnonzero(hit)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, np.minimum(at + n, len(t)), -1)
                    inside = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    rows.append((i, inside.astype("<i4").tobytes(), t[inside].tobytes(), np.unique(s[hit]).view(np.int64)))
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("key").take(at), b.column("doc_id").take(at), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                ["key", "doc_id", "at", "tokens", "seeds"])

    return src.mapInArrow(run, f"key long, doc_id {kind}, at binary, tokens binary, seeds array<long>")


def tile_coverage(docs: DataFrame, benchmark: DataFrame, n: int = 5, bits: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", least: float = 0.0) -> DataFrame:
    """(key, doc_id, item_id, item_words, covered_words, tiles, longest,
    coverage) for every document and item that share ``n`` words in a row.

    ``key`` is a hash of id and text; rows repeated with both are one. An item
    of fewer than ``n`` words is met only by a text of the same words. Null,
    empty or wordless texts and items meet nothing; null ids are kept; other
    columns are not read; without documents or items the table is empty.
    ``bits`` sets the size of the bitmap that every task reads. Pairs whose
    coverage cannot reach ``least`` are left out before they are tiled: a tile
    of m words has m - n + 1 seeds, so w shared seeds cover n * w words at most.
    """
    items = materialize(_items(benchmark, item_col, item_text_col, n), "tiling-items")
    seeds = items.select("item", "n_tokens", F.explode("seeds").alias("s")).select("item", "n_tokens", "s.seed", "s.places")
    hits = materialize(covered(docs, seeds, n, bits, id_col, text_col).dropDuplicates(["key"]), "tiling-hits")
    pairs = hits.select("key", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("key", "item", "n_tokens").agg(F.sum("places").alias("w"))
    pairs = pairs.where(F.least(F.col("n_tokens"), n * F.col("w")) >= F.lit(least) * F.col("n_tokens")).select("key", "item")
    both = pairs.join(hits.select("key", "doc_id", "at", "tokens"), "key").join(
        items.select("item", "item_id", F.col("tokens").alias("item_tokens")), "item")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            out = []
            for at, t, i in zip(*(b.column(c).to_pylist() for c in ("at", "tokens", "item_tokens")), strict=True):
                i = np.frombuffer(i, np.uint64)
                lengths = [x[2] for x in tile(np.frombuffer(t, np.uint64), np.frombuffer(at, "<i4").astype(np.int64), i, n)]
                out.append((len(i), sum(lengths), len(lengths), max(lengths, default=0), sum(lengths) / max(1, len(i))))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("doc_id"), b.column("item_id"), *(pa.array(c, pa.int64()) for c in cols[:4]),
                 pa.array(cols[4], pa.float64())],
                ["key", "doc_id", "item_id", "item_words", "covered_words", "tiles", "longest", "coverage"])

    ids = [d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_col))]
    return both.mapInArrow(run, f"key long, doc_id {ids[0]}, item_id {ids[1]}, item_words long, covered_words long, tiles long, longest long, coverage double")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The pairs whose item is covered to ``least`` or more."""
    return tile_coverage(docs, benchmark, least=least, **options).where(F.col("coverage") >= least)


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = materialize(contaminated(docs, benchmark, least, id_col=id_col, text_col=text_col, **options).select("key").distinct(), "tiling-bad")
    name = free_name(docs, "row_key")
    keyed = docs.withColumn(name, F.xxhash64(F.col(f"`{id_col}`"), utf8(text_col)))
    return keyed.join(bad.withColumnRenamed("key", name), name, "left_anti").drop(name)
