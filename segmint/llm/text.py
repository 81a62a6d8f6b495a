"""Small shared helpers: reading tables, free column names, words and hashes
inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The text's UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


def lower_az(text: Column) -> Column:
    """Only A-Z are lowered, whatever the locale."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores, so that no column is hidden."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def words(text: bytes) -> list[bytes]:
    """A-Z lowered, split at space and \\x09-\\x0D: what bytes.split() splits at."""
    return text.lower().split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer; equal input and salt give equal output everywhere."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(docs: list[np.ndarray], n: int) -> list[np.ndarray]:
    """For each document's word hashes, the hashes of its n-word windows; with
    fewer words, the whole sequence as one; without words, none."""
    sizes = np.array([len(d) for d in docs], np.int64)
    if not sizes.sum():
        return [np.zeros(0, np.uint64) for _ in docs]
    h = np.concatenate(docs)
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        out = mix(out ^ h[i:i + len(out)], i + 1)
    at = np.concatenate([[0], np.cumsum(sizes)])
    return [out[a:a + size - n + 1] if size >= n else _short(h[a:a + size]) for a, size in zip(at, sizes, strict=False)]


def _short(h: np.ndarray) -> np.ndarray:
    out = np.zeros(min(1, len(h)), np.uint64)
    for i in range(len(h)):
        out = mix(out ^ h[i:i + 1], i + 1)
    return out


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    return [np.unique(x) for x in shingle_hashes([word_hashes(words(t)) for t in texts], n)]


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of about ``most`` in size, one item at least."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(first, i)
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def grouped(parts: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """The rows of one key at a time, from batches sorted by ``keys``."""
    rows, key = [], None
    for b in parts:
        for row in b.to_pylist():
            k = tuple(row[c] for c in keys)
            if rows and k != key:
                yield rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield rows


def pack_ints(x: np.ndarray) -> bytes:
    """Bytes of equal weight stand together, which packs well."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def pack_keys(sorted_keys: np.ndarray) -> bytes:
    return pack_ints(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(b, np.uint64), dtype=np.uint64)


def by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts keys of a part together, ascending; part numbers and ends."""
    part = mix(keys, 24) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    which, first = np.unique(part[order], return_index=True)
    return order, which.astype(np.int64), first


def forest(part: np.ndarray) -> list[tuple[int, int]]:
    """Row and column pairs of ``part`` that connect what it connects, by
    breadth-first search over rows and columns."""
    rows_left, cols_left = np.ones(part.shape[0], bool), np.ones(part.shape[1], bool)
    out = []
    for start in range(part.shape[0]):
        if not rows_left[start]:
            continue
        rows_left[start], queue = False, [start]
        while queue:
            r = queue.pop()
            new = np.flatnonzero(part[r] & cols_left)
            cols_left[new] = False
            for c in new.tolist():
                out.append((r, c))
                more = np.flatnonzero(part[:, c] & rows_left)
                rows_left[more] = False
                queue += more.tolist()
                out += [(m, c) for m in more.tolist()]
    return out
