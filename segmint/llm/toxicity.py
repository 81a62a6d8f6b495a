"""Toxicity by a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios.

A text's features are the character n-grams, inside word borders, of its
distinct words; a feature's value is the number of distinct words that hold
it. Every value is scaled by the log ratio of its smoothed share among toxic
and other words, and a logistic regression is fitted on the scaled values.
The score is a sum over distinct words, so a task computes each word's share
once. Only the fit is bounded (``sample`` labelled documents); scoring is one
pass over all rows without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.llm.text import free_name, utf8, words


class Grams(NamedTuple):
    """Lengths of the character n-grams, and the bits of a feature's number."""
    shortest: int = 3
    longest: int = 5
    bits: int = 18


class Model(NamedTuple):
    """``weights`` already hold the log-count ratios."""
    grams: Grams
    weights: np.ndarray
    bias: float


def few_rows(batch: pa.RecordBatch, most: int = 256) -> Iterator[pa.RecordBatch]:
    """The batch in slices, so that only few texts are Python objects at a time."""
    return (batch.slice(i, most) for i in range(0, batch.num_rows, most))


def word_features(word: bytes, g: Grams) -> list[int]:
    s, shift = b" " + word + b" ", 32 - g.bits
    return list({zlib.crc32(s[i:i + n], n) >> shift for n in range(g.shortest, g.longest + 1) for i in range(len(s) - n + 1)})


def text_features(text: bytes, g: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, ascending, and their values."""
    found = [f for w in set(words(text)) for f in word_features(w, g)]
    return np.unique(np.array(found, np.int64), return_counts=True)


def fit(features: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, g: Grams, l2: float = 1e-4,
        epochs: int = 10, rate: float = 0.1, batch: int = 64) -> Model:
    """Log-count ratios, then logistic regression by adaptive gradient steps in
    a fixed order of rows. With one class only, the model is its rate."""
    size, n, pos = 1 << g.bits, len(y), float(y.sum())
    w, b = np.zeros(size), float(np.log((pos + 1) / (n - pos + 1)))
    if not 0 < pos < n:
        return Model(g, w, b)
    share = [np.ones(size), np.ones(size)]
    for f, v, t in zip(features, values, y, strict=True):
        share[int(t)][f] += v
    ratio = np.log(share[1] / share[1].sum()) - np.log(share[0] / share[0].sum())
    seen, seen_b = np.full(size, 1e-8), 1e-8
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for at in np.array_split(order.permutation(n), -(-n // batch)):
            f = np.concatenate([features[i] for i in at])
            row = np.repeat(np.arange(len(at)), [len(features[i]) for i in at])
            x = np.concatenate([values[i] for i in at]) * ratio[f]
            z = np.bincount(row, w[f] * x, len(at)) + b
            off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / len(at)
            u, where = np.unique(f, return_inverse=True)
            step = np.bincount(where, off[row] * x) + l2 * w[u]
            seen[u] += step * step
            w[u] -= rate * step / np.sqrt(seen[u])
            seen_b += off.sum() ** 2
            b -= rate * off.sum() / np.sqrt(seen_b)
    return Model(g, w * ratio, float(b))


class _Words(dict):
    """word -> its part of the score, remembered for up to ``keep`` words."""

    def __init__(self, m: Model, keep: int = 100_000):
        super().__init__()
        self.model, self.keep = m, keep

    def __missing__(self, word: bytes) -> float:
        s = float(self.model.weights[word_features(word, self.model.grams)].sum())
        if len(word) <= 64:
            if len(self) >= self.keep:
                self.clear()
            self[word] = s
        return s


def score_of(text: bytes, parts: _Words) -> float:
    """Sorted, so that equal texts get the same score to the last bit."""
    z = sum(map(parts.__getitem__, sorted(set(words(text))))) + parts.model.bias
    return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, grams: Grams = Grams(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """Fits on at most ``sample`` labelled documents, the first by a hash of
    their id. Rows of ``labels`` with a null id or label are not used; an id
    labelled twice is toxic if one label says so; of documents that share an
    id, one (the smallest by a hash of the text) is used."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
              .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("t")).join(F.broadcast(chosen), "id")

    def featurize(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for b in few_rows(batch):
                got = [text_features(t, grams) for t in b.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("h"), b.column("y"), pa.array([f.astype("<i4").tobytes() for f, _ in got], pa.binary()),
                     pa.array([v.astype("<i4").tobytes() for _, v in got], pa.binary()), b.column("id")], ["h", "y", "f", "v", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = (texts.withColumn("h", F.xxhash64("t")).mapInArrow(featurize, f"h long, y int, f binary, v binary, id {kind}")
            .groupBy("id").agg(F.min(F.struct("h", "y", "f", "v")).alias("r")).select("r.y", "r.f", "r.v", "r.h", "id").toArrow())
    rows = rows.sort_by([("h", "ascending"), ("id", "ascending")])
    as_ints = lambda c: [np.frombuffer(x, "<i4").astype(np.int64) for x in rows.column(c).to_pylist()]
    return fit(as_ints("f"), as_ints("v"), np.array(rows.column("y").to_pylist(), float), grams, **options)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, 0 to 1, of every whole text. A
    null or empty text has the model's base rate; other nulls pass through;
    repeated rows each get theirs; an empty table gives an empty table."""
    out, raw = free_name(docs, "toxicity"), free_name(docs, "utf8")
    kind = docs.schema[text_col].dataType
    if isinstance(kind, T.StringType):  # its Arrow bytes are the text in UTF-8, so it need not travel twice
        sent, raw = docs, docs.schema[text_col].name
    else:
        sent = docs.withColumn(raw, utf8(text_col))
    same = sent is docs
    shared = docs.sparkSession.sparkContext.broadcast(
        (tuple(model.grams), model.weights.astype(np.float64).tobytes(), model.bias))  # 2**bits numbers, whatever the data

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, w, b = shared.value
        cache = _Words(Model(Grams(*g), np.frombuffer(w), b))
        for batch in parts:
            for b in few_rows(batch):
                score = [score_of(t or b"", cache) for t in b.column(raw).cast(pa.binary()).to_pylist()]
                keep = [c for c in b.schema.names if same or c != raw]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(score, pa.float64())], [*keep, out])

    return sent.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def held_out(column: str = "doc_id"):
    """The fold that no label is learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The thin query: the other four folds' labels train, all texts are scored."""
    model = train(docs, labels.where(~held_out()), **options)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the documents scored ``threshold`` or more."""
    scored = score_toxicity(docs, train(docs, labels.where(~held_out()), **options))
    score = next(c for c in scored.columns if c not in docs.columns)
    return scored.where(F.col(score) < threshold).drop(score)
