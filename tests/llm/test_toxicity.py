import zlib

import numpy as np
import pyarrow as pa
from conftest import SF_MID

from fixtures import awkward, docs_of, table
from segmint.llm import toxicity as X


def test_held_out_accuracy_and_folds(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    rows = {r.doc_id: r for r in X.toxicity_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    y = {r.doc_id: r.toxic for r in labels.collect()}
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [d for d in y if rows[d].held_out]
    assert np.mean([rows[d].predicted == y[d] for d in held]) > 0.93
    # labels of the held-out fold are never learned from
    other = labels.selectExpr("doc_id", "quality", "if(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) as toxic")
    again = {r.doc_id: r.score for r in X.toxicity_scores(docs, other).collect()}
    assert all(again[d] == r.score for d, r in rows.items())


def test_score_is_the_linear_form_of_its_features():
    g = X.Grams(2, 3, 12)
    texts = [b"You IDIOT, you idiot", b"nice day", b"", b"idiot"]
    feats = [X.text_features(t, g) for t in texts]
    m = X.fit([f for f, _ in feats], [v for _, v in feats], np.array([1.0, 0, 0, 1]), g)
    for t, (f, v) in zip(texts, feats, strict=True):
        z = (m.weights[f] * v).sum() + m.bias
        assert abs(X.score_of(t, X._Words(m)) - 1 / (1 + np.exp(-z))) < 1e-12
    assert X.score_of(texts[0], X._Words(m)) > 0.5 > X.score_of(texts[1], X._Words(m))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (6, None), (7, 0), (99, 1)], "doc_id long, toxic int")
    m = X.train(awkward(spark), labels)
    out = X.score_toxicity(awkward(spark), m)
    assert out.columns == [*awkward(spark).columns, "toxicity_"]
    rows = out.collect()
    assert len(rows) == 10
    empty = {r.toxicity_ for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1
    kept = X.drop_toxic(awkward(spark), labels)
    assert kept.columns == awkward(spark).columns
    assert X.score_toxicity(awkward(spark).limit(0), m).count() == 0


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = X.toxicity_scores(docs_of(spark, [(1, "a"), (2, None)]), labels).collect()
    assert [r.score for r in rows] == [0.5, 0.5]


def test_texts_travel_once_and_in_slices(spark):
    docs = spark.createDataFrame([(i, None if i % 7 == 0 else f"word{i} abc" * (i % 5)) for i in range(600)], "doc_id long, text string")
    model = X.Model(X.Grams(), np.arange(1 << 18) / 1e6, 0.25)
    out = X.score_toxicity(docs, model)
    assert "utf8" not in out._jdf.queryExecution().analyzed().toString()
    cache = X._Words(model)
    want = {i: X.score_of((t or "").encode(), cache) for i, t in docs.collect()}
    assert {r.doc_id: r.toxicity for r in out.collect()} == want
    batch = pa.RecordBatch.from_arrays([pa.array(range(600))], ["x"])
    assert [b.num_rows for b in X.few_rows(batch)] == [256, 256, 88]
