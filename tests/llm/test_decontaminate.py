import numpy as np
from conftest import SF_MID

from fixtures import awkward, docs_of, table
from segmint.llm import decontaminate as D


def greedy(doc, item, n):
    """Greedy string tiling, token by token."""
    md, mi, out, n = [0] * len(doc), [0] * len(item), [], min(n, len(item))
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                k = 0
                while p + k < len(doc) and q + k < len(item) and doc[p + k] == item[q + k] and not md[p + k] and not mi[q + k]:
                    k += 1
                if k >= n and (best is None or k > best[2]):
                    best = (p, q, k)
        if not best:
            return out
        for k in range(best[2]):
            md[best[0] + k] = mi[best[1] + k] = 1
        out.append(best)


def test_tiles_equal_plain_greedy_tiling():
    rng = np.random.default_rng(0)
    for _ in range(150):
        v, n = int(rng.integers(1, 12)), int(rng.integers(2, 6))
        item = rng.integers(0, v, int(rng.integers(1, 25))).astype(np.uint64)
        doc = rng.integers(0, v, int(rng.integers(0, 60))).astype(np.uint64)
        doc = np.concatenate([doc[:10], item[len(item) // 2:], doc[10:20], item[:len(item) // 2], doc[20:]])
        want = greedy(doc.tolist(), item.tolist(), n)
        assert D.tile(doc, np.arange(len(doc)), item, n) == want
        assert D.tile(doc, np.arange(len(doc)), item, n, most_pairs=0) == want
        gaps = np.arange(len(doc)) + 3 * (np.arange(len(doc)) >= len(doc) // 2)  # a stretch that isn't covered
        assert D.tile(doc, gaps, item, n, most_pairs=0) == D.tile(doc, gaps, item, n)


def test_running_hashes_are_of_the_window():
    t = np.random.default_rng(1).integers(0, 2 ** 63, 50).astype(np.uint64)
    assert D.running_hashes(np.concatenate([t, t]), 7)[50] == D.running_hashes(t, 7)[0]
    assert len(D.running_hashes(t[:3], 7)) == 0


def test_repetitive_texts_are_bounded():
    ones = np.ones(3000, np.uint64)
    assert D.tile(ones, np.arange(3000), ones[:100], 5, most_pairs=1000) == [(0, 0, 100)]
    doc = np.tile(np.array([1, 1, 1, 1, 1, 1, 2], np.uint64), 30_000)  # no place holds more than six ones: each is used once
    tiles = D.tile(doc, np.arange(len(doc)), np.ones(600, np.uint64), 5, most_pairs=1000)
    assert [t[2] for t in tiles] == [6] * 100 and [t[:2] for t in tiles[:3]] == [(0, 0), (7, 6), (14, 12)]


def test_pairs_that_cannot_reach_the_limit_are_not_tiled(spark):
    items = spark.createDataFrame([(i, "read the text below and answer " + " ".join(f"i{i}w{k}" for k in range(40))) for i in range(20)], "item_id long, text string")
    docs = docs_of(spark, [(100, "Read the text below and answer: something else"), (101, "x " + " ".join(f"i3w{k}" for k in range(25)))])
    assert {(r.doc_id, r.item_id) for r in D.tile_coverage(docs, items, least=0.5).collect()} == {(101, 3)}
    assert D.tile_coverage(docs, items).count() == 21 and [(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()] == [(101, 3)]


def test_coverage_equals_brute_force(spark):
    docs, items = table(spark, SF_MID, "documents"), table(spark, SF_MID, "benchmark")
    doc = [(r.doc_id, D.tokens(r.text.encode()).tolist()) for r in docs.collect()]
    item = [(r.item_id, D.tokens(r.text.encode()).tolist()) for r in items.collect()]
    seeds = {i: {tuple(t[k:k + 5]) for k in range(len(t) - 4)} for i, t in item}
    want = {}
    for d, t in doc:
        own = {tuple(t[k:k + 5]) for k in range(len(t) - 4)}
        for i, s in item:
            if own & seeds[i]:
                want[d, i] = sum(x[2] for x in greedy(t, s, 5))
    got = {(r.doc_id, r.item_id): r.covered_words for r in D.tile_coverage(docs, items).collect()}
    assert got == want and want


def test_reordered_passages(spark):
    w = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(w)), (2, "a b c"), (3, None), (None, "p q r s t u v")], "item_id long, text string")
    docs = docs_of(spark, [(1, "start " + " ".join(w[20:] + ["x"] + w[10:20] + ["y"] + w[:10])), (2, "W0, w1; w2 w3 (w4) other words here"),
                           (3, "A, b c!"), (4, "a b c d"), (5, "p q r s t u v"), (None, " ".join(w)), (None, " ".join(w))])
    got = {(r.doc_id, r.item_id): (r.coverage, r.tiles) for r in D.tile_coverage(docs, items).collect()}
    assert got == {(1, 1): (1.0, 3), (2, 1): (5 / 30, 1), (3, 2): (1.0, 1), (5, None): (1.0, 1), (None, 1): (1.0, 1)}
    assert sorted(r.doc_id for r in D.decontaminate(docs, items).collect()) == [2, 4]


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "quick brown fox jumps over")], "item_id long, text string")
    kept = D.decontaminate(awkward(spark), items)
    assert kept.columns == awkward(spark).columns and kept.count() == 6
    assert D.decontaminate(awkward(spark), items.limit(0)).count() == 10
    assert D.tile_coverage(awkward(spark).limit(0), items).count() == 0
