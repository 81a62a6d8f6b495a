import numpy as np
import pytest
from conftest import SF_SMALL

from fixtures import awkward, docs_of, table
from segmint.llm import jaccard as J


def brute(texts, words, percent):
    """Position of the first document of each one's component, and set sizes."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]


@pytest.mark.parametrize("join", [J.Join(3, 90, 2, 1), J.Join(5, 80, 5, 2), J.Join(3, 75, 4, 2)])
def test_similar_sets_share_a_signature(join):
    rng, met = np.random.default_rng(0), 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(1, 250))).astype(np.uint64))
        gone, new = (int(rng.integers(0, max(1, len(a) // 6 + 1))) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2 ** 63, new).astype(np.uint64)]))
        x = len(np.intersect1d(a, b))
        if len(b) and 100 * x >= join.percent * (len(a) + len(b) - x):
            met += 1
            sig, who = J.signatures([a, b], join)
            assert set(sig[who == 0]) & set(sig[who == 1])
    assert met > 100


def test_sketches_never_part_similar_sets():
    rng, met, parted = np.random.default_rng(3), 0, 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(1, 900))).astype(np.uint64))
        gone, new = (int(rng.integers(0, max(1, len(a) // 4 + 1))) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2 ** 63, new).astype(np.uint64)]))
        x = len(np.intersect1d(a, b))
        if len(b):
            similar = 100 * x >= 80 * (len(a) + len(b) - x)
            may = J.possible_pairs(np.array([len(a)]), [J.sketch(a)], np.array([len(b)]), [J.sketch(b)], 80)[0, 0]
            assert may or not similar
            met, parted = met + similar, parted + (not may)
    assert met > 100 and parted > 50


@pytest.mark.parametrize("join", [J.Join(3, 90, 2, 1), J.Join(5, 80)])
def test_components_equal_brute_force(spark, join):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()]
    root, size = brute([t for _, t in rows], join.words, join.percent)
    got = {r.doc_id: r for r in J.jaccard_components(docs_of(spark, rows), join).collect()}
    for i, (d, _) in enumerate(rows):
        assert (got[d].n_shingles, got[d].component_id) == (size[i], rows[root[i]][0])


def test_a_large_group_is_verified_in_blocks(spark):
    """Chains of small changes: far members are not similar, and no member is
    similar to all, so blocks must be compared with each other."""
    rng = np.random.default_rng(5)
    w = [f"w{x}" for x in rng.integers(0, 10 ** 6, 120)]
    rows = []
    for i in range(60):
        if i:
            w[int(rng.integers(0, 120))] = f"n{i}"
        rows.append((i, " ".join(w)))
    order = rng.permutation(60).tolist()
    rows = [(order[i], t) for i, (_, t) in enumerate(rows)] + [(100 + i, " ".join(f"x{y}" for y in rng.integers(0, 10 ** 6, 120))) for i in range(5)]
    rows.sort()
    root, _ = brute([t for _, t in rows], 3, 90)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(spark, rows), J.Join(3, 90, 2), block=8).collect()}
    assert got == {d: rows[root[i]][0] for i, (d, _) in enumerate(rows)}
    assert len({got[d] for d in range(60)}) < 10


def test_awkward_rows(spark):
    rows = J.jaccard_components(awkward(spark)).collect()
    assert len(rows) == 10
    fox = [r for r in rows if r.n_shingles == 5]
    assert {r.component_id for r in fox} == {1} and len(fox) == 4
    assert {(r.doc_id, r.component_id) for r in rows if r.n_shingles == 0} == {(3, 3), (4, 4), (5, 5), (None, None)}
    assert J.jaccard_components(awkward(spark).limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = J.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]
    twice = docs_of(spark, [(1, "a b c"), (1, "a b c"), (1, "x y z"), (2, None), (2, None)])
    assert sorted((r.doc_id, r.text or "") for r in J.keep_first(twice).collect()) == [(1, "a b c"), (1, "x y z"), (2, ""), (2, "")]


@pytest.mark.parametrize("block", [2, 30])
def test_chance_ties_fall_apart(spark, block):
    """Near copies of one text, texts that only share a passage with them, and sets so small that many signatures are
    empty: one cluster of ties, parted into its groups whatever the block."""
    rng = np.random.default_rng(9)
    base, passage = [f"b{i}" for i in range(80)], " ".join(f"p{i}" for i in range(40))
    texts = []
    for i in range(45):
        w = list(base)
        w[int(rng.integers(0, 80))] = f"c{i}"
        texts.append(" ".join(w))
    texts += [passage + " " + " ".join(f"q{x}" for x in rng.integers(0, 10 ** 6, 30)) for _ in range(40)]
    texts += [" ".join(f"s{x}" for x in rng.integers(0, 30, 6)) for _ in range(60)]
    rows = list(enumerate(rng.permutation(texts).tolist()))
    join = J.Join(3, 80)
    root, _ = brute([t for _, t in rows], join.words, join.percent)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(spark, rows), join, block=block).collect()}
    assert got == {d: rows[root[i]][0] for i, (d, _) in enumerate(rows)}
