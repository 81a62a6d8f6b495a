import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from fixtures import awkward, docs_of, table
from segmint.llm import language_model as L


class Plain:
    """States with arcs and failure arcs as dictionaries."""

    def __init__(self, texts, held, order):
        self.order, self.grams, self.history = order, Counter(), Counter()
        self.tokens = [[*(t or "").encode().lower().split(), "END"] for t in texts]
        for ws, h in zip(self.tokens, held, strict=True):
            ws = ["START", *ws]
            for i in range(1, len(ws) if not h else 0):
                for first in range(max(0, i + 1 - order), i + 1):
                    self.grams[tuple(ws[first:i + 1])] += 1
                    self.history[tuple(ws[first:i])] += 1
        self.n = self.history[()]
        distinct = Counter(map(len, self.grams))
        self.v = distinct[1]
        self.m = {k: max(1.0, distinct[k] / max(1, distinct[k - 1])) for k in range(2, order + 1)}

    def root(self, w):
        return (self.grams[w,] + 1) / (self.n + self.v + 1)

    def arc(self, h, w):
        if not h:
            return self.root(w)
        m = self.m[len(h) + 1]
        return (self.grams[*h, w] + m * self.arc(h[1:], w)) / (self.history[h] + m)

    def step(self, state, w):
        """The token's log probability and the next state."""
        total = 0.0
        while state and not self.grams[*state, w]:
            m = self.m[len(state) + 1]
            total += math.log10(m / (self.history[state] + m))
            state = state[1:]
        total += math.log10(self.arc(state, w))
        after = (*state, w)[1 - self.order:] if self.order > 1 else ()
        return total, after if self.grams[after] else after[1:]

    def score(self, ws):
        state, base, score = ("START",) if self.order > 1 and self.history["START",] else (), 0.0, 0.0
        for w in ws:
            base += math.log10(self.root(w))
            gain, state = self.step(state, w)
            score += gain
        return len(ws), sum(self.grams[w,] > 0 for w in ws), self.n, base, score


def close(r, want):
    assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
    assert r.base_score == pytest.approx(want[3], rel=1e-9) and r.score == pytest.approx(want[4], rel=1e-9)


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


@pytest.mark.parametrize(("order", "block_tokens", "part_keys"), [(3, 1_000_000, 2_000_000), (3, 500, 1_000), (2, 5_000, 3_000), (1, 5_000, 3_000), (5, 20_000, 50_000)])
def test_scores_equal_a_plain_automaton(spark, order, block_tokens, part_keys):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()] + [(9001, None), (9002, ""), (9003, "zz yy")]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    model = Plain([t for _, t in rows], held, order)
    want = {d: model.score(ws) for (d, _), ws in zip(rows, model.tokens, strict=True)}
    got = L.score_texts(docs_of(spark, rows), fold(), order=order, block_tokens=block_tokens, part_keys=part_keys).collect()
    assert len(got) == len(rows)
    for r in got:
        close(r, want[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)


@pytest.mark.parametrize("order", [2, 3])
def test_every_state_is_a_distribution(order):
    texts = ["a b a b c", "a b c a b", "b c b a", "c", None]
    model = Plain(texts, [False] * 5, order)
    words = {g[0] for g in model.grams if len(g) == 1}
    for state in [h for h in model.history if len(h) < order]:
        assert sum(10 ** model.step(state, w)[0] for w in [*words, "unseen"]) == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lanes_do_not_change_a_long_text(order):
    rng = np.random.default_rng(7)
    hashes = np.unique(rng.integers(1, 1 << 63, 40).astype(np.uint64))
    lengths = np.array([1, 700, 3, 64, 65, 1])
    b = L.Block(rng.integers(0, 12, lengths.sum()) ** 2 % len(hashes), hashes, lengths, np.array([False, False, True, False, True, False]))
    levels = L.gram_levels(b, order)
    train = np.repeat(~b.held, b.lengths)
    counts = [np.bincount(g.token[train & (g.token >= 0)], minlength=len(g.hash)) for g in levels]
    n = L.Totals(int(counts[0].sum()), tuple(int((c > 0).sum()) for c in counts))
    a = L.automaton(b, levels, counts, n, 4)
    whole = L.traverse(b, a, order, lane=10 ** 6)
    for lane in (1, 2, 7, 64):
        assert np.array_equal(L.traverse(b, a, order, lane), whole)


def test_higher_orders_know_held_out_copies_better(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    total = lambda order: L.score_texts(docs, fold(), order=order).where("held_out").agg(F.sum("score")).first()[0]
    one, two, three = map(total, (1, 2, 3))
    assert one < two < three


def test_awkward_rows(spark):
    rows = L.score_texts(awkward(spark), F.lit(None).cast("boolean")).collect()
    assert len(rows) == 10 and not any(r.held_out for r in rows)
    assert sorted(r.n_tokens for r in rows)[:4] == [1, 1, 1, 1]
    none = L.score_texts(awkward(spark), F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in none} == {(0, 0, 0.0)}
    assert L.score_texts(awkward(spark).limit(0), F.lit(False)).count() == 0
