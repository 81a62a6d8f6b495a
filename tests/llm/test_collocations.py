import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.llm.collocations import chunk_paths, collocations, phrase_counts

ROWS = "doc_id long, text string, lang string"


def plain(docs, least, top, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if any(m == lang and len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for (m, q), b in cands.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((score, a, " ".join(p), l, r))
    rows = []
    for lang, some in out.items():
        some.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        rows += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(some[:top])]
    return sorted(rows)


def made(rng, docs):
    passage = "It is HEREBY stated that nobody, under any law; may sell é ½ this book again"
    out = []
    for i in range(docs):
        ws = [rng.choice(["a", "b", "B", "the", "cat", "Éa", "x y", "a\x1cb", "of"]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "]) for w in ws)
        if rng.random() < 0.4:
            text += " " + passage + rng.choice([" ", ".", " and so"])
        out.append((i, text, rng.choice(["en", "de", None, "und", ""])))
    return out


@pytest.mark.parametrize(("least", "top", "bits", "words", "longest"), [(3, 10_000, 20, 500, 5), (10, 7, 20, 10**6, 5), (5, 10_000, 16, 300, 4), (2, 10_000, 17, 2_000, 3)])
def test_as_plain_counting(spark, least, top, bits, words, longest):
    docs = made(random.Random(least), 250) + [(900, "go on " * 4000, "en"), (901, "a b a b a b a b a b a b", "de")]
    df = spark.createDataFrame(docs, ROWS).repartition(5)
    got = sorted(tuple(r) for r in collocations(df, least=least, top=top, longest=longest, bits=bits, words=words).collect())
    assert got == plain(docs, least, top, longest) and len(got) > 10


def test_flow_is_the_count(spark):
    docs = made(random.Random(1), 120)
    levels = phrase_counts(spark.createDataFrame(docs, ROWS), least=1, bits=16, words=200)
    for k, level in enumerate(levels, 1):
        want = collections.Counter()
        for _, text, lang in docs:
            for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
                ws = [w for w in re.split(r"[ \t]+", piece) if w]
                want.update(("und" if lang is None else lang, " ".join(ws[i:i + k])) for i in range(len(ws) - k + 1))
        assert {(r.lang, r.phrase): r.f for r in level.collect()} == want


def test_paths_open_into_the_entries():
    rng = np.random.default_rng(7)
    passage = rng.integers(5, 40, 30)
    s = np.concatenate([np.concatenate([rng.integers(1, 5, rng.integers(0, 9)), passage if rng.random() < 0.6 else passage[:2], [0]]) for _ in range(80)])
    linked = (s[:-1] > 0) & (s[1:] > 0)
    start, size, n = chunk_paths(s, linked, 5)
    got = collections.Counter()
    for i, k, w in zip(start, size, n, strict=True):
        for j in range(max(1, k - 4)):
            got[tuple(s[i + j:i + min(k, j + 5)])] += w
    want = collections.Counter()
    for p in np.flatnonzero(s):
        end = p + int(np.argmax(s[p:] == 0))
        want[tuple(s[p:min(end, p + 5)])] += 1
    assert got == want and size.max() > 20  # the passage's inner edges are one path
    empty = chunk_paths(np.zeros(3, np.int64), np.zeros(2, bool), 5)
    assert all(len(x) == 0 for x in empty)


def test_odd_rows(spark):
    docs = [(1, None, "en"), (None, "A b", "en"), (1, "a b", "en"), (1, "a b", "en"), (2, "", None), (3, " .;\n", None), (4, "a b", None), (5, "a b", "und")]
    df = spark.createDataFrame(docs, ROWS).withColumns({c: F.lit(9) for c in ("phrase", "n", "k", "f", "t")})
    run = lambda d: sorted(tuple(r) for r in collocations(d, least=2, bits=16).collect())
    assert run(df) == [("en", 1, "a b", 3, 3, 3, 6, 2000), ("und", 1, "a b", 2, 2, 2, 4, 2000)]
    assert run(df.limit(0)) == []


def test_products_beyond_64_bits(spark):
    from segmint.llm import collocations as C
    big = 9 * 10**12
    one = lambda p, f: spark.createDataFrame([("en", p, f)], "lang string, phrase string, f long")
    levels = [one("x", big).union(one("y", big + 7)), one("x y", big - 1), one("x", 0).limit(0), one("x", 0).limit(0), one("x", 0).limit(0)]
    got = C.ranked(levels, 100, 10).first()
    n = 2 * big + 7
    assert (got.n, got.score) == (n, 1000 * (big - 1) * n // (big * (big + 7)))
