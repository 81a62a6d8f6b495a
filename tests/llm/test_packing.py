import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from fixtures import awkward, docs_of, table
from segmint.llm import packing as P
from segmint.llm.byte_bpe import byte_bpe


def tokenizer():
    return Tokenizer.from_file(P.tokenizer_path())


TRICKY = ["", " ", "  a  b ", "it's 's\n\n x", "<|endoftext|> z<|endoftext|>", "\x1c a\x85b 　c", "1 2  3, ,,  .", "é  ñ\t x", "\n \n", "a​b c"]


def test_encoding_equals_the_library(spark):
    t, own = tokenizer(), byte_bpe(P.tokenizer_path())
    texts = TRICKY + [r.text for r in table(spark, SF_SMALL, "documents").limit(60).collect()]
    rng = random.Random(2)
    texts += ["".join(rng.choices([*"abz '’sS\n\t  é東ا़0٣²½,.!_-|<>", "<|endoftext|>", "don't", "\r\n", "😀", "\u200b"], k=rng.randrange(40))) for _ in range(3000)]
    for x in texts:
        assert own.whole(x).tolist() == t.encode(x, add_special_tokens=False).ids, x
    t.encode_special_tokens = True
    for x in texts:
        assert own.ordinary(x).tolist() == t.encode(x, add_special_tokens=False).ids, x


@pytest.mark.parametrize("bit", ["a", " ", "ab", "\n", "-", "é", "9", "a ", "<|endoftext|>"])
def test_very_long_texts(bit):
    ids = byte_bpe(P.tokenizer_path()).whole(bit * 1_000_000)
    assert b"".join(byte_bpe(P.tokenizer_path()).pieces[i] for i in ids.tolist()) == (bit * 1_000_000).encode()


@pytest.mark.parametrize("limits", [P.Limits(128, 4, 100), P.Limits(128, 200, 128), P.Limits(100, 2, 30)])
def test_the_longest_that_fits_has_the_largest_product(limits):
    rng = np.random.default_rng(4)
    for size in (1, 7, 300):
        n = rng.integers(1, min(limits.tokens, limits.loss + 1) + 1, size)
        shape = lambda placed: [(p.length, p.bin, p.offset) for p in placed]  # noqa: E731  equal lengths are interchangeable
        assert shape(P.dot_product_pack(n, n - 1, limits, cut=True, last=False)) == shape(P.longest_fit_pack(n, limits, last=False))
        whole = P.longest_fit_pack(n, limits)
        assert sum(p.length for p in whole) == n.sum()


def check_pieces(rows, texts, most=2048):
    t = tokenizer()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, x in texts.items():
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= most
        padding += 0 if at & (at - 1) == 0 else most - at
    return padding


def test_every_id_is_in_one_piece(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").unionByName(docs_of(spark, [(10_000 + i, x) for i, x in enumerate(TRICKY)] + [(20_000, None)]))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = P.packing_digests(docs).collect()
    assert check_pieces(rows, texts) <= 0.01 * sum(r.length for r in rows)


def test_awkward_rows(spark):
    rows = P.pack_documents(awkward(spark)).collect()
    whole = [r for r in rows if r.start == 0]
    assert len(whole) == 10 and sum(r.doc_id is None for r in whole) == 2
    assert P.pack_documents(awkward(spark).limit(0)).count() == 0


@pytest.mark.parametrize("limits", [P.Limits(100, 3, 60), P.Limits(64, 64, 64)])
def test_limits_hold_without_cuts(spark, limits):
    rng = np.random.default_rng(0)
    n = rng.integers(0, limits.tokens + 1, 500)
    loss = (n * rng.random(500) * limits.loss / limits.tokens).astype(int)
    placed = P.dot_product_pack(n, loss, limits, cut=False)
    assert sorted(p.item for p in placed) == list(range(500))
    total = defaultdict(lambda: np.zeros(3, int))
    for p in placed:
        total[p.bin] += (n[p.item], 1, loss[p.item])
    assert all((t <= limits).all() for t in total.values())
    least = max(n.sum() / limits.tokens, 500 / limits.segments, loss.sum() / limits.loss)
    assert len(total) <= 1.25 * least + 1


def test_limits_hold_with_cuts():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 129, 300)
    limits = P.Limits(128, 4, 100)
    placed = P.dot_product_pack(n, n - 1, limits, cut=True)
    got, bins = np.zeros(300, int), defaultdict(list)
    for p in placed:
        got[p.item] += p.length
        bins[p.bin].append(p)
    assert (got == n).all()
    for pieces in bins.values():
        assert len(pieces) <= 4 and sum(p.length for p in pieces) <= 128 and sum(p.length - 1 for p in pieces) <= 100


def test_examples(spark):
    rows = [(1, 10, 5), (2, 2000, 100), (3, 3000, 5), (4, None, 1), (None, 5, 5), (1, 10, 5), (6, 100, 2048), (7, 0, 0), (8, -1, 0)]
    out = P.pack_examples(spark.createDataFrame(rows, "id long, n long, loss long"), "id", "n", "loss").collect()
    assert len(out) == len(rows)
    assert sorted(r.id for r in out if r.sequence_id is None) == [3, 4, 8]
    with pytest.raises(ValueError):
        P.dot_product_pack(np.array([5]), np.array([1]), P.Limits(4, 1, 4), cut=False)


def test_short_sequences_only_end_a_task(spark):
    docs = docs_of(spark, [(i, f"short text number {i} of many") for i in range(600)]).coalesce(1)
    limits = P.Limits(128, 64, 128)
    rows = P.pack_documents(docs, limits=limits, pool=40).collect()
    size, ids = {}, {}
    for r in rows:
        size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
        ids.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert sum(n < 128 for n in size.values()) <= 7
    for pieces in ids.values():
        ends = [0, *(s + n for s, n, _ in sorted(pieces))]
        assert [s for s, _, _ in sorted(pieces)] == ends[:-1] and ends[-1] == pieces[0][2]
