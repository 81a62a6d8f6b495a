import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from segmint.llm.alignment import align, alignment_digests, alignments, lockstep
from segmint.llm.byte_bpe import byte_bpe, tokenizer_path

ROWS = "doc_id long, text string"


def plain(texts):
    """The digests by the libraries and two plain pointers."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel
    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)}
    assert ByteLevel  # the alphabet above is the decoder's
    out, count = [], collections.Counter()
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        bx = [bytes(byte[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not t or b"".join(bx) != (" " + t).encode() or b"".join(by) != (" " + t).encode():
            out.append((0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in bx]).tolist(), np.cumsum([len(p) for p in by]).tolist()
        cuts = set(ends_a) & set(ends_b)
        groups, ga, gb, j = [], [], [], 0
        for i, e in zip(x, ends_a, strict=True):
            ga.append(i)
            if e in cuts:
                while True:
                    gb.append(y[j])
                    j += 1
                    if ends_b[j - 1] == e:
                        break
                groups.append((ga, gb))
                ga, gb = [], []
        links = [(g[0][-1], g[1][-1]) for g in groups]
        count.update(links)
        out.append((len(x), len(y), groups, links))
    top = collections.Counter()
    for (_, q), n in count.items():
        top[q] = max(top[q], n)
    rows = []
    for n_a, n_b, groups, links in out:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((n_a, n_b, len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


TEXTS = ["", None, " ", "plain words, plain words.", "Zürich 東京 😀 \x00 ok", "a▁b", "x <|endoftext|> </s> <s> <unk> <0x41> y", "two  spaces\tand\n\nlines ",
         "naïve café é", "don't we'll 12345 ...---...", " nbsp line", "plain words, plain words."]


def test_as_the_libraries(spark):
    rng = random.Random(3)
    more = ["".join(rng.choices("abcdefgh <|>é東 \n😀'", k=rng.randrange(1, 400))) for _ in range(150)]
    texts = TEXTS + more + ["the cat " * 3000 + "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ROWS).repartition(7)
    want = plain([t or "" for t in texts])
    got = {r.doc_id: tuple(r)[1:] for r in alignment_digests(df).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(r[2] for r in want) > 10_000 and any(r[0] == 0 and texts[i] for i, r in enumerate(want))


def test_general_output(spark):
    texts = [t for t in TEXTS if t] + ["word " * 5000]
    rows = alignments(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ROWS)).collect()
    pieces = byte_bpe(tokenizer_path()).pieces
    for r in rows:
        text = (" " + texts[r.doc_id]).encode()
        if r.a_ids:
            assert b"".join(pieces[i] for i in r.a_ids) == text
            assert sum(g.n_a for g in r.groups) == len(r.a_ids) and sum(g.n_b for g in r.groups) == len(r.b_ids) and r.groups[-1].end == len(text)
            assert len(pieces[r.a_ids[0]]) <= r.groups[0].end and len({g.end for g in r.groups}) == len(r.groups)


@pytest.mark.parametrize("lane", [1, 2, 7, 1024])
def test_lockstep_is_the_common_ends(lane):
    rng = np.random.default_rng(lane)
    ends, first = ([], []), ([0], [0])
    base = 0
    for _ in range(60):
        size = int(rng.integers(1, 60))
        for k in (0, 1):
            some = np.unique(np.append(rng.integers(1, size + 1, rng.integers(1, size + 1)), size))
            ends[k].extend((some + base).tolist())
            first[k].append(len(ends[k]))
        base += size
        if rng.random() < 0.2:  # a text without tokens
            first[0].append(first[0][-1])
            first[1].append(first[1][-1])
    a, b = map(np.array, ends)
    i, j, cut = lockstep(a, b, *map(np.array, first), lane=lane)
    both = np.intersect1d(a, b)
    assert (cut == both).all() and (a[i] == both).all() and (b[j] == both).all()


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "same"), (1, "same"), (1, "same"), (2, None)], ROWS).withColumns({c: F.lit(9) for c in ("a", "kind", "block", "t", "links")})
    got = sorted((tuple(r) for r in alignment_digests(df).collect()), key=str)
    assert len(got) == 4 and {r[1:] for r in got if r[0] != 2} == {plain(["same"] * 3)[0]} and (2, 0, 0, 0, 0, 0, 0, "") in got
    assert alignment_digests(df.limit(0)).count() == 0 and alignments(df.limit(0)).count() == 0
    assert align([""]).cut.size == 0
