"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Tokenizer A is byte-level pair encoding of a space and the text, tokenizer B a
sentence-piece model of the text, which adds that space itself. The byte ends
of both are merged for many texts at once: a state vector holds a pointer into
A and one into B for every lane, a step advances all of them, and where the
ends are equal it emits a link and a cut. Long texts have several lanes, so the
number of steps is bounded; finished lanes leave the vector.

How often a pair of ids is linked in the whole corpus is counted over blocks of
documents: a block sends each of its pairs once and gets back the totals, sorted
like its own list of pairs, so no task holds all pairs.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.byte_bpe import byte_bpe, tokenizer_path
from segmint.llm.text import pack_ints, slices, unpack_ints
from segmint.session import materialize


class Pair(NamedTuple):
    """The files of tokenizer A (byte-level) and B (sentence pieces)."""
    a: str = tokenizer_path()
    b: str = public_tokenizers.path("piece_bpe_32k.model")


class Aligned(NamedTuple):
    """Texts one after the other: A's and B's ids, each text's first token (one
    place more than texts), the linked tokens' places and their cuts (byte
    offsets over all texts)."""
    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut: np.ndarray


@functools.lru_cache(2)
def _pieces(path: str):
    """The model and the bytes of each of its ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return model, [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in A, place in B, cut) of all ends that are equal. Ends ascend
    over all texts. A lane is up to ``lane`` tokens of A of one text and the
    tokens of B that end inside them."""
    n = np.diff(first_a)
    count = -(-n // lane)
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    i = first_a[text] + at * lane
    stop_i = np.minimum(i + lane, first_a[text + 1])
    j = np.where(at == 0, first_b[text], np.searchsorted(end_b, end_a[np.maximum(i - 1, 0)], "right"))
    stop_j = np.searchsorted(end_b, end_a[stop_i - 1], "right")
    out_a, out_b, out_cut = [], [], []
    on = (i < stop_i) & (j < stop_j)
    while True:
        if not on.all():  # finished lanes leave
            i, j, stop_i, stop_j = i[on], j[on], stop_i[on], stop_j[on]
        if not len(i):
            break
        x, y = end_a[i], end_b[j]
        same = x == y
        out_a.append(i[same])
        out_b.append(j[same])
        out_cut.append(x[same])
        i = i + (x <= y)
        j = j + (y <= x)
        on = (i < stop_i) & (j < stop_j)
    if not out_a:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.sort(np.concatenate(x)) for x in (out_a, out_b, out_cut))


def align(texts: list[str], pair: Pair = Pair()) -> Aligned:
    """Both tokenizations of the texts and their links. A text that is empty, or
    whose tokens' bytes are not those of the space and the text, has no tokens."""
    a, (model, piece_b) = byte_bpe(pair.a), _pieces(pair.b)
    size_a, size_b = _sizes(pair)
    none = np.zeros(0, np.int64)
    ids_a, ids_b = [], []
    for text, y in zip(texts, model.encode(texts, num_threads=1), strict=True):
        x = a.ordinary(" " + text).astype(np.int64) if text else none
        whole = (" " + text).encode() if text else b""
        if not (whole and b"".join(map(a.pieces.__getitem__, x.tolist())) == whole and b"".join(map(piece_b.__getitem__, y)) == whole):
            x, y = none, none
        ids_a.append(x)
        ids_b.append(np.array(y, np.int64))
    starts = lambda some: np.concatenate([[0], np.cumsum([len(x) for x in some])]).astype(np.int64)
    first_a, first_b = starts(ids_a), starts(ids_b)
    ids_a, ids_b = (np.concatenate(x) if x else none for x in (ids_a, ids_b))
    return Aligned(ids_a, ids_b, first_a, first_b, *lockstep(np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b]), first_a, first_b))


@functools.lru_cache(2)
def _sizes(pair: Pair) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([len(p) for p in pieces], np.int64) for pieces in (byte_bpe(pair.a).pieces, _pieces(pair.b)[1]))


def group_text(x: Aligned) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    place_a, place_b = np.arange(len(x.a)), np.arange(len(x.b))
    group_a, group_b = np.searchsorted(x.link_a, place_a), np.searchsorted(x.link_b, place_b)
    before = np.concatenate([[0], x.link_b + 1])
    codes = np.empty(len(x.a) + len(x.b), np.int64)
    last_a, last_b = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
    last_a[x.link_a], last_b[x.link_b] = True, True
    codes[place_a + before[group_a]] = 3 * x.a + last_a
    codes[place_b + x.link_a[group_b] + 1] = 3 * x.b + 2 * last_b
    words = _words(int(codes.max(initial=0)) // 3 + 1)[codes].tolist()
    first = (x.first_a + x.first_b).tolist()
    return ["".join(words[i:j])[:-1] for i, j in zip(first, first[1:], strict=False)]


@functools.lru_cache(4)
def _words(n: int) -> np.ndarray:
    return np.array([f"{i}{c}" for i in range(n) for c in ",|;"], object)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))


def alignments(docs: DataFrame, pair: Pair = Pair(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, groups) of every row: the ids of both tokenizers,
    and for each group how many tokens of A and of B it has and the byte offset
    of its end in the space and the text. The last tokens of a group are linked.

    A null or empty text, and one that a tokenizer does not keep byte for byte,
    has empty arrays. Null ids and repeated rows are rows of their own, other
    columns are not read, and an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.struct([("n_a", pa.int32()), ("n_b", pa.int32()), ("end", pa.int64())])
        for b in batches:
            texts = b.column("t").to_pylist()
            for at in slices([len(t) for t in texts], 1 << 20):
                x = align(texts[at], pair)
                size = np.cumsum(_sizes(pair)[0][x.a])
                first = np.searchsorted(x.link_a, x.first_a)
                base = np.concatenate([[0], size])[x.first_a[:-1]]
                text = np.repeat(np.arange(len(base)), np.diff(first))
                n_a, n_b = np.diff(x.link_a, prepend=-1), np.diff(x.link_b, prepend=-1)
                listed = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
                groups = pa.StructArray.from_arrays([pa.array(n_a, pa.int32()), pa.array(n_b, pa.int32()), pa.array(x.cut - base[text])], fields=list(group))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[at], listed(x.first_a, pa.array(x.a, pa.int32())),
                                                  listed(x.first_b, pa.array(x.b, pa.int32())), listed(first, groups)],
                                                 ["doc_id", "a_ids", "b_ids", "groups"])
    return _texts(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups array<struct<n_a:int,n_b:int,end:bigint>>")


_DOCUMENT = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, pair: Pair, id_col: str, text_col: str, hold: int = 2_000_000) -> DataFrame:
    """kind 0: one pair of ids of a block of documents and its links there;
    kind 1: a document, its digests, and which of the block's pairs it links
    how often."""
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = {"kind": pa.int32(), "block": pa.int64(), "a": pa.int32(), "b": pa.int32(), "n": pa.int64(), **dict.fromkeys(_DOCUMENT, pa.int64()),
             "groups_sha256": pa.string(), "pairs": pa.binary(), "often": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size, id_type = TaskContext.get().partitionId() << 32, [], 0, pa.int64()

        def table_of(**cols):
            size = len(cols["block"])
            names = ["doc_id", *kinds]
            return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(size, id_type if c == "doc_id" else kinds[c]) for c in names], names)

        def rows():
            keys, where = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
            n = np.bincount(where, np.concatenate([h[2] for h in held]), len(keys)).astype(np.int64)
            full = lambda k, n: pa.array(np.full(n, k))
            yield table_of(kind=full(0, len(keys)).cast(pa.int32()), block=full(block, len(keys)), a=pa.array((keys >> 32).astype(np.int32)),
                           b=pa.array((keys & 0xFFFFFFFF).astype(np.int32)), n=pa.array(n))
            at = np.cumsum([0] + [len(h[1]) for h in held])
            for part in range(0, len(held), 2000):
                some = held[part:part + 2000]
                yield table_of(
                    doc_id=pa.array([h[0] for h in some], id_type), kind=full(1, len(some)).cast(pa.int32()), block=full(block, len(some)),
                    pairs=pa.array([pack_ints(where[at[part + k]:at[part + k + 1]].astype("<u4")) for k in range(len(some))], pa.binary()),
                    often=pa.array([pack_ints(h[2].astype("<u4")) for h in some], pa.binary()), groups_sha256=pa.array([h[4] for h in some], pa.string()),
                    **{c: pa.array([h[3][k] for h in some], pa.int64()) for k, c in enumerate(_DOCUMENT)})

        for b in batches:
            id_type = b.schema.field("doc_id").type
            ids, texts = b.column("doc_id").to_pylist(), b.column("t").to_pylist()
            for at in slices([len(t) for t in texts], 1 << 20):
                x = align(texts[at], pair)
                keys = (x.a[x.link_a] << 32) | x.b[x.link_b]
                first = np.searchsorted(x.link_a, x.first_a)
                for k, (doc, text) in enumerate(zip(ids[at], group_text(x), strict=True)):
                    linked, n = np.unique(keys[first[k]:first[k + 1]], return_counts=True)
                    links = int(first[k + 1] - first[k])
                    held.append((doc, linked, n, (int(x.first_a[k + 1] - x.first_a[k]), int(x.first_b[k + 1] - x.first_b[k]), links, links),
                                 hashlib.sha256(text.encode()).hexdigest() if links else ""))
                    size += len(linked) + 10
                if size >= hold:
                    yield from rows()
                    block, held, size = block + 1, [], 0
        if held:
            yield from rows()

    schema = f"doc_id {kind}, kind int, block long, a int, b int, n long, " + ", ".join(f"{c} long" for c in _DOCUMENT) + \
        ", groups_sha256 string, pairs binary, often binary"
    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def link_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, links, best) of a table (a, b, n): how often the pair is linked,
    and whether no other A id is linked to the B id more often."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("links"))
    top = counts.groupBy("b").agg(F.max("links").alias("top"))
    return counts.join(top, "b").select("a", "b", "links", (F.col("links") == F.col("top")).alias("best"))


def alignment_digests(docs: DataFrame, pair: Pair = Pair(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    for every row; rows are treated as by ``alignments``. ``n_best`` counts the
    links whose pair is linked most often of its B id, ``count_sum`` adds the
    pairs' counts over the links."""
    made = materialize(_blocks(docs, pair, id_col, text_col), "alignment-blocks")
    pairs = made.where("kind = 0").select("block", "a", "b", "n")
    counts = materialize(link_counts(pairs), "alignment-counts")
    answers = pairs.join(counts, ["a", "b"]).select(F.lit(0).alias("kind"), "block", "a", "b", "links", "best")
    both = made.where("kind = 1").drop("a", "b", "n").unionByName(answers, allowMissingColumns=True)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, links, best = None, [], []
        for b in batches:
            blocks, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for i, j in zip([0, *edges], [*edges, len(blocks)], strict=True):
                part = b.slice(i, j - i)
                if blocks[i] != block:
                    block, links, best = blocks[i], [], []
                if kinds[i] == 0:
                    links.append(part.column("links").to_numpy())
                    best.append(part.column("best").to_numpy(zero_copy_only=False))
                    continue
                n, top = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (links, best))
                n_best, total = [], []
                for which, often in zip(part.column("pairs").to_pylist(), part.column("often").to_pylist(), strict=True):
                    w, m = unpack_ints(which, "<u4"), unpack_ints(often, "<u4").astype(np.int64)
                    n_best.append(int(m[top[w].astype(bool)].sum()))
                    total.append(int((n[w] * m).sum()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(part.column(c) for c in _DOCUMENT), pa.array(n_best, pa.int64()),
                                                  pa.array(total, pa.int64()), part.column("groups_sha256")],
                                                 ["doc_id", *_DOCUMENT, "n_best", "count_sum", "groups_sha256"])

    keys = ("block", "kind", "a", "b")
    return both.repartition("block").sortWithinPartitions(*keys).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _DOCUMENT) + ", n_best long, count_sum long, groups_sha256 string")
