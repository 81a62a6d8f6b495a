"""Vector bin packing of training examples.

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
The next example for a sequence is the one with the largest dot product of its
needs and the room that is left, weighted by how scarce each resource is among
the waiting examples. Documents may be cut: full pieces are their own
sequences, the rest are packed, and a gap that nothing fits is filled by
cutting an example. Packing needs no key, so every task packs its own rows in
bounded pools and nothing is shuffled.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.byte_bpe import byte_bpe, tokenizer_path


class Limits(NamedTuple):
    """What one sequence holds at most."""
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Placed(NamedTuple):
    item: int
    start: int
    length: int
    bin: int
    offset: int


def dot_product_pack(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool, last: bool = True) -> list[Placed]:
    """Places items of ``tokens`` and ``loss`` needs into numbered bins.

    Without ``cut`` an item must fit an empty bin. With it, a document's loss
    is its length less one (its first id is not predicted); an item that does
    not fit the last gap gives its head to it, and what is left in the last
    bin goes to bins of a power of two, which need no padding, or if more
    items follow (not ``last``) is not placed.
    """
    need = np.stack([tokens, np.ones(len(tokens)), loss], axis=1).astype(float)
    if not cut and (need > np.array(limits)).any():
        raise ValueError("an example is larger than an empty sequence")
    cap = np.array(limits, float)
    need /= cap
    order = np.lexsort((np.arange(len(tokens)), -tokens))
    need, ids = need[order], order
    start, left = np.zeros(len(ids), np.int64), tokens[order].astype(np.int64)
    alive = np.ones(len(ids), bool)
    out: list[Placed] = []
    number = 0

    def set_need(i: int) -> None:
        need[i] = left[i] / cap[0], 1 / cap[1], max(0, left[i] - 1) / cap[2]

    while alive.any():
        if alive.sum() * 2 < len(alive):  # the placed ones no longer cost time
            ids, start, left, need, alive = ids[alive], start[alive], left[alive], need[alive], np.ones(int(alive.sum()), bool)
        scarce = need[alive].sum(axis=0)
        scarce /= max(scarce.max(), 1e-12)
        if cut and left[alive].sum() < limits.tokens and alive.sum() <= limits.segments:
            if last:
                number = _tail(out, ids[alive], start[alive], left[alive], number)
            break
        room, used = np.ones(3), 0
        while True:
            fits = alive & (need <= room + 1e-9).all(axis=1)
            if fits.any():
                i = int(np.argmax(np.where(fits, need @ (room * scarce), -1.0)))
                out.append(Placed(int(ids[i]), int(start[i]), int(left[i]), number, used))
                used, alive[i] = used + int(left[i]), False
                room -= need[i]
                continue
            gap = min(limits.tokens - used, round(room[2] * cap[2]) + 1)
            if cut and gap > 0 and room[1] * cap[1] >= 1 - 1e-9 and (left[alive] > gap).any():
                i = int(np.argmax(np.where(alive, left, -1)))
                out.append(Placed(int(ids[i]), int(start[i]), gap, number, used))
                start[i], left[i] = start[i] + gap, left[i] - gap
                set_need(i)
            break
        number += 1
    return out


def _tail(out: list[Placed], ids, start, left, number: int) -> int:
    """The last, unfilled bin as bins of falling powers of two."""
    rest = int(left.sum())
    i = 0
    start, left = start.copy(), left.copy()
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        used = 0
        while used < room:
            n = min(int(left[i]), room - used)
            out.append(Placed(int(ids[i]), int(start[i]), n, number, used))
            start[i], left[i], used = start[i] + n, left[i] - n, used + n
            i += left[i] == 0
        number += 1
    return number


def longest_fit_pack(tokens: np.ndarray, limits: Limits, last: bool = True) -> list[Placed]:
    """``dot_product_pack`` with ``cut`` for pieces that all bear loss but for
    their first id. All three needs of such a piece grow with its length, so
    the largest dot product is that of the longest piece that fits, which
    stands in a sorted list."""
    waiting = sorted((-int(n), i, 0) for i, n in enumerate(tokens))  # (-length, item, start)
    total, number = int(np.sum(tokens)), 0
    out: list[Placed] = []
    while waiting:
        if total < limits.tokens and len(waiting) <= limits.segments:
            if last:
                ids, start, left = (np.array(x, np.int64) for x in zip(*((i, s, -n) for n, i, s in waiting), strict=True))
                number = _tail(out, ids, start, left, number)
            break
        used, segments, loss = 0, 0, 0
        while waiting and segments < limits.segments:
            gap = min(limits.tokens - used, limits.loss - loss + 1)
            k = bisect.bisect_left(waiting, (-gap, -1, -1))
            if gap <= 0 or (k == len(waiting) and -waiting[0][0] <= gap):
                break
            n, i, s = waiting.pop(k if k < len(waiting) else 0)
            size = min(-n, gap)
            out.append(Placed(i, s, size, number, used))
            used, segments, loss, total = used + size, segments + 1, loss + size - 1, total - size
            if size < -n:
                bisect.insort(waiting, (n + size, i, s + size))
                break
        number += 1
    return out


PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, n_loss long"


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                   end_id: int = 1, limits: Limits = Limits(), pool: int = 1024) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids (unsigned
    little-endian 32-bit), doc_tokens, sequence_id, offset, n_loss.

    Ids are those of the tokenizer's library without special tokens around the
    text; an added token's string inside a text is its id, as there. A null or
    empty text is the end id alone; null ids and repeated rows are
    packed as rows of their own; other columns are not read; an empty table
    gives an empty table. ``sequence_id`` holds the task's number above bit 40
    and a counter below. ``pool`` is how many rest pieces are packed together.
    """
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()
    full = min(limits.tokens, limits.loss + 1)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, tokenizer = TaskContext.get().partitionId() << 40, byte_bpe(path)
        used, rest, kept = 0, [], 0  # rest: (doc_id, start, ids, doc_tokens), the first kept ones from the pool before

        def batch(rows):
            # row: doc_id, start, ids, doc_tokens, sequence, offset
            cols = list(zip(*rows, strict=True))
            n = [len(x) // 4 for x in cols[2]]
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], id_type), pa.array(cols[1], pa.int64()), pa.array(n, pa.int64()), pa.array(cols[2], pa.binary()),
                pa.array(cols[3], pa.int64()), pa.array([base + s for s in cols[4]], pa.int64()), pa.array(cols[5], pa.int64()),
                pa.array([max(0, x - 1) for x in n], pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "n_loss"])

        def flush(first, last):
            """Rows, the next sequence's number, and what is left for the next pool."""
            n = np.array([len(r[2]) // 4 for r in rest])
            rows, done = [], [0] * len(rest)
            for p in longest_fit_pack(n, limits, last):
                d, s, ids, total = rest[p.item]
                rows.append((d, s + p.start, ids[4 * p.start:4 * (p.start + p.length)], total, first + p.bin, p.offset))
                done[p.item] = p.start + p.length
            left = [(d, s + x, ids[4 * x:], total) for (d, s, ids, total), x in zip(rest, done, strict=True) if 4 * x < len(ids)]
            return rows, max((r[4] + 1 for r in rows), default=first), left

        id_type = pa.int64()
        for b in parts:
            id_type = b.schema.field("doc_id").type
            rows = []
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = tokenizer.whole(text).astype("<u4").tobytes() + end
                total, at = len(ids) // 4, 0
                while total - at >= full:
                    rows.append((d, at, ids[4 * at:4 * (at + full)], total, used, 0))
                    used, at = used + 1, at + full
                    if len(rows) >= 2000:
                        yield batch(rows)
                        rows = []
                if at < total:
                    rest.append((d, at, ids[4 * at:], total))
                if len(rest) - kept >= pool:
                    more, used, rest = flush(used, last=False)
                    kept = len(rest)
                    if more:
                        yield batch(more)
            if rows:
                yield batch(rows)
        if rest:
            yield batch(flush(used, last=True)[0])

    return src.mapInArrow(run, PIECES.format(id=docs.schema[id_col].dataType.simpleString()))


def pack_examples(examples: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits(),
                  pool: int = 1024) -> DataFrame:
    """Whole examples, such as instruction turns with masked prompts, in
    sequences: the id, sequence_id, offset, n_tokens, n_loss.

    Rows with a null or negative count, or one beyond an empty sequence's
    limits, come back with a null sequence_id. Nothing else is dropped; null
    ids and repeated rows are packed as rows of their own.
    """
    cap = np.array([limits.tokens, limits.loss])
    src = examples.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{tokens_col}`").cast("long").alias("n_tokens"),
                          F.col(f"`{loss_col}`").cast("long").alias("n_loss"))

    def run(parts):
        base, used, wait = TaskContext.get().partitionId() << 40, 0, []

        def batch(rows, id_type):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                              ["id", "n_tokens", "n_loss", "sequence_id", "offset"])

        def flush():
            placed = dot_product_pack(np.array([w[1] for w in wait]), np.array([w[2] for w in wait]), limits, cut=False)
            return [(*wait[p.item], base + used + p.bin, p.offset) for p in placed], used + 1 + max(p.bin for p in placed)

        kind = pa.int64()
        for b in parts:
            kind, odd = b.schema.field("id").type, []
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "n_tokens", "n_loss")), strict=True):
                if None in row[1:] or min(row[1:]) < 0 or (np.array(row[1:]) > cap).any():
                    odd.append((*row, None, None))
                else:
                    wait.append(row)
                if len(wait) >= pool:
                    rows, used = flush()
                    yield batch(rows, kind)
                    wait = []
            if odd:
                yield batch(odd, kind)
        if wait:
            yield batch(flush()[0], kind)

    return src.mapInArrow(run, f"id {examples.schema[id_col].dataType.simpleString()}, n_tokens long, n_loss long, sequence_id long, offset long") \
        .withColumnRenamed("id", id_col)


def packing_digests(docs: DataFrame, **options) -> DataFrame:
    """The thin query: the pieces with a checksum in place of the ids."""
    return pack_documents(docs, **options).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                                  "doc_tokens", "sequence_id", "offset")
