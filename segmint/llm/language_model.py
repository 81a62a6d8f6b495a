"""Language-model scores by a weighted backoff automaton.

A smoothed n-gram model of any order becomes an automaton. Its states are the
root (no history) and every history of 1 to order - 1 words seen in training,
the start of a document among them. An arc (state h, word w) exists where hw
was seen and leads to the longest state that ends hw; a state's failure arc
leads to the state without its first word and weighs what the state leaves to
words it has not seen. The root has an arc for every word.

    root arc      p(w)   = (c(w) + 1) / (N + V + 1)
    arc           p(w|h) = (c(hw) + m p(w|h')) / (c(h) + m)
    failure arc   f(h)   = m / (c(h) + m)

h' is h without its first word, m the mean number of different words after a
history of that length. A text is read once from left to right: a token takes
failure arcs until a state has an arc for it, then that arc; their logarithms
add up and the arc's end is carried to the next token.

The counts cover all training documents and are as large as the corpus, so no
task holds them all: documents are cut into blocks, each block asks, by sorted
hashed keys dealt over parts of a bounded number of keys, for the totals of its
own n-grams, and the part of the automaton that a block can reach comes back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.text import grouped, mix, pack_ints, pack_keys, unpack_ints, unpack_keys, utf8, word_hashes, words
from segmint.session import ensure_checkpoint_dir, materialize

END, START = np.uint64(0x51ED270B9A3F4D17), np.uint64(0xA0761D6478BD642F)


class Totals(NamedTuple):
    """Of the training tokens: all, and the distinct n-grams of each length."""
    tokens: int
    distinct: tuple[int, ...]

    def weight(self, length: int) -> float:
        """m of histories one shorter than ``length``."""
        return max(1.0, self.distinct[length - 1] / max(1, self.distinct[length - 2]))


def text_hashes(text: bytes) -> np.ndarray:
    return np.append(word_hashes(words(text)), END)


class Block(NamedTuple):
    """Documents one after another: each token's number among the block's
    words (ascending hashes), and the documents' lengths and folds."""
    word: np.ndarray
    vocabulary: np.ndarray
    lengths: np.ndarray
    held: np.ndarray

    @property
    def at(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths


class Grams(NamedTuple):
    """The block's distinct n-grams of one length, by history and last word."""
    token: np.ndarray    # of each token the n-gram that ends there; -1 where the text is too short
    history: np.ndarray  # number among the n-grams one shorter; the start follows the words
    last: np.ndarray
    suffix: np.ndarray   # the n-gram without its first word, among those one shorter
    hash: np.ndarray


def gram_levels(b: Block, order: int) -> list[Grams]:
    size = len(b.vocabulary)
    none = np.zeros(0, np.int64)
    out = [Grams(b.word, none, none, none, b.vocabulary)]
    place = np.arange(len(b.word)) - np.repeat(b.at, b.lengths)
    before = np.append(np.int64(size), b.word[:-1])[:len(b.word)]
    before[place == 0] = size
    hashes = np.append(b.vocabulary, START)
    for length in range(2, order + 1):
        which = np.flatnonzero(place >= length - 2)
        code, first, inverse = np.unique(before[which] * (size + 1) + b.word[which], return_index=True, return_inverse=True)
        token = np.full(len(b.word), -1, np.int64)
        token[which] = inverse
        history, last = code // (size + 1), code % (size + 1)
        hashes = mix(mix(hashes[history], 20 + length) ^ b.vocabulary[last], 40 + length)
        out.append(Grams(token, history, last, out[-1].token[which[first]], hashes))
        before = np.append(np.int64(-1), token[:-1])[:len(token)]
    return out


class Deal(NamedTuple):
    """How many bits of a hash are a key of each length, and how many of them name its part."""
    bits: tuple[int, ...]
    part_bits: tuple[int, ...]

    @classmethod
    def of(cls, words: int, tokens: int, order: int, part_keys: int) -> Deal:
        """Words have whole hashes. Longer n-grams have so many bits that one in
        2^20 at most is taken for another, however many there are."""
        log = lambda n: (max(1, n) - 1).bit_length()
        part = lambda n: log(-(-n // part_keys))
        return cls((64, *(min(64, log(tokens) + 20) for _ in range(order - 1))),
                   (part(words), *(part(tokens) for _ in range(order - 1))))

    @property
    def parts(self) -> int:
        return sum(1 << p for p in self.part_bits)

    def keys(self, levels: list[Grams]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: the order by key, the keys in it, part numbers and where each part starts."""
        for i, g in enumerate(levels):
            key = g.hash >> np.uint64(64 - self.bits[i])
            by = np.argsort(key)
            key = key[by]
            if self.part_bits[i]:
                part = (key >> np.uint64(self.bits[i] - self.part_bits[i])).astype(np.int64)
            else:
                part = np.zeros(len(key), np.int64)
            which, first = np.unique(part, return_index=True)
            yield by, key, which + (i << 40), first


class Automaton(NamedTuple):
    """States are numbers, the root is 0. ``arcs`` are state * words + word, ascending."""
    start: int
    arcs: np.ndarray
    weight: np.ndarray
    end: np.ndarray
    fail: np.ndarray
    fail_weight: np.ndarray
    root_weight: np.ndarray
    root_end: np.ndarray


def automaton(b: Block, levels: list[Grams], counts: list[np.ndarray], n: Totals, documents: int) -> Automaton:
    """What the block's texts can reach of the automaton. ``counts`` are the
    training totals of each length's n-grams, ``documents`` how often the start was seen."""
    size = len(b.vocabulary)
    root = (counts[0] + 1) / (n.tokens + n.distinct[0] + 1)
    seen = np.append(counts[0], documents)  # of histories, by their number
    offset = 1
    arcs, weight, end = [], [], []
    fail, fail_weight = [np.zeros(1 + len(seen), np.int64)], [np.zeros(1)]
    shorter = root
    for length in range(2, len(levels) + 1):
        g, c, m = levels[length - 1], counts[length - 1], n.weight(length)
        fail_weight.append(np.log10(m / (seen + m)))
        p = (c + m * shorter[g.suffix]) / (seen[g.history] + m)
        have = np.flatnonzero(c > 0)
        following = offset + len(seen)
        arcs.append((offset + g.history[have]) * size + g.last[have])
        weight.append(np.log10(p[have]))
        if length < len(levels):
            end.append(following + have)
            fail.append(offset + g.suffix)
        else:
            end.append(offset + g.suffix[have])
        offset, seen, shorter = following, c, p
    none = [np.zeros(0, np.int64)]
    return Automaton(1 + size if documents and len(levels) > 1 else 0, np.concatenate(arcs or none), np.concatenate(weight or none),
                     np.concatenate(end or none), np.concatenate(fail), np.concatenate(fail_weight), np.log10(root),
                     np.where((counts[0] > 0) & (len(levels) > 1), 1 + np.arange(size), 0))


def traverse(b: Block, a: Automaton, order: int, lane: int = 1024) -> np.ndarray:
    """The log10 probability of each token, read from left to right by the
    automaton. All texts of the block advance together. A long text is cut into
    lanes: a state holds order - 1 words at most, so a lane that reads so many
    words before its first, from the root, is in the state of the whole text."""
    lanes = -(-b.lengths // lane)
    text = np.repeat(np.arange(len(b.lengths)), lanes)
    first = b.at[text] + lane * (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    stop = np.minimum(first + lane, (b.at + b.lengths)[text])
    begin = np.maximum(first - (order - 1), b.at[text])
    by = np.argsort(begin - stop, kind="stable")  # the longest lanes first, so that the active ones are a prefix
    first, stop, begin = first[by], stop[by], begin[by]
    state = np.where(begin == b.at[text[by]], a.start, 0)
    out = np.zeros(len(b.word))
    size, last = len(b.vocabulary), len(a.arcs) - 1
    active = len(first)
    for step in range(int((stop - begin).max(initial=0))):
        while begin[active - 1] + step >= stop[active - 1]:
            active -= 1
        at = begin[:active] + step
        word, gain = b.word[at], np.zeros(active)
        left = np.arange(active)
        while len(left):
            s, w = state[left], word[left]
            up = s == 0
            gain[left[up]] += a.root_weight[w[up]]
            state[left[up]] = a.root_end[w[up]]
            left, s, w = left[~up], s[~up], w[~up]
            if not len(left):
                break
            code = s * size + w
            arc = np.minimum(np.searchsorted(a.arcs, code), last)
            hit = a.arcs[arc] == code if last >= 0 else np.zeros(len(left), bool)
            gain[left[hit]] += a.weight[arc[hit]]
            state[left[hit]] = a.end[arc[hit]]
            left, s = left[~hit], s[~hit]
            gain[left] += a.fail_weight[s]
            state[left] = a.fail[s]
        own = at >= first[:active]
        out[at[own]] = gain[own]
    return out


_TOKENS = ("block long, doc_ids array<{id}>, held array<boolean>, lengths array<long>, words binary, vocabulary binary, "
           "n_tokens long, n_words long, n_train long")


def tokenized(docs: DataFrame, held: Column, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Blocks of about ``block_tokens`` tokens, one row each."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held.alias("held"), utf8(text_col).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 32, 0
        ids, held, texts, size, id_type = [], [], [], 0, pa.int64()

        def row():
            v, w = np.unique(np.concatenate(texts), return_inverse=True)
            one = lambda x, t: pa.array([x], t)
            return pa.RecordBatch.from_arrays(
                [one(base + done, pa.int64()), one(ids, pa.list_(id_type)), one(held, pa.list_(pa.bool_())),
                 one([len(t) for t in texts], pa.list_(pa.int64())), one(pack_ints(w.astype("<u4")), pa.binary()),
                 one(pack_keys(v), pa.binary()), one(len(w), pa.int64()), one(len(v), pa.int64()), one(held.count(False), pa.int64())],
                ["block", "doc_ids", "held", "lengths", "words", "vocabulary", "n_tokens", "n_words", "n_train"])

        for b in parts:
            id_type = b.schema.field("doc_id").type
            for d, h, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held", "t")), strict=True):
                ids.append(d)
                held.append(h)
                texts.append(text_hashes(t))
                size += len(texts[-1])
                if size >= block_tokens:
                    yield row()
                    done, ids, held, texts, size = done + 1, [], [], [], 0
        if ids:
            yield row()

    return src.mapInArrow(run, _TOKENS.format(id=kind))


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """``blocks`` written in the shared folder in buckets by block, so that
    answers travel to the blocks and the blocks stay. The table's name is only
    needed to write it; its files stay without it."""
    spark, name = blocks.sparkSession, f"lm_blocks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    blocks.write.format("parquet").option("path", path).bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    written = spark.table(name)
    written.schema  # resolved here, before the name goes
    spark.sql(f"DROP TABLE {name}")
    return written


def _block(r: dict) -> Block:
    return Block(unpack_ints(r["words"], "<u4").astype(np.int64), unpack_keys(r["vocabulary"]),
                 np.array(r["lengths"], np.int64), np.array(r["held"], bool))


def _asked(blocks: DataFrame, order: int, deal: Deal) -> DataFrame:
    """(part, block, keys, counts): what each block has and asks."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = _block(r)
                train = np.repeat(~block.held, block.lengths)
                levels = gram_levels(block, order)
                for g, (by, keys, which, first) in zip(levels, deal.keys(levels), strict=True):
                    if not len(by):  # no text of the block is so long
                        continue
                    own = np.bincount(g.token[train & (g.token >= 0)], minlength=len(by))[by].astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(which), pa.array([r["block"]] * len(which), pa.int64()),
                         pa.array([pack_keys(x) for x in np.split(keys, first[1:])], pa.binary()),
                         pa.array([pack_ints(x) for x in np.split(own, first[1:])], pa.binary())], ["part", "block", "keys", "counts"])
    return blocks.drop("doc_ids").mapInArrow(run, "part long, block long, keys binary, counts binary")


def _answered(asked: DataFrame, parts: int) -> DataFrame:
    """(part, block, totals) in the order asked; and for each part a row
    without a block: its n-grams in training texts, all and distinct."""
    def run(batches):
        for rows in grouped(batches, ("part",)):
            keys = [unpack_keys(r["keys"]) for r in rows]
            unique, where = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(where, np.concatenate([unpack_ints(r["counts"], "<u4") for r in rows]), len(unique)).astype(np.int64)
            ends = np.cumsum([len(k) for k in keys])[:-1]
            back = [pack_ints(total[w]) for w in np.split(where, ends)]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["part"]] * (n + 1), pa.int64()), pa.array([*(r["block"] for r in rows), None], pa.int64()),
                 pa.array([*back, None], pa.binary()), *(pa.array([None] * n + [int(x)], pa.int64()) for x in (total.sum(), (total > 0).sum()))],
                ["part", "block", "totals", "n_all", "n_distinct"])
    return asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
        run, "part long, block long, totals binary, n_all long, n_distinct long")


def score_texts(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 3,
                block_tokens: int = 1_500_000, part_keys: int = 2_000_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row of ``docs``; rows where ``held`` is true train nothing.
    ``order`` is the length of the longest n-grams, 1 or more.

    Tokens are the words of the text with A-Z lowered, and one end. A null or
    empty text is the end alone; a null ``held`` counts as false; null ids are
    kept; repeated rows count and are scored each. Without training rows the
    counts are 0 and every token has the one probability left. Other columns
    are not read. An empty table gives an empty table. Words are compared by
    64-bit hashes, longer n-grams by so many bits that one in 2^20 at most is
    taken for another. A task holds one block at a time, or one text if longer,
    or the keys of one part: about ``part_keys``, and as many parts as the
    tokens need.
    """
    if order < 1:
        raise ValueError("order is 1 or more")
    held = F.coalesce(held, F.lit(False))
    blocks = _bucketed(tokenized(docs, held, id_col, text_col, block_tokens), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = blocks.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_words", "n_train"))).first()
    _, tokens, n_words, train_docs = map(int, size)
    deal = Deal.of(n_words, tokens, order, part_keys)
    answers = materialize(_answered(_asked(blocks, order, deal), deal.parts), "lm-totals")
    stat = {r.level: r for r in answers.where("block is null").groupBy(F.shiftright("part", 40).alias("level")).agg(
        F.sum("n_all").alias("n"), F.sum("n_distinct").alias("distinct")).collect()}  # a row for each length
    n = Totals(stat[0].n if 0 in stat else 0, tuple(stat[i].distinct if i in stat else 0 for i in range(order)))
    id_kind = docs.schema[id_col].dataType.simpleString()

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        (row,), answer = block.to_pylist(), dict(zip(answers["part"].to_pylist(), answers["totals"].to_pylist(), strict=True))
        b = _block(row)
        levels = gram_levels(b, order)
        counts = []
        for by, _, which, _ in deal.keys(levels):
            counts.append(np.empty(len(by), np.int64))
            if len(by):
                counts[-1][by] = np.concatenate([unpack_ints(answer[p], np.int64) for p in which.tolist()])
        gain = traverse(b, automaton(b, levels, counts, n, train_docs), order)
        c = counts[0][b.word]
        known = np.add.reduceat((c > 0).astype(np.int64), b.at)
        base = np.add.reduceat(np.log10((c + 1) / (n.tokens + n.distinct[0] + 1)), b.at)
        return pa.Table.from_arrays(
            [pa.array(row["doc_ids"], ids), pa.array(b.held), pa.array(b.lengths), pa.array(known),
             pa.array(np.full(len(known), n.tokens)), pa.array(base), pa.array(np.add.reduceat(gain, b.at))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    ids = to_arrow_type(docs.schema[id_col].dataType)
    return blocks.groupBy("block").cogroup(answers.where("block is not null").select("part", "block", "totals").groupBy("block")).applyInArrow(
        run, f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame) -> DataFrame:
    """The thin query: rows whose crc32 of the id modulo 7 is 2 are held out."""
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
