"""Phrase collocations from a weighted de Bruijn graph.

Nodes are phrases one word shorter than the longest, an edge between two
overlapping nodes is a longest phrase, its weight the number of occurrences.
Every word occurrence starts exactly one entry: the edge that begins there, or
near the end of a piece the shorter phrase that is left (the piece-end
correction). So the count of any shorter phrase is the flow through its node:
the weights of all entries that begin with it. Counts of four words come from
edges, those of three from those of four, and so on down to words.

A task builds the graph of a chunk of text, adds up equal edges and compacts
unary paths: edges that follow each other everywhere with one weight become one
row, which Spark opens into edges again when it adds them up. A phrase whose
flow all goes through a longer one is an inner node of a unary path and is
dropped at the end.

Only phrases that occur often are candidates, so pieces may be cut between two
words that are rarely neighbours: no candidate is cut, and the flow stays whole
since each word still starts one entry. Which neighbours are rare is told by a
bitmap of fixed size over hashed pairs, which can call a rare pair frequent
(more work, same result) but no frequent pair rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.llm.text import grouped, mix, pack_ints, pack_keys, unpack_ints, unpack_keys
from segmint.session import materialize

#: Ends of pieces; a space or a tab parts words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
_SHIFT = 16  # a block of the bitmap has 2**16 places


class _Words(dict):
    """word -> its number in the chunk, by language."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append((self.lang, word))
        return number


def _chunks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[np.ndarray, list[tuple[str, bytes]]]]:
    """(numbers, names): about ``words`` words and piece ends (0) as numbers;
    the name of a number is (language, word). A chunk ends with a piece end."""
    names, by_lang, parts, size = [("", b"")], {}, [], 0
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("t").to_pylist(), strict=True):
            # 0xFF is no byte of UTF-8, so it can stand for an end
            ws = text.lower().translate(_PLAIN).replace(b"\n", b" \xff ").split()
            ids = by_lang.get(lang)
            if ids is None:
                ids = by_lang[lang] = _Words(lang, names)
                ids[b"\xff"] = 0
            parts.append(np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws)))
            parts.append(np.zeros(1, np.int64))
            size += len(ws) + 1
            if size >= words:
                yield np.concatenate(parts), names
                names, by_lang, parts, size = [("", b"")], {}, [], 0
    if parts:
        yield np.concatenate(parts), names


def _pair_places(s: np.ndarray, names: list[tuple[str, bytes]], bits: int) -> np.ndarray:
    """For each word and its successor the place on the bitmap; -1 over a piece end."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(lang.encode() + b"\xff" + w) for lang, w in names), np.uint64, len(names))
    place = (mix(mix(h[s[:-1]], 31) ^ h[s[1:]], 32) & np.uint64((1 << bits) - 1)).astype(np.int64)
    place[(s[:-1] == 0) | (s[1:] == 0)] = -1
    return place


def _frequent_places(src: DataFrame, least: int, bits: int, words: int) -> bytes:
    """The bitmap of places with ``least`` occurrences or more: 2**bits bits,
    whatever the data. A task adds up one block of it from packed counts."""
    def ask(batches):
        for s, names in _chunks(batches, words):
            place = _pair_places(s, names, bits)
            places, n = np.unique(place[place >= 0], return_counts=True)
            which, first = np.unique(places >> _SHIFT, return_index=True)
            keys = np.split((places & ((1 << _SHIFT) - 1)).astype(np.uint64), first[1:]) if len(which) else []
            often = np.split(n.astype("<u4"), first[1:]) if len(which) else []
            yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array([pack_keys(k) for k in keys], pa.binary()),
                                              pa.array([pack_ints(c) for c in often], pa.binary())], ["part", "places", "often"])

    def add(batches):
        for rows in grouped(batches, ("part",)):
            total = np.zeros(1 << _SHIFT, np.int64)
            for r in rows:
                total[unpack_keys(r["places"]).astype(np.int64)] += unpack_ints(r["often"], "<u4")
            yield pa.RecordBatch.from_arrays([pa.array([rows[0]["part"]], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()])],
                                             ["part", "map"])

    asked = src.mapInArrow(ask, "part int, places binary, often binary")
    full = np.zeros(1 << (bits - 3), np.uint8)
    for r in asked.repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, map binary").collect():  # 2**bits bits
        full[r["part"] << (_SHIFT - 3):(r["part"] + 1) << (_SHIFT - 3)] = np.frombuffer(r["map"], np.uint8)
    return full.tobytes()


def chunk_paths(s: np.ndarray, linked: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, words, weight) of a chunk's entries, each distinct one once.

    ``linked`` tells of each place whether its word and the next belong
    together. Edges that follow each other with one weight are one path, of
    more than ``longest`` words."""
    at = np.flatnonzero(s)
    length = np.ones(len(s), np.int64)  # words of the entry that starts here
    on = linked.copy()
    for k in range(1, longest):
        length[:len(on)] += on
        on = on[:-1] & linked[k:] if len(on) > 1 else on[:0]
    # exact names of the phrases of 1, 2 ... words that start at each place
    name, names_at, out = s.copy(), at, []
    nodes = None
    for k in range(1, longest + 1):
        if k > 1:
            names_at = names_at[length[names_at] >= k]
            pair = name[names_at] * (int(s.max(initial=0)) + 1) + s[names_at + k - 1]
            name[names_at] = np.unique(pair, return_inverse=True)[1]
        if k == longest - 1:
            nodes = name.copy()
        ends = names_at[length[names_at] == k]
        if k < longest and len(ends):
            _, first, n = np.unique(name[ends], return_index=True, return_counts=True)
            out.append((ends[first], np.full(len(first), k), n))
    if len(names_at):  # edges
        _, first, weight = np.unique(name[names_at], return_index=True, return_counts=True)
        first = names_at[first]
        # through[v]: occurrences of the phrase of a node, with and without an edge behind it
        some = np.flatnonzero((s > 0) & (length >= longest - 1))
        through = np.bincount(nodes[some])
        by = np.argsort(first)
        first, weight = first[by], weight[by]
        # An edge goes on by the next one where the node between them is unary: all its flow comes from the one and goes
        # on by the other. Then the other's first occurrence is right behind the one's, so paths are runs in this order.
        goes_on = (np.diff(first) == 1) & (weight[1:] == weight[:-1]) & (through[nodes[first[1:]]] == weight[1:])
        heads = np.flatnonzero(np.concatenate([[True], ~goes_on]))
        out.append((first[heads], np.diff([*heads, len(first)]) + longest - 1, weight[heads]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _paths(src: DataFrame, frequent: bytes, bits: int, longest: int, words: int) -> DataFrame:
    """(lang, phrase, n): the paths and piece ends of every chunk."""
    shared = src.sparkSession.sparkContext.broadcast(frequent)  # 2**bits bits

    def run(batches):
        bitmap = np.frombuffer(shared.value, np.uint8)
        for s, names in _chunks(batches, words):
            place = _pair_places(s, names, bits)
            linked = (place >= 0) & ((bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
            start, size, n = chunk_paths(s, linked, longest)
            ids = s.tolist()
            for a in range(0, len(start), 50_000):
                i, k = start[a:a + 50_000].tolist(), size[a:a + 50_000].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[ids[x]][0] for x in i], pa.string()),
                     pa.array([b" ".join([names[w][1] for w in ids[x:x + y]]).decode() for x, y in zip(i, k, strict=True)], pa.string()),
                     pa.array(n[a:a + 50_000])], ["lang", "phrase", "n"])

    return src.mapInArrow(run, "lang string, phrase string, n long")


def _words_of(k: Column) -> Column:
    """The first k words of a phrase, the last -k if k is negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), k.cast("int"))


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5, text_col: str = "text", lang_col: str = "lang", bits: int = 26,
                  words: int = 1_500_000) -> list[DataFrame]:
    """For 1, 2 ... ``longest`` words a table (lang, phrase, f).

    The counts of all words, and those of longer phrases that occur ``least``
    times or more, are whole; a rarer phrase may be missing or have less."""
    und = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    src = docs.select(und.alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("t"))
    frequent = _frequent_places(src, least, bits, words)
    parts = F.split("phrase", " ")
    opened = F.when(F.size(parts) <= longest, F.array("phrase")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(parts) - longest + 1), lambda i: F.array_join(F.slice(parts, i, longest), " ")))
    paths = _paths(src, frequent, bits, longest, words)
    entries = paths.select("lang", F.explode(opened).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    entries = materialize(entries.withColumn("k", F.size(F.split("phrase", " "))), "collocation-entries")
    counts = [entries.where(F.col("k") == longest).select("lang", "phrase", F.col("n").alias("f"))]
    for k in range(longest - 1, 0, -1):
        flow = counts[0].select("lang", _words_of(F.lit(k)).alias("phrase"), "f")
        ends = entries.where(F.col("k") == k).select("lang", "phrase", F.col("n").alias("f"))
        counts.insert(0, materialize(flow.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), f"collocation-{k}"))
    return counts


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, longest: int = 5, text_col: str = "text", lang_col: str = "lang",
                 bits: int = 26, words: int = 1_500_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    of 2 to ``longest`` words.

    Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at
    spaces and tabs; A-Z are lowered. a is a phrase's count, l and r those of
    its two parts at the cut with the lowest score floor(1000 * a * n / (l * r)),
    the first of equal ones, n the language's words. Only phrases with a of
    ``least`` or more take part, without those that a longer one with the same
    count holds. Ranks go by score, then a, both from the highest, then phrase
    in byte order. A null or blank text has no words, a null language is
    ``und``. Repeated rows count each. Other columns are not read, and an empty
    table gives an empty table. Products are exact below 10**17 words.
    """
    return ranked(phrase_counts(docs, least, longest, text_col, lang_col, bits, words), least, top)


def ranked(levels: list[DataFrame], least: int, top: int) -> DataFrame:
    """The ranks of ``collocations`` from the tables of ``phrase_counts``."""
    n = levels[0].groupBy("lang").agg(F.sum("f").alias("n"))
    often = [x.where(F.col("f") >= least).withColumn("k", F.lit(k)) for k, x in enumerate(levels, 1)]
    known = often[0]
    for x in often[1:]:
        known = known.unionByName(x)
    known = materialize(known, "collocation-known")
    cands = known.where("k > 1").withColumnRenamed("f", "a")
    # what a phrase one word longer with the same count holds
    ends = F.array(_words_of(F.col("k") - 1), _words_of(1 - F.col("k")))
    held = cands.where("k > 2").select("lang", F.explode(ends).alias("phrase"), "a").distinct()
    cands = cands.join(held, ["lang", "phrase", "a"], "left_anti")
    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _words_of(F.col("cut")).alias("left"), _words_of(F.col("cut") - F.col("k")).alias("right"))
    part = lambda phrase, f: known.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(n, "lang")
    cuts = cuts.withColumn("up", (whole("a") * whole("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")).withColumn("down", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("up div down"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("m")).select("lang", "phrase", "m.*")
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return best.withColumn("rank", order.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The query in SQL. A phrase longer than a candidate with its count is found by the phrases one word longer:
#: those between have the same count.
ORACLE = r"""
WITH p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM w, range(1, 6) AS t(k) WHERE len(ws) >= k) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 100),
held AS (SELECT DISTINCT lang, unnest([array_to_string(ws[1:k - 1], ' '), array_to_string(ws[2:k], ' ')]) AS phrase, f FROM c),
cuts AS (SELECT lang, phrase, f AS a, cut, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:k], ' ') AS rp
         FROM c ANTI JOIN held USING (lang, phrase, f), range(1, 5) AS t(cut) WHERE cut < k),
s AS (SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, n,
             (1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
      FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = lp JOIN g y ON y.lang = cuts.lang AND y.phrase = rp JOIN n ON n.lang = cuts.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b QUALIFY rank <= 2000"""
