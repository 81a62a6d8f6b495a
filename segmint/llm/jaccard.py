"""N-gram Jaccard join by PartEnum signatures.

Sets of similar size share a band. Two sets of a band (or of neighbouring
bands) that are similar enough differ in at most k elements, so when the
feature domain is split into n1 parts of n2 smaller ones, one part differs in
at most k2 of them: one of the enumerated subsets of n2 - k2 smaller parts is
equal on both sides, and its content is a signature that both sets have.

Equal sets are one node. A set is signed only if few enough of its elements are
its own alone, which keeps texts with a common passage apart. Elements and
signatures travel as sorted blocks, once for each block of documents; what
shares a signature is tied to the first that has it, and ties give candidate
clusters. Sets of a large cluster are looked at again, bucket by bucket: those
that share a signature are linked only if their parity sketches allow it, whose
distance is never more than that of the sets; so clusters that only chance ties
hold together fall apart. Then every cluster is verified exactly. Both are done
in blocks, so that no group is held whole by a task, and tasks give back
spanning forests, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.text import by_part, forest, free_name, grouped, mix, pack_ints, pack_keys, shingle_sets, slices, unpack_ints, unpack_keys, utf8
from segmint.operators.components import connected_components
from segmint.session import materialize

_LOW = np.uint64(0xFFFFFFFF)


class Join(NamedTuple):
    """Shingles of ``words`` words; linked at 100 * intersection >=
    ``percent`` * union; parts of ``n2`` smaller ones, ``k2`` of which may differ."""
    words: int = 5
    percent: int = 80
    n2: int = 4
    k2: int = 1


def bands(j: Join, largest: int) -> np.ndarray:
    """Largest size of each band; similar sets are in one band or neighbours."""
    ends = [100 // j.percent]
    while ends[-1] < largest:
        ends.append((ends[-1] + 1) * 100 // j.percent)
    return np.array([*ends, (ends[-1] + 1) * 100 // j.percent], np.int64)


def set_hash(s: np.ndarray) -> np.ndarray:
    """One number for a set, whatever the order."""
    return mix(np.array([mix(s, 3).sum(dtype=np.uint64)]), 4)


def signatures(sets: list[np.ndarray], j: Join) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) for sets that are not empty."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = bands(j, int(sizes.max()))
    own = np.searchsorted(ends, sizes)
    elements, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    value, place = mix(elements, 5), mix(elements, 6)
    subsets = list(combinations(range(j.n2), j.n2 - j.k2))
    out, who = [], []
    for instance in (own, own + 1):
        k = 2 * ends[instance] * (100 - j.percent) // (100 + j.percent)
        n1 = k // (j.k2 + 1) + 1
        cells = n1 * j.n2
        first = np.concatenate([[0], np.cumsum(cells)])
        cell = first[doc] + (place % cells[doc].astype(np.uint64)).astype(np.int64)
        # exact 64-bit sums: each half stays far below 2**53
        total = np.bincount(cell, value & _LOW, first[-1]).astype(np.uint64) + (
            np.bincount(cell, value >> np.uint64(32), first[-1]).astype(np.uint64) << np.uint64(32))
        total = total.reshape(-1, j.n2)
        part = np.arange(len(total)) - np.repeat(first[:-1] // j.n2, n1)
        name = mix((np.repeat(instance, n1).astype(np.uint64) << np.uint64(40)) ^ part.astype(np.uint64), 7)
        owner = np.repeat(np.arange(len(sets)), n1)
        for number, subset in enumerate(subsets):
            content = np.zeros(len(total), np.uint64)
            for x in subset:
                content += mix(total[:, x], 10 + x)
            out.append(mix(content ^ name, 100 + number))
            who.append(owner)
    return np.concatenate(out), np.concatenate(who)


def _least_of(sig: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each signature once, ascending, with its smallest owner; and the
    (owner, smallest) ties of the others, once each."""
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    least = who[new][np.cumsum(new) - 1]
    tie = who != least
    ties = np.unique(np.stack([who[tie], least[tie]], axis=1), axis=0) if tie.any() else np.zeros((0, 2), np.int64)
    return sig[new], who[new], ties


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _documents(src: DataFrame, j: Join) -> DataFrame:
    """(doc_id, key, n_shingles, node) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n, node = b.column("t").to_pylist(), [], []
            for at in slices([len(t) for t in texts], 1 << 20):
                sets = shingle_sets(texts[at], j.words)
                n += [len(s) for s in sets]
                node += [int(_signed(set_hash(s))[0]) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array(node, pa.int64())],
                                             ["doc_id", "key", "n_shingles", "node"])
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, key long, n_shingles long, node long")


def _probed(s: np.ndarray, percent: int) -> np.ndarray:
    """The part of the domain that is counted: 2.5 times the share of a set
    that may be missing from a similar one."""
    return s[(mix(s, 9) >> np.uint64(32)) % np.uint64(1000) < np.uint64(min(1000, 25 * (100 - percent)))]


def _with_company(src: DataFrame, j: Join, parts: int, hold: int = 1_500_000) -> DataFrame:
    """(node) of the sets that can be similar to another one.

    Of a set of n, at most n * (100 - percent) / 100 elements are missing from
    a similar set. So a set with more elements that no other has, in whatever
    part of the domain they are counted, is similar to none. Blocks of
    documents send the elements of that part, cut to 48 bits (elements taken
    as equal by chance only keep a set), to the task that counts them, and get
    back how many of each set are its own alone."""
    def ask(batches):
        block, sets, nodes, size = TaskContext.get().partitionId() << 32, [], {}, 0

        def rows():
            keys = np.concatenate(sets) >> np.uint64(16)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            up = np.argsort(keys, kind="stable")
            keys, owner = keys[up], owner[up]
            order, which, first = by_part(keys, parts)
            some = np.split(order, first[1:]) if len(which) else [order]
            which = which if len(which) else np.zeros(1, np.int64)
            about = [np.array(list(nodes), np.int64).tobytes(), np.array(list(nodes.values()), np.int64).tobytes()]
            once = lambda x: pa.array([x] + [None] * (len(which) - 1), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(np.full(len(which), block)), pa.array([pack_keys(keys[o]) for o in some], pa.binary()),
                 pa.array([pack_ints(owner[o].astype("<u4")) for o in some], pa.binary()), once(about[0]), once(about[1])],
                ["part", "block", "keys", "owners", "nodes", "sizes"])

        for b in batches:
            texts = b.column("t").to_pylist()
            for at in slices([len(t) for t in texts], 1 << 20):
                for s in shingle_sets(texts[at], j.words):
                    if len(s) and (node := int(_signed(set_hash(s))[0])) not in nodes:
                        nodes[node] = len(s)
                        sets.append(_probed(s, j.percent))
                        size += len(sets[-1]) + 1
                if size >= hold:
                    yield rows()
                    block, sets, nodes, size = block + 1, [], {}, 0
        if sets:
            yield rows()

    def answer(batches):
        for group in grouped(batches, ("part",)):
            keys = [unpack_keys(r["keys"]) for r in group]
            _, where, often = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            alone = np.split(often[where] == 1, np.cumsum([len(k) for k in keys])[:-1])
            lonely = [pack_ints(np.bincount(unpack_ints(r["owners"], "<u4")[x]).astype("<u4")) for r, x in zip(group, alone, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["block"] for r in group], pa.int64()), pa.array(lonely, pa.binary()),
                 *(pa.array([r[c] for r in group], pa.binary()) for c in ("nodes", "sizes"))], ["block", "lonely", "nodes", "sizes"])

    def decide(batches):
        for group in grouped(batches, ("block",)):
            r = next(r for r in group if r["nodes"] is not None)
            nodes, sizes = np.frombuffer(r["nodes"], np.int64), np.frombuffer(r["sizes"], np.int64)
            lonely = np.zeros(len(nodes), np.int64)
            for r in group:
                x = unpack_ints(r["lonely"], "<u4")
                lonely[:len(x)] += x
            yield pa.RecordBatch.from_arrays([pa.array(nodes[lonely <= sizes * (100 - j.percent) // 100])], ["node"])

    asked = src.select("t").mapInArrow(ask, "part long, block long, keys binary, owners binary, nodes binary, sizes binary")
    answers = asked.repartition("part").sortWithinPartitions("part").mapInArrow(answer, "block long, lonely binary, nodes binary, sizes binary")
    return answers.repartition("block").sortWithinPartitions("block").mapInArrow(decide, "node long").distinct()


def _signed_sets(texts: DataFrame, j: Join, parts: int, hold: int = 1_500_000) -> DataFrame:
    """kind 1: a tie inside a block of documents; 2: signatures of a block,
    ascending, and their owners' places in it; 3: a set, its node and its
    place. Signatures are cut to 48 bits besides their part: chance ties cost
    a comparison, no more."""
    names = ["kind", "node", "least", "block", "at", "n", "s", "part", "sigs", "owners"]
    types = dict.fromkeys(names, pa.int64()) | {"s": pa.binary(), "part": pa.int32(), "sigs": pa.binary(), "owners": pa.binary()}

    def table_of(kind, size, **cols):
        return pa.RecordBatch.from_arrays([pa.array([kind] * size, pa.int32()) if c == "kind" else cols[c] if c in cols
                                           else pa.nulls(size, types[c]) for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, {}, 0

        def rows():
            node, some = np.array(list(held), np.int64), list(held.values())
            yield table_of(3, len(some), node=pa.array(node), block=pa.array(np.full(len(some), block)), at=pa.array(np.arange(len(some))),
                           n=pa.array([len(s) for s in some], pa.int64()), s=pa.array([s.tobytes() for s in some], pa.binary()))
            s, who, ties = _least_of(*signatures(some, j))
            if len(ties):
                yield table_of(1, len(ties), node=pa.array(node[ties[:, 0]]), least=pa.array(node[ties[:, 1]]))
            part = (s % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            which, first = np.unique(part[order], return_index=True)
            own = np.split(order, first[1:])
            yield table_of(2, len(which), part=pa.array(which.astype(np.int32)), block=pa.array(np.full(len(which), block)),
                           sigs=pa.array([pack_keys(s[o] >> np.uint64(16)) for o in own], pa.binary()),
                           owners=pa.array([pack_ints(who[o].astype("<u4")) for o in own], pa.binary()))

        for b in batches:
            texts = b.column("t").to_pylist()
            for at in slices([len(t) for t in texts], 1 << 20):
                for s in shingle_sets(texts[at], j.words):
                    if len(s) and (node := int(_signed(set_hash(s))[0])) not in held:
                        held[node] = s
                        size += len(s)
                if size >= hold:
                    yield from rows()
                    block, held, size = block + 1, {}, 0
        if held:
            yield from rows()

    return texts.mapInArrow(run, "kind int, node long, least long, block long, at long, n long, s binary, part int, sigs binary, owners binary")


def _ties(blocks: DataFrame) -> DataFrame:
    """The signatures of one part at a time: (block, at) and the first (block,
    at) where they meet."""
    names = ["block", "at", "block0", "at0"]

    def run(batches):
        for rows in grouped(batches, ("part",)):
            sig = np.concatenate([unpack_keys(r["sigs"]) for r in rows])
            at = [unpack_ints(r["owners"], "<u4") for r in rows]
            # blocks by their number among the part's, owners below it
            who = np.concatenate([(np.int64(i) << 32) | a.astype(np.int64) for i, a in enumerate(at)])
            _, _, ties = _least_of(sig, who)
            number = np.array([r["block"] for r in rows], np.int64)
            cols = [number[ties[:, 0] >> 32], ties[:, 0] & 0xFFFFFFFF, number[ties[:, 1] >> 32], ties[:, 1] & 0xFFFFFFFF]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def linked_pairs(sets: list[np.ndarray], percent: int, group: list, columns: int = 8192) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that are similar enough, by exact counts
    of common elements; pairs of one ``group`` (not None) are not compared."""
    n = np.array([len(s) for s in sets], np.int64)
    elements, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(elements, kind="stable")
    elements, doc = elements[order], doc[order]
    new = np.ones(len(elements), bool)
    new[1:] = elements[1:] != elements[:-1]
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    doc, number = doc[shared], np.unique(number[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)))
    for first in range(0, int(number.max()) + 1 if len(number) else 0, columns):
        a, b = np.searchsorted(number, (first, first + columns))
        m = np.zeros((len(sets), columns), np.float32)
        m[doc[a:b], number[a:b] - first] = 1
        common += m @ m.T  # counts below 2**24 are exact
    links = np.argwhere(np.triu(100 * common >= percent * (n[:, None] + n[None, :] - common), 1))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    out, known = [], {}
    for i, g in enumerate(group):
        if g is not None:
            root[i] = find(known.setdefault(g, i))
    for a, b in links.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[y] = x
            out.append((a, b))
    return out


def sketch(s: np.ndarray) -> bytes:
    """Parities of the numbers of elements in about as many cells."""
    cells = 1 << max(6, int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((mix(s, 8) & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8) & 1).tobytes()


def _fold(bits: np.ndarray, cells: int) -> np.ndarray:
    """The sketch that the sets would have with fewer cells."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, cells), axis=1)


def possible_pairs(n: np.ndarray, sketches: list[bytes], m: np.ndarray, others: list[bytes], percent: int) -> np.ndarray:
    """Which pairs can be similar enough by their sizes and sketches."""
    out = 100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :])
    most = (n[:, None] + m[None, :]) * (100 - percent) // (100 + percent)
    left, right = np.array([8 * len(x) for x in sketches]), np.array([8 * len(x) for x in others])
    bits = lambda xs, at: np.unpackbits(np.frombuffer(b"".join(xs[i] for i in at), np.uint8)).reshape(len(at), -1)
    for a in np.unique(left):
        for b in np.unique(right):
            i, j = np.flatnonzero(left == a), np.flatnonzero(right == b)
            block = np.ix_(i, j)
            if out[block].any():
                cells = int(min(a, b))
                u, v = _fold(bits(sketches, i), cells), _fold(bits(others, j), cells)
                same = np.zeros((len(i), len(j)))
                for k in range(0, cells, 8192):
                    same += (1 - 2 * u[:, k:k + 8192].astype(np.float32)) @ (1 - 2 * v[:, k:k + 8192].astype(np.float32)).T
                out[block] &= (cells - same) / 2 <= most[block]
    return out


def _shared_buckets(large: DataFrame, j: Join) -> DataFrame:
    """(sig, node, m): the signatures that several sets of a cluster share, and
    the sets that have them; of signatures with the same sets one is kept,
    since their pairs are the same."""
    def run(batches):
        for b in batches:
            nodes, cluster = b.column("node").to_numpy(), b.column("cluster").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in b.column("s").to_pylist()]
            for at in slices([len(x) for x in sets], 1 << 20):
                sig, who = signatures(sets[at], j)
                # the same content in another cluster is another bucket
                sig = mix(sig ^ mix(cluster[at].astype(np.int64).view(np.uint64)[who], 21), 22)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(sig)), pa.array(nodes[at][who])], ["sig", "node"])

    rows = materialize(large.select("cluster", "node", "s").mapInArrow(run, "sig long, node long"), "partenum-bucket-rows")
    member = lambda salt: F.bit_xor(F.xxhash64("node", F.lit(salt)))
    found = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), member(1).alias("h1"), member(2).alias("h2")).where("m > 1")
    one = found.groupBy("m", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig", "m")
    return materialize(rows.join(one, "sig"), "partenum-buckets")


def _possible(rows: DataFrame, keys: tuple[str, ...], j: Join, star: bool) -> DataFrame:
    """(u, v): a forest of the pairs of each group that can be similar by their
    sketches. Of a ``star`` group only the pairs with its first row are looked
    at, and a row that is not one of them comes back as (node, null). Else rows
    with ``side`` 0 meet those with ``side`` 1, or each other if there are none."""
    def run(batches):
        for group in grouped(batches, keys):
            get = lambda rows, c: [r[c] for r in rows]
            left = group[:1] if star else [r for r in group if r["side"] == 0]
            right = group[1:] if star else [r for r in group if r["side"] == 1] or left
            if not left or not right:
                continue
            may = possible_pairs(np.array(get(left, "n")), get(left, "sketch"), np.array(get(right, "n")), get(right, "sketch"), j.percent)
            if star:
                u = [left[0]["node"] if hit else r["node"] for r, hit in zip(right, may[0].tolist(), strict=True)]
                v = [r["node"] if hit else None for r, hit in zip(right, may[0].tolist(), strict=True)]
            else:
                may &= np.array(get(left, "node"))[:, None] != np.array(get(right, "node"))
                found = forest(may)
                u, v = [left[a]["node"] for a, _ in found], [right[b]["node"] for _, b in found]
            sig = [group[0]["sig"]] * len(u)
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["sig", "u", "v"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, "sig long, u long, v long")


def _parted(large: DataFrame, j: Join, block: int = 1024) -> DataFrame:
    """(u, v): a forest of the pairs that share a signature and can be similar.

    A bucket of up to ``block`` sets is one group. Of a larger one all sets
    first meet its smallest in blocks; only those that cannot be similar to it
    then meet the whole bucket, so a group of near copies of any size costs one
    look at each."""
    def drawn(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), pa.array(
                [sketch(np.frombuffer(x, np.uint64)) for x in b.column("s").to_pylist()], pa.binary())], ["node", "n", "sketch"])

    sketches = materialize(large.select("node", "n", "s").mapInArrow(drawn, "node long, n long, sketch binary"), "partenum-sketches")
    buckets = _shared_buckets(large, j)
    rows = buckets.where(F.col("m") <= block).join(sketches, "node").withColumn("side", F.lit(0))
    links = materialize(_possible(rows, ("sig",), j, star=False).select("u", "v"), "partenum-possible")
    wide = buckets.where(F.col("m") > block).withColumn("parts", F.ceil(F.col("m") / block).cast("int"))
    if wide.isEmpty():
        return links
    wide = materialize(wide.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), "partenum-wide")
    first = wide.groupBy("sig", "parts").agg(F.min("node").alias("node"))
    spread = first.select("sig", "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own"), F.lit(0).alias("side"))
    others = wide.join(first.select("sig", "node"), ["sig", "node"], "left_anti").select("sig", "node", "own", F.lit(1).alias("side"))
    met = materialize(_possible(spread.unionByName(others).join(sketches, "node"), ("sig", "own"), j, star=True), "partenum-star")
    links = links.unionByName(met.where("v is not null").select("u", "v"))
    rest = met.where("v is null").select("sig", F.col("u").alias("node"))
    if rest.isEmpty():
        return links
    count = materialize(rest.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rests")), "partenum-rests")
    rest = rest.join(count, "sig").join(wide.select("sig", "parts").distinct(), "sig")
    left = rest.select("sig", "node", F.pmod(F.xxhash64("node", F.lit(1)), F.col("rests")).cast("int").alias("of"),
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own"), F.lit(0).alias("side"))
    right = wide.join(count, "sig").select("sig", "node", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("of"), "own", F.lit(1).alias("side"))
    again = _possible(left.unionByName(right).join(sketches, "node"), ("sig", "of", "own"), j, star=False)
    return links.unionByName(materialize(again.select("u", "v"), "partenum-rest"))


def _verified(rows: DataFrame, j: Join) -> DataFrame:
    """(u, v) links inside each (cluster, block, other)."""
    keys = ("cluster", "block", "other")

    def run(batches):
        for group in grouped(batches, keys):
            if len(group) < 2:
                continue
            sets = [np.frombuffer(r["s"], np.uint64) for r in group]
            found = linked_pairs(sets, j.percent, [r["known"] for r in group])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([group[a]["node"] for a, _ in found], pa.int64()),
                                                  pa.array([group[b]["node"] for _, b in found], pa.int64())], ["u", "v"])
    return rows.select(*keys, "node", "s", "known").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long")


def row_key(id_col: str, text_col: str):
    """A hash of id and text; only rows that are equal in both share it."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def _components(docs: DataFrame, join: Join, id_col: str, text_col: str, block: int, block_elements: int) -> DataFrame:
    """(doc_id, key, n_shingles, node, component_id, first_key) for every row."""
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), row_key(id_col, text_col).alias("key"), utf8(text_col).alias("t"))
    rows = materialize(_documents(src, join), "partenum-documents")
    company = materialize(_with_company(src, join, parts), "partenum-company")
    chosen = rows.groupBy("node").agg(F.min("key").alias("key")).join(company, "node").select("key")  # one row of equal sets
    # fewer parts here: sets that meet in several signatures of a part are tied once
    second = materialize(_signed_sets(src.join(chosen, "key", "left_semi").select("t"), join, parts // 2), "partenum-signatures")
    places = second.where("kind = 3").select("block", "at", "node")
    found = _ties(second.where("kind = 2").select("part", "block", "sigs", "owners")).distinct()
    found = found.join(places, ["block", "at"]).join(
        places.select(F.col("block").alias("block0"), F.col("at").alias("at0"), F.col("node").alias("least")), ["block0", "at0"])
    ties = second.where("kind = 1").select("node", "least").unionByName(found.select("node", "least")).distinct()
    clusters = connected_components(ties, "node", "least").withColumnRenamed("component", "cluster")
    sets = second.where("kind = 3").select("node", "n", "s").join(clusters, "node")
    sets = materialize(sets.groupBy("node", "cluster").agg(F.first("n").alias("n"), F.first("s").alias("s")), "partenum-sets")
    size = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    several = materialize(size.where(F.col("m") > block), "partenum-several").select("cluster")
    if not several.isEmpty():
        large = materialize(sets.join(several, "cluster", "left_semi"), "partenum-several-sets")
        parted = connected_components(_parted(large, join, 4 * block)).withColumnRenamed("component", "cluster")
        sets = materialize(sets.join(several, "cluster", "left_anti").unionByName(
            large.drop("cluster").join(parted, "node").select("node", "cluster", "n", "s")), "partenum-parted")
    blocks = materialize(sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
                         .select("cluster", F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("total") / block_elements)).cast("int").alias("blocks")),
                         "partenum-blocks")
    sets = sets.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # inside each block, and with the cluster's smallest node in every block
    everywhere = sets.where("node = cluster and blocks > 1").select(
        "node", "cluster", "s", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to")).where("to <> block")
    inside = sets.select("node", "cluster", "s", "block").unionByName(everywhere.select("node", "cluster", "s", F.col("to").alias("block")))
    links = materialize(_verified(inside.withColumns({"other": F.lit(-1), "known": F.lit(None).cast("long")}), join), "partenum-links")

    large = sets.where("blocks > 1")
    if not large.isEmpty():
        # across blocks: what is not in a cluster's largest component meets all blocks
        found = connected_components(links)
        large = large.join(found, "node", "left").withColumn("known", F.coalesce("component", "node")).drop("component")
        top = (large.groupBy("cluster", "known").count().groupBy("cluster")
               .agg(F.max_by("known", F.struct("count", "known")).alias("top")))
        large = materialize(large.join(materialize(top, "partenum-top"), "cluster"), "partenum-large")
        few = large.where("known <> top")
        if not few.isEmpty():
            pairs = few.select("cluster", "block").distinct().join(blocks, "cluster").select(
                "cluster", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            left = few.select("cluster", "block", "node", "s", "known").join(pairs, ["cluster", "block"])
            right = large.select("cluster", F.col("block").alias("other"), "node", "s", "known").join(pairs, ["cluster", "other"])
            both = left.unionByName(right).dropDuplicates(["cluster", "block", "other", "node"])
            links = links.unionByName(_verified(both, join))

    found = connected_components(links)
    some = rows.where("node is not null").join(found, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component")
    least = materialize(some.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "key")).alias("f"))
                        .select("root", F.col("f.doc_id").alias("component_id"), F.col("f.key").alias("first_key")), "partenum-least")
    whole = some.join(least, "root").select(*rows.columns, "component_id", "first_key")
    alone = rows.where("node is null").select(*rows.columns, F.col("doc_id").alias("component_id"), F.col("key").alias("first_key"))
    return whole.unionByName(alone)


def jaccard_components(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text",
                       block: int = 256, block_elements: int = 1_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``n_shingles`` is the size of the set, ``component_id`` the smallest id
    that links reach, the row's own included. Sets with equal 64-bit hashes are
    taken as equal; all other links are verified exactly. A null, empty or
    blank text has no set and is its own component. Rows with a null id take
    part; a component without any other id has a null one. Repeated rows are
    equal sets. Other columns are not read. An empty table gives an empty
    table. A verifying task holds blocks of ``block`` sets and about
    ``block_elements`` elements.
    """
    return _components(docs, join, id_col, text_col, block, block_elements).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, then
    of the smallest row hash; a null id is last. Rows without a set all stay."""
    found = materialize(_components(docs, join, id_col, text_col, 256, 1_000_000), "partenum-kept")
    keep = (found.where("node is null or key = first_key").groupBy("key")
            .agg(F.count(F.lit(1)).alias("copies"), F.max(F.isnull("node")).alias("blank")))
    name = free_name(docs, "row_key")
    keyed = docs.withColumn(name, row_key(id_col, text_col))
    stay = lambda k: keyed.join(k.select(F.col("key").alias(name)), name, "left_semi")
    out = stay(keep.where("copies = 1 or blank"))
    many = keep.where("copies > 1 and not blank")
    if not many.isEmpty():  # rows repeated with their id: one stays
        out = out.unionByName(stay(many).dropDuplicates([name]))
    return out.drop(name)
