"""Secret scans by token efficiency.

Rules find assignments, access keys and long hex runs. Beside them, every run
of key characters is encoded with a byte-pair vocabulary: words and ordinary
identifiers are few tokens, random strings are many, so a low ratio of
characters to tokens exposes them. Where words of a path or a key's name hide
a random part from the ratio of the whole run, its pieces are tested one by
one. Known digests and identifiers are taken out of the runs before any test,
and base64 is judged by the text that it says. The work is one pass over the
rows, without a shuffle.
"""

from __future__ import annotations

import base64
import bisect
import functools
import itertools
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.llm.text import free_name, utf8

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # runs are maximal, so this equals dropping the short ones
RUN = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
#: What has a known form and is no secret: digests of the usual lengths, UUIDs, ULIDs, integrity digests and key
#: fingerprints (fixed forms).
DIGEST_LENGTHS = (128, 96, 64, 56, 40, 32)
KNOWN = re.compile(
    rb"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-7][0-9A-HJKMNP-TV-Z]{25}|"
    + b"|".join(b"[0-9a-f]{%d}|[0-9A-F]{%d}" % (n, n) for n in DIGEST_LENGTHS)
    + rb")(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?i:sha)(?:1[-:][A-Za-z0-9+/_-]{27}|256[-:][A-Za-z0-9+/_-]{43}|384[-:][A-Za-z0-9+/_-]{64}|512[-:][A-Za-z0-9+/_-]{86})"
    rb"={0,2}(?![A-Za-z0-9+/_-])")
PLAIN_TEXT = re.compile(rb"[\t\n\r\x20-\x7e]+\Z")
PIECE = re.compile(rb"[A-Za-z0-9+]+")
LEAST_PIECE = 12
CLASSES = (re.compile(rb"[a-z]"), re.compile(rb"[A-Z]"), re.compile(rb"[0-9]"))

# A cheap necessary condition for each pattern, so that most texts need no regex.
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MAP = bytes(48 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_URL64 = bytes.maketrans(b"-_", b"+/")
_RUN_MAP = bytes(48 if RUN.match(bytes([i]) * 20) else 32 for i in range(256))

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


@functools.lru_cache(4)
def _encoder(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_random(run: bytes, vocabulary: str, max_ratio: float) -> bool:
    """Whether a run of key characters is at most ``max_ratio`` characters a
    token, has two of lower case, upper case and digits, and is neither of a
    known form, nor a path or name that only joins short words, nor plain text
    in base64."""
    if sum(bool(c.search(run)) for c in CLASSES) < 2:
        return False
    if (m := KNOWN.match(run)) and m.end() == len(run):
        return False
    if max(map(len, re.split(rb"[/_=-]+", run))) < LEAST_PIECE:
        return False
    return _is_dense(run, vocabulary, max_ratio) and not _is_plain64(run, vocabulary, max_ratio)


def _is_dense(run: bytes, vocabulary: str, max_ratio: float) -> bool:
    return len(run) <= max_ratio * len(_encoder(vocabulary).encode_ordinary(run.decode("ascii")))


def _is_plain64(run: bytes, vocabulary: str, max_ratio: float) -> bool:
    """Whether a run is base64 of printable text without a dense part."""
    body = run.rstrip(b"=").translate(_URL64)
    if len(body) < 16 or len(body) % 4 == 1 or b"=" in body:
        return False
    said = base64.b64decode(body + b"=" * (-len(body) % 4))
    return bool(PLAIN_TEXT.match(said)) and not any(
        _is_dense(p, vocabulary, max_ratio) for p in PIECE.findall(said) if len(p) >= LEAST_PIECE)


def random_parts(run: bytes, vocabulary: str, max_ratio: float) -> list[tuple[int, int]]:
    """The whole run if it is random; otherwise its random pieces between
    ``/_=-``, each with the neighbours of few characters a token that one
    ``/``, ``_`` or ``-`` joins to it (base64 has these too) and its padding."""
    if is_random(run, vocabulary, max_ratio):
        return [(0, len(run))]
    if _is_plain64(run, vocabulary, max_ratio):
        return []
    pieces = [m.span() for m in PIECE.finditer(run)]

    def joined(i: int) -> bool:  # piece i to the one after it
        return pieces[i + 1][0] - pieces[i][1] == 1 and run[pieces[i][1]] != ord("=")

    out: list[tuple[int, int]] = []
    for i, (s, e) in enumerate(pieces):
        if e - s < LEAST_PIECE or out and s < out[-1][1] or not is_random(run[s:e], vocabulary, max_ratio):
            continue
        a = b = i
        while a and joined(a - 1) and (not out or pieces[a - 1][0] >= out[-1][1]) and _is_dense(run[slice(*pieces[a - 1])], vocabulary, max_ratio):
            a -= 1
        while b + 1 < len(pieces) and joined(b) and _is_dense(run[slice(*pieces[b + 1])], vocabulary, max_ratio):
            b += 1
        end = pieces[b][1]
        out.append((pieces[a][0], len(run) if run[end:] in (b"=", b"==") else end))
    return out


def spans_of(text: bytes, vocabulary: str, max_ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"0" * 24 in text.translate(_HEX_MAP):
        found += [(2, *m.span()) for m in HEX.finditer(text)]
    if b"0" * 20 in text.translate(_RUN_MAP):
        base = sorted((a, b) for _, a, b in found)
        starts, ends = [a for a, _ in base], list(itertools.accumulate((b for _, b in base), max))
        inside = lambda s, e: (i := bisect.bisect_right(starts, s)) > 0 and ends[i - 1] >= e
        # known forms leave their runs, so that what is around them is judged by itself
        for m in RUN.finditer(KNOWN.sub(lambda k: b" " * len(k.group()), text)):
            s, e = m.span()
            if not inside(s, e):
                parts = [(s + x, s + y) for x, y in random_parts(m.group(), vocabulary, max_ratio)]
                found += [(3, x, y) for x, y in parts if not inside(x, y)]
    if not found:
        return []
    if not text.isascii():
        at = sorted({x for _, s, e in found for x in (s, e)})
        points, n, last = {}, 0, 0
        for x in at:
            n += len(text[last:x].decode("utf-8", "replace"))
            points[x], last = n, x
        found = [(k, points[s], points[e]) for k, s, e in found]
    return [(KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in found)]


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return public_tokenizers.path(name)


def find_secrets(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, max_ratio: float = 1.9) -> DataFrame:
    """All columns of ``docs`` and ``secret_spans`` (kind, start, end in code
    points, end exclusive), ordered by start and then kind.

    A null or empty text has an empty list; other nulls pass through; repeated
    rows each get their row; the new column gets underscores if the name is
    taken; an empty table gives an empty table. ``vocabulary`` is a file of
    ranks on every executor, ``max_ratio`` the characters a token up to which
    a run, or a piece of 12 or more characters in it, counts as random.
    """
    vocabulary = vocabulary or vocabulary_path()
    out, raw = free_name(docs, "secret_spans"), free_name(docs, "utf8")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, vocabulary, max_ratio)]
                     for t in b.column(raw).to_pylist()]
            keep = [c for c in b.schema.names if c != raw]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(spans, kind)], [*keep, out])

    fields = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(SPAN))])
    return docs.withColumn(raw, utf8(text_col)).mapInArrow(scan, fields)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **scan) -> DataFrame:
    """``docs`` with every found span (overlapping ones joined) replaced by
    ``mark``; an ``n_chars`` column follows the new length. Texts without a
    find are returned as they are, null included; no row goes."""
    found = find_secrets(docs, text_col, **scan)
    spans = next(c for c in found.columns if c not in docs.columns)
    at, text = F.col(f"`{spans}`"), F.col(f"`{text_col}`")
    # joined spans: (start, end) folded from the ordered list
    joined = F.aggregate(
        at, F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"),
                                                        F.greatest(F.element_at(acc, -1)["e"], x["end"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("s"), x["end"].alias("e"))))))
    new = F.aggregate(
        joined, F.struct(F.lit("").alias("t"), F.lit(0).alias("p")),
        lambda acc, x: F.struct(F.concat(acc["t"], F.substring(text, acc["p"] + 1, x["s"] - acc["p"]), F.lit(mark)).alias("t"),
                                x["e"].alias("p")),
        lambda acc: F.concat(acc["t"], F.substring(text, acc["p"] + 1, F.length(text))))
    hit = F.size(at) > 0
    out = found.select(*(F.when(hit, new).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in found.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def secret_digests(docs: DataFrame, **scan) -> DataFrame:
    """The thin query: counts and digests of the spans of each document."""
    found = find_secrets(docs.select("doc_id", "text"), **scan)
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("secret_spans", lambda x: x["kind"] != "random")
    n = lambda k: F.size(F.filter("secret_spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("secret_spans", line), ",").alias("spans"), n("random"))
