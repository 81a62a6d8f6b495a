"""Format-preserving pseudonyms by a keyed Feistel network.

Validated numbers and dates, and the local part of addresses, are ranked
inside the set of all values of their format, the rank is permuted by a keyed
Feistel network over exactly that set (walking the cycle where the network is
larger), and the value of the new rank takes its place. Equal values get equal
pseudonyms in every document, different ones different pseudonyms, and the
result is valid in the same format. One pass over the rows, no shuffle.
"""

from __future__ import annotations

import bisect
import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.llm.text import free_name


def permute(rank: int, size: int, key: bytes, tweak: str, rounds: int = 10) -> int:
    """A keyed permutation of 0 ... size - 1."""
    if size < 2:
        return rank
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def f(i: int, half: int, m: int) -> int:
        h = blake2b(f"{tweak}:{size}:{i}:{half}".encode(), key=key, digest_size=32 if m < 1 << 128 else 64)
        return int.from_bytes(h.digest(), "big") % m

    while True:
        left, right = divmod(rank, b)
        for i in range(0, rounds, 2):
            left = (left + f(i, right, a)) % a
            right = (right + f(i + 1, left, b)) % b
        rank = left * b + right
        if rank < size:
            return rank


def mixed(value: list[int], radix: list[int], key: bytes, tweak: str) -> list[int]:
    """Permutes the tuples with the given radixes."""
    rank = 0
    for v, r in zip(value, radix, strict=True):
        rank = rank * r + v
    size = 1
    for r in radix:
        size *= r
    rank, out = permute(rank, size, key, tweak), []
    for r in reversed(radix):
        rank, v = divmod(rank, r)
        out.append(v)
    return out[::-1]


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def luhn(digits: str) -> int:
    """The check digit of ``digits``."""
    odd = sum(sum(divmod(2 * int(c), 10)) for c in digits[::-2])
    return -(odd + sum(map(int, digits[-2::-2]))) % 10


def card(text: str, key: bytes) -> str | None:
    """13 to 19 digits with a right check digit; the first digit stays."""
    d = re.sub(r"\D", "", text)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != int(d[-1]):
        return None
    body = d[0] + "".join(map(str, mixed([int(c) for c in d[1:-1]], [10] * (len(d) - 2), key, f"card{d[0]}")))
    return _refill(text, body + str(luhn(body)))


def ssn(text: str, key: bytes) -> str | None:
    """Area 1 to 899 but 666, group 1 to 99, serial 1 to 9999."""
    a, g, s = map(int, text.split("-"))
    if a in (0, 666) or a >= 900 or not g or not s:
        return None
    a, g, s = mixed([a - 1 - (a > 666), g - 1, s - 1], [898, 99, 9999], key, "ssn")
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


def phone(text: str, key: bytes) -> str | None:
    """+1: area and exchange start with 2 to 9. Others: the digits after the
    country code, 6 to 12 of them."""
    code, rest = re.match(r"(\+\d{1,3})(.*)", text, re.S).groups() if re.match(r"\+\d{1,3}\D", text) else (text[:2], text[2:])
    d = [int(c) for c in rest if c.isdigit()]
    if code == "+1":
        if len(d) != 10 or d[0] < 2 or d[3] < 2:
            return None
        radix = [8, 10, 10, 8] + [10] * 6
        low = [2, 0, 0, 2] + [0] * 6
    else:
        if not 6 <= len(d) <= 12:
            return None
        radix, low = [10] * len(d), [0] * len(d)
    new = mixed([x - y for x, y in zip(d, low, strict=True)], radix, key, f"phone{code}:{len(d)}")
    return code + _refill(rest, "".join(str(x + y) for x, y in zip(new, low, strict=True)))


def other_phone(text: str, key: bytes) -> str | None:
    """Ten digits after +1 that ``phone`` rejects: an area or exchange that
    starts with 0 or 1. They are permuted among themselves."""
    code, rest = text[:2], text[2:]
    d = [int(c) for c in rest if c.isdigit()]
    if code != "+1" or len(d) != 10 or d[0] >= 2 and d[3] >= 2:
        return None
    number = lambda of: int("".join(map(str, of)))
    area, size = 2 * 10**9, 2 * 10**9 + 8 * 100 * 2 * 10**6  # areas under 200, then exchanges under 200 in other areas
    rank = number(d) if d[0] < 2 else area + (number(d[:3]) - 200) * 2 * 10**6 + number(d[3:])
    rank = permute(rank, size, key, "other phone+1")
    if rank < area:
        return code + _refill(rest, f"{rank:010d}")
    a, low = divmod(rank - area, 2 * 10**6)
    return code + _refill(rest, f"{a + 200}{low:07d}")


def any_phone(text: str, key: bytes) -> str | None:
    """With + and the country's code, or ten digits that are read as +1."""
    if text[0] == "+":
        return phone(text, key) or other_phone(text, key)
    lead = re.match(r"(?:1[ .-])?", text).group()
    new = any_phone("+1" + text[len(lead):], key)
    return new and lead + new[2:]


def ipv4(text: str, key: bytes) -> str | None:
    """Four numbers up to 255, without leading zeros."""
    n = text.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in n):
        return None
    return ".".join(map(str, mixed([int(x) for x in n], [256] * 4, key, "ipv4")))


def _classes(text: str) -> tuple[list[int], list[int], list[str]]:
    """Digits and letters as numbers, their radixes, and where each belongs."""
    value, radix, first = [], [], []
    for c in text:
        start = "0" if "0" <= c <= "9" else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else None
        if start:
            value.append(ord(c) - ord(start))
            radix.append(10 if start == "0" else 26)
            first.append(start)
    return value, radix, first


def _same_classes(text: str, key: bytes, tweak: str) -> str:
    value, radix, first = _classes(text)
    if not value:
        return text
    new = iter(chr(ord(s) + v) for s, v in zip(first, mixed(value, radix, key, tweak + "".join(first)), strict=True))
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in text)


def email(text: str, key: bytes) -> str | None:
    """Letters and digits of the local part; the domain stays."""
    local, at, domain = text.rpartition("@")
    return _same_classes(local, key, "email") + at + domain


def iban(text: str, key: bytes) -> str | None:
    """Right by modulo 97; the country stays, the check digits follow."""
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(text) <= 34 or number(text[4:] + text[:4]) % 97 != 1:
        return None
    body = _same_classes(text[4:], key, "iban" + text[:2])
    return f"{text[:2]}{98 - number(body + text[:2] + '00') % 97:02d}{body}"


def any_iban(text: str, key: bytes) -> str | None:
    """In one piece or in groups of four."""
    new = iban(text.replace(" ", ""), key)
    if new is None:
        return None
    it = iter(new)
    return "".join(c if c == " " else next(it) for c in text)


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _date(year: int, month: int, day: int, key: bytes, late: bool = False) -> datetime.date | None:
    """A day of 1900 to 2099; ``late``: only days after the 12th, and the same."""
    try:
        at = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not _FIRST <= at <= _LAST:
        return None
    while True:
        at = _FIRST + permute(at - _FIRST, _LAST - _FIRST + 1, key, "late date" if late else "date")
        if not late or datetime.date.fromordinal(at).day > 12:
            return datetime.date.fromordinal(at)


def date(text: str, key: bytes) -> str | None:
    """yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy, and dd/mm/yyyy where no other
    reading is possible. One date has one pseudonym, except in the last form,
    which keeps to days that cannot be months."""
    x, y, z = (int(v) for v in re.split(r"[-./]", text))
    if "-" in text:
        d = _date(x, y, z, key)
        return d and d.isoformat()
    if "." in text:
        d = _date(z, y, x, key)
        return d and f"{d.day:02d}.{d.month:02d}.{d.year}"
    if x > 12:
        d = _date(z, y, x, key, late=True)
        return d and f"{d.day:02d}/{d.month:02d}/{d.year}"
    d = _date(z, x, y, key)
    return d and f"{d.month:02d}/{d.day:02d}/{d.year}"


#: kind, its form, and its validating permutation; earlier kinds win. Where a
#: form takes groups, a match that is rejected is tried again with fewer.
KINDS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), email),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), any_iban),
    ("card", re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])"), card),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), ssn),
    ("phone", re.compile(r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,5}\)?){2,5}(?![0-9])"
                         r"|(?<![0-9A-Za-z+.-])(?:1[ .-])?(?:\([0-9]{3}\) ?[0-9]{3}[.-]|[0-9]{3}([.-])[0-9]{3}\1)[0-9]{4}(?![0-9]|[.-][0-9])"), any_phone),
    ("date", re.compile(r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])"), date),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"), ipv4),
)
GROUPED = ("phone", "iban")
_GROUP = re.compile(r"[A-Za-z0-9]+\)?")
_ANY = re.compile(r"[0-9@]")
FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("pseudonym", T.StringType())]))


def _ends(kind: str, m: re.Match) -> list[int]:
    """Where a match may end: as it is, or after one of its groups. A phone
    rather ends before a date or an address that starts inside the match."""
    s, e = m.span()
    if kind not in GROUPED:
        return [e]
    ends = sorted({e, *(g.end() for g in _GROUP.finditer(m.string, s, e))}, reverse=True)
    if kind == "phone" and m.group()[0] == "+":
        later = [x.start() for _, form, _ in KINDS[-2:] for x in form.finditer(m.string, s + 1, min(len(m.string), e + 20)) if x.start() < e]
        ends.sort(key=lambda x: x > min(later, default=e))
    return ends


def pseudonymize_text(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The new text, and (kind, start, end, pseudonym) in the old one."""
    if not _ANY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    for kind, form, change in KINDS:
        taken = sorted(x[:2] for x in found)  # apart from each other, so the last that starts before an end decides
        starts = [a for a, _ in taken]
        free = lambda s, e: (i := bisect.bisect_left(starts, e)) == 0 or taken[i - 1][1] <= s  # noqa: E731, B023
        at = 0
        while m := form.search(text, at):
            s = m.start()
            at = s + 1 if kind in GROUPED else m.end()
            for e in _ends(kind, m):
                if free(s, e) and (new := change(text[s:e], key)) is not None:
                    found.append((s, e, kind, new))
                    at = e
                    break
    found.sort()
    out, last = [], 0
    for s, e, _, new in found:
        out += [text[last:s], new]
        last = e
    return "".join([*out, text[last:]]), [(k, s, e, new) for s, e, k, new in found]


def pseudonymize(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the new text, and ``pseudonyms`` (kind,
    start, end in code points of the old text, pseudonym), by start.

    A null text stays null with an empty list; other nulls pass through;
    repeated rows are treated alike; the new column gets underscores if its
    name is taken; an empty table gives an empty table. ``key`` must be the
    same for all documents that should stay linked, 1 to 64 bytes.
    """
    out = free_name(docs, "pseudonyms")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            text, found = [], []
            for t in b.column(text_col).to_pylist():
                new, spans = (None, []) if t is None else pseudonymize_text(t, key)
                text.append(new)
                found.append([{"kind": k, "start": s, "end": e, "pseudonym": p} for k, s, e, p in spans])
            cols = [pa.array(text, b.schema.field(c).type) if c == text_col else b.column(c) for c in b.schema.names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found, kind)], [*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, FOUND)]))


def private_digests(docs: DataFrame, key: bytes = b"an example key; use one of your own") -> DataFrame:
    """The thin query: the new texts, and what was replaced."""
    found = pseudonymize(docs.select("doc_id", "text"), key)
    return found.select("doc_id", "text", F.size("pseudonyms").cast("long").alias("n_replaced"), F.array_join(F.transform(
        "pseudonyms", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",").alias("spans"))
