"""Exact quantiles by bracket and select, and modes.

One pass of mergeable sketches gives each wanted rank a bracket of two values,
a second counts what lies below and inside. While a bracket holds many values
it is sketched again, inside only; then its values are counted and the ranks
are looked up among them. What is shuffled depends on the sketches and on a
bound, not on the rows; the result is exact, since the counts tell for certain
whether a bracket holds its ranks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Values that a bracket may hold when it is looked up.
INSIDE = 10_000


class _Bracket:
    """The two ranks around a quantile's place and values that enclose them."""

    def __init__(self, n: int, q: float):
        self.pos = (n - 1) * q
        self.ranks = (math.floor(self.pos), math.ceil(self.pos))
        self.lo = self.hi = None  # no bound
        self.below, self.inside = 0, n

    def holds(self, c: Column) -> Column:
        out = c.isNotNull()
        if self.lo is not None:
            out = out & (c >= F.lit(self.lo))
        return out if self.hi is None else out & (c <= F.lit(self.hi))

    def shares(self, slack: float) -> list[float]:
        """Where to look for the two values among those inside."""
        at = [(r - self.below) / max(1, self.inside - 1) for r in self.ranks]
        return [max(0.0, at[0] - slack), min(1.0, at[1] + slack)]

    def open(self, limit: int) -> bool:
        return self.inside > limit and not (self.lo is not None and self.lo == self.hi)


def quantile_values(df: DataFrame, columns: dict[str, Column], qs: list[float], also: list[Column] | None = None, limit: int = INSIDE,
                    accuracy: int = 10_000) -> tuple[dict[str, list[float | None]], Row]:
    """(name -> its quantiles, the row of the aggregates ``also``, which are
    computed in the first pass). Quantiles are interpolated linearly, nulls
    are skipped; a column without values has null ones."""
    cols = {name: c.cast("double") for name, c in columns.items()}
    slack = 3.0 / accuracy
    sketch = lambda c, shares: F.percentile_approx(c, F.array(*map(F.lit, shares)), F.lit(accuracy))
    first = [s for q in qs for s in (max(0.0, q - slack), min(1.0, q + slack))]
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols.values())],
                 *[sketch(c, first).alias(f"s{i}") for i, c in enumerate(cols.values())], *(also or [])).first()
    brackets = {}
    for i, name in enumerate(cols):
        for k, q in enumerate(qs):
            if row[f"n{i}"]:
                b = brackets[name, k] = _Bracket(row[f"n{i}"], q)
                if b.inside > limit:
                    b.lo, b.hi = row[f"s{i}"][2 * k:2 * k + 2]
    todo = [key for key, b in brackets.items() if b.lo is not None]
    while todo:
        count = lambda on: F.count(F.when(on, 1))
        got = df.agg(*[x for name, k in todo for b in (brackets[name, k],) for x in (
            count(cols[name] < F.lit(b.lo)) if b.lo is not None else F.lit(0), count(b.holds(cols[name])))]).first()
        for at, key in enumerate(todo):
            b = brackets[key]
            b.below, b.inside = got[2 * at], got[2 * at + 1]
            if b.ranks[0] < b.below:  # a sketch that is worse than promised: this side is open again
                b.lo = None
            if b.ranks[1] >= b.below + b.inside:
                b.hi = None
        again = [key for key in todo if not (brackets[key].ranks[0] >= brackets[key].below and
                                             brackets[key].ranks[1] < brackets[key].below + brackets[key].inside)]
        wide = [key for key in todo if key not in again and brackets[key].open(limit)]
        if wide:
            got = df.agg(*[sketch(F.when(brackets[key].holds(cols[key[0]]), cols[key[0]]), brackets[key].shares(slack)) for key in wide]).first()
            for at, key in enumerate(wide):
                old, (lo, hi) = (brackets[key].lo, brackets[key].hi), got[at]
                brackets[key].lo, brackets[key].hi = lo, hi
                if (lo, hi) == old:  # nothing between: both ends are values, looked up below
                    continue
                again.append(key)
        todo = again
    found = {key: [(b.lo, b.inside)] for key, b in brackets.items() if b.lo is not None and b.lo == b.hi}
    keys = [key for key in brackets if key not in found]
    if keys:
        each = F.array(*[F.when(brackets[key].holds(cols[key[0]]), F.struct(F.lit(i).alias("i"), cols[key[0]].alias("v"))) for i, key in enumerate(keys)])
        rows = df.select(F.explode(F.filter(each, lambda x: x.isNotNull())).alias("r")).groupBy("r.i", "r.v").count().collect()  # ``limit`` for each, or ties
        for i, key in enumerate(keys):
            found[key] = sorted((r["v"], r["count"]) for r in rows if r["i"] == i)
    out = {name: [_interpolated(brackets.get((name, k)), found.get((name, k))) for k in range(len(qs))] for name in cols}
    return out, row


def _interpolated(b: _Bracket | None, values: list[tuple[float, int]] | None) -> float | None:
    if b is None:
        return None
    at, picked = b.below, []
    for v, n in values:
        picked += [v for r in b.ranks[len(picked):] if at <= r < at + n]
        at += n
    lo, hi = b.ranks
    return picked[0] if lo == hi else (hi - b.pos) * picked[0] + (b.pos - lo) * picked[1]


def quantile_row(df: DataFrame, columns: dict[str, Column], qs: list[float], **options) -> DataFrame:
    """One row: for each name the array of its quantiles ``qs``."""
    values, _ = quantile_values(df, columns, qs, **options)
    return df.sparkSession.range(1).select(*[F.array(*[F.lit(v).cast("double") for v in vs]).alias(name) for name, vs in values.items()])


def modes(df: DataFrame, col: str, by: Column, out: str) -> DataFrame:
    """(_by, out): the most frequent value for each ``by``, ties to the lowest;
    nulls are skipped. Counts are made map-side, no state holds all values."""
    c = F.col("`" + col.replace("`", "``") + "`")
    counts = df.where(c.isNotNull()).groupBy(by.alias("_by"), c.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("_by").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("m")).select("_by", F.col("m.v").alias(out))
