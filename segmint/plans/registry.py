"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame``. Double columns are
rounded to 6 decimals on the Spark side, and the listed double columns are
rounded the same way in the oracle SQL, because sums arrive in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def round_half_away(x, digits: int = 6):
    """Round the binary value scaled by 10^digits half away from zero, then
    scale back: the same arithmetic as the oracle's ``round(double, n)``
    (Spark's ``round`` rounds the decimal expansion, which differs on exact
    halves such as 106.2815625)."""
    m = 10.0 ** digits
    z = F.abs(x) * F.lit(m) + F.lit(0.5)
    r = F.signum(x) * (z - z % F.lit(1.0)) / F.lit(m)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x).otherwise(r)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_half_away(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def wrap_sql(sql: str, doubles: tuple = (), digits: int = 6) -> str:
    if not doubles:
        return sql
    repl = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) oracle_q"


def register(name: str, sql: str | None = None, doubles: tuple = ()):
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return round_doubles(_fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = wrap_sql(sql, tuple(doubles))
        return fn
    return deco
