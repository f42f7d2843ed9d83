"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder reads the driver tables of one scale-factor folder (through the
star-schema adapters) and returns a lazy DataFrame. Measure columns are
rounded to a fixed scale and typed DOUBLE on both sides so the engines can be
compared value for value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from .oracle import star


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    measures: tuple[str, ...] = ()
    scale: int = 6
    ops: str = ""          # SURVEY ids covered
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def _rounded(col, scale: int):
    """DOUBLE rounded to ``scale`` decimals with IEEE operations only.

    ``rint(x * 10^s) / 10^s`` (nearest, ties to even on the binary value) is
    computed bit-for-bit the same by Spark and by DuckDB's
    ``round_even(x * 10^s, 0) / 10^s``; their own ``round`` functions break
    decimal ties differently (shortest-decimal HALF_UP vs binary).
    """
    k = float(10 ** scale)
    return F.rint(col.cast("double") * F.lit(k)) / F.lit(k)


def finish(df: DataFrame, measures, scale: int) -> DataFrame:
    if not measures:
        return df
    return df.withColumns({m: _rounded(F.col(m), scale) for m in measures})


def oracle_wrap(sql: str, measures, scale: int) -> str:
    if not measures:
        return sql
    k = repr(float(10 ** scale))
    repl = ", ".join(f"round_even(CAST({m} AS DOUBLE) * {k}, 0) / {k} AS {m}" for m in measures)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"


def register(name: str, sql: str | None, measures=(), scale: int = 6, ops: str = "",
             headline: bool = False, raw_sql: bool = False):
    def deco(fn):
        body = None if sql is None else (sql if raw_sql else star(sql))
        REGISTRY[name] = Query(name, fn, body, tuple(measures), scale, ops, headline)
        return fn
    return deco


def build(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query over tables opened for this call: files added since the last call count."""
    q = REGISTRY[name]
    return finish(q.build(Tables(spark, sf_dir)), q.measures, q.scale)


def oracle(name: str) -> str | None:
    q = REGISTRY[name]
    return None if q.sql is None else oracle_wrap(q.sql, q.measures, q.scale)


def load_all() -> dict[str, Query]:
    from . import queries  # noqa: F401  (registers on import)
    return REGISTRY
