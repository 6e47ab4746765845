"""Registry of queries and their SQL counterparts.

A query is a function of the given tables. Its counterpart is SQL for another
engine over the same tables, written independently of the Spark code; the two
must return the same rows. Queries without one are iterative (clustering,
regression) or depend on file names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfsight.session import tune
from shelfsight.sources import adapters
from shelfsight.sources.adapters import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}
# Named SELECTs for use in counterparts: name -> (what it reads, SQL).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return QUERIES[name](Tables(tune(spark), directory))

    run.__name__ = name
    return run


def rounded(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Round all doubles, for comparing results of two engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, by_column.get(f.name, digits)) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def _reads(name: str) -> tuple[tuple[str, ...], str]:
    if name in BLOCKS:
        return BLOCKS[name]
    return adapters.LOGICAL[name][0], adapters.logical_sql(name)


def _build_order(name: str) -> list[str]:
    order: list[str] = []
    for source in _reads(name)[0]:
        if source in BLOCKS or source in adapters.LOGICAL:
            order += [n for n in _build_order(source) if n not in order]
    return [*order, name]


def sql(final: str, *reads: str, doubles: str | list[str] = "", digits: int = 6) -> Callable[[], str]:
    """SQL text made on demand, when all blocks are known: see :func:`assemble`."""
    return lambda: assemble(final, *reads, doubles=doubles, digits=digits)


def assemble(final: str, *reads: str, doubles: str | list[str] = "", digits: int = 6) -> str:
    """``final`` with the logical tables and blocks it reads in front, and its doubles rounded.

    A double may carry its own number of digits: ``name:8``.
    """
    names: list[str] = []
    for name in reads:
        names += [n for n in _build_order(name) if n not in names]
    ctes = ",\n".join(f"{n} AS ({_reads(n)[1].strip()})" for n in names)
    columns = [d.partition(":") for d in (doubles.split() if isinstance(doubles, str) else doubles)]
    body = final.strip()
    if columns:
        rounds = ", ".join(f'round("{c}", {own or digits}) + 0.0 AS "{c}"' for c, _, own in columns)
        body = f"SELECT * REPLACE ({rounds}) FROM ({body}) AS result"
    return f"WITH {ctes}\n{body}" if ctes else body
