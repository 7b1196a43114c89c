"""Queries with their output columns and the equivalent SQL.

The output specification ``"day:s n:i"`` fixes names and types on both sides: text, 64-bit integers
and doubles, so that dates and decimals compare the same way in both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.adapter import VIEWS, Tables, prelude

SPARK_TYPES = {"s": "string", "i": "bigint", "d": "double"}
SQL_TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in spec.split()]


def oracle(spec: str, body: str) -> str:
    """The SQL with the logical tables it mentions and the fixed output types."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    head = f"WITH {prelude(used)}\n" if used else ""
    cast = ", ".join(f"CAST({n} AS {SQL_TYPES[t]}) AS {n}" for n, t in columns(spec))
    return f"{head}SELECT {cast} FROM ({body}) result"


def query(name: str, spec: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; without SQL the check is rows only."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir)).select(*[F.col(n).cast(SPARK_TYPES[t]).alias(n) for n, t in columns(spec)])

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(spec, sql)
        return fn

    return register
