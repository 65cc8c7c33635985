"""Query registry: name -> (Spark builder, DuckDB oracle text or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables.  The oracle text is the same result in DuckDB SQL over
the raw tables; queries that are not SQL-expressible register ``None``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import apply_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str | None] = {}


def register(name: str, oracle: str | None):
    """Register ``fn(spark, sf_dir)``; the session settings the operators rely
    on (UTC, ANSI, AQE, dynamic partition overwrite) are applied first, since
    a caller may hand in a session built without them."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tidewater.plans import batch_queries, stream_queries  # noqa: F401
