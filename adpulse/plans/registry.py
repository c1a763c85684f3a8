"""Registry of runnable queries: name -> (Spark builder, DuckDB oracle SQL).

Each Spark builder takes ``(spark, sf_dir)``, reads the fixture views (which
read the driver tables under ``sf_dir``) and returns a DataFrame. Output
conventions shared with the oracle: integer measures BIGINT, non-integer
measures DOUBLE made from an exactly rounded decimal, dates as
``yyyy-MM-dd`` strings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    headline: bool = False


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, headline)
        return fn
    return deco


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    """Cast the named (decimal) columns to DOUBLE."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def bigints(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def date_strings(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd") for c in cols})


def load_all() -> dict[str, Query]:
    """Import every module that registers queries and return the registry."""
    from . import (  # noqa: F401
        q_reports, q_ecpm, q_forecast, q_custom, q_config, q_state, q_io, q_stream,
    )
    return QUERIES
