"""Registry of named queries (Spark callables) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SCALE = 6


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """Round every DOUBLE/FLOAT column to ``scale`` decimals (the oracle does the same),
    so that last-bit differences between engines do not change the value hash."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r(expr: str, alias: str | None = None, scale: int = SCALE) -> str:
    """SQL text ``round(CAST(expr AS DOUBLE), scale) AS alias``."""
    a = alias or expr
    return f"round(CAST({expr} AS DOUBLE), {scale}) AS {a}"
