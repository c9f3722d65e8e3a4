"""Shared column expressions and helpers of the ``llm`` operators."""

from __future__ import annotations

import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters outside these (space, tab, LF, VT, FF, CR).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of words ``[^\\x20\\x09-\\x0D]+``; null text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (the built-in ``lower`` is used where the text is pure ASCII)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def groups_for(n_rows: int, rows_per_group: int) -> int:
    """Number of hash groups so that a group holds about ``rows_per_group`` rows."""
    return max(1, math.ceil(n_rows / rows_per_group))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker. Functions of this package travel to
    the workers by value, with globals of their own per task; what is costly to build and
    the same for every task (a tokenizer, its memo) is kept here instead."""
    name = "zonecast_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def fresh(df: DataFrame, base: str) -> str:
    """A column name not in ``df``, so that working columns never clash with the caller's."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name
