"""Scalers: standard scaling fitted on train, per-district min-max scaling and
its inverse. Written as column expressions over statistics, so fitting is one
aggregation and applying it is a projection.

``ml.StandardScaler`` uses the sample std and ``ml.MinMaxScaler`` maps a constant column
to 0.5; the reference's scalers use the population std and map a constant to 0, hence
the SQL forms here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "cd_name"


def standard_stats(train: DataFrame, cols) -> dict[str, tuple[Column, Column]]:
    """{col: (mean, std_pop)} fitted on ``train`` (all districts together).

    The fit is one aggregation returning 2 x p numbers, brought to the driver as the
    fitted parameters (like a fitted scaler) and inlined as literals: one job, and the
    plans that apply it stay small."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (F.lit(row[f"m_{c}"]).cast("double"), F.lit(row[f"s_{c}"]).cast("double")) for c in cols}


def apply_standard(df: DataFrame, stats, cols) -> DataFrame:
    """(x - mean) / std, a zero std divides by 1."""
    out = {}
    for c in cols:
        m, s = stats[c]
        out[c] = (F.col(c) - m) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return df.withColumns(out)


def standard_scale(train: DataFrame, test: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    st = standard_stats(train, cols)
    return apply_standard(train, st, cols), apply_standard(test, st, cols)


def minmax_stats(df: DataFrame, cols, key: str = KEY) -> DataFrame:
    """Statistics table: one row per district with min_<c>, max_<c>."""
    return df.groupBy(key).agg(*[F.min(c).cast("double").alias(f"min_{c}") for c in cols],
                               *[F.max(c).cast("double").alias(f"max_{c}") for c in cols])


def minmax_scale(df: DataFrame, cols, key: str = KEY) -> DataFrame:
    """(x - min) / (max - min) per district over all its rows; a constant column gives 0."""
    w = Window.partitionBy(key)
    out = {}
    for c in cols:
        lo, hi = F.min(c).over(w).cast("double"), F.max(c).over(w).cast("double")
        rng = hi - lo
        out[c] = (F.col(c).cast("double") - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return df.withColumns(out)


def minmax_inverse(df: DataFrame, stats: DataFrame, col: str, stat_col: str, key: str = KEY,
                   stats_key: str | None = None) -> DataFrame:
    """s * (max - min) + min with the statistics of ``stat_col`` joined by district
    (one row per district: a small table)."""
    sk = stats_key or key
    st = stats.select(F.col(sk).alias(key), F.col(f"min_{stat_col}").alias("_lo"), F.col(f"max_{stat_col}").alias("_hi"))
    rng = F.col("_hi") - F.col("_lo")
    return (df.join(st, key, "inner")
              .withColumn(col, F.col(col) * F.when(rng == 0, F.lit(1.0)).otherwise(rng) + F.col("_lo"))
              .drop("_lo", "_hi"))
