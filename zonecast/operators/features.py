"""Hourly district time series and its features.

Scale note: every window here runs on the *hourly* table, i.e. after ``hourly_count``
has collapsed raw points into one row per (district, hour) with a partial (map-side)
aggregation. A district partition therefore holds at most one row per hour of the
covered period, whatever the number of raw points, so a hot district cannot blow up a
window task. Lags, rolling frames and the hour-of-day mean share one hash exchange on
``cd_name`` (the (cd_name, hour) window is satisfied by the same partitioning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cyclic_cos, cyclic_sin, floor_hour, is_weekend, weekday0

KEY = "cd_name"
TS = "pickup_datetime"
TARGET = "pickups"

# Lags 1, 2 and 24 rows; rolling frames of 3 and 24 rows.
DEFAULT_LAGS = (1, 2, 24)
DEFAULT_WINDOWS = (3, 24)


def hourly_count(points: DataFrame, key: str = KEY, ts: str = TS, out_ts: str = TS,
                 out: str = TARGET) -> DataFrame:
    """Count per (key, hour floor). Hours without points have no row."""
    return (points.where(F.col(key).isNotNull())
                  .groupBy(F.col(key).alias(key), floor_hour(ts).alias(out_ts))
                  .agg(F.count(F.lit(1)).alias(out)))


def series_window(key: str = KEY, ts: str = TS, extra_keys=()) -> Window:
    return Window.partitionBy(key, *extra_keys).orderBy(ts)


def add_calendar(df: DataFrame, ts: str = TS) -> DataFrame:
    """hour, weekday (Mon=0), month, day, is_weekend and the four cyclic encodings."""
    return (df.withColumn("hour", F.hour(ts))
              .withColumn("weekday", weekday0(ts))
              .withColumn("month", F.month(ts))
              .withColumn("day", F.dayofmonth(ts))
              .withColumn("is_weekend", is_weekend(ts))
              .withColumn("sin_hour", cyclic_sin("hour", 24))
              .withColumn("cos_hour", cyclic_cos("hour", 24))
              .withColumn("sin_weekday", cyclic_sin("weekday", 7))
              .withColumn("cos_weekday", cyclic_cos("weekday", 7)))


def group_mean_transform(df: DataFrame, keys=(KEY, "hour"), value: str = TARGET,
                         out: str = "pickup_density_cd") -> DataFrame:
    """Mean of ``value`` per group, repeated on every row of the group."""
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(*keys)))


def add_lags(df: DataFrame, value: str = TARGET, lags=DEFAULT_LAGS, key: str = KEY, ts: str = TS,
             extra_keys=(), prefix: str = "lag_") -> DataFrame:
    """Lags by row (not by clock) within each series."""
    w = series_window(key, ts, extra_keys)
    for k in lags:
        df = df.withColumn(f"{prefix}{k}", F.lag(value, k).over(w))
    return df


def add_rolling_full(df: DataFrame, value: str = TARGET, windows=DEFAULT_WINDOWS, key: str = KEY,
                     ts: str = TS, extra_keys=()) -> DataFrame:
    """Mean and sample std over the last n rows including the current one; NULL until
    the frame holds n rows (``rolling(n)`` semantics)."""
    base = series_window(key, ts, extra_keys)
    for n in windows:
        w = base.rowsBetween(-(n - 1), 0)
        full = F.count(value).over(w) == n
        df = df.withColumn(f"rolling_mean_{n}h", F.when(full, F.avg(value).over(w)))
    for n in windows:
        w = base.rowsBetween(-(n - 1), 0)
        full = F.count(value).over(w) == n
        df = df.withColumn(f"rolling_std_{n}h", F.when(full, F.stddev_samp(value).over(w)))
    return df


def add_rolling_shifted(df: DataFrame, value: str = TARGET, windows=DEFAULT_WINDOWS, key: str = KEY,
                        ts: str = TS, extra_keys=(), suffix: str = "") -> DataFrame:
    """Mean over the previous n rows (current excluded), at least one row
    (``shift(1).rolling(n, min_periods=1)``)."""
    base = series_window(key, ts, extra_keys)
    for n in windows:
        df = df.withColumn(f"rolling_mean_{n}h{suffix}", F.avg(value).over(base.rowsBetween(-n, -1)))
    return df


def relag_per_split(df: DataFrame, split_col: str = "split", value: str = TARGET, key: str = KEY,
                    ts: str = TS, lags=DEFAULT_LAGS, windows=DEFAULT_WINDOWS, suffix: str = "") -> DataFrame:
    """Lags and shifted rolling means recomputed on raw ``value`` inside each split, then
    rows without all lags dropped (the first ``max(lags)`` rows of each split)."""
    df = add_lags(df, value, lags, key, ts, extra_keys=(split_col,), prefix="lag_")
    if suffix:
        df = df.select(*[F.col(c).alias(c + suffix) if c.startswith("lag_") else F.col(c) for c in df.columns])
    df = add_rolling_shifted(df, value, windows, key, ts, extra_keys=(split_col,), suffix=suffix)
    return df.dropna(subset=[f"lag_{k}{suffix}" for k in lags])


FEATURE_COLUMNS = [
    KEY, TS, TARGET, "hour", "pickup_density_cd", "weekday", "month", "day", "is_weekend",
    "sin_hour", "cos_hour", "sin_weekday", "cos_weekday", "lag_1", "lag_2", "lag_24",
    "rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h", "rolling_std_24h",
]


def series_window_exprs(value: str = TARGET, lags=DEFAULT_LAGS, windows=DEFAULT_WINDOWS, key: str = KEY,
                        ts: str = TS, extra_keys=()) -> dict:
    """All lag and rolling expressions over one (key, ts) ordering, so that Catalyst
    evaluates them in a single Window operator after a single sort."""
    base = series_window(key, ts, extra_keys)
    out = {f"lag_{k}": F.lag(value, k).over(base) for k in lags}
    for n in windows:
        w = base.rowsBetween(-(n - 1), 0)
        full = F.count(value).over(w) == n
        out[f"rolling_mean_{n}h"] = F.when(full, F.avg(value).over(w))
        out[f"rolling_std_{n}h"] = F.when(full, F.stddev_samp(value).over(w))
    return out


def build_features(hourly: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Hourly counts -> the 20-column feature table (NULL rows dropped by default).

    Plan: one hash exchange on cd_name; one sort by (cd_name, time) feeds a single
    Window operator for all lags and rolling frames; the (cd_name, hour) mean follows
    on the same partitioning (a second sort, no second exchange). Putting the mean
    first would make Spark partition by (cd_name, hour) and shuffle again."""
    df = add_calendar(hourly).withColumns(series_window_exprs())
    df = group_mean_transform(df)
    df = df.select(*FEATURE_COLUMNS)
    return df.dropna() if drop_incomplete else df


def dense_hours(hourly: DataFrame, key: str = KEY, ts: str = TS, value: str = TARGET) -> DataFrame:
    """Option (not the default): fill missing hours of each district with 0 between its
    first and last hour, so that lags are by clock. One row per district-hour; the
    explode size per district is bounded by its time span in hours."""
    span = hourly.groupBy(key).agg(F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
    grid = span.select(key, F.explode(F.sequence("_t0", "_t1", F.expr("INTERVAL 1 HOUR"))).alias(ts))
    return (grid.join(hourly, [key, ts], "left")
                .withColumn(value, F.coalesce(F.col(value), F.lit(0).cast("bigint"))))
