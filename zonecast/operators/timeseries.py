"""Autocorrelation and partial autocorrelation per district (SURVEY 2.5 ``acf``, ``pacf``,
``acf_conf``).

Plan: one Window pass over the per-district series computes the demeaned value and its
lags 1..max_lag as columns (no self-join, no 49x row explosion), one grouped aggregation
sums the lagged products, and the Levinson-Durbin recursion for the partial
autocorrelations runs as a Spark higher-order ``aggregate`` over the 49 sums of each
district (JVM-side, no Python worker). Series are short (one row per hour), so a
district partition is bounded by its time span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_LAG = 48


def lag_product_sums(series: DataFrame, value: str = "pickups", key: str = "cd_name", order=("ts",),
                     max_lag: int = MAX_LAG) -> DataFrame:
    """Per key: n and s_k = sum_t d_t * d_{t-k} (k = 0..max_lag) with d = value - mean."""
    p = Window.partitionBy(key)
    w = Window.partitionBy(key).orderBy(*order)
    d = series.withColumn("_d", F.col(value) - F.avg(value).over(p))
    lagged = d.select(key, *[(F.col("_d") * (F.col("_d") if k == 0 else F.lag("_d", k).over(w))).alias(f"_p{k}")
                             for k in range(max_lag + 1)])
    return lagged.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                   F.array(*[F.coalesce(F.sum(f"_p{k}"), F.lit(0.0)) for k in range(max_lag + 1)])
                                   .alias("s"))


def acf(series: DataFrame, value: str = "pickups", key: str = "cd_name", order=("ts",),
        max_lag: int = MAX_LAG, min_points: int = MAX_LAG) -> DataFrame:
    """(key, lag, acf): biased estimator s_k / s_0. Series shorter than ``min_points``
    are skipped."""
    s = lag_product_sums(series, value, key, order, max_lag).where(F.col("n") >= min_points)
    return (s.select(key, F.posexplode_outer("s").alias("lag", "sk"), F.col("s")[0].alias("s0"))
             .select(key, "lag", F.try_divide(F.col("sk"), F.col("s0")).alias("acf")))


def _levinson(r: Column, max_lag: int) -> Column:
    """Partial autocorrelations 0..max_lag from autocovariances r[0..max_lag]."""
    def step(acc, k):
        phi = acc["phi"]
        num = F.get(r, k) - F.aggregate(F.transform(phi, lambda p, i: p * F.get(r, k - 1 - i)), F.lit(0.0),
                                        lambda a, b: a + b)
        den = F.get(r, 0) - F.aggregate(F.transform(phi, lambda p, i: p * F.get(r, i + 1)), F.lit(0.0),
                                        lambda a, b: a + b)
        a = F.try_divide(num, den)
        new_phi = F.concat(F.transform(phi, lambda p, i: p - a * F.get(phi, k - 2 - i)), F.array(a))
        return F.struct(new_phi.alias("phi"), F.concat(acc["pacf"], F.array(a)).alias("pacf"))
    # element types that allow NULL: a constant series has no partial autocorrelations
    init = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).cast("array<double>").alias("pacf"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_lag)), init, step)["pacf"]


def pacf_yw(series: DataFrame, value: str = "pickups", key: str = "cd_name", order=("ts",),
            max_lag: int = MAX_LAG, min_points: int = MAX_LAG) -> DataFrame:
    """(key, lag, pacf) by Yule-Walker with sample-size-adjusted autocovariances
    r_k = s_k / (n - k) (r_0 = s_0 / n), solved for every order by Levinson-Durbin."""
    s = lag_product_sums(series, value, key, order, max_lag).where(F.col("n") >= min_points)
    r = F.transform("s", lambda sk, k: F.try_divide(sk, (F.col("n") - k).cast("double")))
    # bind r to a column: the recursion refers to it O(max_lag^2) times per row
    out = s.select(key, r.alias("_r")).select(key, _levinson(F.col("_r"), max_lag).alias("pacf"))
    # posexplode_outer: a plain posexplode makes Catalyst infer a size(pacf) > 0 filter and
    # push it below this projection, evaluating the whole recursion twice
    return out.select(key, F.posexplode_outer("pacf").alias("lag", "pacf"))


def acf_conf(series: DataFrame, key: str = "cd_name") -> DataFrame:
    """+-1.96 / sqrt(N) band per series."""
    return series.groupBy(key).agg((F.lit(1.96) / F.sqrt(F.count(F.lit(1)))).alias("conf"))


def pseudo_series(points: DataFrame, key: str = "cd_name") -> DataFrame:
    """Counts per (district, Hour, Weekday, Day, Month) ordered by a year-less
    'MM-DD HH' time index (the exploration step's series; empty hours have no row)."""
    from ..functions.scalars import pseudo_timestamp
    g = points.groupBy(key, "Hour", "Weekday", "Day", "Month").agg(F.count(F.lit(1)).alias("pickups"))
    return g.withColumn("ts", pseudo_timestamp("Month", "Day", "Hour"))
