"""Chronological splits: per-district and global train/test, validation
cut-off, sequence train/val/test and the meta-model hold-out.

All positional rules are window expressions partitioned by district, over the hourly
table (bounded rows per district). The global split avoids an unpartitioned window:
it finds the cut-off through per-hour counts (one row per hour) and ranks only inside
the cut-off hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "cd_name"
TS = "pickup_datetime"


def _pos(key=KEY, ts=TS, extra=()):
    return Window.partitionBy(key, *extra).orderBy(ts)


def chrono_split(df: DataFrame, test_size: float = 0.2, by_district: bool = True, key: str = KEY,
                 ts: str = TS, out: str = "split") -> DataFrame:
    """Adds ``split`` = 'train' / 'test'. Per district (default of the script): the first
    ``int(n * (1 - test_size))`` rows by time are train. Globally: the same rule over
    all rows ordered by (time, district)."""
    frac = F.lit(1 - test_size)
    if by_district:
        w = _pos(key, ts)
        n = F.count(F.lit(1)).over(Window.partitionBy(key))
        cut = F.floor(n.cast("double") * frac)
        return df.withColumn(out, F.when(F.row_number().over(w) <= cut, "train").otherwise("test"))
    total = df.agg(F.count(F.lit(1))).scalar()
    k = F.floor(total.cast("double") * frac)
    per_ts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_c"))
    # running count over distinct timestamps: one row per hour, a small table
    cum = per_ts.withColumn("_before", F.coalesce(F.sum("_c").over(
        Window.orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank_in_ts = F.row_number().over(Window.partitionBy(ts).orderBy(key))
    j = df.join(cum.select(ts, "_before"), ts)
    return (j.withColumn(out, F.when(F.col("_before") + rank_in_ts <= k, "train").otherwise("test"))
             .drop("_before"))


def cutoff_split(df: DataFrame, days: int = 14, min_val: int = 100, fallback_frac: float = 0.9,
                 key: str = KEY, ts: str = TS, out: str = "fit_split") -> DataFrame:
    """Validation = rows at or after max(ts) - ``days`` per district; when that leaves
    fewer than ``min_val`` rows, the last (1 - fallback_frac) of rows by position."""
    p = Window.partitionBy(key)
    cutoff = F.max(ts).over(p) - F.make_dt_interval(F.lit(days))
    is_val_time = F.col(ts) >= cutoff
    n_val = F.count_if(is_val_time).over(p)
    n = F.count(F.lit(1)).over(p)
    pos = F.row_number().over(_pos(key, ts))
    by_pos = pos > F.floor(n.cast("double") * F.lit(fallback_frac))
    is_val = F.when(n_val < min_val, by_pos).otherwise(is_val_time)
    return df.withColumn(out, F.when(is_val, "val").otherwise("fit"))


def sequence_split(df: DataFrame, train: float = 0.8, val: float = 0.9, key: str = KEY, ts: str = TS,
                   out: str = "split") -> DataFrame:
    """Per district by position: idx < int(train*n) train, < int(val*n) val, else test."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key)).cast("double")
    idx = F.row_number().over(_pos(key, ts)) - 1
    return df.withColumn(out, F.when(idx < F.floor(F.lit(train) * n), "train")
                               .when(idx < F.floor(F.lit(val) * n), "val").otherwise("test"))


def holdout_split(df: DataFrame, frac: float = 0.6, min_rows: int = 10, key: str = "district",
                  order: str = "pos", out: str = "part") -> DataFrame:
    """First ``max(min_rows, int(frac*n))`` rows fit the meta-model ('meta'), the rest
    score it ('hold')."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key)).cast("double")
    idx = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    cut = F.greatest(F.lit(min_rows).cast("bigint"), F.floor(F.lit(frac) * n))
    return df.withColumn(out, F.when(idx < cut, "meta").otherwise("hold"))


def last_row(df: DataFrame, keys, order: str) -> DataFrame:
    """The last row per group by ``order`` (ties: any one; give a total order)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
