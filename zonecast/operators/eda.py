"""Exploratory statistics over pickups: counts by calendar part, pivots,
modes, ranges, null and duplicate counts, quantile summaries, hot spots, district and
borough shares, correlation and top-k reports.

Totals used as denominators are scalar subqueries (``df.agg(...).scalar()``): a single
value, evaluated once and inlined, instead of an unpartitioned ``sum() over ()`` window
that would pull every row into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import WEEKDAY_SHORT, timedelta_days, weekday0
from .clean import exact_quantiles


def with_parts(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Hour, Day, Weekday (Mon=0), Month columns as in the exploration step."""
    return df.withColumns({"Hour": F.hour(ts), "Day": F.dayofmonth(ts),
                           "Weekday": weekday0(ts), "Month": F.month(ts)})


def total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def count_by_part(df: DataFrame, part: str, out: str = "pickups") -> DataFrame:
    return df.groupBy(part).agg(F.count(F.lit(1)).alias(out))


def calendar_day_avg(df: DataFrame, day: str = "Day", month: str = "Month") -> DataFrame:
    """Total per day of month divided by the number of distinct months in the data
    (every day is divided by all months, day 31 included)."""
    n_months = df.agg(F.countDistinct(month)).scalar()
    return (df.groupBy(day).agg(F.count(F.lit(1)).alias("Total_Pickups"))
              .withColumn("Avg_Pickups", F.col("Total_Pickups") / n_months))


def daily_total(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("Date")).agg(F.count(F.lit(1)).alias("Pickups"))


def pivot_count(df: DataFrame, index: str = "Hour", columns: str = "Weekday", values=range(7)) -> DataFrame:
    """index x columns count table, missing cells 0. The column values are given, so no
    extra job is run to discover them."""
    vals = list(values)
    return (df.groupBy(index).pivot(columns, vals).agg(F.count(F.lit(1))).fillna(0)
              .select(index, *[F.col(str(v)).cast("bigint").alias(str(v)) for v in vals]))


def pivot_pct_norm(df: DataFrame, index: str = "Hour", columns: str = "Weekday",
                   labels=WEEKDAY_SHORT) -> DataFrame:
    """Each weekday column as a percentage of that weekday's total, named Mon..Sun."""
    cnt = df.groupBy(index, columns).agg(F.count(F.lit(1)).alias("_n"))
    pct = cnt.withColumn("_pct", F.col("_n") / F.sum("_n").over(Window.partitionBy(columns)) * 100)
    wide = pct.groupBy(index).pivot(columns, list(range(len(labels)))).agg(F.first("_pct")).fillna(0.0)
    return wide.select(index, *[F.col(str(i)).alias(lab) for i, lab in enumerate(labels)])


def value_counts_top(df: DataFrame, col: str, k: int = 1, out: str = "count") -> DataFrame:
    """The k most frequent values with their counts; ties broken by the value ascending."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.col(out).desc(), F.col(col).asc()).limit(k))


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value; the smallest among equally frequent ones."""
    return value_counts_top(df, col, 1).select(F.col(col).alias("mode"))


def top_hour_day(df: DataFrame) -> DataFrame:
    return (df.groupBy("Day", "Hour").agg(F.count(F.lit(1)).alias("Count"))
              .orderBy(F.col("Count").desc(), "Day", "Hour").limit(1))


def time_range(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    a = df.agg(F.min(ts).alias("start_date"), F.max(ts).alias("end_date"))
    return a.withColumn("days_covered", timedelta_days("start_date", "end_date"))


def coord_stats(df: DataFrame, lat: str = "Lat", lon: str = "Lon") -> DataFrame:
    return df.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                  F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"),
                  F.avg(lat).alias("lat_mean"), F.avg(lon).alias("lon_mean"))


def null_counts(df: DataFrame) -> DataFrame:
    """Long form (column_name, null_count), one aggregation pass over all columns."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "null_count")


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Rows repeating an earlier row on ``keys`` (sum over groups of size - 1)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def describe(df: DataFrame, cols) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per numeric column (long form).
    Moments come from one aggregation per column; the quartiles of all columns from one
    quantile run over (column, value) rows."""
    cols = list(cols)
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v"))
                                             for c in cols])).alias("_s")).select("_s.column_name", "_s._v")
    q = exact_quantiles(stacked, "_v", (0.25, 0.5, 0.75), ["column_name"])
    mom = stacked.groupBy("column_name").agg(F.count("_v").alias("count"), F.avg("_v").alias("mean"),
                                             F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"),
                                             F.max("_v").alias("max"))
    return mom.join(q, "column_name", "left").select("column_name", "count", "mean", "std", "min", "q25", "q50",
                                                    "q75", "max")


def hotspots(df: DataFrame, lat: str = "Lat", lon: str = "Lon", decimals: int = 3, k: int = 10) -> DataFrame:
    """Points rounded half-even to ``decimals``; the k most frequent rounded locations."""
    g = (df.groupBy(F.bround(lat, decimals).alias("Lat_round"), F.bround(lon, decimals).alias("Lon_round"))
           .agg(F.count(F.lit(1)).alias("Count")))
    return g.orderBy(F.col("Count").desc(), "Lat_round", "Lon_round").limit(k)


def pct_of_total(df: DataFrame, count_col: str = "count", out: str = "percentage", decimals: int = 2) -> DataFrame:
    tot = df.agg(F.sum(count_col)).scalar()
    return df.withColumn(out, F.bround(F.col(count_col) / tot * 100, decimals))


def district_stats(points: DataFrame, key: str = "cd_name") -> DataFrame:
    """Pickups per district with the percentage of all pickups (2 decimals)."""
    cnt = points.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return pct_of_total(cnt)


def topk(df: DataFrame, by: str, k: int = 10, key: str = "cd_name") -> DataFrame:
    """k largest by ``by``, ties by ``key`` ascending (pandas keeps first-seen order and
    groupby output is key-sorted), with a 1-based rank."""
    w = Window.orderBy(F.col(by).desc(), F.col(key).asc())
    top = df.orderBy(F.col(by).desc(), F.col(key).asc()).limit(k)
    # rank over at most k rows
    return top.withColumn("rank", F.row_number().over(w))


def topk_by_rows(hourly: DataFrame, k: int = 10, key: str = "cd_name") -> DataFrame:
    """Districts with the most hourly rows (``value_counts().head(k)``)."""
    return topk(hourly.groupBy(key).agg(F.count(F.lit(1)).alias("count")), "count", k, key)


def topk_by_pickups(points: DataFrame, k: int = 10, key: str = "cd_name") -> DataFrame:
    return topk(district_stats(points, key), "count", k, key)


def district_top_report(points: DataFrame, k: int = 10, key: str = "cd_name") -> DataFrame:
    """Top-k districts with rank, share, total and the share covered by the top k."""
    stats = district_stats(points, key)
    tot = points.where(F.col(key).isNotNull()).agg(F.count(F.lit(1))).scalar()
    top = topk(stats, "count", k, key)
    cover = top.agg(F.sum("percentage")).scalar()
    return top.withColumn("total_pickups", tot).withColumn("topk_coverage", cover)


def borough_rollup(stats: DataFrame, lookup: DataFrame, key: str = "cd_name") -> DataFrame:
    """Sum of count and percentage per borough. ``lookup`` (cd_name, boro_name) acts as
    a dictionary, so it is reduced to one row per key first (Spark rows have no order,
    so of several names for one key the largest is kept). Districts missing from the
    lookup fall under a NULL borough. The lookup holds one row per district, a bounded
    dimension; the planner broadcasts it."""
    d = lookup.groupBy(key).agg(F.max("boro_name").alias("borough"))
    j = stats.join(d, key, "left")
    return (j.groupBy("borough").agg(F.sum("count").alias("count"), F.sum("percentage").alias("percentage"))
             .orderBy(F.col("count").desc()))


def pivot_part_by_district(points: DataFrame, part: str, names, key: str = "cd_name") -> DataFrame:
    """part x district count table for the given districts, missing cells 0."""
    names = list(names)
    return (points.where(F.col(key).isin(names)).groupBy(part).pivot(key, names)
                  .agg(F.count(F.lit(1))).fillna(0))


def long_from_pivot(wide: DataFrame, index, value_name: str = "pickups", var_name: str = "cd_name") -> DataFrame:
    index = [index] if isinstance(index, str) else list(index)
    vals = [c for c in wide.columns if c not in index]
    if not vals:   # no district columns (no input rows): an empty long table
        return wide.select(*index, F.lit(None).cast("string").alias(var_name),
                           F.lit(None).cast("bigint").alias(value_name)).where(F.lit(False))
    return wide.unpivot(index, [F.col(f"`{c}`").cast("bigint").alias(c) for c in vals], var_name, value_name)


def guarded_corr(a: Column, b: Column) -> Column:
    """Pearson correlation that is NULL (not an error) for a constant column."""
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def corr_pairs(wide: DataFrame, cols) -> DataFrame:
    """Long form (var_a, var_b, corr) of the Pearson matrix over ``cols``.

    One aggregation of sufficient sums (n, sum x_i, sum x_i x_j for i <= j: p(p+3)/2 + 1
    aggregates instead of three per pair), then
    corr = (n s_ij - s_i s_j) / sqrt((n s_ii - s_i^2)(n s_jj - s_j^2)), NULL for a constant
    column. For integer-valued columns (counts, calendar parts) the sums are exact."""
    cols = list(cols)
    p = len(cols)
    x = [f"cast(`{c}` AS double)" for c in cols]
    sums = [f"sum({x[i]}) AS s{i}" for i in range(p)]
    sums += [f"sum({x[i]} * {x[j]}) AS q{i}_{j}" for i in range(p) for j in range(i, p)]
    one = wide.selectExpr("cast(count(1) AS double) AS n", *sums)
    var = [f"(n * q{i}_{i} - s{i} * s{i})" for i in range(p)]

    def pair(i, j):
        cov = f"(n * q{min(i, j)}_{max(i, j)} - s{i} * s{j})"
        name = [c.replace("\\", "\\\\").replace("'", "\\'") for c in (cols[i], cols[j])]
        return f"struct('{name[0]}' AS var_a, '{name[1]}' AS var_b, try_divide({cov}, nullif(sqrt({var[i]} * {var[j]}), 0D)) AS corr)"
    # as SQL text: a few thousand expression nodes are parsed at once instead of call by call
    pairs = ", ".join(pair(i, j) for i in range(p) for j in range(p))
    return one.selectExpr(f"inline(array({pairs}))")


def corr_matrix(points: DataFrame, names, key: str = "cd_name") -> DataFrame:
    """Correlation of district pickup counts and the calendar parts over the (Hour,
    Weekday, Day, Month) combinations present; a missing district count is 0."""
    names = sorted(names)
    parts = ["Hour", "Weekday", "Day", "Month"]
    wide = (points.where(F.col(key).isin(names)).groupBy(*parts).pivot(key, names)
                  .agg(F.count(F.lit(1))).fillna(0))
    return corr_pairs(wide, names + parts)


def sink_eda_tables(points: DataFrame, names, out: str, key: str = "cd_name") -> list[str]:
    """Write the hour / weekday / day / month x district tables and the correlation pairs
    of the given (top) districts under ``out`` (one parquet table each).

    One pass over the points: a partial aggregation to counts per (Hour, Weekday, Day,
    Month, district) - bounded by calendar x k - is written once; every table is then
    derived from that small table."""
    from ..session import materialize
    names = list(names)
    parts = ["Hour", "Weekday", "Day", "Month"]
    agg = materialize(points.where(F.col(key).isin(names)).groupBy(*parts, key)
                      .agg(F.count(F.lit(1)).alias("n")), "eda_counts")
    written = []
    for part in parts:
        path = f"{out}/{part.lower()}_table"
        (agg.groupBy(part).pivot(key, names).agg(F.sum("n")).fillna(0)
            .select(part, *[F.col(f"`{n}`").cast("bigint").alias(n) for n in names])
            .write.mode("overwrite").parquet(path))
        written.append(path)
    path = f"{out}/correlation_table"
    wide = agg.groupBy(*parts).pivot(key, sorted(names)).agg(F.sum("n")).fillna(0)
    corr_pairs(wide, sorted(names) + parts).write.mode("overwrite").parquet(path)
    written.append(path)
    return written
