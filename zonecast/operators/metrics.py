"""Error metrics and the evaluation tables built from them.

Predictions are kept in one long table ``(district, model, pickup_datetime, y_true,
y_pred)``; every metric is a grouped aggregate over it, so any number of districts and
models is one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .eda import guarded_corr

# The four model families of the evaluation table, in column order.
EVAL_MODELS = ["rf", "lgbm", "conv", "hybrid"]


def rmse(y, p) -> Column:
    y, p = (F.col(y) if isinstance(y, str) else y), (F.col(p) if isinstance(p, str) else p)
    return F.sqrt(F.avg(F.pow(y - p, 2)))


def mae(y, p) -> Column:
    y, p = (F.col(y) if isinstance(y, str) else y), (F.col(p) if isinstance(p, str) else p)
    return F.avg(F.abs(y - p))


def pearson(y, p) -> Column:
    y, p = (F.col(y) if isinstance(y, str) else y), (F.col(p) if isinstance(p, str) else p)
    return guarded_corr(y.cast("double"), p.cast("double"))


def improvement_pct(model_rmse, baseline_rmse) -> Column:
    m = F.col(model_rmse) if isinstance(model_rmse, str) else model_rmse
    b = F.col(baseline_rmse) if isinstance(baseline_rmse, str) else baseline_rmse
    return F.lit(100.0) * (F.lit(1.0) - F.try_divide(m, b))


def score(preds: DataFrame, keys=("district", "model"), y: str = "y_true", p: str = "y_pred",
          baseline: str | None = None) -> DataFrame:
    """rmse, mae, correlation (and baseline rmse / improvement when a baseline column is
    given) per group."""
    aggs = [rmse(y, p).alias("rmse"), mae(y, p).alias("mae"), pearson(y, p).alias("correlation"),
            F.count(F.lit(1)).alias("n")]
    if baseline:
        aggs.append(rmse(y, baseline).alias("baseline_rmse"))
    out = preds.groupBy(*keys).agg(*aggs)
    if baseline:
        out = out.withColumn("improvement_pct", improvement_pct("rmse", "baseline_rmse"))
    return out


def broadcast_mean(df: DataFrame, col: str, out: str) -> DataFrame:
    """The overall mean of ``col`` repeated on every row (scalar subquery, no window)."""
    return df.withColumn(out, df.agg(F.avg(col)).scalar())


def model_eval_table(preds: DataFrame, models=EVAL_MODELS, key: str = "district",
                     y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One row per district: rmse_<m>, mae_<m> for each model (NULL when missing)."""
    wide = preds.groupBy(key).pivot("model", list(models)).agg(rmse(y, p).alias("rmse"), mae(y, p).alias("mae"))
    cols = [F.col(key)]
    for m in models:
        cols += [F.col(f"{m}_rmse").alias(f"rmse_{m}"), F.col(f"{m}_mae").alias(f"mae_{m}")]
    return wide.select(*cols)


def row_idxmin(cols) -> Column:
    """Name of the column holding the row minimum; NULL/NaN skipped, first wins ties,
    NULL when every value is missing."""
    items = F.array(*[F.struct(F.col(c).alias("v"), F.lit(i).alias("i"), F.lit(c).alias("n"))
                      for i, c in enumerate(cols)])
    present = F.filter(items, lambda s: s["v"].isNotNull() & ~F.isnan(s["v"]))
    return F.when(F.size(present) > 0, F.array_min(present)["n"])


def row_mean(cols) -> Column:
    """Mean of the non-missing values of a row; NULL when all are missing."""
    vals = [F.when(F.col(c).isNotNull() & ~F.isnan(c), F.col(c)) for c in cols]
    s = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
    n = sum((v.isNotNull().cast("int") for v in vals), F.lit(0))
    return F.try_divide(s, F.nullif(n, F.lit(0)).cast("double"))


def add_best_model(eval_table: DataFrame, models=EVAL_MODELS) -> DataFrame:
    rc = [f"rmse_{m}" for m in models]
    return eval_table.withColumn("best_model", row_idxmin(rc)).withColumn("mean_rmse", row_mean(rc))


def melt(eval_table: DataFrame, models=EVAL_MODELS, key: str = "district") -> DataFrame:
    """Wide rmse_* columns -> (district, Model, RMSE)."""
    return eval_table.unpivot([key], [F.col(f"rmse_{m}") for m in models], "Model", "RMSE")


def box_stats(long: DataFrame, group: str = "Model", value: str = "RMSE") -> DataFrame:
    """Box-plot numbers per group: min, quartiles (linear), max, count."""
    ok = long.where(F.col(value).isNotNull() & ~F.isnan(value))
    q = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (ok.groupBy(group).agg(F.min(value).alias("min"), q.alias("_q"), F.max(value).alias("max"),
                                  F.count(F.lit(1)).alias("n"))
              .select(group, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                      F.col("_q")[2].alias("q3"), "max", "n"))


def best_model_counts(eval_table: DataFrame, col: str = "best_model") -> DataFrame:
    from ..functions.scalars import model_label
    return (eval_table.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
                      .select(model_label(col).alias("model_type"), "count"))


def mean_rmse_rank(table: DataFrame, key: str = "district", value: str = "rmse", k: int = 3) -> DataFrame:
    """The k districts with the lowest mean RMSE, ranked 1..k."""
    from pyspark.sql import Window
    m = table.groupBy(key).agg(F.avg(value).alias("mean_rmse"))
    top = m.orderBy(F.col("mean_rmse").asc(), F.col(key).asc()).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_rmse").asc(), F.col(key).asc())))


def residuals(preds: DataFrame, n: int = 10, ts: str = "pickup_datetime", decimals: int = 2) -> DataFrame:
    """The first n rows (by time) of a prediction series with model and lag-1 errors,
    numbers rounded half-even like numpy: Actual, Predicted, Baseline, Pred_Error,
    Base_Error."""
    first = preds.orderBy(ts).limit(n)
    return first.select(ts, F.col("y_true").alias("Actual"), F.bround("y_pred", decimals).alias("Predicted"),
                        F.col("lag_1").alias("Baseline"),
                        F.bround(F.col("y_true") - F.col("y_pred"), decimals).alias("Pred_Error"),
                        F.bround(F.col("y_true") - F.col("lag_1"), decimals).alias("Base_Error"))
