"""Blending by position, soft blending, and the next-hour forecast table (SURVEY 2.3, 2.5,
2.9, 2.12 ``forecast_table``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import color_bucket, model_label
from . import metrics as M
from .spatial import centroid_join
from .splits import last_row


def tail_align(series: dict[str, DataFrame], key: str = "district", ts: str = "pickup_datetime",
               truth_from: str | None = None) -> DataFrame:
    """Align several prediction series of one district by position counted from the end
    (the last rows of each are paired, the longer ones are cut to the shortest).

    ``series``: name -> DataFrame(key, ts, y_true, y_pred). Output: key, rpos (1 = last),
    pos (0-based from the start of the aligned block), y_true and ts of ``truth_from``
    (default the first series), y_<name> per series.
    """
    names = list(series)
    truth_from = truth_from or names[0]
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    out = None
    for n, df in series.items():
        cols = [key, F.row_number().over(w).alias("rpos"), F.col("y_pred").alias(f"y_{n}")]
        if n == truth_from:
            cols += ["y_true", ts]
        s = df.select(*cols)
        out = s if out is None else out.join(s, [key, "rpos"], "inner")
    n_al = F.count(F.lit(1)).over(Window.partitionBy(key))
    return out.withColumn("pos", n_al - F.col("rpos"))


def mean_blend(cols) -> Column:
    return sum((F.col(c) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))


def soft_blend_weights(val_scores: DataFrame, key: str = "district", model_col: str = "model",
                       rmse_col: str = "rmse", eps: float = 1e-6) -> DataFrame:
    """w_m = (1 / (rmse_m + eps)) / sum over models, one row per (district, model)."""
    inv = F.lit(1.0) / (F.col(rmse_col) + F.lit(eps))
    return (val_scores.withColumn("_inv", inv)
                      .withColumn("weight", F.col("_inv") / F.sum("_inv").over(Window.partitionBy(key)))
                      .select(key, model_col, "weight"))


def soft_blend(preds: DataFrame, weights: DataFrame, key: str = "district", model_col: str = "model",
               ts: str = "pickup_datetime") -> DataFrame:
    """Weighted sum of model predictions per (district, time). ``weights`` has one row per
    (district, model), a small table."""
    j = preds.join(weights, [key, model_col], "inner")
    return j.groupBy(key, ts, "y_true").agg(F.sum(F.col("y_pred") * F.col("weight")).alias("pred_ensemble"))


def pred_name_coalesce(df: DataFrame, out: str = "pred_next_hour",
                       candidates=("y_pred_blend", "pred_ensemble", "y_pred")) -> DataFrame:
    """Rename the first present prediction column to ``out`` (metadata only)."""
    for c in candidates:
        if c in df.columns:
            return df.withColumnRenamed(c, out)
    raise KeyError(f"no prediction column among {candidates}: {df.columns}")


def best_model_lookup(eval_table: DataFrame, preds: DataFrame, key: str = "district",
                      ts: str = "pickup_datetime") -> DataFrame:
    """For each district, the last prediction of its best model with that model's RMSE.
    ``eval_table`` carries rmse_<m> and best_model ('rmse_<m>'); ``preds`` is the long
    prediction table (district, model, ts, y_true, y_pred)."""
    rmse_cols = [c for c in eval_table.columns if c.startswith("rmse_")]
    long = eval_table.unpivot([key, "best_model"], [F.col(c) for c in rmse_cols], "rmse_col", "rmse")
    best = (long.where(F.col("rmse_col") == F.col("best_model"))
                .select(key, F.regexp_replace("best_model", "^rmse_", "").alias("model"), "rmse"))
    last = last_row(preds, [key, "model"], ts)
    return (best.join(last, [key, "model"], "inner")
                .select(key, model_label(F.col("model")).alias("model_type"),
                        F.col("y_pred").cast("double").alias("pred_next_hour"),
                        F.col("y_true").cast("double").alias("y_true"), "rmse"))


def minmax_radius(df: DataFrame, col: str = "pred_next_hour", out: str = "radius",
                  lo: float = 6.0, hi: float = 28.0) -> DataFrame:
    """lo + (x - min) * (hi - lo) / max(max - min, 1e-6) over the whole result (scalar
    subqueries for min and max)."""
    mn = df.agg(F.min(col)).scalar()
    mx = df.agg(F.max(col)).scalar()
    return df.withColumn(out, F.lit(lo) + (F.col(col) - mn) * F.lit(hi - lo) / F.greatest(mx - mn, F.lit(1e-6)))


def forecast_table(eval_table: DataFrame, preds: DataFrame, centroids: DataFrame) -> DataFrame:
    """district, model_type, pred_next_hour, y_true, rmse, cd_name, lat, lon, radius, color.
    An empty join (names not matching the polygons) is the caller's error to check."""
    look = best_model_lookup(eval_table, preds)
    merged = centroid_join(look, centroids, "district", "cd_name")
    out = minmax_radius(merged).withColumn("color", color_bucket("rmse"))
    return out.select("district", "model_type", "pred_next_hour", "y_true", "rmse", "cd_name", "lat", "lon",
                      "radius", "color")


def marker_size(df: DataFrame, col: str, base: float = 6.0, span: float = 10.0, out: str = "marker_size") -> DataFrame:
    mx = df.agg(F.max(col)).scalar()
    return df.withColumn(out, F.lit(base) + F.col(col) / mx * F.lit(span))


__all__ = ["tail_align", "mean_blend", "soft_blend_weights", "soft_blend", "pred_name_coalesce",
           "best_model_lookup", "minmax_radius", "forecast_table", "marker_size", "M"]
