"""Model runs composed from operators: single-model and ensemble runs per
district, the sequence regressor, and the hybrid stacking blend.

All runs return DataFrames in the long prediction layout
(district, model, pickup_datetime, y_true, y_pred) plus a summary table; nothing is
written unless the caller sinks it (see :mod:`zonecast.sources.runs`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import eda
from ..operators import features as feat
from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import scaling as sc
from ..operators import sequences as sq
from ..operators import splits as spl
from ..operators import stacking as st
from ..session import materialize

KEY = "cd_name"
TS = "pickup_datetime"


def top_names(df: DataFrame, k: int = 10) -> list[str]:
    """Top-k districts by number of rows (k names: a bounded collect)."""
    return [r[KEY] for r in eda.topk_by_rows(df, k).select(KEY).collect()]


def relag_train_test(train: DataFrame, test: DataFrame, names) -> DataFrame:
    """Both splits of the chosen districts with lags / shifted means recomputed on raw
    pickups inside each split; rows lacking a lag dropped."""
    both = (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
                 .where(F.col(KEY).isin(list(names))))
    keep = [c for c in both.columns if c not in ("lag_1", "lag_2", "lag_24", "rolling_mean_3h", "rolling_mean_24h")]
    return feat.relag_per_split(both.select(*keep), "split")


def _summary(preds: DataFrame) -> DataFrame:
    s = M.score(preds, ["district"], baseline="lag_1")
    s = s.select("district", F.col("rmse").alias("model_rmse"), "baseline_rmse",
                 F.col("improvement_pct").alias("improvement_%"), "correlation")
    return M.broadcast_mean(s, "model_rmse", "mean_rmse")


def single_model_run(train: DataFrame, test: DataFrame, kind: str = "linear", top_k: int = 10,
                     params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """One model type per top-k district (by train rows) on 13 features.
    kind: linear | ridge | lasso | rf | lgbm. Returns (predictions, summary)."""
    names = top_names(train, top_k)
    data = materialize(relag_train_test(train, test, names), "single_model_input")
    feats = MD.BASE_FEATURES + MD.SINGLE_EXTRA
    tr, te = data.where("split = 'train'"), data.where("split = 'test'")
    if kind in ("linear", "ridge", "lasso"):
        coefs = MD.fit_linear(tr, feats, kind)
        pr = MD.predict_linear(te, coefs, feats)
    elif kind in ("rf", "lgbm"):
        single = MD.trees.BOOST_SINGLE if kind == "lgbm" else {}
        pr = MD.fit_predict_trees(tr, te, feats, "rf" if kind == "rf" else "gbm", {**single, **(params or {})})
    else:
        raise ValueError(f"Unsupported model_type={kind}")
    preds = pr.select(F.col(KEY).alias("district"), F.lit(kind).alias("model"), TS,
                      F.col("pickups").cast("double").alias("y_true"), F.col("y_pred").cast("double"),
                      F.col("lag_1").cast("double"))
    if kind in ("rf", "lgbm"):
        preds = materialize(preds, "single_model_predictions")      # applying many trees costs more than a table
    return preds, _summary(preds)


def ensemble_run(train: DataFrame, test: DataFrame, top_k: int = 10, rf_params: dict | None = None,
                 gbm_params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """RF + GBM per district on 10 features, a 14-day validation cut (fallback: last 10 %),
    GBM early stopping on it, blend weights 1 / (validation RMSE + 1e-6).
    Returns (predictions long: rf, lgbm, ensemble; summary of the ensemble)."""
    names = top_names(train, top_k)
    data = materialize(relag_train_test(train, test, names), "ensemble_input")
    feats = MD.BASE_FEATURES + MD.ENSEMBLE_EXTRA
    tr = spl.cutoff_split(data.where("split = 'train'"))
    te = data.where("split = 'test'").withColumn("fit_split", F.lit("test"))
    fit, val = tr.where("fit_split = 'fit'"), tr.where("fit_split = 'val'")
    score_rows = val.unionByName(te)
    rf = MD.fit_predict_trees(fit, score_rows, feats, "rf", rf_params)
    gb_train = tr.withColumn("_is_val", F.col("fit_split") == "val")
    gb = MD.fit_predict_trees(gb_train, score_rows, feats, "gbm", gbm_params, validation_col="_is_val")

    def long(df, model):
        return df.select(F.col(KEY).alias("district"), F.lit(model).alias("model"), TS, "fit_split",
                         F.col("pickups").cast("double").alias("y_true"), F.col("y_pred").cast("double"),
                         F.col("lag_1").cast("double"))
    both = materialize(long(rf, "rf").unionByName(long(gb, "lgbm")), "ensemble_predictions")
    w = FC.soft_blend_weights(M.score(both.where("fit_split = 'val'")))
    test_preds = both.where("fit_split = 'test'").drop("fit_split")
    ens = (test_preds.join(w, ["district", "model"])
                     .groupBy("district", TS, "y_true", "lag_1")
                     .agg(F.sum(F.col("y_pred") * F.col("weight")).alias("y_pred"))
                     .withColumn("model", F.lit("ensemble")))
    preds = test_preds.unionByName(ens.select(*test_preds.columns))
    return preds, _summary(ens)


def sequence_run(features: DataFrame, top_k: int = 10, seq_len: int = 24, reg: float = 1.0,
                 kind: str = "ridge") -> tuple[DataFrame, DataFrame]:
    """The sequence model re-aimed: one ridge on the flattened 24 x 14 window per district,
    from lag products, without building the windows (or boosted trees on built windows),
    predictions of the test windows mapped back to pickups with the district's min-max statistics."""
    top = F.broadcast(eda.topk_by_rows(features, top_k).select(KEY))
    sel = features.join(top, KEY, "left_semi")
    if kind == "ridge":
        scaled = materialize(sc.minmax_scale(sel, sq.SEQ_FEATURES, KEY).select(KEY, TS, *sq.SEQ_FEATURES), "sequence_rows")
        model = materialize(sq.fit_sequence_ridge(scaled, seq_len=seq_len, reg=reg), "sequence_model")
        pr = spl.sequence_split(sq.predict_sequence_ridge(scaled, model, seq_len=seq_len)).where("split = 'test'")
    else:
        seq = materialize(sq.flatten_x(sq.sequence_job(features, top_k, seq_len)), "sequence_windows")
        names = [r[KEY] for r in seq.select(KEY).distinct().collect()]      # <= top_k names
        pr = MD.fit_predict_vector(seq.where("split = 'train'"), seq.where("split = 'test'"), kind, reg, "y", KEY, names)
    stats = sc.minmax_stats(sel, ["pickups"])
    pr = pr.select(KEY, TS, F.col("y").alias("y_true"), "y_pred")
    pr = sc.minmax_inverse(sc.minmax_inverse(pr, stats, "y_true", "pickups"), stats, "y_pred", "pickups")
    preds = pr.select(F.col(KEY).alias("district"), F.lit("conv").alias("model"), TS, "y_true", "y_pred")
    summ = preds.groupBy("district").agg(M.rmse("y_true", "y_pred").alias("rmse"), M.mae("y_true", "y_pred").alias("mae"))
    summ = M.broadcast_mean(M.broadcast_mean(summ, "rmse", "mean_rmse"), "mae", "mean_mae")
    return preds, summ


def hybrid_run(rf: DataFrame, lgbm: DataFrame, conv: DataFrame, min_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """Tail-aligned stacking of three prediction series per district.
    < min_rows aligned rows: mean of the three; else the first max(10, int(0.6 n)) rows
    fit RidgeCV and ElasticNetCV, the rest (hold-out) score them, the lower hold-out RMSE
    wins (elastic net only when strictly lower). Returns (hybrid predictions, summary)."""
    al = FC.tail_align({"rf": rf, "lgbm": lgbm, "conv": conv})
    n = F.count(F.lit(1)).over(Window.partitionBy("district"))
    # the aligned table feeds five branches (two CV fits, LOO join, hold-out scoring,
    # small-district blend): write it once instead of recomputing the inputs per branch
    al = materialize(al.withColumn("n_al", n), "hybrid_aligned")
    small = al.where(F.col("n_al") < min_rows)
    big = spl.holdout_split(al.where(F.col("n_al") >= min_rows))
    feats = ["y_rf", "y_lgbm", "y_conv"]
    meta, hold = big.where("part = 'meta'"), big.where("part = 'hold'")
    rid = st.ridge_cv(meta, feats)
    en = st.elastic_net_cv(meta, feats)
    pr = st.predict(st.predict(hold, rid, feats, out="pred_ridge"), en, feats, out="pred_enet")
    sc_ = pr.groupBy("district").agg(M.rmse("y_true", "pred_ridge").alias("rmse_ridge"),
                                     M.rmse("y_true", "pred_enet").alias("rmse_enet"))
    use_enet = F.col("rmse_enet") < F.col("rmse_ridge")
    chosen = sc_.select("district", F.when(use_enet, "ElasticNet").otherwise("Ridge").alias("method"),
                        F.when(use_enet, F.col("rmse_enet")).otherwise(F.col("rmse_ridge")).alias("rmse_blend"))
    out_big = (pr.join(chosen, "district")
                 .withColumn("y_pred_blend", F.when(F.col("method") == "ElasticNet", F.col("pred_enet"))
                             .otherwise(F.col("pred_ridge"))))
    out_small = small.withColumn("y_pred_blend", FC.mean_blend(feats)).withColumn("method", F.lit("MeanBlend"))
    cols = ["district", "pos", TS, "y_true", "y_pred_blend", "y_rf", "y_lgbm", "y_conv", "method"]
    preds = out_big.select(*cols).unionByName(out_small.select(*cols))
    summary = preds.groupBy("district", "method").agg(M.rmse("y_true", "y_pred_blend").alias("rmse_blend"))
    return (preds.withColumnRenamed("y_rf", "y_pred_rf").withColumnRenamed("y_lgbm", "y_pred_lgbm")
                 .withColumnRenamed("y_conv", "y_pred_conv"), summary.select("district", "rmse_blend", "method"))


def run_all_districts(train: DataFrame, test: DataFrame, model_type: str = "ensemble", **kw):
    """(predictions, summary) of the top districts with one model type: ``ensemble`` (random
    forest and boosting, blended) or one of linear, ridge, lasso, rf, lgbm."""
    if model_type == "ensemble":
        return ensemble_run(train, test, **kw)
    return single_model_run(train, test, model_type, **kw)
