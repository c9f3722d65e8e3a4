"""The whole pipeline as one Spark application.

Steps run in order and stop at the first failure; each step's duration and status is
appended to the step log table once. Every step writes its result as a table under
``out`` and the next step reads that table: the lineage is cut at each step, so a lost
executor recomputes from the last written table, and the tables are the hand-off a
scheduler or a later run can reuse. Paths are on shared storage (the caller's ``out``).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as feat
from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators import scaling as sc
from ..operators import spatial as sp
from ..operators import splits as spl
from ..operators.runlog import log_pipeline_step
from ..sources import runs as RS
from . import modeling as MR


@dataclass
class Config:
    out: str                                  # shared output folder
    top_k: int = 10
    test_size: float = 0.2
    rf_params: dict = field(default_factory=dict)
    gbm_params: dict = field(default_factory=dict)
    seq_len: int = 24
    enable_hybrid: bool = True
    group_clean_by_file: bool = True


def _t(spark, cfg, name):
    return spark.read.parquet(f"{cfg.out}/{name}")


def _w(df: DataFrame, cfg, name, partition_by=()):
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{cfg.out}/{name}")


def run(spark: SparkSession, cfg: Config, raw_points: DataFrame, polygons: DataFrame, run_id: str | None = None) -> dict:
    """raw_points: pickup_datetime (text or timestamp), Lat, Lon[, Base][, source_file];
    polygons: cd_name, part_id, rings. Returns {step: status}."""
    run_id = run_id or RS.new_run_id("run")
    log_path = f"{cfg.out}/pipeline_log"
    status = {}

    def clean():
        group = ("source_file",) if cfg.group_clean_by_file and "source_file" in raw_points.columns else ()
        df, report = C.clean_with_report(raw_points, group_by=group)
        _w(df.select("pickup_datetime", F.col("lat").alias("Lat"), F.col("lon").alias("Lon")), cfg, "cleaned")
        _w(report, cfg, "cleaning_report")

    def preprocess():
        # district ids (INT) through the join and the per-point aggregation; names are
        # attached to the district-hour rows afterwards (a broadcast of one row per district)
        pts = sp.spatial_within_join(_t(spark, cfg, "cleaned"), polygons, key="id")
        hourly = feat.hourly_count(pts, key="district_id")
        named = hourly.join(sp.district_ids(polygons), "district_id").drop("district_id")
        _w(feat.build_features(named), cfg, "features_hourly")

    def split():
        f = spl.chrono_split(_t(spark, cfg, "features_hourly"), cfg.test_size)
        cols = [c for c in feat.FEATURE_COLUMNS if c not in ("cd_name", "pickup_datetime", "pickups")]
        stats = sc.standard_stats(f.where("split = 'train'"), cols)
        _w(sc.apply_standard(f, stats, cols), cfg, "train_test", ("split",))

    def tree_models():
        tt = _t(spark, cfg, "train_test")
        preds, summary = MR.ensemble_run(tt.where("split = 'train'").drop("split"),
                                         tt.where("split = 'test'").drop("split"), cfg.top_k,
                                         cfg.rf_params, cfg.gbm_params)
        RS.sink_run(preds, f"{cfg.out}/predictions", run_id, ("run_id", "model"))
        RS.sink_run(summary, f"{cfg.out}/summary_ensemble", run_id)

    def sequence_model():
        preds, summary = MR.sequence_run(_t(spark, cfg, "features_hourly"), cfg.top_k, cfg.seq_len)
        RS.sink_run(preds, f"{cfg.out}/predictions", run_id, ("run_id", "model"))
        RS.sink_run(summary, f"{cfg.out}/summary_sequence", run_id)

    def hybrid():
        p = RS.run_rows(spark.read.parquet(f"{cfg.out}/predictions"), run_id)
        sel = lambda m: p.where(F.col("model") == m)
        preds, summary = MR.hybrid_run(sel("rf"), sel("lgbm"), sel("conv"))
        hp = preds.select("district", F.lit("hybrid").alias("model"), "pickup_datetime", "y_true",
                          F.col("y_pred_blend").alias("y_pred"))
        RS.sink_run(hp, f"{cfg.out}/predictions", run_id, ("run_id", "model"))
        RS.sink_run(summary, f"{cfg.out}/summary_hybrid", run_id)

    def evaluate():
        p = RS.run_rows(spark.read.parquet(f"{cfg.out}/predictions"), run_id)
        ev = M.add_best_model(M.model_eval_table(p.where(F.col("model").isin(*M.EVAL_MODELS))))
        RS.sink_run(ev, f"{cfg.out}/evaluation", f"eval_{run_id}")

    def forecast():
        ev = RS.run_rows(spark.read.parquet(f"{cfg.out}/evaluation"), f"eval_{run_id}")
        p = RS.run_rows(spark.read.parquet(f"{cfg.out}/predictions"), run_id)
        tab = FC.forecast_table(ev.drop("run_id", "written_at"), p, sp.polygon_centroids(polygons))
        _w(tab, cfg, "forecast_next_hour")

    steps = [("Data cleaning", clean), ("Preprocessing", preprocess), ("Split + scale", split),
             ("District modeling", tree_models), ("Sequence model training", sequence_model)]
    if cfg.enable_hybrid:
        steps.append(("Hybrid blending", hybrid))
    steps += [("Unified evaluation on test dataset", evaluate), ("Next-hour forecast table", forecast)]
    for name, fn in steps:
        t0 = time.time()
        try:
            fn()
        except Exception as e:  # noqa: BLE001 - logged, pipeline stops
            log_pipeline_step(spark, log_path, name, "failed", round((time.time() - t0) / 60, 2), str(e))
            status[name] = "failed"
            break
        log_pipeline_step(spark, log_path, name, "success", round((time.time() - t0) / 60, 2), f"run={run_id}")
        status[name] = "success"
    if status and all(v == "success" for v in status.values()):
        if not RS.publish_latest(spark, f"{cfg.out}/evaluation", f"{cfg.out}/forecast_latest", "eval_"):
            raise ValueError("the run succeeded but left no evaluation to publish")
    return status
