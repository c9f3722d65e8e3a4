"""Registered queries for the operators that are otherwise only exercised inside other
queries: readers and sinks round-tripping data derived from the test tables, name
checks, the clustering pieces, and the job-level compositions (SURVEY 2.1-2.12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators import clustering as CL
from ..operators import eda
from ..operators import features as feat
from ..operators import forecast as FC
from ..operators import runlog as RL
from ..operators import spatial as sp
from ..session import materialize, scratch_path
from ..sources import files as FS
from ..sources import runs as RS
from ..sources.polygons import grid_polygons, scan_polygons
from . import standins as si
from .q_eval import _LAST_SQL, _series, eval_table, preds_long, PREDS_SQL
from .q_spatial import _TOP_GRID_SQL, grid_points
from .registry import query, r, rounded


# -- sources and sinks -------------------------------------------------------------

def _files_with_bad_ones(spark, d):
    """Raw files, a file without coordinates (orders), a missing path, an empty file and a
    compressed file that ends too early."""
    base = scratch_path(spark, "skip")
    si.raw_pickups(spark, d).write.option("header", True).csv(f"{base}/good")
    si.table(spark, d, "orders").select("o_orderkey", "o_orderdate") \
        .write.option("header", True).csv(f"{base}/bad")
    files = [f for sub in ("good", "bad") for f in spark.read.text(f"{base}/{sub}").inputFiles()]
    # the beginning of a compressed file of the same rows, and a file without any
    si.raw_pickups(spark, d).withColumnRenamed("Date/Time", "pickup_datetime").write.option(
        "header", True).option("compression", "gzip").csv(f"{base}/whole")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    whole = jvm.org.apache.hadoop.fs.Path(spark.read.text(f"{base}/whole").inputFiles()[0])
    fs = whole.getFileSystem(conf)
    stream = fs.open(whole)
    begin = bytes(stream.readNBytes(min(1 << 16, fs.getFileStatus(whole).getLen() // 2)))
    stream.close()
    for name, body in (("cut.csv.gz", begin), ("empty.csv", b"")):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{base}/{name}"))
        out.write(bytearray(body))
        out.close()
        files.append(f"{base}/{name}")
    return [*files, f"{base}/missing.csv"]


@query("scan_skip_bad_file", "WITH " + si.PICKUPS_SQL + """
SELECT date_trunc('second', pickup_datetime) AS pickup_datetime, Lat, Lon FROM pickups""")
def q_scan_skip_bad_file(spark, d):
    """Of good and bad files the good ones are read as one table."""
    return FS.scan_many_union(spark, _files_with_bad_ones(spark, d)).select("pickup_datetime", "Lat", "Lon")


@query("skipped_files", """SELECT * FROM (VALUES ('bad', 'no columns'), ('cut.csv.gz', 'unreadable'), ('empty.csv', 'empty'),
('missing.csv', 'missing')) AS v(file, reason) WHERE (SELECT COUNT(*) FROM orders) > 0""")
def q_skipped_files(spark, d):
    """The bad files and why they were skipped."""
    report = FS.scan_many_report(spark, _files_with_bad_ones(spark, d))[1]
    why = (F.when(F.col("reason").startswith("no time"), "no columns").when(F.col("reason") == "empty file", "empty")
           .when(F.col("reason").contains("PATH_NOT_FOUND"), "missing").otherwise("unreadable"))
    name = F.when(F.col("file").contains("/bad/"), "bad").otherwise(F.substring_index("file", "/", -1))
    return report.select(name.alias("file"), why.alias("reason")).distinct()


@query("scan_skip_bad_rows", "WITH " + si.RUNLOG_SQL + """
SELECT timestamp_utc, step, status, duration_min, CASE WHEN status = 'failed' THEN NULL ELSE details END AS details
FROM runlog WHERE status IS NOT NULL""")
def q_scan_skip_bad_rows(spark, d):
    """The step log as text with long rows (pending orders: one extra field, dropped)
    and short rows (failed ones: no details field, padded with NULL)."""
    log = si.run_log(spark, d)
    body = log.select(F.when(F.col("status").isNull(),
                             F.concat_ws(",", "timestamp_utc", "step", F.lit(""), "duration_min", "details", F.lit("x")))
                      .when(F.col("status") == "failed",
                            F.concat_ws(",", "timestamp_utc", "step", "status", "duration_min"))
                      .otherwise(F.concat_ws(",", "timestamp_utc", "step", "status", "duration_min", "details"))
                      .alias("value"))
    path = scratch_path(spark, "log_txt")
    body.write.text(path)
    return RL.read_log_csv(spark, path)


@query("scan_polygons", "WITH " + si.GRID_SQL + "\nSELECT cd_name, COUNT(*) AS count FROM gpts GROUP BY cd_name")
def q_scan_polygons(spark, d):
    """The fallback grid written as a GeoJSON FeatureCollection, read back with the
    GeoJSON reader and used for the point-in-polygon join."""
    g = grid_polygons(spark)
    coords = F.transform(F.col("rings"), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    feats = g.select(F.struct(F.lit("Feature").alias("type"),
                              F.struct(F.col("cd_name")).alias("properties"),
                              F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))
                     .alias("f"))
    doc = feats.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                       F.collect_list("f").alias("features"))).alias("value"))
    path = scratch_path(spark, "geojson")
    doc.coalesce(1).write.text(path)
    polys = scan_polygons(spark, path, name_col="cd_name")
    pts = sp.spatial_within_join(si.pickups(spark, d).drop("cd_name"), polys)
    return pts.groupBy("cd_name").agg(F.count(F.lit(1)).alias("count"))


@query("grid_polygons", "WITH " + si.GRID_SQL + """
SELECT g.cd_name, """ + ", ".join(r(c) for c in ["x0", "x1", "y0", "y1"]) + """, COUNT(p.event_id) AS count
FROM gridc g LEFT JOIN gpts p USING (cd_name) GROUP BY g.cd_name, x0, x1, y0, y1""")
def q_grid_polygons(spark, d):
    """The 5 x 5 fallback grid (cell bounds) with the pickups inside each cell."""
    g = grid_polygons(spark)
    ext = F.get(F.col("rings"), 0)
    b = g.select("cd_name", F.get(ext, 0)["x"].alias("x0"), F.get(ext, 2)["x"].alias("x1"),
                 F.get(ext, 0)["y"].alias("y0"), F.get(ext, 2)["y"].alias("y1"))
    c = grid_points(spark, d).groupBy("cd_name").agg(F.count(F.lit(1)).alias("count"))
    return rounded(b.join(c, "cd_name", "left").fillna(0, subset=["count"]))


@query("scan_by_filename_key", "WITH " + PREDS_SQL + """
SELECT lower(replace(regexp_replace(lower(district), '[^a-z0-9]', '_', 'g'), '_', ' ')) AS district_key,
       pickup_datetime, y_true, """ + r("y_pred") + " FROM tp WHERE model = 'rf'")
def q_scan_by_filename_key(spark, d):
    """Per-district prediction files named rf_preds_<slug> written and read back with the
    district key parsed from the path."""
    p = preds_long(spark, d).where("model = 'rf'")
    path = scratch_path(spark, "per_district")
    (p.withColumn("file", F.concat(F.lit("rf_preds_"), S.slugify_tree("district")))
      .select("file", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
              "y_true", "y_pred")
      .write.partitionBy("file").option("header", True).csv(path))
    schema = "pickup_datetime string, y_true double, y_pred double"
    df = FS.scan_by_filename_key(spark, path, "rf_preds_", schema)
    return rounded(df.select("district_key", F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
                             "y_true", "y_pred"))


@query("latest_run_by_name", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM hourly")
def q_latest_run_by_name(spark, d):
    path = scratch_path(spark, "runs_name")
    h = feat.hourly_count(si.pickups(spark, d))
    RS.sink_run(h.withColumn("pickups", F.col("pickups") + 1), path, "hourly_20240101_000000")
    RS.sink_run(h, path, "hourly_20240301_000000")
    RS.sink_run(h.withColumn("pickups", F.col("pickups") + 2), path, "other_20250101_000000")
    return RS.latest_run_by_name(spark.read.parquet(path), "hourly_").select("cd_name", "pickup_datetime", "pickups")


@query("sink_csv", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM hourly")
def q_sink_csv(spark, d):
    path = scratch_path(spark, "sink_csv")
    FS.sink_csv(feat.hourly_count(si.pickups(spark, d)), path)
    return FS.scan_csv(spark, path, "cd_name string, pickup_datetime timestamp_ntz, pickups long")


@query("sink_append_log", "WITH " + si.RUNLOG_SQL + """
SELECT * FROM runlog UNION ALL SELECT 'now', 'self check', 'success', '0.5', 'rows=' || COUNT(*) FROM runlog""")
def q_sink_append_log(spark, d):
    """Log rows appended in batches and a step logged through ``log_pipeline_step``, read back
    (the time of the run shown as ``now``)."""
    path = scratch_path(spark, "append_log")
    log = si.run_log(spark, d)
    RL.append_log(log.where(F.col("status").isNull()), path)
    RL.append_log(log.where(F.col("status").isNotNull()), path)
    RL.log_pipeline_step(spark, path, "self check", "success", 0.5, f"rows={log.count()}")
    return spark.read.parquet(path).withColumn("timestamp_utc", F.when(F.col("step") == "self check", "now").otherwise(F.col("timestamp_utc")))


@query("publish_latest", "WITH " + PREDS_SQL + "\nSELECT district, " + ", ".join(
    r(f"rmse_{m}") for m in ("rf", "lgbm", "conv", "hybrid")) + ", best_model FROM evb")
def q_publish_latest(spark, d):
    """Two evaluation runs written; the newest is published to the fixed 'latest' table."""
    ev = eval_table(spark, d).select("district", "rmse_rf", "rmse_lgbm", "rmse_conv", "rmse_hybrid", "best_model")
    path, out = scratch_path(spark, "evals"), scratch_path(spark, "latest")
    RS.sink_run(ev.withColumn("rmse_rf", F.lit(-1.0)), path, "eval_20240101_000000")
    RS.sink_run(ev, path, "eval_20240201_000000")
    if not RS.publish_latest(spark, path, out, "eval_"):
        raise RuntimeError("nothing published")
    return rounded(spark.read.parquet(out).drop("run_id", "written_at"))


@query("sink_eda_tables", "WITH " + _TOP_GRID_SQL + """,
pts AS (SELECT * FROM gpts WHERE cd_name IN (SELECT cd_name FROM top)),
vals AS (SELECT DISTINCT Hour FROM pts),
cnt AS (SELECT Hour, cd_name, COUNT(*) AS n FROM pts GROUP BY 1, 2)
SELECT v.Hour, t.cd_name, COALESCE(c.n, 0) AS pickups
FROM vals v CROSS JOIN top t LEFT JOIN cnt c ON c.Hour = v.Hour AND c.cd_name = t.cd_name""")
def q_sink_eda_tables(spark, d):
    """The EDA tables written; the hour x district table read back (long form)."""
    from .q_eda import _top_grid_names
    out = scratch_path(spark, "eda")
    paths = eda.sink_eda_tables(grid_points(spark, d), _top_grid_names(spark, d), out)
    return eda.long_from_pivot(spark.read.parquet(paths[0]), "Hour")


@query("model_store", "WITH " + si.FEATURES_SQL + """
SELECT cd_name, pickup_datetime, TRUE AS linear_equal, TRUE AS trees_equal, 'models_20240102_000000' AS run_id FROM features""")
def q_model_store(spark, d):
    """Two runs of models saved as rows (linear coefficients, boosted trees); the latest one
    loaded and applied beside the models it came from, which give the same predictions."""
    from ..operators import models as MD
    from .q_splits import features
    f = materialize(features(spark, d), "model_store_features")
    feats = ["lag_1", "lag_2", "lag_24", "rolling_mean_3h", "sin_hour", "cos_hour"]
    path = scratch_path(spark, "models")
    for run_id, rounds in (("models_20240101_000000", 2), ("models_20240102_000000", 20)):
        coefs = MD.fit_linear(f, feats, "ridge")
        model = MD.fit_trees(f, feats, "gbm", {"rounds": rounds})
        RS.save_models(path, run_id, feats, linear=coefs, trees=model)
    store = RS.load_models(spark, path, "models_")
    out = MD.predict_linear(f, coefs, feats, out="l0")
    out = MD.predict_linear(out, store["linear"], store["features"], out="l1")
    out = MD.trees.predict(MD.trees.predict(out, model, feats, out="t0"), store["trees"], store["features"], out="t1")
    return out.select("cd_name", "pickup_datetime", (F.col("l0") == F.col("l1")).alias("linear_equal"),
                      (F.col("t0") == F.col("t1")).alias("trees_equal"), F.lit(store["run_id"]).alias("run_id"))


# -- names and checks --------------------------------------------------------------

@query("resolve_aliases", "WITH " + si.RAW_SQL + """
SELECT "Date/Time" AS pickup_datetime, Lat, Lon, Base FROM raw""")
def q_resolve_aliases(spark, d):
    raw = si.raw_pickups(spark, d).toDF("Pickup Time", "latitude", "LNG", "Base")
    return C.resolve_aliases(raw)


@query("require_latlon", "WITH " + si.PICKUPS_SQL + """
SELECT pickup_datetime, Lat, Lon, 1 AS pickups FROM pickups""")
def q_require_latlon(spark, d):
    p = si.pickups(spark, d).select("pickup_datetime", F.col("Lat").alias("pickup_latitude"),
                                    F.col("Lon").alias("pickup_longitude"))
    return C.require_latlon(p)


@query("require_columns", "WITH " + si.FEATURES_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM features")
def q_require_columns(spark, d):
    from .q_splits import features
    from ..operators.sequences import SEQ_FEATURES
    f = C.require_columns(features(spark, d), SEQ_FEATURES)
    return f.select("cd_name", "pickup_datetime", "pickups")


@query("drop_geometry", "WITH " + si.GRID_SQL + "\nSELECT event_id, pickup_datetime, Lat, Lon, cd_name FROM gpts")
def q_drop_geometry(spark, d):
    """Joined points as a plain table: the polygon side's geometry (rings, cell keys) is
    dropped inside the join; here the remaining helper columns are dropped too."""
    j = grid_points(spark, d)
    extra = [c for c in j.columns if c not in ("event_id", "pickup_datetime", "Lat", "Lon", "cd_name")]
    return C.drop_columns(j, *extra)


@query("distinct", "WITH " + si.PICKUPS_SQL + "\nSELECT DISTINCT cd_name, Base FROM pickups")
def q_distinct(spark, d):
    return si.pickups(spark, d).select("cd_name", "Base").distinct()


@query("sort_time", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM hourly")
def q_sort_time(spark, d):
    """Chronological order of the output (order is applied at the end only)."""
    return feat.hourly_count(si.pickups(spark, d)).orderBy("pickup_datetime", "cd_name")


@query("rank_number", "WITH " + _TOP_GRID_SQL + "\nSELECT cd_name, rank FROM top")
def q_rank_number(spark, d):
    return eda.topk_by_pickups(grid_points(spark, d)).select("cd_name", "rank")


@query("minmax_radius", _LAST_SQL + """
SELECT district, """ + r("6 + (pred_next_hour - (SELECT MIN(pred_next_hour) FROM look)) * 22.0 / "
                         "greatest((SELECT MAX(pred_next_hour) FROM look) - (SELECT MIN(pred_next_hour) FROM look), 1e-6)",
                         "radius") + " FROM look")
def q_minmax_radius(spark, d):
    look = FC.best_model_lookup(eval_table(spark, d), preds_long(spark, d))
    return rounded(FC.minmax_radius(look).select("district", "radius"))


@query("model_presence_join", "WITH " + PREDS_SQL + """,
c0 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pickup_datetime) AS p FROM tp WHERE model = 'conv')
SELECT DISTINCT a.district FROM tp a JOIN tp b ON a.district = b.district AND b.model = 'lgbm'
JOIN c0 c ON c.district = a.district AND c.p > 10 WHERE a.model = 'rf'""")
def q_model_presence_join(spark, d):
    """Districts that have rf, lgbm and sequence-model predictions (inner joins on the key)."""
    s = _series(spark, d)
    keys = [df.select("district").distinct() for df in s.values()]
    out = keys[0]
    for k in keys[1:]:
        out = out.join(k, "district", "inner")
    return out


# -- clustering pieces, with given centres (the fit itself is ``kmeans_assign``) ----------

# four centres in the city box and one far away, which receives no point
CENTRES = [(0, 40.58, -74.02), (1, 40.66, -73.93), (2, 40.83, -73.98), (3, 40.91, -73.72), (4, 10.0, 10.0)]
_CLUSTER_SQL = "WITH " + si.PICKUPS_SQL + """,
cen(Cluster, clat, clon) AS (VALUES """ + ", ".join(f"({k}, CAST({a} AS DOUBLE), CAST({o} AS DOUBLE))" for k, a, o in CENTRES) + """),
asg AS (SELECT event_id, any_value(Lat) AS Lat, any_value(Lon) AS Lon,
          CAST(arg_min(Cluster, (Lat - clat) * (Lat - clat) + (Lon - clon) * (Lon - clon)) AS INTEGER) AS Cluster
        FROM pickups, cen GROUP BY event_id),
rep AS (SELECT asg.Cluster, COUNT(*) AS Pickups, round_even(COUNT(*) / (SELECT COUNT(*) FROM asg) * 100, 2) AS Pct_of_Total,
          round(AVG(Lat), 6) AS Avg_Lat, round(AVG(Lon), 6) AS Avg_Lon,
          round_even(AVG(sqrt((Lat - clat) * (Lat - clat) + (Lon - clon) * (Lon - clon))), 4) AS Radius
        FROM asg JOIN cen USING (Cluster) GROUP BY asg.Cluster)
"""


def _assigned(spark, d):
    cents = spark.createDataFrame(CENTRES, "Cluster int, Centroid_Lat double, Centroid_Lon double")
    return CL.assign_nearest(si.pickups(spark, d), cents), cents


@query("cluster_summary", _CLUSTER_SQL + "SELECT Cluster, Pickups, Avg_Lat, Avg_Lon, Pct_of_Total FROM rep")
def q_cluster_summary(spark, d):
    a, _ = _assigned(spark, d)
    return rounded(CL.cluster_summary(a))


@query("cluster_radius", _CLUSTER_SQL + "SELECT Cluster, Radius FROM rep")
def q_cluster_radius(spark, d):
    a, c = _assigned(spark, d)
    return rounded(CL.cluster_radius(a, c))


@query("cluster_left_join", _CLUSTER_SQL + """
SELECT CAST(cen.Cluster AS INTEGER) AS Cluster, Pickups, Pct_of_Total, Avg_Lat, Avg_Lon, Radius FROM cen LEFT JOIN rep ON rep.Cluster = cen.Cluster""")
def q_cluster_left_join(spark, d):
    """Centroids left-joined with the per-cluster statistics (one of them is empty)."""
    return rounded(CL.cluster_report(*_assigned(spark, d)))


# -- job-level compositions ---------------------------------------------------------

@query("sequence_job", "WITH " + si.FEATURES_SQL + """,
topd AS (SELECT cd_name FROM (SELECT cd_name, COUNT(*) AS n FROM features GROUP BY cd_name) ORDER BY n DESC, cd_name LIMIT 10),
s AS (SELECT * FROM features WHERE cd_name IN (SELECT cd_name FROM topd)),
w AS (SELECT cd_name, pickup_datetime,
             COUNT(*) OVER (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS len
      FROM s),
q AS (SELECT * FROM w WHERE len = 24),
q2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cd_name ORDER BY pickup_datetime) - 1 AS idx,
              COUNT(*) OVER (PARTITION BY cd_name) AS n FROM q)
SELECT cd_name, pickup_datetime, CASE WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train'
            WHEN idx < floor(CAST(0.9 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split FROM q2""")
def q_sequence_job(spark, d):
    """prepare-sequences job: which rows become windows and their split."""
    from ..operators.sequences import sequence_job
    from .q_splits import features
    return sequence_job(features(spark, d)).select("cd_name", "pickup_datetime", "split")


def _single_runs_sql() -> str:
    from .q_models import _linear_sql
    return "\nUNION ALL\n".join(f"SELECT *, '{k}' AS model_type FROM ({_linear_sql(k)})" for k in ("linear", "ridge", "lasso"))


@query("single_model_run", _single_runs_sql())
def q_single_model_run(spark, d):
    """The linear model types one after the other, per top-10 district, with the lag-1
    comparison and the type of each row (the tree types are ``rf_fit`` and ``gbm_fit``)."""
    from . import modeling as MR
    from .q_models import train_test
    tr, te = (materialize(t, "single_runs") for t in train_test(spark, d))    # the features once, not per type
    parts = [MR.single_model_run(tr, te, kind)[1].withColumn("model_type", F.lit(kind)) for kind in ("linear", "ridge", "lasso")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("run_all_districts")
def q_run_all_districts(spark, d):
    """All top-10 districts with the default model type, the blended ensemble."""
    from . import modeling as MR
    from .q_models import train_test
    tr, te = train_test(spark, d)
    return rounded(MR.run_all_districts(tr, te)[1])


@query("gbm_early_stop")
def q_gbm_early_stop(spark, d):
    """Boosting of up to 5,000 rounds with early stopping on the 14-day validation cut, all
    districts in one job: rounds fitted, the round of least validation error (the trees
    kept), and whether the patience of 200 rounds ran out."""
    from ..operators import models as MD
    from ..operators import splits as spl
    from . import modeling as MR
    from .q_models import train_test
    tr, te = train_test(spark, d)
    data = spl.cutoff_split(MR.relag_train_test(tr, te, MR.top_names(tr)).where("split = 'train'"))
    model = MD.trees.fit_boosted(data.withColumn("_is_val", F.col("fit_split") == "val"), MD.BASE_FEATURES + MD.ENSEMBLE_EXTRA,
                                 valid_col="_is_val")
    got = model.groupBy("cd_name").agg(F.count(F.lit(1)).alias("rounds"), F.count_if("kept").alias("n_trees"),
                                       F.min("valid_rmse").alias("least_valid_rmse"), F.first("base").alias("base"))
    return rounded(got.select("cd_name", "rounds", "n_trees", "least_valid_rmse",
                              (F.col("rounds") - F.col("n_trees") == MD.trees.BOOST["patience"]).alias("patience_ran_out")))


@query("end_to_end_run")
def q_end_to_end_run(spark, d):
    """The whole pipeline (clean -> spatial join -> features -> split -> tree ensemble ->
    sequence model -> hybrid -> evaluation -> forecast table) on the dirty raw stand-in;
    returns the forecast table with the number of steps logged as successful and of rows
    that cleaning took in and left."""
    from .runner import Config, run
    raw = si.dirty_pickups(spark, d).select("Date/Time", "Lat", "Lon", "Base", F.concat(F.col("Base"), F.lit(".csv")).alias("source_file"))
    out = scratch_path(spark, "end_to_end")
    status = run(spark, Config(out=out), raw,
                 si.dense_district_polygons(spark), run_id="run_" + _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S"))
    if not all(v == "success" for v in status.values()):
        raise RuntimeError(f"pipeline failed: {status}")
    log = spark.read.parquet(f"{out}/pipeline_log").where("status = 'success'")
    rows = spark.read.parquet(f"{out}/cleaning_report").agg(F.max("rows_before").alias("rows_in"), F.min("rows_after").alias("rows_kept"))
    return spark.read.parquet(f"{out}/forecast_next_hour").withColumns(
        {"steps_done": log.agg(F.count(F.lit(1))).scalar(), "rows_in": rows.select("rows_in").scalar(), "rows_kept": rows.select("rows_kept").scalar()})
