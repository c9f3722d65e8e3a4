"""Registered queries: metrics, evaluation table, blending by position, forecast table and
name/label scalars (SURVEY 2.3, 2.4, 2.5, 2.8, 2.9).

Stand-in predictions (SQL-expressible, so that the whole evaluation layer has an exact
oracle) on the per-district test split of the feature table:
rf = lag_1, lgbm = (lag_1 + lag_2) / 2, conv = lag_24, hybrid = (lag_1 + lag_24) / 2.
The fitted models of :mod:`zonecast.plans.q_models` produce the same long layout.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators import spatial as sp
from . import standins as si
from .q_splits import _SPLIT_SQL, split_features
from .registry import query, r, rounded

MODELS = {"rf": "CAST(lag_1 AS DOUBLE)", "lgbm": "(lag_1 + lag_2) / 2", "conv": "CAST(lag_24 AS DOUBLE)",
          "hybrid": "(lag_1 + lag_24) / 2"}


def preds_long(spark, d, split="test"):
    t = split_features(spark, d).where(F.col("split") == split)
    items = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("double").alias("y_pred"))
                      for m, e in MODELS.items()])
    return (t.select(F.col("cd_name").alias("district"), "pickup_datetime",
                     F.col("pickups").cast("double").alias("y_true"), F.col("lag_1").cast("double").alias("lag_1"),
                     F.explode(items).alias("m"))
             .select("district", "m.model", "pickup_datetime", "y_true", "m.y_pred", "lag_1"))


PREDS_SQL = _SPLIT_SQL[len("WITH "):] + """,
preds AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT cd_name AS district, '{m}' AS model, pickup_datetime, CAST(pickups AS DOUBLE) AS y_true, "
    f"CAST({e} AS DOUBLE) AS y_pred, CAST(lag_1 AS DOUBLE) AS lag_1, split FROM sp" for m, e in MODELS.items()) + """
),
tp AS (SELECT * FROM preds WHERE split = 'test'),
ev AS (
  SELECT district, """ + ", ".join(
    f"sqrt(AVG(power(y_true - y_pred, 2)) FILTER (WHERE model = '{m}')) AS rmse_{m}, "
    f"AVG(abs(y_true - y_pred)) FILTER (WHERE model = '{m}') AS mae_{m}" for m in MODELS) + """
  FROM tp GROUP BY district
),
evb AS (
  SELECT *,
    (SELECT n FROM (VALUES (rmse_rf, 0, 'rmse_rf'), (rmse_lgbm, 1, 'rmse_lgbm'), (rmse_conv, 2, 'rmse_conv'),
                           (rmse_hybrid, 3, 'rmse_hybrid')) v(x, i, n)
     WHERE x IS NOT NULL AND NOT isnan(x) ORDER BY x, i LIMIT 1) AS best_model,
    (COALESCE(rmse_rf, 0) + COALESCE(rmse_lgbm, 0) + COALESCE(rmse_conv, 0) + COALESCE(rmse_hybrid, 0))
      / NULLIF((rmse_rf IS NOT NULL)::INT + (rmse_lgbm IS NOT NULL)::INT + (rmse_conv IS NOT NULL)::INT
               + (rmse_hybrid IS NOT NULL)::INT, 0) AS mean_rmse
  FROM ev
)"""

_GUARD = ("CASE WHEN stddev_pop(y_true) * stddev_pop(y_pred) = 0 THEN NULL "
          "ELSE covar_pop(y_true, y_pred) / (stddev_pop(y_true) * stddev_pop(y_pred)) END")


def eval_table(spark, d):
    return M.add_best_model(M.model_eval_table(preds_long(spark, d)))


@query("rmse", "WITH " + PREDS_SQL + "\nSELECT district, model, " + r("sqrt(AVG(power(y_true - y_pred, 2)))", "rmse")
       + " FROM tp GROUP BY 1, 2")
def q_rmse(spark, d):
    return rounded(preds_long(spark, d).groupBy("district", "model").agg(M.rmse("y_true", "y_pred").alias("rmse")))


@query("mae", "WITH " + PREDS_SQL + "\nSELECT district, model, " + r("AVG(abs(y_true - y_pred))", "mae")
       + " FROM tp GROUP BY 1, 2")
def q_mae(spark, d):
    return rounded(preds_long(spark, d).groupBy("district", "model").agg(M.mae("y_true", "y_pred").alias("mae")))


@query("pearson", "WITH " + PREDS_SQL + "\nSELECT district, model, " + r(_GUARD, "correlation")
       + " FROM tp GROUP BY 1, 2")
def q_pearson(spark, d):
    return rounded(preds_long(spark, d).groupBy("district", "model")
                   .agg(M.pearson("y_true", "y_pred").alias("correlation")))


_SCORE_SQL = "WITH " + PREDS_SQL + """,
sc AS (SELECT district, model, sqrt(AVG(power(y_true - y_pred, 2))) AS rmse,
              sqrt(AVG(power(y_true - lag_1, 2))) AS baseline_rmse FROM tp GROUP BY 1, 2)"""


@query("persistence_baseline", _SCORE_SQL + "\nSELECT DISTINCT district, " + r("baseline_rmse") + " FROM sc")
def q_persistence_baseline(spark, d):
    """RMSE of the lag-1 forecast per district."""
    p = preds_long(spark, d).where("model = 'rf'")
    return rounded(p.groupBy("district").agg(M.rmse("y_true", "lag_1").alias("baseline_rmse")))


@query("improvement_pct", _SCORE_SQL + "\nSELECT district, model, " + r("rmse") + ", " + r("baseline_rmse") + ", "
       + r("100.0 * (1.0 - rmse / NULLIF(baseline_rmse, 0))", "improvement_pct") + " FROM sc")
def q_improvement_pct(spark, d):
    s = M.score(preds_long(spark, d), baseline="lag_1")
    return rounded(s.select("district", "model", "rmse", "baseline_rmse", "improvement_pct"))


@query("broadcast_mean", _SCORE_SQL + "\nSELECT district, " + r("rmse", "model_rmse") + ", "
       + r("AVG(rmse) OVER ()", "mean_rmse") + " FROM sc WHERE model = 'lgbm'")
def q_broadcast_mean(spark, d):
    s = M.score(preds_long(spark, d).where("model = 'lgbm'"), ["district"]).select(
        "district", F.col("rmse").alias("model_rmse"))
    return rounded(M.broadcast_mean(s, "model_rmse", "mean_rmse"))


_EVAL_COLS = ["district"] + [f"{k}_{m}" for m in MODELS for k in ("rmse", "mae")]


@query("model_eval_table", "WITH " + PREDS_SQL + "\nSELECT district, "
       + ", ".join(r(c) for c in _EVAL_COLS[1:]) + " FROM ev")
def q_model_eval_table(spark, d):
    return rounded(M.model_eval_table(preds_long(spark, d)))


@query("row_idxmin", "WITH " + PREDS_SQL + "\nSELECT district, best_model FROM evb")
def q_row_idxmin(spark, d):
    return eval_table(spark, d).select("district", "best_model")


@query("row_mean", "WITH " + PREDS_SQL + "\nSELECT district, " + r("mean_rmse") + " FROM evb")
def q_row_mean(spark, d):
    return rounded(eval_table(spark, d).select("district", "mean_rmse"))


@query("select_by_prefix", "WITH " + PREDS_SQL + "\nSELECT district, "
       + ", ".join(r(f"rmse_{m}") for m in MODELS) + " FROM ev")
def q_select_by_prefix(spark, d):
    from ..operators.clean import select_by_prefix
    return rounded(select_by_prefix(M.model_eval_table(preds_long(spark, d)), "rmse_", keep=("district",)))


_MELT_SQL = "WITH " + PREDS_SQL + """,
melted AS (""" + " UNION ALL ".join(f"SELECT district, 'rmse_{m}' AS Model, rmse_{m} AS RMSE FROM ev" for m in MODELS) + ")"


@query("melt", _MELT_SQL + "\nSELECT district, Model, " + r("RMSE") + " FROM melted")
def q_melt(spark, d):
    return rounded(M.melt(M.model_eval_table(preds_long(spark, d))))


@query("box_stats", _MELT_SQL + "\nSELECT Model, " + ", ".join([
    r("MIN(RMSE)", "min"), r("quantile_cont(RMSE, 0.25)", "q1"), r("quantile_cont(RMSE, 0.5)", "median"),
    r("quantile_cont(RMSE, 0.75)", "q3"), r("MAX(RMSE)", "max")]) + ", COUNT(*) AS n FROM melted GROUP BY Model")
def q_box_stats(spark, d):
    return rounded(M.box_stats(M.melt(M.model_eval_table(preds_long(spark, d)))))


@query("best_model_counts", "WITH " + PREDS_SQL + """
SELECT upper(replace(best_model, 'rmse_', '')) AS model_type, COUNT(*) AS count FROM evb
WHERE best_model IS NOT NULL GROUP BY best_model""")
def q_best_model_counts(spark, d):
    return M.best_model_counts(eval_table(spark, d))


@query("model_label", "WITH " + PREDS_SQL + "\nSELECT district, upper(replace(best_model, 'rmse_', '')) AS label FROM evb")
def q_model_label(spark, d):
    return eval_table(spark, d).select("district", S.model_label("best_model").alias("label"))


@query("mean_rmse_rank", _MELT_SQL + """,
m AS (SELECT district, AVG(RMSE) AS mean_rmse FROM melted GROUP BY district)
SELECT district, """ + r("mean_rmse") + """, CAST(ROW_NUMBER() OVER (ORDER BY mean_rmse, district) AS INTEGER) AS rank
FROM m ORDER BY mean_rmse, district LIMIT 3""")
def q_mean_rmse_rank(spark, d):
    long = M.melt(M.model_eval_table(preds_long(spark, d))).withColumnRenamed("RMSE", "rmse")
    return rounded(M.mean_rmse_rank(long))


@query("color_bucket", "WITH " + PREDS_SQL + """
SELECT district, CASE WHEN rmse_conv < 20 THEN '#2ecc71' WHEN rmse_conv < 40 THEN '#f39c12' ELSE '#e74c3c' END AS color
FROM ev""")
def q_color_bucket(spark, d):
    return M.model_eval_table(preds_long(spark, d)).select("district", S.color_bucket("rmse_conv").alias("color"))


@query("example_series", "WITH " + PREDS_SQL + """
SELECT district, model, pickup_datetime, y_true, """ + r("y_pred") + """ FROM tp
WHERE district IN ('Manhattan CD 01', 'Brooklyn CD 02', 'Nowhere CD 99')""")
def q_example_series(spark, d):
    """Truth and every model's prediction over time for a fixed list of districts
    (districts without predictions are simply absent)."""
    p = preds_long(spark, d).where(F.col("district").isin("Manhattan CD 01", "Brooklyn CD 02", "Nowhere CD 99"))
    return rounded(p.select("district", "model", "pickup_datetime", "y_true", "y_pred"))


# -- blending by position ----------------------------------------------------------

def _series(spark, d):
    p = preds_long(spark, d)
    rf = p.where("model = 'rf'")
    lg = p.where("model = 'lgbm'")
    # the sequence model scores fewer rows: its first 10 test rows have no prediction
    cv = p.where("model = 'conv'")
    from pyspark.sql import Window
    cv = cv.withColumn("_p", F.row_number().over(Window.partitionBy("district").orderBy("pickup_datetime"))) \
           .where("_p > 10").drop("_p")
    return {"rf": rf, "lgbm": lg, "conv": cv}


_ALIGN_SQL = "WITH " + PREDS_SQL + """,
s_rf AS (SELECT district, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pickup_datetime DESC) AS rpos, pickup_datetime, y_true, y_pred AS y_rf
         FROM tp WHERE model = 'rf'),
s_lg AS (SELECT district, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pickup_datetime DESC) AS rpos, y_pred AS y_lgbm
         FROM tp WHERE model = 'lgbm'),
c0 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pickup_datetime) AS p FROM tp WHERE model = 'conv'),
s_cv AS (SELECT district, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pickup_datetime DESC) AS rpos, y_pred AS y_conv
         FROM c0 WHERE p > 10),
al AS (SELECT district, rpos, pickup_datetime, y_true, y_rf, y_lgbm, y_conv, COUNT(*) OVER (PARTITION BY district) - rpos AS pos
       FROM s_rf JOIN s_lg USING (district, rpos) JOIN s_cv USING (district, rpos))"""


def aligned(spark, d):
    return FC.tail_align(_series(spark, d))


@query("tail_align_join", _ALIGN_SQL + "\nSELECT district, CAST(rpos AS INTEGER) AS rpos, CAST(pos AS BIGINT) AS pos, "
       "y_true, " + ", ".join(r(c) for c in ["y_rf", "y_lgbm", "y_conv"]) + " FROM al")
def q_tail_align_join(spark, d):
    return rounded(aligned(spark, d).select("district", "rpos", "pos", "y_true", "y_rf", "y_lgbm", "y_conv"))


@query("mean_blend", _ALIGN_SQL + "\nSELECT district, pos, " + r("(y_rf + y_lgbm + y_conv) / 3", "y_pred_blend") + " FROM al")
def q_mean_blend(spark, d):
    a = aligned(spark, d)
    return rounded(a.select("district", "pos", FC.mean_blend(["y_rf", "y_lgbm", "y_conv"]).alias("y_pred_blend")))


@query("holdout_split", _ALIGN_SQL + """
SELECT district, pos, CASE WHEN ROW_NUMBER() OVER (PARTITION BY district ORDER BY pos) - 1
   < greatest(10, floor(CAST(0.6 AS DOUBLE) * COUNT(*) OVER (PARTITION BY district))) THEN 'meta' ELSE 'hold' END AS part
FROM al""")
def q_holdout_split(spark, d):
    from ..operators.splits import holdout_split
    return holdout_split(aligned(spark, d)).select("district", "pos", "part")


_SOFT_SQL = "WITH " + PREDS_SQL + """,
vs AS (SELECT district, model, sqrt(AVG(power(y_true - y_pred, 2))) AS rmse FROM preds
       WHERE split = 'train' AND model IN ('rf', 'lgbm') GROUP BY 1, 2),
wt AS (SELECT district, model, (1.0 / (rmse + 1e-6)) / SUM(1.0 / (rmse + 1e-6)) OVER (PARTITION BY district) AS weight FROM vs)"""


@query("soft_blend", _SOFT_SQL + """
SELECT t.district, t.pickup_datetime, t.y_true, """ + r("SUM(t.y_pred * w.weight)", "pred_ensemble") + """
FROM tp t JOIN wt w USING (district, model) GROUP BY 1, 2, 3""")
def q_soft_blend(spark, d):
    """rf and lgbm blended with weights 1/(validation RMSE + 1e-6), normalised per
    district (validation = the train split here)."""
    val = preds_long(spark, d, "train").where(F.col("model").isin("rf", "lgbm"))
    w = FC.soft_blend_weights(M.score(val))
    test = preds_long(spark, d).where(F.col("model").isin("rf", "lgbm"))
    return rounded(FC.soft_blend(test, w))


@query("pred_name_coalesce", _SOFT_SQL + """
SELECT t.district, t.pickup_datetime, """ + r("SUM(t.y_pred * w.weight)", "pred_next_hour") + """
FROM tp t JOIN wt w USING (district, model) GROUP BY 1, 2""")
def q_pred_name_coalesce(spark, d):
    val = preds_long(spark, d, "train").where(F.col("model").isin("rf", "lgbm"))
    test = preds_long(spark, d).where(F.col("model").isin("rf", "lgbm"))
    b = FC.soft_blend(test, FC.soft_blend_weights(M.score(val))).drop("y_true")
    return rounded(FC.pred_name_coalesce(b))


# -- forecast table ------------------------------------------------------------------

_LAST_SQL = "WITH " + PREDS_SQL + """,
lastp AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY district, model ORDER BY pickup_datetime DESC) AS rn
                         FROM tp) WHERE rn = 1),
look AS (
  SELECT e.district, upper(replace(e.best_model, 'rmse_', '')) AS model_type, l.y_pred AS pred_next_hour, l.y_true,
         CASE e.best_model WHEN 'rmse_rf' THEN rmse_rf WHEN 'rmse_lgbm' THEN rmse_lgbm WHEN 'rmse_conv' THEN rmse_conv
              ELSE rmse_hybrid END AS rmse
  FROM evb e JOIN lastp l ON l.district = e.district AND 'rmse_' || l.model = e.best_model
)"""


@query("last_row", _LAST_SQL + "\nSELECT district, model, pickup_datetime, y_true, " + r("y_pred") + " FROM lastp")
def q_last_row(spark, d):
    from ..operators.splits import last_row
    p = preds_long(spark, d).select("district", "model", "pickup_datetime", "y_true", "y_pred")
    return rounded(last_row(p, ["district", "model"], "pickup_datetime"))


@query("best_model_lookup", _LAST_SQL + "\nSELECT district, model_type, " + ", ".join(
    r(c) for c in ["pred_next_hour", "y_true", "rmse"]) + " FROM look")
def q_best_model_lookup(spark, d):
    return rounded(FC.best_model_lookup(eval_table(spark, d), preds_long(spark, d)))


_MERC_LAT = ("degrees(2 * atan(exp(((6378137.0 * ln(tan(pi() / 4 + radians(y0) / 2)) + 6378137.0 * ln(tan(pi() / 4 + "
             "radians(y1) / 2))) / 2) / 6378137.0)) - pi() / 2)")


@query("polygon_centroid", "WITH " + si.PICKUPS_SQL + ",\n" + si.DENSE_POLY_SQL + """,
c AS (SELECT cd_name, COUNT(*) AS pickups FROM pickups GROUP BY cd_name)
SELECT p.cd_name, """ + r(_MERC_LAT, "lat") + ", " + r("(x0 + x1) / 2", "lon") + """, c.pickups
FROM dpoly p LEFT JOIN c USING (cd_name)""")
def q_polygon_centroid(spark, d):
    """Area centroids (EPSG:3857) of the district polygons, back in degrees, beside the
    pickups of each district (the map markers' data)."""
    cen = sp.polygon_centroids(si.dense_district_polygons(spark))
    c = si.pickups(spark, d).groupBy("cd_name").agg(F.count(F.lit(1)).alias("pickups"))
    return rounded(cen.select("cd_name", "lat", "lon").join(c, "cd_name", "left"))


@query("forecast_table", _LAST_SQL + ",\n" + si.DENSE_POLY_SQL + """,
m AS (SELECT l.*, p.cd_name, """ + _MERC_LAT + """ AS lat, (x0 + x1) / 2 AS lon FROM look l JOIN dpoly p ON p.cd_name = l.district)
SELECT district, model_type, """ + ", ".join(r(c) for c in ["pred_next_hour", "y_true", "rmse"]) + """, cd_name, """
       + r("lat") + ", " + r("lon") + ", "
       + r("6 + (pred_next_hour - (SELECT MIN(pred_next_hour) FROM m)) * 22.0 / greatest((SELECT MAX(pred_next_hour) FROM m)"
           " - (SELECT MIN(pred_next_hour) FROM m), 1e-6)", "radius") + """,
       CASE WHEN rmse < 20 THEN '#2ecc71' WHEN rmse < 40 THEN '#f39c12' ELSE '#e74c3c' END AS color
FROM m""")
def q_forecast_table(spark, d):
    """Best model per district -> its last prediction -> polygon centroid -> radius by
    predicted demand -> colour by RMSE class."""
    cen = sp.polygon_centroids(si.dense_district_polygons(spark))
    return rounded(FC.forecast_table(eval_table(spark, d), preds_long(spark, d), cen))


@query("centroid_join", _LAST_SQL + ",\n" + si.DENSE_POLY_SQL + """
SELECT l.district, """ + r("l.pred_next_hour", "pred_next_hour") + ", " + r(_MERC_LAT, "lat") + """
FROM look l JOIN dpoly p ON p.cd_name = l.district""")
def q_centroid_join(spark, d):
    cen = sp.polygon_centroids(si.dense_district_polygons(spark))
    look = FC.best_model_lookup(eval_table(spark, d), preds_long(spark, d))
    return rounded(sp.centroid_join(look, cen).select("district", "pred_next_hour", "lat"))


# -- names and labels ----------------------------------------------------------------

@query("district_name", """
SELECT c_custkey,
  CASE substr(CAST((c_nationkey % 5 + 1) * 100 + c_custkey % 13 AS VARCHAR), 1, 1)
    WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn' WHEN '4' THEN 'Queens'
    WHEN '5' THEN 'Staten Island' ELSE 'Unknown' END || ' CD ' || substr(CAST((c_nationkey % 5 + 1) * 100 + c_custkey % 13 AS VARCHAR), 2) AS name_features,
  CASE substr(CAST(c_custkey + 1000 AS VARCHAR), 1, 1)
    WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn' WHEN '4' THEN 'Queens'
    WHEN '5' THEN 'Staten Island' ELSE 'Unknown' END || ' CD ' || printf('%02d', CAST(substr(CAST(c_custkey + 1000 AS VARCHAR), 2) AS INTEGER)) AS name_padded,
  CASE WHEN length(CAST(c_custkey + 95 AS VARCHAR)) = 3 THEN
    CASE substr(CAST(c_custkey + 95 AS VARCHAR), 1, 1)
      WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn' WHEN '4' THEN 'Queens'
      WHEN '5' THEN 'Staten Island' ELSE 'Unknown' END || ' CD ' || substr(CAST(c_custkey + 95 AS VARCHAR), 2)
    ELSE 'CD_' || CAST(c_custkey + 95 AS VARCHAR) END AS name_survey
FROM customer""")
def q_district_name(spark, d):
    """District names from codes derived from customers (3-digit codes for the feature
    rule, 4-digit ones for the padded rule, mixed lengths for the survey rule)."""
    c = si.table(spark, d, "customer")
    code3 = (F.col("c_nationkey") % 5 + 1) * 100 + F.col("c_custkey") % 13
    return c.select("c_custkey",
                    S.district_name(code3, "features").alias("name_features"),
                    S.district_name(F.col("c_custkey") + 1000, "padded").alias("name_padded"),
                    S.district_name(F.col("c_custkey") + 95, "survey").alias("name_survey"))


@query("slugify_tree", """
SELECT c_custkey, trim(lower(regexp_replace(c_mktsegment || ' / ' || c_name, '[^\\p{L}\\p{N}]', '_', 'g')), '_') AS slug
FROM customer""")
def q_slugify_tree(spark, d):
    c = si.table(spark, d, "customer")
    return c.select("c_custkey", S.slugify_tree(F.concat_ws(" / ", "c_mktsegment", "c_name")).alias("slug"))


@query("slugify_collapse", """
SELECT c_custkey, regexp_replace(translate(lower(trim(' ' || c_mktsegment || ' / ' || c_name || ' ')), ' /', '__'), '_{2,}', '_', 'g') AS slug
FROM customer""")
def q_slugify_collapse(spark, d):
    c = si.table(spark, d, "customer")
    s = F.concat(F.lit(" "), F.concat_ws(" / ", "c_mktsegment", "c_name"), F.lit(" "))
    return c.select("c_custkey", S.slugify_collapse(s).alias("slug"))


@query("zfill_timestamp", "WITH " + si.PARTS_SQL + """
SELECT DISTINCT cd_name, Month, Day, Hour,
  try_strptime('1900-' || lpad(CAST(Month AS VARCHAR), 2, '0') || '-' || lpad(CAST(Day AS VARCHAR), 2, '0') || ' '
               || lpad(CAST(Hour AS VARCHAR), 2, '0'), '%Y-%m-%d %H') AS timestamp
FROM parts""")
def q_zfill_timestamp(spark, d):
    """Pseudo time index 'MM-DD HH' of the autocorrelation step (no year: 1900, so a
    29 February gives NULL)."""
    p = si.pickups_with_parts(spark, d).select("cd_name", "Month", "Day", "Hour").distinct()
    return p.withColumn("timestamp", S.pseudo_timestamp("Month", "Day", "Hour"))


@query("popup_text", "WITH " + si.GRID_SQL + """,
c AS (SELECT cd_name, COUNT(*) AS count FROM gpts GROUP BY cd_name),
pc AS (SELECT cd_name, count, round_even(count / (SELECT SUM(count) FROM c) * 100, 2) AS percentage FROM c)
SELECT cd_name, printf('%s: %d pickups (%.2f%% of total)', cd_name, count, percentage) AS popup FROM pc""")
def q_popup_text(spark, d):
    from ..operators import eda
    from .q_spatial import grid_points
    st = eda.district_stats(grid_points(spark, d))
    return st.select("cd_name", F.format_string("%s: %d pickups (%.2f%% of total)", "cd_name", "count",
                                                "percentage").alias("popup"))


@query("marker_size", "WITH " + si.PICKUPS_SQL + """,
h AS (SELECT round_even(Lat, 3) AS Lat_round, round_even(Lon, 3) AS Lon_round, COUNT(*) AS Count
      FROM pickups GROUP BY 1, 2 ORDER BY Count DESC, Lat_round, Lon_round LIMIT 10)
SELECT Lat_round, Lon_round, Count, """ + r("6.0 + Count / (SELECT MAX(Count) FROM h) * 10.0", "marker_size") + " FROM h")
def q_marker_size(spark, d):
    from ..operators import eda
    return rounded(FC.marker_size(eda.hotspots(si.pickups(spark, d)), "Count"))


@query("residuals", "WITH " + PREDS_SQL + """
SELECT pickup_datetime, y_true AS Actual, round_even(y_pred, 2) AS Predicted, lag_1 AS Baseline,
       round_even(y_true - y_pred, 2) AS Pred_Error, round_even(y_true - lag_1, 2) AS Base_Error
FROM tp WHERE district = 'Manhattan CD 01' AND model = 'lgbm' ORDER BY pickup_datetime LIMIT 10""")
def q_residuals(spark, d):
    """First 10 test predictions of one district beside the lag-1 baseline (the
    reference's eyeballed comparison table)."""
    p = preds_long(spark, d).where((F.col("district") == "Manhattan CD 01") & (F.col("model") == "lgbm"))
    return M.residuals(p)
