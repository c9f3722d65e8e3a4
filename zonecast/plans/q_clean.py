"""Registered queries: cleaning operators on the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as feat
from . import standins as si
from .q_features import features_all
from .registry import query, r, rounded


def _lower_points(spark, d):
    return si.pickups(spark, d).select("event_id", F.col("Lat").alias("lat"), F.col("Lon").alias("lon"), "Base")


@query("normalize_colnames", "WITH " + si.RAW_SQL + """
SELECT "Date/Time" AS "date/time", Lat AS lat, Lon AS lon, Base AS base FROM raw""")
def q_normalize_colnames(spark, d):
    raw = si.raw_pickups(spark, d).toDF(" Date/Time", "Lat ", "Lon", "Base")
    return C.normalize_colnames(raw)


@query("resolve_time_alias", "WITH " + si.RAW_SQL + """
SELECT "Date/Time" AS pickup_datetime, Lat AS lat, Lon AS lon, Base AS base FROM raw""")
def q_resolve_time_alias(spark, d):
    return C.resolve_time_alias(C.normalize_colnames(si.raw_pickups(spark, d)))


@query("parse_ts_coerce", "WITH " + si.DIRTY_SQL + """
SELECT event_id, pickup_datetime FROM dirty WHERE pickup_datetime IS NOT NULL""")
def q_parse_ts_coerce(spark, d):
    """Times written in eight forms and some that are none."""
    p = si.dirty_pickups(spark, d).select("event_id", F.col("Date/Time").alias("pickup_datetime"))
    return C.parse_ts_coerce(p, "pickup_datetime")


@query("unparsed_times", "WITH " + si.PICKUPS_SQL + """
SELECT shape, COUNT(*) AS n, MIN(bad) AS example FROM (
  SELECT CASE event_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '13/45/2014' WHEN 2 THEN '2014-02-30' END AS bad,
         CASE event_id % 4 WHEN 0 THEN 'a/a' WHEN 1 THEN '99/99/9999' WHEN 2 THEN '9999-99-99' END AS shape
  FROM pickups, range(2) copies(c) WHERE event_id % 9 = 8 AND (c = 0 OR event_id % 20 = 0)) WHERE bad IS NOT NULL GROUP BY shape""")
def q_unparsed_times(spark, d):
    """What the coercing parse drops: the shapes of unreadable times, counted."""
    from ..functions.timestamps import unparsed_shapes
    return unparsed_shapes(si.dirty_pickups(spark, d), "Date/Time")


@query("drop_null_subset", "WITH " + si.FEATURES_ALL_SQL + """
SELECT cd_name, pickup_datetime, pickups, lag_1, lag_2, lag_24 FROM feat_all
WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_24 IS NOT NULL""")
def q_drop_null_subset(spark, d):
    f = features_all(spark, d).select("cd_name", "pickup_datetime", "pickups", "lag_1", "lag_2", "lag_24")
    return C.drop_null_subset(f, ["lag_1", "lag_2", "lag_24"])


@query("dedup_all", "WITH " + si.PICKUPS_SQL + """
SELECT DISTINCT cd_name, CAST(hour(pickup_datetime) AS INTEGER) AS hour, Base FROM pickups""")
def q_dedup_all(spark, d):
    p = si.pickups(spark, d).select("cd_name", F.hour("pickup_datetime").alias("hour"), "Base")
    return C.dedup_all(p)


@query("dedup_subset", "WITH " + si.DIRTY_SQL + """
SELECT DISTINCT event_id, Lat, Lon, Base FROM dirty""")
def q_dedup_subset(spark, d):
    """One row per event of a source that writes every twentieth twice."""
    return C.dedup_subset(si.dirty_pickups(spark, d).select("event_id", "Lat", "Lon", "Base"), ["event_id", "Base"])


_IQR_SQL = si.DIRTY_SQL + """,
q AS (
  SELECT quantile_cont(Lat, 0.25) AS la1, quantile_cont(Lat, 0.75) AS la3,
         quantile_cont(Lon, 0.25) AS lo1, quantile_cont(Lon, 0.75) AS lo3 FROM dirty
),
b AS (
  SELECT la1 - 1.5 * (la3 - la1) AS lat_lo, la3 + 1.5 * (la3 - la1) AS lat_hi,
         lo1 - 1.5 * (lo3 - lo1) AS lon_lo, lo3 + 1.5 * (lo3 - lo1) AS lon_hi FROM q
)"""


@query("iqr_filter", "WITH " + _IQR_SQL + """
SELECT event_id, Lat AS lat, Lon AS lon, Base FROM dirty, b
WHERE Lat BETWEEN lat_lo AND lat_hi AND Lon BETWEEN lon_lo AND lon_hi""")
def q_iqr_filter(spark, d):
    """Points with far outliers and repeated rows."""
    p = si.dirty_pickups(spark, d).select("event_id", F.col("Lat").alias("lat"), F.col("Lon").alias("lon"), "Base")
    return C.iqr_filter(p, ("lat", "lon"))


_EV_IQR_GROUP_SQL = """
q AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type
)"""


@query("iqr_filter_grouped", "WITH " + _EV_IQR_GROUP_SQL + """
SELECT e.event_id, e.event_type, e.value FROM events e JOIN q USING (event_type)
WHERE e.value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def q_iqr_filter_grouped(spark, d):
    """IQR bounds per group (the reference computes them per input file)."""
    ev = si.table(spark, d, "events").select("event_id", "event_type", "value")
    return C.iqr_filter(ev, ("value",), group_by=("event_type",))


@query("iqr_outliers", """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def q_iqr_outliers(spark, d):
    ev = si.table(spark, d, "events").select("event_id", "value")
    return C.iqr_outliers(ev, ("value",))


@query("quantiles", "WITH " + si.PICKUPS_SQL + """
SELECT """ + ", ".join([r("quantile_cont(Lat, 0.25)", "q25"), r("quantile_cont(Lat, 0.5)", "q50"),
                        r("quantile_cont(Lat, 0.75)", "q75")]) + " FROM pickups")
def q_quantiles(spark, d):
    return rounded(C.exact_quantiles(si.pickups(spark, d), "Lat", (0.25, 0.5, 0.75)))


@query("bbox_filter", "WITH " + si.PICKUPS_SQL + """
SELECT event_id, Lat AS lat, Lon AS lon, Base FROM pickups
WHERE Lat BETWEEN 40.5 AND 41.0 AND Lon BETWEEN -74.3 AND -73.7""")
def q_bbox_filter(spark, d):
    return C.bbox_filter(_lower_points(spark, d))


@query("bbox_outliers", "WITH " + si.PICKUPS_SQL + """
SELECT event_id, Lat, Lon FROM pickups
WHERE Lat < 40.5 OR Lat > 41.0 OR Lon < -74.3 OR Lon > -73.7""")
def q_bbox_outliers(spark, d):
    return C.bbox_outliers(si.pickups(spark, d).select("event_id", "Lat", "Lon"))


@query("positive_filter", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups - 5 AS pickups FROM hourly WHERE pickups - 5 > 0")
def q_positive_filter(spark, d):
    """Hourly counts less five, so that some are zero or negative."""
    return C.positive_filter(feat.hourly_count(si.pickups(spark, d)).withColumn("pickups", F.col("pickups") - 5))


_CLEAN_SQL = si.DIRTY_SQL + """,
dd AS (SELECT DISTINCT pickup_datetime, Lat AS lat, Lon AS lon, Base AS base FROM dirty WHERE pickup_datetime IS NOT NULL),
q2 AS (SELECT quantile_cont(lat, 0.25) AS la1, quantile_cont(lat, 0.75) AS la3,
              quantile_cont(lon, 0.25) AS lo1, quantile_cont(lon, 0.75) AS lo3 FROM dd),
fl AS (SELECT dd.*, lat BETWEEN la1 - 1.5 * (la3 - la1) AND la3 + 1.5 * (la3 - la1)
                AND lon BETWEEN lo1 - 1.5 * (lo3 - lo1) AND lo3 + 1.5 * (lo3 - lo1) AS in_fence,
              lat BETWEEN 40.5 AND 41.0 AND lon BETWEEN -74.3 AND -73.7 AS in_box FROM dd, q2)"""


@query("clean_job", "WITH " + _CLEAN_SQL + "\nSELECT pickup_datetime, lat, lon, base FROM fl WHERE in_fence AND in_box")
def q_clean_job(spark, d):
    """The whole cleaning step on a dirty source (times in many forms, repeated rows, outliers)."""
    return C.clean_pickups(si.dirty_pickups(spark, d).select("Date/Time", "Lat", "Lon", "Base"))


@query("clean_steps", "WITH " + _CLEAN_SQL + """,
n AS (SELECT (SELECT COUNT(*) FROM dirty) AS a, (SELECT COUNT(*) FROM dirty WHERE pickup_datetime IS NOT NULL) AS b,
             COUNT(*) AS c, COUNT(*) FILTER (WHERE in_fence) AS d, COUNT(*) FILTER (WHERE in_fence AND in_box) AS e FROM fl)
SELECT 'parse_time' AS step, a AS rows_before, b AS rows_after FROM n UNION ALL SELECT 'duplicates', b, c FROM n
UNION ALL SELECT 'iqr', c, d FROM n UNION ALL SELECT 'bounding_box', d, e FROM n""")
def q_clean_steps(spark, d):
    """Rows before and after every cleaning step."""
    return C.clean_with_report(si.dirty_pickups(spark, d).select("Date/Time", "Lat", "Lon", "Base"))[1]


@query("fill_unknown", "WITH " + si.GRID_SQL + """
SELECT p.event_id, COALESCE(g.cd_name, 'Unknown') AS cd_name
FROM parts p LEFT JOIN gpts g ON p.event_id = g.event_id""")
def q_fill_unknown(spark, d):
    from .q_spatial import grid_points
    p = si.pickups(spark, d).select("event_id")
    j = p.join(grid_points(spark, d).select("event_id", "cd_name"), "event_id", "left")
    return C.fill_unknown(j)


@query("to_numeric_coerce", "WITH " + si.RUNLOG_SQL + """
SELECT step, status, TRY_CAST(duration_min AS DOUBLE) AS duration_min FROM runlog""")
def q_to_numeric_coerce(spark, d):
    return C.to_numeric_coerce(si.run_log(spark, d).select("step", "status", "duration_min"), "duration_min")


@query("conform_columns", "WITH " + si.RUNLOG_SQL + """
SELECT DISTINCT CAST(NULL AS VARCHAR) AS "timestamp", step, duration_min, status, details FROM runlog""")
def q_conform_columns(spark, d):
    """Log rows projected onto the expected columns (missing ones NULL), deduplicated."""
    return C.conform_columns(si.run_log(spark, d), ["timestamp", "step", "duration_min", "status", "details"])


@query("cast_columns", "WITH " + si.FEATURES_SQL + """
SELECT cd_name, CAST(pickup_datetime AS VARCHAR) AS pickup_datetime, CAST(pickups AS DOUBLE) AS pickups,
       CAST(lag_1 AS DOUBLE) AS lag_1 FROM features""")
def q_cast_columns(spark, d):
    f = feat.build_features(feat.hourly_count(si.pickups(spark, d))).select("cd_name", "pickup_datetime",
                                                                            "pickups", "lag_1")
    return C.cast_columns(f, to_double=("pickups", "lag_1"))


@query("all_duplicates", "WITH " + si.PARTS_SQL + """
SELECT event_id, cd_name, Hour, Day FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY cd_name, Day, Hour) AS n FROM parts) WHERE n > 1""")
def q_all_duplicates(spark, d):
    """Every member of a group sharing (cd_name, Day, Hour), pandas ``keep=False``."""
    p = si.pickups_with_parts(spark, d).select("event_id", "cd_name", "Hour", "Day")
    return C.all_duplicates(p, ["cd_name", "Day", "Hour"])


@query("filter_key", "WITH " + si.HOURLY_SQL + "\nSELECT * FROM hourly WHERE cd_name = 'Manhattan CD 01'")
def q_filter_key(spark, d):
    return C.filter_key(feat.hourly_count(si.pickups(spark, d)), "Manhattan CD 01")
