"""Registered queries: hourly aggregation and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import features as feat
from . import standins as si
from .registry import query, r, rounded

_FEAT_DOUBLES = ["pickup_density_cd", "sin_hour", "cos_hour", "sin_weekday", "cos_weekday",
                 "rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h", "rolling_std_24h"]


def _feature_select_sql(src: str) -> str:
    cols = []
    for c in feat.FEATURE_COLUMNS:
        cols.append(r(c) if c in _FEAT_DOUBLES else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


def hourly(spark, d):
    return feat.hourly_count(si.pickups(spark, d))


def features_all(spark, d):
    return feat.build_features(hourly(spark, d), drop_incomplete=False)


@query("feature_job", "WITH " + si.FEATURES_SQL + "\n" + _feature_select_sql("features"))
def q_feature_job(spark, d):
    """Flagship: pickups -> district-hour counts -> calendar, cyclic, density, lag and
    rolling features -> rows with any NULL dropped."""
    return rounded(feat.build_features(hourly(spark, d)))


@query("hourly_count", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM hourly")
def q_hourly_count(spark, d):
    return hourly(spark, d)


@query("floor_hour", "WITH " + si.PICKUPS_SQL + """
SELECT event_id, date_trunc('hour', pickup_datetime) AS pickup_hour FROM pickups""")
def q_floor_hour(spark, d):
    return si.pickups(spark, d).select("event_id", S.floor_hour("pickup_datetime").alias("pickup_hour"))


@query("date_parts", "WITH " + si.PICKUPS_SQL + """
SELECT event_id, CAST(hour(pickup_datetime) AS INTEGER) AS Hour, CAST(day(pickup_datetime) AS INTEGER) AS Day,
       CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS Weekday, CAST(month(pickup_datetime) AS INTEGER) AS Month,
       CAST(pickup_datetime AS DATE) AS Date
FROM pickups""")
def q_date_parts(spark, d):
    p = si.pickups(spark, d)
    return p.select("event_id", F.hour("pickup_datetime").alias("Hour"), F.dayofmonth("pickup_datetime").alias("Day"),
                    S.weekday0("pickup_datetime").alias("Weekday"), F.month("pickup_datetime").alias("Month"),
                    F.to_date("pickup_datetime").alias("Date"))


@query("is_weekend", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, pickup_datetime, CAST(isodow(pickup_datetime) - 1 >= 5 AS INTEGER) AS is_weekend FROM hourly""")
def q_is_weekend(spark, d):
    return hourly(spark, d).select("cd_name", "pickup_datetime", S.is_weekend("pickup_datetime").alias("is_weekend"))


@query("cyclic_encode", "WITH " + si.FEATURES_ALL_SQL + """
SELECT cd_name, pickup_datetime, """ + ", ".join(r(c) for c in ["sin_hour", "cos_hour", "sin_weekday", "cos_weekday"])
       + " FROM feat_all")
def q_cyclic_encode(spark, d):
    return rounded(features_all(spark, d).select("cd_name", "pickup_datetime", "sin_hour", "cos_hour",
                                                 "sin_weekday", "cos_weekday"))


@query("group_mean_transform", "WITH " + si.FEATURES_ALL_SQL + """
SELECT cd_name, pickup_datetime, hour, """ + r("pickup_density_cd") + " FROM feat_all")
def q_group_mean_transform(spark, d):
    return rounded(features_all(spark, d).select("cd_name", "pickup_datetime", "hour", "pickup_density_cd"))


@query("lags", "WITH " + si.FEATURES_ALL_SQL + """
SELECT cd_name, pickup_datetime, pickups, lag_1, lag_2, lag_24 FROM feat_all""")
def q_lags(spark, d):
    return features_all(spark, d).select("cd_name", "pickup_datetime", "pickups", "lag_1", "lag_2", "lag_24")


@query("rolling_full", "WITH " + si.FEATURES_ALL_SQL + """
SELECT cd_name, pickup_datetime, """ + ", ".join(r(c) for c in ["rolling_mean_3h", "rolling_mean_24h",
                                                               "rolling_std_3h", "rolling_std_24h"])
       + " FROM feat_all")
def q_rolling_full(spark, d):
    return rounded(features_all(spark, d).select("cd_name", "pickup_datetime", "rolling_mean_3h", "rolling_mean_24h",
                                                 "rolling_std_3h", "rolling_std_24h"))


@query("rolling_shifted", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, pickup_datetime,
  """ + r("AVG(pickups) OVER (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)",
         "rolling_mean_3h") + """,
  """ + r("AVG(pickups) OVER (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)",
         "rolling_mean_24h") + """
FROM hourly""")
def q_rolling_shifted(spark, d):
    df = feat.add_rolling_shifted(hourly(spark, d))
    return rounded(df.select("cd_name", "pickup_datetime", "rolling_mean_3h", "rolling_mean_24h"))


@query("drop_null_any", "WITH " + si.FEATURES_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM features")
def q_drop_null_any(spark, d):
    return features_all(spark, d).dropna().select("cd_name", "pickup_datetime", "pickups")
