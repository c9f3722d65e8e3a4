"""Registered queries: exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import eda
from . import standins as si
from .registry import query, r, rounded


def parts(spark, d):
    return si.pickups_with_parts(spark, d)


@query("count_by_part", "WITH " + si.PARTS_SQL + "\nSELECT Hour, COUNT(*) AS pickups FROM parts GROUP BY Hour")
def q_count_by_part(spark, d):
    return eda.count_by_part(parts(spark, d), "Hour")


@query("weekday_name", "WITH " + si.PARTS_SQL + """
SELECT Weekday, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][Weekday + 1] AS weekday_name, COUNT(*) AS pickups
FROM parts GROUP BY Weekday""")
def q_weekday_name(spark, d):
    c = eda.count_by_part(parts(spark, d), "Weekday")
    return c.select("Weekday", S.weekday_name("Weekday").alias("weekday_name"), "pickups")


@query("calendar_day_avg", "WITH " + si.PARTS_SQL + """
SELECT Day, COUNT(*) AS Total_Pickups, """ + r("COUNT(*) / (SELECT COUNT(DISTINCT Month) FROM parts)", "Avg_Pickups")
       + " FROM parts GROUP BY Day")
def q_calendar_day_avg(spark, d):
    return rounded(eda.calendar_day_avg(parts(spark, d)))


@query("daily_total", "WITH " + si.PICKUPS_SQL + """
SELECT CAST(pickup_datetime AS DATE) AS Date, COUNT(*) AS Pickups FROM pickups GROUP BY 1""")
def q_daily_total(spark, d):
    return eda.daily_total(si.pickups(spark, d))


@query("pivot_count", "WITH " + si.PARTS_SQL + "\nSELECT Hour, "
       + ", ".join(f'COUNT(*) FILTER (WHERE Weekday = {i}) AS "{i}"' for i in range(7))
       + " FROM parts GROUP BY Hour")
def q_pivot_count(spark, d):
    return eda.pivot_count(parts(spark, d))


@query("pivot_pct_norm", "WITH " + si.PARTS_SQL + """,
c AS (SELECT Hour, Weekday, COUNT(*) AS n FROM parts GROUP BY 1, 2),
p AS (SELECT Hour, Weekday, n / SUM(n) OVER (PARTITION BY Weekday) * 100 AS pct FROM c)
SELECT Hour, """ + ", ".join(r(f"COALESCE(MAX(pct) FILTER (WHERE Weekday = {i}), 0)", lab)
                             for i, lab in enumerate(S.WEEKDAY_SHORT)) + " FROM p GROUP BY Hour")
def q_pivot_pct_norm(spark, d):
    return rounded(eda.pivot_pct_norm(parts(spark, d)))


@query("mode_value", "WITH " + si.PARTS_SQL + """
SELECT Hour AS mode FROM (SELECT Hour, COUNT(*) AS n FROM parts GROUP BY Hour) ORDER BY n DESC, Hour LIMIT 1""")
def q_mode_value(spark, d):
    return eda.mode_value(parts(spark, d), "Hour")


@query("value_counts_top", "WITH " + si.PARTS_SQL + """
SELECT Day, COUNT(*) AS count FROM parts GROUP BY Day ORDER BY count DESC, Day LIMIT 1""")
def q_value_counts_top(spark, d):
    return eda.value_counts_top(parts(spark, d), "Day", 1)


@query("top_hour_day", "WITH " + si.PARTS_SQL + """
SELECT Day, Hour, COUNT(*) AS Count FROM parts GROUP BY Day, Hour ORDER BY Count DESC, Day, Hour LIMIT 1""")
def q_top_hour_day(spark, d):
    return eda.top_hour_day(parts(spark, d))


@query("time_range", "WITH " + si.PICKUPS_SQL + """
SELECT MIN(pickup_datetime) AS start_date, MAX(pickup_datetime) AS end_date,
       CAST(floor((epoch_us(MAX(pickup_datetime)) - epoch_us(MIN(pickup_datetime))) / 86400000000.0) AS BIGINT) AS days_covered
FROM pickups""")
def q_time_range(spark, d):
    return eda.time_range(si.pickups(spark, d))


@query("coord_stats", "WITH " + si.PICKUPS_SQL + "\nSELECT " + ", ".join([
    r("MIN(Lat)", "lat_min"), r("MAX(Lat)", "lat_max"), r("MIN(Lon)", "lon_min"), r("MAX(Lon)", "lon_max"),
    r("AVG(Lat)", "lat_mean"), r("AVG(Lon)", "lon_mean")]) + " FROM pickups")
def q_coord_stats(spark, d):
    return rounded(eda.coord_stats(si.pickups(spark, d)))


_NULL_COLS = ["event_id", "pickup_datetime", "Lat", "Lon", "Base", "cd_name"]


@query("null_counts", "WITH " + si.DIRTY_SQL + ", gaps AS (SELECT * REPLACE (CASE WHEN event_id % 11 <> 4 THEN Lat END AS Lat) FROM dirty)\n"
       + "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM gaps" for c in _NULL_COLS))
def q_null_counts(spark, d):
    """A dirty source: unreadable times kept as nulls, every eleventh latitude missing."""
    from ..operators.clean import parse_ts_coerce
    p = si.dirty_pickups(spark, d).withColumnRenamed("Date/Time", "pickup_datetime")
    p = p.withColumn("Lat", F.when(F.pmod("event_id", F.lit(11)) != 4, F.col("Lat")))
    return eda.null_counts(parse_ts_coerce(p, "pickup_datetime", drop=False).select(*_NULL_COLS))


@query("duplicate_count", "WITH " + si.PARTS_SQL + """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT COUNT(*) AS n FROM parts GROUP BY cd_name, Day, Hour)""")
def q_duplicate_count(spark, d):
    return eda.duplicate_count(parts(spark, d), ["cd_name", "Day", "Hour"])


@query("describe", "WITH " + si.PICKUPS_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, " + ", ".join([
        r(f"AVG({c})", "mean"), r(f"STDDEV_SAMP({c})", "std"), r(f"MIN({c})", "min"),
        r(f"quantile_cont({c}, 0.25)", "q25"), r(f"quantile_cont({c}, 0.5)", "q50"),
        r(f"quantile_cont({c}, 0.75)", "q75"), r(f"MAX({c})", "max")]) + " FROM pickups"
    for c in ["Lat", "Lon"]))
def q_describe(spark, d):
    return rounded(eda.describe(si.pickups(spark, d), ["Lat", "Lon"]))


@query("hotspots", "WITH " + si.PICKUPS_SQL + """
SELECT round_even(Lat, 3) AS Lat_round, round_even(Lon, 3) AS Lon_round, COUNT(*) AS Count
FROM pickups GROUP BY 1, 2 ORDER BY Count DESC, Lat_round, Lon_round LIMIT 10""")
def q_hotspots(spark, d):
    return eda.hotspots(si.pickups(spark, d))


@query("round_half_even", "WITH " + si.PICKUPS_SQL + """
SELECT event_id, round_even(Lat, 3) AS lat3, round_even(Lon, 3) AS lon3 FROM pickups""")
def q_round_half_even(spark, d):
    p = si.pickups(spark, d)
    return p.select("event_id", S.round_half_even("Lat", 3).alias("lat3"), S.round_half_even("Lon", 3).alias("lon3"))


@query("topk_by_rows", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, cd_name) AS INTEGER) AS rank
FROM (SELECT cd_name, COUNT(*) AS count FROM hourly GROUP BY cd_name) ORDER BY count DESC, cd_name LIMIT 10""")
def q_topk_by_rows(spark, d):
    from ..operators.features import hourly_count
    return eda.topk_by_rows(hourly_count(si.pickups(spark, d))).select("cd_name", "count", "rank")


def _top_grid_names(spark, d):
    """Top-10 grid districts by pickups: k names, collected (bounded by k) to name the
    pivot columns."""
    from .q_spatial import grid_points
    return [r_["cd_name"] for r_ in eda.topk_by_pickups(grid_points(spark, d)).select("cd_name").collect()]




def _pivot_long_sql(part: str) -> str:
    from .q_spatial import _TOP_GRID_SQL
    return ("WITH " + _TOP_GRID_SQL + f""",
pts AS (SELECT * FROM gpts WHERE cd_name IN (SELECT cd_name FROM top)),
vals AS (SELECT DISTINCT {part} FROM pts),
cnt AS (SELECT {part}, cd_name, COUNT(*) AS n FROM pts GROUP BY 1, 2)
SELECT v.{part}, t.cd_name, COALESCE(c.n, 0) AS pickups
FROM vals v CROSS JOIN top t LEFT JOIN cnt c ON c.{part} = v.{part} AND c.cd_name = t.cd_name""")


def _pivot_long(spark, d, part):
    from .q_spatial import grid_points
    names = _top_grid_names(spark, d)
    wide = eda.pivot_part_by_district(grid_points(spark, d), part, names)
    return eda.long_from_pivot(wide, part)


@query("pivot_part_by_district", _pivot_long_sql("Hour"))
def q_pivot_part_by_district(spark, d):
    """Hour x top-10 district pickup table, missing cells 0 (long form)."""
    return _pivot_long(spark, d, "Hour")


@query("pivot_weekday_by_district", _pivot_long_sql("Weekday"))
def q_pivot_weekday_by_district(spark, d):
    return _pivot_long(spark, d, "Weekday")


@query("pivot_day_by_district", _pivot_long_sql("Day"))
def q_pivot_day_by_district(spark, d):
    return _pivot_long(spark, d, "Day")


def _corr_sql() -> str:
    from .q_spatial import _TOP_GRID_SQL
    guarded = ("CASE WHEN stddev_pop(a.v) * stddev_pop(b.v) = 0 THEN NULL "
               "ELSE covar_pop(a.v, b.v) / (stddev_pop(a.v) * stddev_pop(b.v)) END")
    return ("WITH " + _TOP_GRID_SQL + """,
pts AS (SELECT * FROM gpts WHERE cd_name IN (SELECT cd_name FROM top)),
combos AS (SELECT DISTINCT Hour, Weekday, Day, Month FROM pts),
cnt AS (SELECT Hour, Weekday, Day, Month, cd_name, COUNT(*) AS n FROM pts GROUP BY ALL),
vals AS (
  SELECT c.Hour, c.Weekday, c.Day, c.Month, t.cd_name AS var, CAST(COALESCE(n.n, 0) AS DOUBLE) AS v
  FROM combos c CROSS JOIN top t
  LEFT JOIN cnt n ON n.Hour = c.Hour AND n.Weekday = c.Weekday AND n.Day = c.Day AND n.Month = c.Month AND n.cd_name = t.cd_name
  UNION ALL SELECT Hour, Weekday, Day, Month, 'Hour', CAST(Hour AS DOUBLE) FROM combos
  UNION ALL SELECT Hour, Weekday, Day, Month, 'Weekday', CAST(Weekday AS DOUBLE) FROM combos
  UNION ALL SELECT Hour, Weekday, Day, Month, 'Day', CAST(Day AS DOUBLE) FROM combos
  UNION ALL SELECT Hour, Weekday, Day, Month, 'Month', CAST(Month AS DOUBLE) FROM combos
)
SELECT a.var AS var_a, b.var AS var_b, """ + r(guarded, "corr") + """
FROM vals a JOIN vals b ON a.Hour = b.Hour AND a.Weekday = b.Weekday AND a.Day = b.Day AND a.Month = b.Month
GROUP BY a.var, b.var""")


@query("corr_matrix", _corr_sql())
def q_corr_matrix(spark, d):
    from .q_spatial import grid_points
    return rounded(eda.corr_matrix(grid_points(spark, d), _top_grid_names(spark, d)))
