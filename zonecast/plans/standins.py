"""Stand-in inputs derived from the test tables (the reference's city data is not shipped).

pickups   events -> pickup_datetime = ts, Base = event_type, a point (Lon, Lat) spread by
          two modular hashes of event_id, and a dense district from ``user_id % 10``
          named through the district-code rule (codes 101..105, 201..205 -> 'Manhattan
          CD 01' ...). Every row of ``events`` is a pickup; nothing is filtered.

Each Spark stand-in has an SQL twin (``*_SQL`` CTE text) used by the DuckDB oracle; the
arithmetic is written in the same operator order with DOUBLE literals, so both engines
produce bit-equal points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import district_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def point_lon(event_id) -> F.Column:
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    return F.lit(-74.10) + F.lit(0.45) * (F.pmod(e * 7919, F.lit(10007)).cast("double") / F.lit(10007.0))


def point_lat(event_id) -> F.Column:
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    return F.lit(40.50) + F.lit(0.50) * (F.pmod(e * 104729, F.lit(9973)).cast("double") / F.lit(9973.0))


def dense_code(user_id) -> F.Column:
    d = F.pmod(F.col(user_id), F.lit(10))
    return (F.pmod(d, F.lit(5)) + 1) * 100 + F.floor(d / 5).cast("bigint") + 1


def pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        point_lat("event_id").alias("Lat"),
        point_lon("event_id").alias("Lon"),
        F.col("event_type").alias("Base"),
        "user_id",
        dense_code("user_id").alias("boro_cd"),
        district_name(dense_code("user_id"), "features").alias("cd_name"),
    )


# SQL twins --------------------------------------------------------------------------

PICKUPS_SQL = """
pickups AS (
  SELECT event_id,
         ts AS pickup_datetime,
         CAST(40.50 AS DOUBLE) + CAST(0.50 AS DOUBLE) * (CAST((event_id * 104729) % 9973 AS DOUBLE) / CAST(9973.0 AS DOUBLE)) AS Lat,
         CAST(-74.10 AS DOUBLE) + CAST(0.45 AS DOUBLE) * (CAST((event_id * 7919) % 10007 AS DOUBLE) / CAST(10007.0 AS DOUBLE)) AS Lon,
         event_type AS Base,
         user_id,
         ((user_id % 10) % 5 + 1) * 100 + (user_id % 10) // 5 + 1 AS boro_cd,
         CASE CAST(((user_id % 10) % 5 + 1) AS VARCHAR)
              WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn'
              WHEN '4' THEN 'Queens' WHEN '5' THEN 'Staten Island' ELSE 'Unknown' END
           || ' CD ' || substr(CAST(((user_id % 10) % 5 + 1) * 100 + (user_id % 10) // 5 + 1 AS VARCHAR), 2) AS cd_name
  FROM events
)"""

# Hourly counts per dense district (hour floor).
HOURLY_SQL = PICKUPS_SQL + """,
hourly AS (
  SELECT cd_name, date_trunc('hour', pickup_datetime) AS pickup_datetime, COUNT(*) AS pickups
  FROM pickups WHERE cd_name IS NOT NULL GROUP BY 1, 2
)"""

# The feature table before dropping incomplete rows.
FEATURES_ALL_SQL = HOURLY_SQL + """,
cal AS (
  SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS hour,
         CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS weekday,
         CAST(month(pickup_datetime) AS INTEGER) AS month,
         CAST(day(pickup_datetime) AS INTEGER) AS day
  FROM hourly
),
feat_all AS (
  SELECT cd_name, pickup_datetime, pickups, hour,
         AVG(pickups) OVER (PARTITION BY cd_name, hour) AS pickup_density_cd,
         weekday, month, day,
         CAST(weekday >= 5 AS INTEGER) AS is_weekend,
         sin(CAST(6.283185307179586 AS DOUBLE) * hour / CAST(24.0 AS DOUBLE)) AS sin_hour,
         cos(CAST(6.283185307179586 AS DOUBLE) * hour / CAST(24.0 AS DOUBLE)) AS cos_hour,
         sin(CAST(6.283185307179586 AS DOUBLE) * weekday / CAST(7.0 AS DOUBLE)) AS sin_weekday,
         cos(CAST(6.283185307179586 AS DOUBLE) * weekday / CAST(7.0 AS DOUBLE)) AS cos_weekday,
         LAG(pickups, 1) OVER w AS lag_1,
         LAG(pickups, 2) OVER w AS lag_2,
         LAG(pickups, 24) OVER w AS lag_24,
         CASE WHEN COUNT(pickups) OVER w3 = 3 THEN AVG(pickups) OVER w3 END AS rolling_mean_3h,
         CASE WHEN COUNT(pickups) OVER w24 = 24 THEN AVG(pickups) OVER w24 END AS rolling_mean_24h,
         CASE WHEN COUNT(pickups) OVER w3 = 3 THEN STDDEV_SAMP(pickups) OVER w3 END AS rolling_std_3h,
         CASE WHEN COUNT(pickups) OVER w24 = 24 THEN STDDEV_SAMP(pickups) OVER w24 END AS rolling_std_24h
  FROM cal
  WINDOW w AS (PARTITION BY cd_name ORDER BY pickup_datetime),
         w3 AS (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w24 AS (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
)"""

FEATURES_SQL = FEATURES_ALL_SQL + """,
features AS (
  SELECT * FROM feat_all
  WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_24 IS NOT NULL
    AND rolling_mean_3h IS NOT NULL AND rolling_mean_24h IS NOT NULL
    AND rolling_std_3h IS NOT NULL AND rolling_std_24h IS NOT NULL
)"""


def raw_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-file layout of the reference input: Date/Time text, Lat, Lon, Base."""
    p = pickups(spark, sf_dir)
    return p.select(F.date_format("pickup_datetime", "M/d/yyyy H:mm:ss").alias("Date/Time"),
                    "Lat", "Lon", "Base")


#: Ways in which the time of a dirty row is written, by event_id % 9; the last kind cannot be read.
DIRTY_FORMS = ["M/d/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss", "MMM d yyyy", "yyyy/MM/dd HH:mm", "yyyyMMdd", "M-d-yyyy H:mm",
               "M/d/yy H:mm", "M/d/yyyy h:mm:ss a"]
DIRTY_BAD = ["n/a", "13/45/2014", "2014-02-30", None]


def dirty_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups as a careless source writes them: times in eight forms and some that are none,
    every twentieth row twice, points far off and points just outside the city box."""
    p = pickups(spark, sf_dir)
    e = F.col("event_id")
    text = F.element_at(F.array(*[F.lit(b) for b in DIRTY_BAD]), (F.pmod(e, F.lit(4)) + 1).cast("int"))
    for k, f in enumerate(DIRTY_FORMS):
        text = F.when(F.pmod(e, F.lit(9)) == k, F.date_format("pickup_datetime", f)).otherwise(text)
    lat = F.col("Lat") + F.when(F.pmod(e, F.lit(50)) == 3, 3.0).when(F.pmod(e, F.lit(30)) == 7, 0.2).otherwise(0.0)
    lon = F.col("Lon") - F.when(F.pmod(e, F.lit(70)) == 5, 2.0).otherwise(0.0)
    twice = F.explode(F.array_repeat(F.lit(1), F.when(F.pmod(e, F.lit(20)) == 0, 2).otherwise(1)))
    return p.select("event_id", text.alias("Date/Time"), lat.alias("Lat"), lon.alias("Lon"), "Base", "cd_name",
                    twice.alias("_copy")).drop("_copy")


def pickups_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.eda import with_parts
    return with_parts(pickups(spark, sf_dir))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline-log layout (all text) derived from ``orders``: one log row per order.
    step = order priority, status from the order status (F success, O failed, P NULL),
    duration_min = an integer minute count as text, 'n/a' for pending orders."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("timestamp_utc"),
        F.col("o_orderpriority").alias("step"),
        F.when(F.col("o_orderstatus") == "F", F.lit("success"))
         .when(F.col("o_orderstatus") == "O", F.lit("failed")).alias("status"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
         .otherwise((F.floor("o_totalprice").cast("bigint") % 997).cast("string")).alias("duration_min"),
        F.concat(F.lit("custkey="), F.col("o_custkey").cast("string")).alias("details"),
    )


RAW_SQL = PICKUPS_SQL + """,
raw AS (
  SELECT strftime(pickup_datetime, '%-m/%-d/%Y %-H:%M:%S') AS "Date/Time", Lat, Lon, Base FROM pickups
)"""

#: What is left of the dirty rows' times: the precision that their form keeps, NULL if it is none.
DIRTY_SQL = PICKUPS_SQL + """,
dirty AS (
  SELECT event_id, CASE WHEN event_id % 9 IN (0, 1, 7) THEN date_trunc('second', pickup_datetime)
                        WHEN event_id % 9 IN (2, 4) THEN CAST(CAST(pickup_datetime AS DATE) AS TIMESTAMP)
                        WHEN event_id % 9 IN (3, 5, 6) THEN date_trunc('minute', pickup_datetime) END AS pickup_datetime,
         Lat + CAST(CASE WHEN event_id % 50 = 3 THEN 3.0 WHEN event_id % 30 = 7 THEN 0.2 ELSE 0.0 END AS DOUBLE) AS Lat,
         Lon - CAST(CASE WHEN event_id % 70 = 5 THEN 2.0 ELSE 0.0 END AS DOUBLE) AS Lon, Base, cd_name
  FROM pickups, range(2) copies(c) WHERE c = 0 OR event_id % 20 = 0
)"""

PARTS_SQL = PICKUPS_SQL + """,
parts AS (
  SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS Hour, CAST(day(pickup_datetime) AS INTEGER) AS Day,
         CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS Weekday, CAST(month(pickup_datetime) AS INTEGER) AS Month
  FROM pickups
)"""

# Fallback grid cells and the points strictly inside them (bounds join, same arithmetic
# as the grid builder).
GRID_SQL = PARTS_SQL + """,
gridc AS (
  SELECT i, j, 'Grid_' || CAST(i AS VARCHAR) || '_' || CAST(j AS VARCHAR) AS cd_name,
         CAST(-74.05 AS DOUBLE) + CAST(i AS DOUBLE) * ((CAST(-73.70 AS DOUBLE) - CAST(-74.05 AS DOUBLE)) / 5) AS x0,
         CAST(-74.05 AS DOUBLE) + CAST(i + 1 AS DOUBLE) * ((CAST(-73.70 AS DOUBLE) - CAST(-74.05 AS DOUBLE)) / 5) AS x1,
         CAST(40.55 AS DOUBLE) + CAST(j AS DOUBLE) * ((CAST(40.95 AS DOUBLE) - CAST(40.55 AS DOUBLE)) / 5) AS y0,
         CAST(40.55 AS DOUBLE) + CAST(j + 1 AS DOUBLE) * ((CAST(40.95 AS DOUBLE) - CAST(40.55 AS DOUBLE)) / 5) AS y1
  FROM range(5) a(i), range(5) b(j)
),
gpts AS (
  SELECT p.event_id, p.pickup_datetime, p.Lat, p.Lon, p.Base, p.Hour, p.Day, p.Weekday, p.Month, g.cd_name
  FROM parts p JOIN gridc g ON p.Lon > g.x0 AND p.Lon < g.x1 AND p.Lat > g.y0 AND p.Lat < g.y1
)"""

RUNLOG_SQL = """
runlog AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S UTC') AS timestamp_utc,
         o_orderpriority AS step,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' END AS status,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 997 AS VARCHAR) END AS duration_min,
         'custkey=' || CAST(o_custkey AS VARCHAR) AS details
  FROM orders
)"""


def dense_district_polygons(spark: SparkSession) -> DataFrame:
    """Polygon layer for the ten dense districts: vertical strips of the point area
    (lon -74.10..-73.65 in 0.045 degree steps, lat 40.50..41.00), named by code."""
    from ..sources.polygons import RINGS
    d = F.col("id")
    code = (F.pmod(d, F.lit(5)) + 1) * 100 + F.floor(d / 5).cast("bigint") + 1
    x0 = F.lit(-74.10) + d.cast("double") * F.lit(0.045)
    x1 = F.lit(-74.10) + (d + 1).cast("double") * F.lit(0.045)
    y0, y1 = F.lit(40.50), F.lit(41.00)

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))
    return spark.range(10).select(district_name(code, "padded").alias("cd_name"), F.lit(0).alias("part_id"),
                                  F.array(ring).cast(RINGS).alias("rings"))


DENSE_POLY_SQL = """
dpoly AS (
  SELECT CASE CAST(d % 5 + 1 AS VARCHAR) WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn'
              WHEN '4' THEN 'Queens' WHEN '5' THEN 'Staten Island' ELSE 'Unknown' END
           || ' CD ' || lpad(CAST(d // 5 + 1 AS VARCHAR), 2, '0') AS cd_name,
         CAST(-74.10 AS DOUBLE) + CAST(d AS DOUBLE) * CAST(0.045 AS DOUBLE) AS x0,
         CAST(-74.10 AS DOUBLE) + CAST(d + 1 AS DOUBLE) * CAST(0.045 AS DOUBLE) AS x1,
         CAST(40.50 AS DOUBLE) AS y0, CAST(41.00 AS DOUBLE) AS y1
  FROM range(10) t(d)
)"""
