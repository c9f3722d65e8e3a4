"""Registered queries: spatial join and the district tables built on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import BOROUGHS
from ..operators import eda
from ..operators import spatial as sp
from ..sources.polygons import grid_polygons
from . import standins as si
from .registry import query, r, rounded


def grid_points(spark, d):
    """Pickups (with calendar parts) strictly inside the 5 x 5 fallback grid cells."""
    return sp.spatial_within_join(si.pickups_with_parts(spark, d).drop("cd_name"), grid_polygons(spark))


@query("spatial_within_join", "WITH " + si.GRID_SQL + "\nSELECT event_id, Lat, Lon, cd_name FROM gpts")
def q_spatial_within_join(spark, d):
    return grid_points(spark, d).select("event_id", "Lat", "Lon", "cd_name")


@query("grid_feature_job", "WITH " + si.GRID_SQL + """,
hourly AS (SELECT cd_name, date_trunc('hour', pickup_datetime) AS pickup_datetime, COUNT(*) AS pickups
           FROM gpts GROUP BY 1, 2)
SELECT cd_name, pickup_datetime, pickups,
       LAG(pickups, 1) OVER w AS lag_1, LAG(pickups, 24) OVER w AS lag_24
FROM hourly WINDOW w AS (PARTITION BY cd_name ORDER BY pickup_datetime)""")
def q_grid_feature_job(spark, d):
    """Points -> grid district by the point-in-polygon join -> hourly counts -> lags.
    The district travels as an INT id through the join and the per-point aggregation;
    names are attached to the district-hour rows."""
    from ..operators import features as feat
    polys = grid_polygons(spark)
    pts = sp.spatial_within_join(si.pickups(spark, d).drop("cd_name"), polys, key="id")
    h = feat.hourly_count(pts, key="district_id")
    h = h.join(sp.district_ids(polys), "district_id").drop("district_id")
    return feat.add_lags(h, lags=(1, 24)).select("cd_name", "pickup_datetime", "pickups", "lag_1", "lag_24")


@query("district_stats", "WITH " + si.GRID_SQL + """,
c AS (SELECT cd_name, COUNT(*) AS count FROM gpts GROUP BY cd_name)
SELECT cd_name, count, """ + r("round_even(count / (SELECT SUM(count) FROM c) * 100, 2)", "percentage") + " FROM c")
def q_district_stats(spark, d):
    return rounded(eda.district_stats(grid_points(spark, d)))


@query("pct_of_total", "WITH " + si.PARTS_SQL + """,
c AS (SELECT Hour, COUNT(*) AS count FROM parts GROUP BY Hour)
SELECT Hour, count, """ + r("round_even(count / (SELECT SUM(count) FROM c) * 100, 2)", "percentage") + " FROM c")
def q_pct_of_total(spark, d):
    c = eda.count_by_part(si.pickups_with_parts(spark, d), "Hour", "count")
    return rounded(eda.pct_of_total(c))


_TOP_GRID_SQL = si.GRID_SQL + """,
c AS (SELECT cd_name, COUNT(*) AS count FROM gpts GROUP BY cd_name),
top AS (SELECT cd_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, cd_name) AS INTEGER) AS rank FROM c
        ORDER BY count DESC, cd_name LIMIT 10)"""


@query("topk_by_pickups", "WITH " + _TOP_GRID_SQL + "\nSELECT cd_name, count, rank FROM top")
def q_topk_by_pickups(spark, d):
    return eda.topk_by_pickups(grid_points(spark, d)).select("cd_name", "count", "rank")


@query("district_top_report", "WITH " + _TOP_GRID_SQL + """,
pc AS (SELECT cd_name, count, round_even(count / (SELECT SUM(count) FROM c) * 100, 2) AS percentage FROM c)
SELECT t.cd_name, t.count, """ + r("pc.percentage", "percentage") + """, t.rank,
       (SELECT COUNT(*) FROM gpts) AS total_pickups,
       """ + r("(SELECT SUM(pc.percentage) FROM pc JOIN top USING (cd_name))", "topk_coverage") + """
FROM top t JOIN pc USING (cd_name)""")
def q_district_top_report(spark, d):
    return rounded(eda.district_top_report(grid_points(spark, d)))


@query("topk_semi_join", "WITH " + _TOP_GRID_SQL + """
SELECT event_id, cd_name FROM gpts WHERE cd_name IN (SELECT cd_name FROM top)""")
def q_topk_semi_join(spark, d):
    from ..session import materialize
    g = materialize(grid_points(spark, d).select("event_id", "cd_name"), "grid_points")  # the join runs once
    top = eda.topk_by_pickups(g).select("cd_name")     # at most k rows
    return g.join(F.broadcast(top), "cd_name", "left_semi").select("event_id", "cd_name")


# a 7 x 7 grid over a box wider than the points (lon -74.25..-73.50, lat 40.35..41.15):
# its outer cells receive no pickups, so the left join keeps them with a NULL count
WIDE_GRID = (-74.25, 40.35, -73.50, 41.15)
_WIDE_SQL = si.PICKUPS_SQL + """,
wg AS (
  SELECT 'Grid_' || CAST(i AS VARCHAR) || '_' || CAST(j AS VARCHAR) AS cd_name,
         CAST(-74.25 AS DOUBLE) + CAST(i AS DOUBLE) * ((CAST(-73.50 AS DOUBLE) - CAST(-74.25 AS DOUBLE)) / 7) AS x0,
         CAST(-74.25 AS DOUBLE) + CAST(i + 1 AS DOUBLE) * ((CAST(-73.50 AS DOUBLE) - CAST(-74.25 AS DOUBLE)) / 7) AS x1,
         CAST(40.35 AS DOUBLE) + CAST(j AS DOUBLE) * ((CAST(41.15 AS DOUBLE) - CAST(40.35 AS DOUBLE)) / 7) AS y0,
         CAST(40.35 AS DOUBLE) + CAST(j + 1 AS DOUBLE) * ((CAST(41.15 AS DOUBLE) - CAST(40.35 AS DOUBLE)) / 7) AS y1
  FROM range(7) a(i), range(7) b(j)
)"""


@query("polygon_stats_left_join", "WITH " + _WIDE_SQL + """,
c AS (SELECT g.cd_name, COUNT(*) AS count FROM pickups p JOIN wg g
      ON p.Lon > g.x0 AND p.Lon < g.x1 AND p.Lat > g.y0 AND p.Lat < g.y1 GROUP BY g.cd_name)
SELECT g.cd_name, c.count FROM wg g LEFT JOIN c USING (cd_name)""")
def q_polygon_stats_left_join(spark, d):
    """Every polygon with its pickup count (polygons without pickups keep NULL)."""
    polys = grid_polygons(spark, WIDE_GRID, 7)
    pts = sp.spatial_within_join(si.pickups(spark, d).drop("cd_name"), polys)
    c = pts.groupBy("cd_name").agg(F.count(F.lit(1)).alias("count"))
    return polys.select("cd_name").join(c, "cd_name", "left")


_BORO_CASE = "CASE " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in BOROUGHS.items()) + " END"


@query("dict_lookup", "WITH " + si.PICKUPS_SQL + f""",
lookup AS (SELECT DISTINCT cd_name, {_BORO_CASE.replace('WHEN ', 'WHEN boro_cd // 100 = ')} AS boro_name FROM pickups),
c AS (SELECT cd_name, COUNT(*) AS count FROM pickups GROUP BY cd_name)
SELECT c.cd_name, c.count, l.boro_name AS borough FROM c LEFT JOIN lookup l USING (cd_name)""")
def q_dict_lookup(spark, d):
    p = si.pickups(spark, d)
    lookup = _borough_lookup(p)
    c = p.groupBy("cd_name").agg(F.count(F.lit(1)).alias("count"))
    return c.join(lookup.groupBy("cd_name").agg(F.max("boro_name").alias("borough")), "cd_name", "left")


def _borough_lookup(p):
    m = F.create_map(*[x for k, v in BOROUGHS.items() for x in (F.lit(int(k)), F.lit(v))])
    return p.select("cd_name", F.element_at(m, F.floor(F.col("boro_cd") / 100).cast("int")).alias("boro_name")).distinct()


@query("borough_rollup", "WITH " + si.PICKUPS_SQL + f""",
lookup AS (SELECT DISTINCT cd_name, {_BORO_CASE.replace('WHEN ', 'WHEN boro_cd // 100 = ')} AS boro_name FROM pickups),
c AS (SELECT cd_name, COUNT(*) AS count FROM pickups GROUP BY cd_name),
pc AS (SELECT cd_name, count, round_even(count / (SELECT SUM(count) FROM c) * 100, 2) AS percentage FROM c)
SELECT l.boro_name AS borough, CAST(SUM(count) AS BIGINT) AS count, """ + r("SUM(percentage)", "percentage") + """
FROM pc LEFT JOIN lookup l USING (cd_name) GROUP BY l.boro_name""")
def q_borough_rollup(spark, d):
    p = si.pickups(spark, d)
    stats = eda.district_stats(p)
    return rounded(eda.borough_rollup(stats, _borough_lookup(p)))
