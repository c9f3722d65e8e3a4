"""Registered queries: autocorrelation, run-log analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eda
from ..operators import runlog as RL
from ..operators import timeseries as TSR
from . import standins as si
from .registry import query, r, rounded


def top_series(spark, d):
    p = si.pickups_with_parts(spark, d)
    top = eda.topk_by_pickups(p).select("cd_name")            # at most 10 rows
    return TSR.pseudo_series(p.join(F.broadcast(top), "cd_name", "left_semi"))


def _order():
    return (F.col("ts").asc_nulls_last(), F.col("Weekday").asc())

_SER_SQL = "WITH " + si.PARTS_SQL + """,
top10 AS (SELECT cd_name FROM (SELECT cd_name, COUNT(*) AS c FROM parts GROUP BY cd_name) ORDER BY c DESC, cd_name LIMIT 10),
ser AS (
  SELECT cd_name, Hour, Weekday, Day, Month, COUNT(*) AS pickups,
         try_strptime('1900-' || lpad(CAST(Month AS VARCHAR), 2, '0') || '-' || lpad(CAST(Day AS VARCHAR), 2, '0') || ' '
                      || lpad(CAST(Hour AS VARCHAR), 2, '0'), '%Y-%m-%d %H') AS ts
  FROM parts WHERE cd_name IN (SELECT cd_name FROM top10) GROUP BY ALL
),
dm AS (SELECT cd_name, ts, Weekday, pickups - AVG(pickups) OVER (PARTITION BY cd_name) AS d FROM ser),
lg AS (SELECT cd_name, """ + ", ".join(
    ["d * d AS p0"] + [f"d * LAG(d, {k}) OVER w AS p{k}" for k in range(1, 49)]) + """
       FROM dm WINDOW w AS (PARTITION BY cd_name ORDER BY ts NULLS LAST, Weekday)),
s AS (SELECT cd_name, COUNT(*) AS n, [""" + ", ".join(f"COALESCE(SUM(p{k}), 0)" for k in range(49)) + """] AS arr
      FROM lg GROUP BY cd_name)"""


@query("acf", _SER_SQL + """
SELECT cd_name, CAST(k AS INTEGER) AS lag, """ + r("arr[k + 1] / NULLIF(arr[1], 0)", "acf") + """
FROM s, range(49) t(k) WHERE n >= 48""")
def q_acf(spark, d):
    """Autocorrelation, lags 0..48, of the hourly pickup series of the top-10 districts."""
    return rounded(TSR.acf(top_series(spark, d), order=_order()))


@query("pacf", _SER_SQL.replace("WITH", "WITH RECURSIVE", 1) + """,
rr AS (SELECT cd_name, list_transform(range(0, 49), lambda i: arr[i + 1] / (n - i)) AS r FROM s WHERE n >= 48),
lev AS (
  SELECT cd_name, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS a FROM rr
  UNION ALL
  SELECT cd_name, r, k + 1, list_transform(range(1, k + 1), lambda i: phi[i] - b * phi[k + 1 - i]) || [b], b
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 2 - i])), 0))
               / nullif(r[1] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[i + 1])), 0), 0) AS b
        FROM lev WHERE k < 48)
)
SELECT cd_name, CAST(k AS INTEGER) AS lag, """ + r("a", "pacf") + " FROM lev")
def q_pacf(spark, d):
    """Partial autocorrelation (Yule-Walker, adjusted), lags 0..48, by Levinson-Durbin."""
    return rounded(TSR.pacf_yw(top_series(spark, d), order=_order()))


@query("acf_conf", _SER_SQL + "\nSELECT cd_name, " + r("1.96 / sqrt(COUNT(*))", "conf") + " FROM ser GROUP BY cd_name")
def q_acf_conf(spark, d):
    return rounded(TSR.acf_conf(top_series(spark, d)))


_LOG_SQL = "WITH " + si.RUNLOG_SQL + """,
tidy AS (SELECT DISTINCT timestamp_utc AS "timestamp", step, TRY_CAST(duration_min AS DOUBLE) AS duration_min, status, details
         FROM runlog WHERE step IS NOT NULL)"""


@query("step_duration", _LOG_SQL + "\nSELECT step, " + r("AVG(duration_min)", "duration_min") + " FROM tidy GROUP BY step")
def q_step_duration(spark, d):
    return rounded(RL.step_duration(si.run_log(spark, d)))


@query("success_rate", _LOG_SQL + "\nSELECT " + r(
    "AVG(CAST(COALESCE(contains(lower(status), 'success'), false) AS DOUBLE)) * 100", "success_rate") + " FROM tidy")
def q_success_rate(spark, d):
    return rounded(RL.success_rate(si.run_log(spark, d)))


@query("tail_log", _LOG_SQL + """
SELECT "timestamp", step, duration_min, status, details FROM tidy
ORDER BY "timestamp" DESC, step DESC, status DESC NULLS LAST, duration_min DESC NULLS LAST, details DESC LIMIT 10""")
def q_tail_log(spark, d):
    return RL.tail_log(si.run_log(spark, d)).select("timestamp", "step", "duration_min", "status", "details")
