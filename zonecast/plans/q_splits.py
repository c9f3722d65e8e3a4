"""Registered queries: splits, scalers, sequence windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as feat
from ..operators import scaling as sc
from ..operators import sequences as sq
from ..operators import splits as spl
from . import standins as si
from .q_features import features_all, hourly
from .registry import query, r, rounded

# the 17 scaled columns of the split step: every feature column except time, target, key
SCALE_COLS = [c for c in feat.FEATURE_COLUMNS if c not in ("cd_name", "pickup_datetime", "pickups")]


def features(spark, d):
    return feat.build_features(hourly(spark, d))


def split_features(spark, d):
    return spl.chrono_split(features(spark, d))


_SPLIT_SQL = "WITH " + si.FEATURES_SQL + """,
sp AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY cd_name ORDER BY pickup_datetime)
                      <= floor(COUNT(*) OVER (PARTITION BY cd_name) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM features
)"""


@query("chrono_split", _SPLIT_SQL + "\nSELECT cd_name, pickup_datetime, split FROM sp")
def q_chrono_split(spark, d):
    return split_features(spark, d).select("cd_name", "pickup_datetime", "split")


@query("chrono_split_global", "WITH " + si.FEATURES_SQL + """
SELECT cd_name, pickup_datetime,
       CASE WHEN ROW_NUMBER() OVER (ORDER BY pickup_datetime, cd_name)
                 <= floor((SELECT COUNT(*) FROM features) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM features""")
def q_chrono_split_global(spark, d):
    return spl.chrono_split(features(spark, d), by_district=False).select("cd_name", "pickup_datetime", "split")


def _std_sql():
    stats = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in SCALE_COLS)
    cols = ", ".join(r(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END", c) for c in SCALE_COLS)
    return (_SPLIT_SQL + f""",
st AS (SELECT {stats} FROM sp WHERE split = 'train')
SELECT {cols}, pickup_datetime, pickups, cd_name, split FROM sp, st""")


def scaled_split(spark, d):
    df = split_features(spark, d)
    stats = sc.standard_stats(df.where("split = 'train'"), SCALE_COLS)
    cols = SCALE_COLS + ["pickup_datetime", "pickups", "cd_name", "split"]
    return sc.apply_standard(df, stats, SCALE_COLS).select(*cols)


@query("standard_scale", _std_sql())
def q_standard_scale(spark, d):
    """Split per district (80/20 by time), then standard scaling fitted on train (all
    districts together, population std) applied to both parts."""
    return rounded(scaled_split(spark, d))


@query("impute_train_mean", "WITH " + si.FEATURES_ALL_SQL + """,
sp AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY cd_name ORDER BY pickup_datetime)
                      <= floor(COUNT(*) OVER (PARTITION BY cd_name) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM feat_all
),
m AS (SELECT AVG(lag_24) AS m24, AVG(rolling_std_24h) AS ms FROM sp WHERE split = 'train')
SELECT cd_name, pickup_datetime, split, """ + r("COALESCE(lag_24, m24)", "lag_24") + ", "
       + r("COALESCE(rolling_std_24h, ms)", "rolling_std_24h") + " FROM sp, m")
def q_impute_train_mean(spark, d):
    df = spl.chrono_split(features_all(spark, d)).select("cd_name", "pickup_datetime", "split",
                                                         F.col("lag_24").cast("double").alias("lag_24"),
                                                         "rolling_std_24h")
    tr, te = C.impute_train_mean(df.where("split = 'train'"), df.where("split = 'test'"),
                                 ["lag_24", "rolling_std_24h"])
    return rounded(tr.unionByName(te))


_RELAG_SQL = _SPLIT_SQL + """,
rl AS (
  SELECT cd_name, pickup_datetime, pickups, split,
         LAG(pickups, 1) OVER w AS lag_1, LAG(pickups, 2) OVER w AS lag_2, LAG(pickups, 24) OVER w AS lag_24,
         AVG(pickups) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3h,
         AVG(pickups) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_mean_24h
  FROM sp WINDOW w AS (PARTITION BY cd_name, split ORDER BY pickup_datetime)
),
rl2 AS (SELECT * FROM rl WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_24 IS NOT NULL)"""


def relagged(spark, d):
    df = split_features(spark, d).select("cd_name", "pickup_datetime", "pickups", "split")
    return feat.relag_per_split(df, "split")


@query("relag_per_split", _RELAG_SQL + """
SELECT cd_name, pickup_datetime, pickups, split, lag_1, lag_2, lag_24, """
       + r("rolling_mean_3h") + ", " + r("rolling_mean_24h") + " FROM rl2")
def q_relag_per_split(spark, d):
    return rounded(relagged(spark, d))


@query("cutoff_split", _RELAG_SQL + """,
tr AS (SELECT * FROM rl2 WHERE split = 'train'),
c AS (
  SELECT cd_name, pickup_datetime,
         pickup_datetime >= MAX(pickup_datetime) OVER (PARTITION BY cd_name) - INTERVAL 14 DAY AS is_val_time,
         COUNT(*) OVER (PARTITION BY cd_name) AS n,
         ROW_NUMBER() OVER (PARTITION BY cd_name ORDER BY pickup_datetime) AS pos
  FROM tr
),
c2 AS (SELECT *, SUM(CASE WHEN is_val_time THEN 1 ELSE 0 END) OVER (PARTITION BY cd_name) AS n_val FROM c)
SELECT cd_name, pickup_datetime,
       CASE WHEN (CASE WHEN n_val < 100 THEN pos > floor(n * CAST(0.9 AS DOUBLE)) ELSE is_val_time END)
            THEN 'val' ELSE 'fit' END AS fit_split
FROM c2""")
def q_cutoff_split(spark, d):
    tr = relagged(spark, d).where("split = 'train'")
    return spl.cutoff_split(tr).select("cd_name", "pickup_datetime", "fit_split")


_SEQ_SQL = "WITH " + si.FEATURES_SQL + """,
topd AS (SELECT cd_name FROM (SELECT cd_name, COUNT(*) AS n FROM features GROUP BY cd_name)
         ORDER BY n DESC, cd_name LIMIT 10),
f AS (SELECT * FROM features WHERE cd_name IN (SELECT cd_name FROM topd)),
s AS (
  SELECT cd_name, pickup_datetime, """ + ",\n         ".join(
    f"(CAST({c} AS DOUBLE) - MIN({c}) OVER p) / CASE WHEN MAX({c}) OVER p = MIN({c}) OVER p THEN 1.0 "
    f"ELSE CAST(MAX({c}) OVER p - MIN({c}) OVER p AS DOUBLE) END AS {c}" for c in sq.SEQ_FEATURES) + """
  FROM f WINDOW p AS (PARTITION BY cd_name)
),
s2 AS (SELECT *, """ + " + ".join(sq.SEQ_FEATURES) + """ AS rowsum FROM s),
w AS (
  SELECT cd_name, pickup_datetime, pickups AS y,
         COUNT(*) OVER (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS len,
         LAG(pickups, 24) OVER (PARTITION BY cd_name ORDER BY pickup_datetime) AS x_first,
         LAG(pickups, 1) OVER (PARTITION BY cd_name ORDER BY pickup_datetime) AS x_last,
         SUM(rowsum) OVER (PARTITION BY cd_name ORDER BY pickup_datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS x_sum
  FROM s2
),
seq AS (SELECT * FROM w WHERE len = 24),
seq2 AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cd_name ORDER BY pickup_datetime) - 1 AS idx,
         COUNT(*) OVER (PARTITION BY cd_name) AS n FROM seq
)"""


@query("sequence_windows", _SEQ_SQL + """
SELECT cd_name, pickup_datetime, """ + ", ".join([r("y"), r("x_first"), r("x_last"), r("x_sum")]) + """,
       CASE WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train'
            WHEN idx < floor(CAST(0.9 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split,
       CAST(336 AS INTEGER) AS x_len
FROM seq2""")
def q_sequence_windows(spark, d):
    """The sequence job: top-10 districts by rows, min-max per district, 24-step windows,
    0.8 / 0.9 positional split. Reported with a digest of X (first and last step's
    pickups, total of all 336 values, length)."""
    s = sq.sequence_job(features(spark, d))
    flat = F.flatten("X")
    out = s.select("cd_name", "pickup_datetime", "y",
                   F.col("X")[0][0].alias("x_first"), F.col("X")[23][0].alias("x_last"),
                   F.aggregate(flat, F.lit(0.0), lambda a, b: a + b).alias("x_sum"),
                   "split", F.size(flat).alias("x_len"))
    return rounded(out)


@query("sequence_split", _SEQ_SQL + """
SELECT cd_name, CASE WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train'
            WHEN idx < floor(CAST(0.9 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split, COUNT(*) AS n_rows
FROM seq2 GROUP BY 1, 2""")
def q_sequence_split(spark, d):
    s = sq.sequence_job(features(spark, d))
    return s.groupBy("cd_name", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("minmax_scale", _SEQ_SQL + "\nSELECT cd_name, pickup_datetime, " + ", ".join(r(c) for c in sq.SEQ_FEATURES) + " FROM s")
def q_minmax_scale(spark, d):
    f = features(spark, d)
    top = spl_top(f)
    return rounded(sc.minmax_scale(f.join(F.broadcast(top), "cd_name", "left_semi"), sq.SEQ_FEATURES)
                   .select("cd_name", "pickup_datetime", *sq.SEQ_FEATURES))


def spl_top(f, k=10):
    from ..operators import eda
    return eda.topk_by_rows(f, k).select("cd_name")


@query("minmax_inverse", _SEQ_SQL + "\nSELECT cd_name, pickup_datetime, " + r("f.pickups", "y_true")
       + " FROM seq JOIN f USING (cd_name, pickup_datetime)")
def q_minmax_inverse(spark, d):
    """Scaled targets of the sequence windows mapped back with the per-district
    statistics table: equals the raw pickups."""
    f = features(spark, d)
    stats = sc.minmax_stats(f.join(F.broadcast(spl_top(f)), "cd_name", "left_semi"), ["pickups"])
    s = sq.sequence_job(f).select("cd_name", "pickup_datetime", F.col("y").alias("y_true"))
    return rounded(sc.minmax_inverse(s, stats, "y_true", "pickups"))
