"""Registered queries: fitted models, stacking and clustering. Linear models have
an SQL oracle that solves for them; the others (iterative fits) have none: the driver
records a rows-only check and the tests hold the invariants (exact solutions against numpy, model beats the mean, weights sum to 1,
same seed gives the same output)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clustering as CL
from ..operators import stacking as st
from . import modeling as MR
from ..operators import models as MD
from .q_eval import _ALIGN_SQL, _GUARD, aligned
from .q_splits import _SPLIT_SQL, SCALE_COLS, features, scaled_split
from .registry import query, r, rounded


def train_test(spark, d):
    s = scaled_split(spark, d)
    return s.where("split = 'train'").drop("split"), s.where("split = 'test'").drop("split")


def _single(kind, params=None):
    def run(spark, d):
        tr, te = train_test(spark, d)
        return rounded(MR.single_model_run(tr, te, kind, params=params)[1])
    return run


def _linear_sql(kind: str, sweeps: int = 400) -> str:
    """A linear model per district in SQL: scaled split, lags renewed inside each part, centred
    moments, then Gauss-Jordan elimination (linear, ridge) or coordinate descent (lasso), one
    step of either per turn of a recursive query."""
    feats = MD.BASE_FEATURES + MD.SINGLE_EXTRA
    new = {"lag_1", "lag_2", "lag_24", "rolling_mean_3h", "rolling_mean_24h"}
    kept = [f for f in feats if f not in new]
    stats = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in kept)
    scaled = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" if c in SCALE_COLS else c for c in kept)
    p = len(feats)
    ridge = {"ridge": MD.RIDGE_ALPHA}.get(kind, 0.0)
    gram = ", ".join("[" + ", ".join(f"covar_pop({f}, {g}) * COUNT(*)" + (f" + {ridge}" if f == g else "") for g in feats)
                     + f", covar_pop({f}, pickups) * COUNT(*)]" for f in feats)
    if kind == "lasso":
        solve = f"""
cd AS (
  SELECT cd_name, a, n, mx, my, 0 AS k, list_transform(range({p}), lambda i: CAST(0 AS DOUBLE)) AS w FROM g
  UNION ALL
  SELECT cd_name, a, n, mx, my, k + 1, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i <> j THEN w[i]
           ELSE sign(rho) * greatest(abs(rho) - {MD.LASSO_ALPHA} * n, 0) / a[j][j] END)
  FROM (SELECT *, k % {p} + 1 AS j, a[k % {p} + 1][{p + 1}] + a[k % {p} + 1][k % {p} + 1] * w[k % {p} + 1]
               - list_sum(list_transform(range(1, {p + 1}), lambda i: a[k % {p} + 1][i] * w[i])) AS rho
        FROM cd WHERE k < {p * sweeps})
),
coef AS (SELECT cd_name, w, mx, my FROM cd WHERE k = {p * sweeps})"""
    else:
        solve = f"""
gj AS (
  SELECT cd_name, a, mx, my, 1 AS k FROM g
  UNION ALL
  SELECT cd_name, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k THEN row
           ELSE list_transform(range(1, {p + 2}), lambda j: a[i][j] - a[i][k] * row[j]) END), mx, my, k + 1
  FROM (SELECT *, list_transform(a[k], lambda v: v / a[k][k]) AS row FROM gj WHERE k <= {p})
),
coef AS (SELECT cd_name, list_transform(a, lambda v: v[{p + 1}]) AS w, mx, my FROM gj WHERE k = {p + 1})"""
    return _SPLIT_SQL.replace("WITH", "WITH RECURSIVE", 1) + f""",
st AS (SELECT {stats} FROM sp WHERE split = 'train'),
top AS (SELECT cd_name FROM (SELECT cd_name, COUNT(*) AS n FROM sp WHERE split = 'train' GROUP BY 1) ORDER BY n DESC, cd_name LIMIT 10),
rl AS (
  SELECT cd_name, pickup_datetime, CAST(pickups AS DOUBLE) AS pickups, split, {scaled},
         LAG(pickups, 1) OVER w AS lag_1, LAG(pickups, 2) OVER w AS lag_2, LAG(pickups, 24) OVER w AS lag_24,
         AVG(pickups) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3h,
         AVG(pickups) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_mean_24h
  FROM sp, st WHERE cd_name IN (SELECT cd_name FROM top) WINDOW w AS (PARTITION BY cd_name, split ORDER BY pickup_datetime)
),
lin AS (SELECT * FROM rl WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_24 IS NOT NULL),
g AS (SELECT cd_name, [{gram}] AS a, CAST(COUNT(*) AS DOUBLE) AS n, [{', '.join(f'AVG({f})' for f in feats)}] AS mx, AVG(pickups) AS my
      FROM lin WHERE split = 'train' GROUP BY cd_name),{solve},
pr AS (SELECT cd_name AS district, pickups AS y_true, CAST(lag_1 AS DOUBLE) AS lag_1,
              my + list_sum(list_transform(range(1, {p + 1}), lambda i: w[i] * (x[i] - mx[i]))) AS y_pred
       FROM (SELECT lin.*, w, mx, my, [{', '.join(f'CAST({f} AS DOUBLE)' for f in feats)}] AS x FROM lin JOIN coef USING (cd_name) WHERE split = 'test')),
sc AS (SELECT district, sqrt(AVG(power(y_true - y_pred, 2))) AS model_rmse, sqrt(AVG(power(y_true - lag_1, 2))) AS baseline_rmse,
              {_GUARD} AS correlation FROM pr GROUP BY 1)
SELECT district, {r('model_rmse')}, {r('baseline_rmse')}, {r('100.0 * (1.0 - model_rmse / NULLIF(baseline_rmse, 0))', '"improvement_%"')},
       {r('correlation')}, {r('AVG(model_rmse) OVER ()', 'mean_rmse')} FROM sc"""


for _kind in ("linear", "ridge", "lasso"):
    query(f"{_kind}_fit", _linear_sql(_kind))(_single(_kind))
query("rf_fit")(_single("rf"))
query("gbm_fit")(_single("lgbm"))


@query("ensemble_run")
def q_ensemble_run(spark, d):
    """RF (500 trees) + GBM (up to 5,000 rounds, early stopping on the 14-day validation cut) +
    soft blend per top-10 district: summary of the blended model against the lag-1 baseline."""
    tr, te = train_test(spark, d)
    return rounded(MR.ensemble_run(tr, te)[1])


@query("sequence_regressor")
def q_sequence_regressor(spark, d):
    return rounded(MR.sequence_run(features(spark, d))[1])


def _meta(spark, d):
    from ..operators.splits import holdout_split
    return holdout_split(aligned(spark, d)).where("part = 'meta'")


_XS = ("y_rf", "y_lgbm", "y_conv")
_META_SQL = _ALIGN_SQL + """,
ho AS (SELECT *, COUNT(*) OVER (PARTITION BY district) AS n_al, CASE WHEN ROW_NUMBER() OVER (PARTITION BY district ORDER BY pos) - 1
         < greatest(10, floor(CAST(0.6 AS DOUBLE) * COUNT(*) OVER (PARTITION BY district))) THEN 'meta' ELSE 'hold' END AS part FROM al),
mt AS (SELECT * FROM ho WHERE part = 'meta')"""


def _moments() -> str:
    """Count, means and centred moments of the three series and the truth."""
    return ("CAST(COUNT(*) AS DOUBLE) AS n, AVG(y_true) AS my, " + ", ".join(f"AVG({x}) AS m{i}" for i, x in enumerate(_XS)) + ", "
            + ", ".join(f"covar_pop({_XS[i]}, {_XS[j]}) * COUNT(*) AS g{i}{j}" for i in range(3) for j in range(i, 3)) + ", "
            + ", ".join(f"covar_pop({x}, y_true) * COUNT(*) AS c{i}" for i, x in enumerate(_XS)))


#: Ridge for every alpha by elimination of [G + alpha | c | I], then exact leave-one-out errors.
_RIDGE_CV_SQL = """,
rm AS (SELECT district, """ + _moments() + """ FROM mt GROUP BY district),
ra AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, CAST({a!r} AS DOUBLE))" for i, a in enumerate(st.RIDGE_ALPHAS)) + """) v(ai, alpha)),
gj AS (
  SELECT district, ai, 1 AS k, [[g00 + alpha, g01, g02, c0, 1, 0, 0], [g01, g11 + alpha, g12, c1, 0, 1, 0], [g02, g12, g22 + alpha, c2, 0, 0, 1]] AS a
  FROM rm, ra
  UNION ALL
  SELECT district, ai, k + 1, list_transform(range(1, 4), lambda i: CASE WHEN i = k THEN row
           ELSE list_transform(range(1, 8), lambda j: a[i][j] - a[i][k] * row[j]) END)
  FROM (SELECT *, list_transform(a[k], lambda v: v / a[k][k]) AS row FROM gj WHERE k <= 3)
),
rs AS (SELECT district, ai, alpha, n, m0, m1, m2, my, a[1][4] AS w0, a[2][4] AS w1, a[3][4] AS w2, a FROM gj JOIN rm USING (district) JOIN ra USING (ai) WHERE k = 4),
rl AS (SELECT district, ai, AVG(power((y_true - my - w0 * d[1] - w1 * d[2] - w2 * d[3])
           / nullif(1 - 1 / n - list_sum(list_transform(range(1, 4), lambda i: d[i] * (a[i][5] * d[1] + a[i][6] * d[2] + a[i][7] * d[3]))), 0), 2)) AS e
       FROM (SELECT rs.*, y_true, [y_rf - m0, y_lgbm - m1, y_conv - m2] AS d FROM mt JOIN rs USING (district)) GROUP BY 1, 2),
rb AS (SELECT district, ai FROM rl QUALIFY ROW_NUMBER() OVER (PARTITION BY district ORDER BY e, ai) = 1),
rc AS (SELECT district, alpha, my - w0 * m0 - w1 * m1 - w2 * m2 AS intercept, w0, w1, w2 FROM rs JOIN rb USING (district, ai))"""


def _sweep(inner: str) -> str:
    """One sweep of coordinate descent over the three weights."""
    soft = lambda rho: f"(sign({rho}) * greatest(abs({rho}) - t1, 0) + 0.0)"
    rho = ["c0 - g01 * w1 - g02 * w2", "c1 - g01 * w0 - g12 * w2", "c2 - g02 * w0 - g12 * w1"]
    for i in range(3):
        inner = f"SELECT * REPLACE (CASE WHEN g{i}{i} > 0 THEN {soft(rho[i])} / (g{i}{i} + t2) ELSE w{i} END AS w{i}) FROM ({inner})"
    return inner


def _enet_cv_sql(turns: int = 300, sweeps: int = 8) -> str:
    """Elastic net for every fold left out (3: none) and grid point, held-out errors, best point."""
    grid = [(i, l1, a) for i, l1 in enumerate(st.ENET_L1) for a in st.ENET_ALPHAS]
    step = "SELECT e.*, w0, w1, w2, it FROM ecd JOIN em e USING (id) WHERE it < " + str(turns)
    for _ in range(sweeps):
        step = _sweep(step)
    return f""",
fd AS (SELECT *, CASE WHEN p < n // 3 + least(1, n % 3) THEN 0 WHEN p < 2 * (n // 3) + least(2, n % 3) THEN 1 ELSE 2 END AS fold
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY district ORDER BY pos) - 1 AS p, COUNT(*) OVER (PARTITION BY district) AS n FROM mt)),
eg AS (SELECT * FROM (VALUES {', '.join(f'({i}, {l1}, CAST({a!r} AS DOUBLE))' for i, l1, a in grid)}) v(li, l1, alpha)),
em AS MATERIALIZED (SELECT row_number() OVER () AS id, *, alpha * CAST(l1 AS DOUBLE) * n AS t1, alpha * (1 - CAST(l1 AS DOUBLE)) * n AS t2
       FROM (SELECT district, k, {_moments()} FROM fd, range(4) t(k) WHERE fold <> k GROUP BY district, k), eg),
ecd AS (
  SELECT id, 0 AS it, CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2 FROM em
  UNION ALL SELECT id, it + 1, w0, w1, w2 FROM ({step})
),
es AS (SELECT em.*, w0, w1, w2, my - w0 * m0 - w1 * m1 - w2 * m2 AS b FROM ecd JOIN em USING (id) WHERE it = {turns}),
ee AS (SELECT district, li, alpha, AVG(e) AS e FROM (
         SELECT fd.district, k, li, alpha, AVG(power(y_true - b - w0 * y_rf - w1 * y_lgbm - w2 * y_conv, 2)) AS e
         FROM fd JOIN es ON fd.district = es.district AND fold = k GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
ea AS (SELECT district, li, alpha, e FROM (SELECT DISTINCT district FROM mt) CROSS JOIN eg LEFT JOIN ee USING (district, li, alpha)),
eb AS (SELECT district, li, alpha FROM ea QUALIFY ROW_NUMBER() OVER (PARTITION BY district ORDER BY round(e, 9) NULLS LAST, li, alpha DESC) = 1),
ec AS (SELECT district, CAST(l1 AS DOUBLE) AS l1_ratio, alpha, b AS intercept, w0, w1, w2 FROM es JOIN eb USING (district, li, alpha) WHERE k = 3)"""


_HYBRID_SQL = _META_SQL + _RIDGE_CV_SQL + _enet_cv_sql() + """,
hp AS (SELECT ho.*, rc.intercept + rc.w0 * y_rf + rc.w1 * y_lgbm + rc.w2 * y_conv AS pr, ec.intercept + ec.w0 * y_rf + ec.w1 * y_lgbm + ec.w2 * y_conv AS pe
       FROM ho JOIN rc USING (district) JOIN ec USING (district) WHERE part = 'hold' AND n_al >= 20),
hs AS (SELECT district, sqrt(AVG(power(y_true - pe, 2))) < sqrt(AVG(power(y_true - pr, 2))) AS use_enet FROM hp GROUP BY 1),
hy AS (SELECT district, pos, pickup_datetime, y_true, CASE WHEN use_enet THEN pe ELSE pr END AS y_pred_blend, y_rf, y_lgbm, y_conv,
              CASE WHEN use_enet THEN 'ElasticNet' ELSE 'Ridge' END AS method FROM hp JOIN hs USING (district)
       UNION ALL SELECT district, pos, pickup_datetime, y_true, (y_rf + y_lgbm + y_conv) / 3, y_rf, y_lgbm, y_conv, 'MeanBlend' FROM ho WHERE n_al < 20)"""
_RECURSIVE = ("WITH", "WITH RECURSIVE", 1)
_W = ", ".join([r("alpha"), r("intercept"), r("w0"), r("w1"), r("w2")])


@query("ridge_cv", (_META_SQL + _RIDGE_CV_SQL).replace(*_RECURSIVE) + f"\nSELECT district, {_W} FROM rc")
def q_ridge_cv(spark, d):
    return rounded(st.ridge_cv(_meta(spark, d), list(_XS))
                   .select("district", "alpha", "intercept", *[F.col("coef")[i].alias(f"w{i}") for i in range(3)]))


@query("elastic_net_cv", (_META_SQL + _enet_cv_sql()).replace(*_RECURSIVE) + f"\nSELECT district, {r('l1_ratio')}, {_W} FROM ec")
def q_elastic_net_cv(spark, d):
    return rounded(st.elastic_net_cv(_meta(spark, d), list(_XS))
                   .select("district", "l1_ratio", "alpha", "intercept",
                           *[F.col("coef")[i].alias(f"w{i}") for i in range(3)]))


def _hybrid(spark, d):
    from .q_eval import _series
    s = _series(spark, d)
    return MR.hybrid_run(s["rf"], s["lgbm"], s["conv"])


@query("meta_select", _HYBRID_SQL.replace(*_RECURSIVE) + """
SELECT district, """ + r("sqrt(AVG(power(y_true - y_pred_blend, 2)))", "rmse_blend") + ", method FROM hy GROUP BY district, method")
def q_meta_select(spark, d):
    """Per district: the meta-model chosen (elastic net only when its hold-out RMSE is
    strictly lower) and its hold-out RMSE."""
    return rounded(_hybrid(spark, d)[1])


@query("hybrid_output", _HYBRID_SQL.replace(*_RECURSIVE) + """
SELECT district, CAST(pos AS BIGINT) AS pos, pickup_datetime, """ + ", ".join([r("y_true"), r("y_pred_blend"), r("y_rf", "y_pred_rf"),
    r("y_lgbm", "y_pred_lgbm"), r("y_conv", "y_pred_conv")]) + ", method FROM hy")
def q_hybrid_output(spark, d):
    return rounded(_hybrid(spark, d)[0])


@query("kmeans_elbow")
def q_kmeans_elbow(spark, d):
    from . import standins as si
    return rounded(CL.kmeans_elbow(si.pickups(spark, d)))


@query("kmeans_assign")
def q_kmeans_assign(spark, d):
    """Every pickup with its cluster."""
    from . import standins as si
    points, _ = CL.kmeans_assign(si.pickups(spark, d))
    return points.select("event_id", F.col("Cluster").alias("cluster"))


@query("sample_n", """SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id FROM lineitem)
ORDER BY md5(id || ':42'), id LIMIT 2000""")
def q_sample_n(spark, d):
    """2,000 line items drawn reproducibly (seed 42)."""
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"))
    return CL.sample_n(li, 2000, 42, "id").drop("id")
