"""Numerical checks of the model layer against straightforward numpy computations on the
same rows (brute force), plus invariants (weights sum to 1, determinism)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonecast.operators import models as MD
from zonecast.operators import stacking as st
from zonecast.operators import timeseries as TSR


def _frame(spark, seed=0, n=60, p=3, groups=("a", "b")):
    rng = np.random.default_rng(seed)
    rows = []
    for g in groups:
        X = rng.normal(size=(n, p))
        y = X @ rng.normal(size=p) + 2.0 + rng.normal(scale=0.3, size=n)
        for i in range(n):
            rows.append((g, i, *map(float, X[i]), float(y[i])))
    cols = ["cd_name", "pos"] + [f"x{j}" for j in range(p)] + ["y"]
    return spark.createDataFrame(pd.DataFrame(rows, columns=cols)), rows, cols


def _np_group(rows, g, p):
    a = np.array([r[2:] for r in rows if r[0] == g], dtype=float)
    return a[:, :p], a[:, p]


@pytest.mark.parametrize("kind,alpha", [("linear", 0.0), ("ridge", 1.0)])
def test_ols_ridge_equal_closed_form(spark, kind, alpha):
    df, rows, _ = _frame(spark)
    feats = ["x0", "x1", "x2"]
    coefs = {r["cd_name"]: r for r in MD.fit_linear(df, feats, kind, target="y").collect()}
    for g in ("a", "b"):
        X, y = _np_group(rows, g, 3)
        Xc, yc = X - X.mean(0), y - y.mean()
        w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
        assert np.allclose(coefs[g]["coef"], w, atol=1e-9)
        assert coefs[g]["intercept"] == pytest.approx(y.mean() - X.mean(0) @ w, abs=1e-9)


def test_lasso_kkt(spark):
    df, rows, _ = _frame(spark, seed=3)
    feats = ["x0", "x1", "x2"]
    alpha = 0.1
    coefs = {r["cd_name"]: r for r in MD.fit_linear(df, feats, "lasso", target="y").collect()}
    for g in ("a", "b"):
        X, y = _np_group(rows, g, 3)
        w, b = np.array(coefs[g]["coef"]), coefs[g]["intercept"]
        grad = X.T @ (y - X @ w - b) / len(y)
        for j in range(3):
            if abs(w[j]) > 1e-12:
                assert grad[j] == pytest.approx(alpha * np.sign(w[j]), abs=1e-7)
            else:
                assert abs(grad[j]) <= alpha + 1e-7


def test_predict_linear_matches_numpy(spark):
    df, rows, _ = _frame(spark)
    feats = ["x0", "x1", "x2"]
    c = MD.fit_linear(df, feats, "ridge", target="y")
    pr = {(r["cd_name"], r["pos"]): r["y_pred"] for r in MD.predict_linear(df, c, feats).collect()}
    cc = {r["cd_name"]: r for r in c.collect()}
    for r in rows[:20]:
        exp = cc[r[0]]["intercept"] + np.dot(cc[r[0]]["coef"], r[2:5])
        assert pr[(r[0], r[1])] == pytest.approx(exp, abs=1e-9)


def test_ridge_cv_brute_force_loo(spark):
    df, rows, _ = _frame(spark, seed=5, n=40)
    feats = ["x0", "x1", "x2"]
    got = {r["district"]: r for r in st.ridge_cv(df.withColumnRenamed("cd_name", "district"), feats, "y").collect()}
    for g in ("a", "b"):
        X, y = _np_group(rows, g, 3)
        best = None
        for a in st.RIDGE_ALPHAS:
            errs = []
            for i in range(len(y)):
                m = np.ones(len(y), bool)
                m[i] = False
                Xt, yt = X[m], y[m]
                xm, ym = Xt.mean(0), yt.mean()
                w = np.linalg.solve((Xt - xm).T @ (Xt - xm) + a * np.eye(3), (Xt - xm).T @ (yt - ym))
                errs.append((y[i] - (ym - xm @ w) - X[i] @ w) ** 2)
            e = np.mean(errs)
            if best is None or e < best[0] - 1e-15:
                best = (e, a)
        assert got[g]["alpha"] == pytest.approx(best[1])


def _cd(X, y, a, l1, iters=20000):
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    n, p = X.shape
    w = np.zeros(p)
    for _ in range(iters):
        old = w.copy()
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r
            w[j] = np.sign(rho) * max(abs(rho) - a * l1 * n, 0) / (Xc[:, j] @ Xc[:, j] + a * (1 - l1) * n)
        if np.max(np.abs(w - old)) < 1e-12:
            break
    return ym - xm @ w, w


def test_elastic_net_cv_brute_force(spark):
    df, rows, _ = _frame(spark, seed=7, n=31, groups=("a",))
    feats = ["x0", "x1", "x2"]
    got = st.elastic_net_cv(df.withColumnRenamed("cd_name", "district"), feats, "y").first()
    X, y = _np_group(rows, "a", 3)
    n = len(y)
    sizes = [n // 3 + (1 if i < n % 3 else 0) for i in range(3)]
    bounds = np.cumsum([0] + sizes)
    best = None
    for l1 in st.ENET_L1:
        for a in sorted(st.ENET_ALPHAS, reverse=True):
            ms = []
            for f in range(3):
                m = np.ones(n, bool)
                m[bounds[f]:bounds[f + 1]] = False
                b, w = _cd(X[m], y[m], a, l1)
                ms.append(np.mean((y[~m] - b - X[~m] @ w) ** 2))
            e = np.mean(ms)
            if best is None or e < best[0] - 1e-12:
                best = (e, l1, a)
    assert (got["l1_ratio"], got["alpha"]) == pytest.approx((best[1], best[2]))
    b, w = _cd(X, y, best[2], best[1])
    assert np.allclose(got["coef"], w, atol=1e-6)


def _series_df(spark, vals):
    import datetime as dt
    rows = [("d", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "cd_name string, ts timestamp_ntz, pickups double")


def test_acf_pacf_against_numpy(spark):
    rng = np.random.default_rng(11)
    x = np.zeros(120)
    for t in range(2, 120):
        x[t] = 0.6 * x[t - 1] - 0.2 * x[t - 2] + rng.normal()
    df = _series_df(spark, x)
    K = 10
    acf = sorted((r["lag"], r["acf"]) for r in TSR.acf(df, max_lag=K, min_points=K).collect())
    d = x - x.mean()
    n = len(x)
    ref = [np.sum(d[k:] * d[:n - k]) / np.sum(d * d) for k in range(K + 1)]
    assert np.allclose([v for _, v in acf], ref, atol=1e-12)
    pacf = sorted((r["lag"], r["pacf"]) for r in TSR.pacf_yw(df, max_lag=K, min_points=K).collect())
    r_ = np.array([np.sum(d[k:] * d[:n - k]) / (n - k) for k in range(K + 1)])
    expect = [1.0]
    for k in range(1, K + 1):
        R = np.array([[r_[abs(i - j)] for j in range(k)] for i in range(k)])
        expect.append(np.linalg.solve(R, r_[1:k + 1])[-1])
    assert np.allclose([v for _, v in pacf], expect, atol=1e-10)


def test_soft_blend_weights_sum_to_one(spark):
    from zonecast.operators.forecast import soft_blend_weights
    sc = spark.createDataFrame([("d", "rf", 2.0), ("d", "lgbm", 4.0), ("e", "rf", 0.0), ("e", "lgbm", 1.0)],
                               "district string, model string, rmse double")
    w = soft_blend_weights(sc).groupBy("district").agg(F.sum("weight").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in w)


def test_sample_n_exact_and_deterministic(spark):
    from zonecast.operators.clustering import sample_n
    df = spark.range(5000).withColumnRenamed("id", "event_id")
    a = [r["event_id"] for r in sample_n(df, 700).collect()]
    b = [r["event_id"] for r in sample_n(df, 700).collect()]
    assert len(a) == 700 and sorted(a) == sorted(b) and len(set(a)) == 700
    assert sample_n(df, 10_000).count() == 5000


def test_kmeans_same_seed_same_output(spark):
    from zonecast.operators.clustering import kmeans_report
    from zonecast.plans.standins import pickups
    p = pickups(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in kmeans_report(p, k=4).collect())
    b = sorted(tuple(r) for r in kmeans_report(p, k=4).collect())
    assert a == b and sum(r[1] for r in a) == p.count()


def test_tree_models_run_per_district(spark):
    df, _, _ = _frame(spark, n=80)
    feats = ["x0", "x1", "x2"]
    out = MD.fit_predict_trees(df, df, feats, "rf", {"n_trees": 5, "max_depth": 4}, target="y")
    assert out.count() == 160
    r = out.select(F.sqrt(F.avg(F.pow(F.col("y") - F.col("y_pred"), 2))).alias("e"),
                   F.stddev_pop("y").alias("s")).first()
    assert r["e"] < r["s"]      # better than predicting the mean
    g = MD.fit_predict_trees(df.withColumn("v", F.col("pos") >= 60), df, feats, "gbm",
                             {"rounds": 20, "max_depth": 2, "min_leaf": 5}, target="y", validation_col="v")
    assert g.count() == 160 and g.where("y_pred is null").count() == 0
