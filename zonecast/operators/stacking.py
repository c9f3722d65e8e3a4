"""Stacking meta-models of the hybrid blend (SURVEY 2.9 ``ridge_cv``, ``elastic_net_cv``,
``meta_select``, ``mean_blend``, ``hybrid_output``).

Everything is driven by per-district sufficient statistics:
* ridge with leave-one-out choice of alpha: one grouped aggregation of Gram sums, a small
  per-district solve for each of the 20 alphas (``applyInPandas`` on one row per
  district), then the exact leave-one-out residual e_i / (1 - h_i) as a column
  expression on the meta rows joined with the (district, alpha) parameter table;
* elastic net with 3 contiguous folds: Gram sums per (district, fold); the training Gram
  of a fold is total - fold, the held-out error comes from the fold's own sums, so the
  whole 5 x 15 x 3 grid needs no further pass over the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .models import centered, gram_sums, solve_enet

KEY = "district"
# The meta-model grids.
RIDGE_ALPHAS = [float(a) for a in np.logspace(-3, 2, 20)]
ENET_L1 = [0.1, 0.3, 0.5, 0.7, 1.0]
ENET_ALPHAS = [float(a) for a in np.logspace(-3, 1, 15)]
ENET_FOLDS = 3
ENET_MAX_ITER = 20000


def _ridge_params(keys, p):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, row in pdf.iterrows():
            G, c, xbar, ybar, n = centered(row)
            for ai, a in enumerate(RIDGE_ALPHAS):
                A = np.linalg.inv(G + a * np.eye(p))
                w = A @ c
                rec = {k: row[k] for k in keys}
                rec.update(alpha_idx=ai, alpha=a, intercept=float(ybar - xbar @ w), coef=w.tolist(),
                           ainv=A.reshape(-1).tolist(), xbar=xbar.tolist(), n=float(n))
                rows.append(rec)
        return pd.DataFrame(rows, columns=list(keys) + ["alpha_idx", "alpha", "intercept", "coef", "ainv", "xbar", "n"])
    return fit


def ridge_cv(meta: DataFrame, features, target: str = "y_true", key: str = KEY) -> DataFrame:
    """Per district: alpha chosen by exact leave-one-out error (first alpha on ties) and
    the ridge fitted with it. Returns (key, alpha, intercept, coef)."""
    p = len(features)
    g = gram_sums(meta, features, target, (key,))
    kt = dict(g.dtypes)[key]
    params = g.groupBy(key).applyInPandas(
        _ridge_params([key], p),
        f"`{key}` {kt}, alpha_idx int, alpha double, intercept double, coef array<double>, "
        "ainv array<double>, xbar array<double>, n double")
    x = [F.col(f).cast("double") for f in features]
    j = meta.join(params, key, "inner")
    pred = F.col("intercept")
    for i in range(p):
        pred = pred + F.col("coef")[i] * x[i]
    d = [x[i] - F.col("xbar")[i] for i in range(p)]
    h = F.lit(0.0)
    for a in range(p):
        for b in range(p):
            h = h + d[a] * F.col("ainv")[a * p + b] * d[b]
    h = h + F.lit(1.0) / F.col("n")
    loo = F.try_divide(F.col(target) - pred, F.lit(1.0) - h)
    err = j.groupBy(key, "alpha_idx").agg(F.avg(loo * loo).alias("loo_mse"))
    w = Window.partitionBy(key).orderBy(F.col("loo_mse").asc(), F.col("alpha_idx").asc())
    best = err.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, "alpha_idx")
    return params.join(best, [key, "alpha_idx"]).select(key, "alpha", "intercept", "coef")


def fold_ids(meta: DataFrame, key: str = KEY, order: str = "pos", k: int = ENET_FOLDS) -> DataFrame:
    """Contiguous k folds by position; the first n % k folds are one row longer."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    pos = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    base, rem = F.floor(n / k), n % k
    # end (exclusive) of fold f = (f + 1) * base + min(f + 1, rem)
    fold = F.lit(k - 1)
    for f in range(k - 2, -1, -1):
        end = (f + 1) * base + F.least(F.lit(f + 1), rem)
        fold = F.when(pos < end, F.lit(f)).otherwise(fold)
    return meta.withColumn("fold", fold)


def _enet_grid(key, p):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = {int(r["fold"]): r for _, r in pdf.iterrows()}

        def arr(r):
            return (float(r["n"]), np.asarray(r["sx"], float), float(r["sy"]),
                    np.asarray(r["sxx"], float).reshape(p, p), np.asarray(r["sxy"], float), float(r["syy"]))
        folds = {f: arr(r) for f, r in rows.items()}
        total = [sum(v[i] for v in folds.values()) for i in range(6)]

        def fit_sums(s, a, l1, w0=None):
            n, sx, sy, sxx, sxy, _ = s
            xbar, ybar = sx / n, sy / n
            G = sxx - n * np.outer(xbar, xbar)
            c = sxy - n * xbar * ybar
            w = solve_enet(G, c, n, a, l1, ENET_MAX_ITER, 1e-12, w0)
            return float(ybar - xbar @ w), w

        def sse(s, b, w):
            n, sx, sy, sxx, sxy, syy = s
            return syy - 2 * b * sy - 2 * w @ sxy + n * b * b + 2 * b * (w @ sx) + w @ sxx @ w

        best = None
        alphas = sorted(ENET_ALPHAS, reverse=True)
        for l1 in ENET_L1:
            warm = {}           # per fold: the solution at the previous (larger) alpha
            for a in alphas:
                mses = []
                for f, s in folds.items():
                    tr = [total[i] - s[i] for i in range(6)]
                    if tr[0] < 1:
                        continue
                    b, w = fit_sums(tr, a, l1, warm.get(f))
                    warm[f] = w
                    mses.append(sse(s, b, w) / s[0])
                m = float(np.mean(mses)) if mses else np.inf
                if best is None or m < best[0]:
                    best = (m, l1, a)
        _, l1, a = best
        b, w = fit_sums(total, a, l1)
        first = pdf.iloc[0]         # the sums are about the district's means
        b = b + float(first["my"]) - float(np.asarray(first["mx"], float) @ w)
        return pd.DataFrame([{key: pdf[key].iloc[0], "l1_ratio": l1, "alpha": a, "intercept": b,
                              "coef": [float(v) for v in w]}])
    return fit


def elastic_net_cv(meta: DataFrame, features, target: str = "y_true", key: str = KEY,
                   order: str = "pos") -> DataFrame:
    """Per district: (l1_ratio, alpha) by 3-fold contiguous CV mean squared error, then the
    model refitted on all meta rows. Returns (key, l1_ratio, alpha, intercept, coef)."""
    g = gram_sums(fold_ids(meta, key, order), features, target, (key, "fold"), (key,))
    kt = dict(g.dtypes)[key]
    return g.groupBy(key).applyInPandas(
        _enet_grid(key, len(features)),
        f"`{key}` {kt}, l1_ratio double, alpha double, intercept double, coef array<double>")


def predict(df: DataFrame, params: DataFrame, features, key: str = KEY, out: str = "y_pred") -> DataFrame:
    j = df.join(params.select(key, "intercept", "coef"), key, "inner")
    pred = F.col("intercept")
    for i, f in enumerate(features):
        pred = pred + F.col("coef")[i] * F.col(f).cast("double")
    return j.withColumn(out, pred).drop("intercept", "coef")
