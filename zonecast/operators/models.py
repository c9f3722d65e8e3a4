"""Per-district regressors.

Linear family (OLS, ridge, lasso, elastic net)
    Grouped aggregations compute the sufficient statistics of every district (means, then
    n and the sums of x, y, x x^T, x y, y^2 about them) with partial (map-side) aggregation, so a hot
    district costs one row of partial sums per task, never a whole group in memory.
    The solve itself runs on that one-row-per-district table with ``applyInPandas``
    (p x p numpy algebra, p <= ~20), and predictions are a projection after joining the
    coefficient table (one row per district).

Trees (random forest, gradient boosting)
    Per district by :mod:`zonecast.operators.trees`: all districts in one job, at the
    reference's sizes. ``pooled=True`` fits one ``pyspark.ml`` model for all districts, with
    the district as an indexed feature, whose training spreads the rows themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import trees

KEY = "cd_name"
TS = "pickup_datetime"
TARGET = "pickups"

# The reference's model settings.
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1
RF_PARAMS = dict(numTrees=500, minInstancesPerNode=5, seed=42, featureSubsetStrategy="all", maxDepth=30)
GBM_PARAMS = dict(stepSize=0.03, maxDepth=6, minInstancesPerNode=50, maxIter=5000, seed=42)
GBM_PATIENCE = 200              # stop after so many rounds without a lower validation error
BASE_FEATURES = ["sin_hour", "cos_hour", "sin_weekday", "cos_weekday", "is_weekend"]
SINGLE_EXTRA = ["lag_1", "lag_2", "lag_24", "rolling_mean_3h", "rolling_mean_24h",
                "rolling_std_3h", "rolling_std_24h", "pickup_density_cd"]
ENSEMBLE_EXTRA = ["lag_1", "lag_2", "lag_24", "rolling_mean_3h", "rolling_mean_24h"]


# -- sufficient statistics -------------------------------------------------------------

def gram_sums(df: DataFrame, features, target: str = TARGET, keys=(KEY,), shift_keys=None) -> DataFrame:
    """One row per group of sums over values less the mean of their ``shift_keys`` group (by
    default the group itself; rows that share it can be added up): n, sx[p], sy, sxx[p*p]
    (row-major), sxy[p], syy, and the means mx[p], my.

    Raw sums of columns with a large mean and a small spread cancel; shifted ones do not. The
    means are one more aggregation, joined back as one row per group."""
    from .quantiles import _null_safe
    shift_keys = list(keys if shift_keys is None else shift_keys)
    p = len(features)
    vals = df.select(*keys, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)],
                     F.col(target).cast("double").alias("_y"))
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    means = vals.groupBy(*shift_keys).agg(F.array(*[mean(f"_x{i}") for i in range(p)]).alias("mx"), mean("_y").alias("my"))
    j = _null_safe(vals, means, shift_keys).withColumns(
        {**{f"_x{i}": F.col(f"_x{i}") - F.col("mx")[i] for i in range(p)}, "_y": F.col("_y") - F.col("my")})
    xs, y = [F.col(f"_x{i}") for i in range(p)], F.col("_y")
    half = [(i, k) for i in range(p) for k in range(i, p)]       # the other half is the same by symmetry
    g = j.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(*[F.sum(x) for x in xs]).alias("sx"),
        F.sum(y).alias("sy"),
        F.array(*[F.sum(xs[i] * xs[k]) for i, k in half]).alias("_half"),
        F.array(*[F.sum(x * y) for x in xs]).alias("sxy"),
        F.sum(y * y).alias("syy"), F.first("mx").alias("mx"), F.first("my").alias("my"))
    at = {ik: n for n, ik in enumerate(half)}
    full = F.array(*[F.col("_half")[at[min(i, k), max(i, k)]] for i in range(p) for k in range(p)])
    return g.withColumn("sxx", full).drop("_half")


def centered(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """(G, c, xbar, ybar, n) with G = Xc'Xc and c = Xc'yc from one gram row."""
    n = float(row["n"])
    sx = np.asarray(row["sx"], dtype=float)
    p = sx.size
    sxx = np.asarray(row["sxx"], dtype=float).reshape(p, p)
    sxy = np.asarray(row["sxy"], dtype=float)
    xoff, yoff = sx / n, float(row["sy"]) / n           # what the means missed: rounding only
    G = sxx - n * np.outer(xoff, xoff)
    c = sxy - n * xoff * yoff
    return G, c, np.asarray(row["mx"], float) + xoff, float(row["my"]) + yoff, n


def solve_ridge(G, c, alpha: float) -> np.ndarray:
    """argmin ||yc - Xc w||^2 + alpha ||w||^2 (alpha = 0: least squares, minimum norm)."""
    if alpha == 0:
        return np.linalg.lstsq(G, c, rcond=None)[0]
    return np.linalg.solve(G + alpha * np.eye(G.shape[0]), c)


def solve_enet(G, c, n: float, alpha: float, l1_ratio: float = 1.0, max_iter: int = 20000,
               tol: float = 1e-10, w0=None) -> np.ndarray:
    """Coordinate descent for (1/(2n))||yc - Xc w||^2 + alpha*l1*||w||_1
    + alpha*(1-l1)/2*||w||^2 on the centered Gram matrix."""
    p = G.shape[0]
    w = np.zeros(p) if w0 is None else np.array(w0, dtype=float)
    l1, l2 = alpha * l1_ratio * n, alpha * (1 - l1_ratio) * n
    diag = np.diag(G)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = c[j] - G[j] @ w + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diag[j] + l2) + 0.0      # no negative zero
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta < tol:
            break
    return w


def _solver(kind: str, alpha: float, key_cols):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            G, c, xbar, ybar, n = centered(row)
            if kind == "lasso":
                w = solve_enet(G, c, n, alpha, 1.0)
            else:
                w = solve_ridge(G, c, 0.0 if kind == "linear" else alpha)
            rec = {k: row[k] for k in key_cols}
            rec.update(intercept=float(ybar - xbar @ w), coef=[float(v) for v in w])
            out.append(rec)
        return pd.DataFrame(out, columns=list(key_cols) + ["intercept", "coef"])
    return fit


def fit_linear(train: DataFrame, features, kind: str = "linear", alpha: float | None = None,
               target: str = TARGET, keys=(KEY,)) -> DataFrame:
    """Coefficient table (keys, intercept, coef ARRAY<DOUBLE>) per group.
    kind: linear | ridge (alpha 1.0) | lasso (alpha 0.1)."""
    if kind not in ("linear", "ridge", "lasso"):
        raise ValueError(f"Unsupported model_type={kind}")
    a = alpha if alpha is not None else {"linear": 0.0, "ridge": RIDGE_ALPHA, "lasso": LASSO_ALPHA}[kind]
    g = gram_sums(train, features, target, keys)
    key_fields = ", ".join(f"`{k}` {t}" for k, t in g.select(*keys).dtypes)
    schema = f"{key_fields}, intercept double, coef array<double>"
    return g.groupBy(*keys).applyInPandas(_solver(kind, a, list(keys)), schema)


def predict_linear(df: DataFrame, coefs: DataFrame, features, keys=(KEY,), out: str = "y_pred") -> DataFrame:
    """intercept + sum coef_i * x_i after joining the (one row per group) coefficients."""
    j = df.join(coefs, list(keys), "inner")
    pred = F.col("intercept")
    for i, f in enumerate(features):
        pred = pred + F.col("coef")[i] * F.col(f).cast("double")
    return j.withColumn(out, pred).drop("intercept", "coef")


# -- trees -------------------------------------------------------------------------------

def _assembler(features, out="features"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def best_round(errors, patience: int = GBM_PATIENCE) -> tuple[int, bool]:
    """(rounds to keep, whether the patience ran out): the round of least validation error
    before ``patience`` rounds in a row bring none lower."""
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(train: DataFrame, valid: DataFrame, params: dict | None, label: str, patience: int = GBM_PATIENCE):
    """Boosted trees cut at the round of least validation error, stopping ``patience`` rounds
    after it. Rounds are fitted in doubling numbers (with one seed a longer fit begins with
    the same trees), judged per round on ``valid``, and the model is fitted to the kept
    number. Both frames carry ``features``. Returns (model, validation error per round)."""
    limit = {**GBM_PARAMS, **(params or {})}["maxIter"]
    if valid.isEmpty():
        return _estimator("gbm", {**(params or {}), "maxIter": limit}, label).fit(train), []
    rounds = min(limit, 2 * patience)
    while True:
        model = _estimator("gbm", {**(params or {}), "maxIter": rounds}, label).fit(train)
        errors = list(model.evaluateEachIteration(valid, "squared"))
        keep, stopped = best_round(errors, patience)
        if stopped or rounds >= limit:
            break
        rounds = min(limit, 2 * rounds)
    if keep < len(errors):
        model = _estimator("gbm", {**(params or {}), "maxIter": keep}, label).fit(train)
    return model, errors


def _fitted(stages, kind: str, params: dict | None, label: str, data: DataFrame, validation_col: str | None):
    """Fit feature stages and trees; returns frame -> frame with predictions."""
    from pyspark.ml import Pipeline
    prep = Pipeline(stages=stages).fit(data)
    ready = prep.transform(data)
    if kind == "gbm" and validation_col:
        model, _ = fit_boosted(ready.where(~F.col(validation_col)), ready.where(F.col(validation_col)), params, label)
    else:
        model = _estimator(kind, params, label).fit(ready)
    return lambda df: model.transform(prep.transform(df))


def _estimator(kind: str, params: dict | None, label: str):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    if kind == "rf":
        p = {**RF_PARAMS, **(params or {})}
        return RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred", **p)
    if kind == "gbm":
        p = {**GBM_PARAMS, **(params or {})}
        return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred", **p)
    raise ValueError(f"Unsupported model_type={kind}")


def fit_trees(train: DataFrame, features, kind: str = "rf", params: dict | None = None, target: str = TARGET,
              key: str = KEY, validation_col: str | None = None) -> DataFrame:
    """Model rows (one per tree) of every district of ``train``, in one job whatever their number,
    written once. kind: rf | gbm; ``params`` as in ``trees.FOREST`` / ``trees.BOOST``."""
    if kind == "rf":
        model = trees.fit_forest(train, features, params, target, key)
    elif kind == "gbm":
        model = trees.fit_boosted(train, features, params, target, key, validation_col)
    else:
        raise ValueError(f"Unsupported model_type={kind}")
    return materialize(model, f"{kind}_model")


def fit_predict_trees(train: DataFrame, score: DataFrame, features, kind: str = "rf", params: dict | None = None,
                      target: str = TARGET, key: str = KEY, pooled: bool = False,
                      validation_col: str | None = None) -> DataFrame:
    """Fit per district on ``train`` and predict ``score``; returns ``score`` with y_pred (rows
    of districts without training rows are left out).

    ``pooled``: one ``pyspark.ml`` model for all districts with the district index as an extra
    feature (``params`` are then the estimator's).
    """
    if not pooled:
        model = fit_trees(train, features, kind, params, target, key, validation_col)
        return trees.predict(score, model, features, mean=kind == "rf", key=key).where("y_pred is not null")
    label = "_label"
    tr = train.withColumn(label, F.col(target).cast("double"))
    if validation_col:
        tr = tr.withColumn(validation_col, F.col(validation_col).cast("boolean"))
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCol=key, outputCol="_key_idx", handleInvalid="keep")
    predict = _fitted([idx, _assembler(list(features) + ["_key_idx"])], kind, params, label, tr, validation_col)
    return predict(score).drop("features", "_key_idx")


def _in_parallel(fn, names, parallelism: int | None):
    """Run independent per-district fits concurrently (each one is a distributed Spark
    job; the driver only submits them). ``names`` is bounded by the caller (top-k)."""
    from concurrent.futures import ThreadPoolExecutor
    names = list(names)
    if not names:
        return []
    workers = max(1, min(len(names), parallelism or 8))
    with ThreadPoolExecutor(max_workers=workers) as ex:
        return list(ex.map(fn, names))


def _union(parts, empty=None):
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out if out is not None else empty


def fit_predict_vector(train: DataFrame, score: DataFrame, kind: str = "ridge", reg: float = 1.0,
                       label: str = "y", key: str = KEY, names=None, params: dict | None = None) -> DataFrame:
    """Regressors on a ready ``features`` vector column (the flattened sequence window),
    one fit per district. kind: ridge (``LinearRegression`` normal equations, L2) | gbm."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    if names is None:
        raise ValueError("pass the district names to model (bounded, e.g. the top k)")

    def fit_one(name):
        if kind == "ridge":
            est = LinearRegression(featuresCol="features", labelCol=label, predictionCol="y_pred",
                                   regParam=reg, elasticNetParam=0.0, solver="normal", standardization=True)
        else:
            est = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred",
                               **{**dict(maxIter=100, maxDepth=4, stepSize=0.1, seed=42), **(params or {})})
        m = est.fit(train.where(F.col(key) == name))
        return m.transform(score.where(F.col(key) == name))
    empty = score.withColumn("y_pred", F.lit(None).cast("double")).where(F.lit(False))
    return _union(_in_parallel(fit_one, names, 8), empty)
