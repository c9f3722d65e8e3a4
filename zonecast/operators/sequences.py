"""Sliding sequence windows for the sequence regressor.

For row i of a district (ordered by time) with i >= seq_len: X = the feature vectors of
rows i-seq_len .. i-1 (min-max scaled per district), y = scaled pickups of row i. Built
with ``collect_list`` over a bounded ROWS frame: each output row carries seq_len x p
numbers, the frame never grows with the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import eda
from .scaling import minmax_scale
from .splits import sequence_split

KEY = "cd_name"
TS = "pickup_datetime"

# The 14 sequence features, target first.
SEQ_FEATURES = [
    "pickups", "lag_1", "lag_2", "lag_24", "rolling_mean_3h", "rolling_mean_24h",
    "rolling_std_3h", "rolling_std_24h", "pickup_density_cd", "sin_hour", "cos_hour",
    "sin_weekday", "cos_weekday", "is_weekend",
]


def sequence_windows(scaled: DataFrame, feats=SEQ_FEATURES, seq_len: int = 24, key: str = KEY,
                     ts: str = TS) -> DataFrame:
    """(key, ts, X ARRAY<ARRAY<DOUBLE>>, y) for rows with a full history of seq_len rows."""
    w = Window.partitionBy(key).orderBy(ts).rowsBetween(-seq_len, -1)
    vec = F.array(*[F.col(c).cast("double") for c in feats])
    return (scaled.withColumn("X", F.collect_list(vec).over(w))
                  .where(F.size("X") == seq_len)
                  .select(key, ts, "X", F.col(feats[0]).cast("double").alias("y")))


def sequence_job(features: DataFrame, top_k: int = 10, seq_len: int = 24, feats=SEQ_FEATURES,
                 key: str = KEY, ts: str = TS) -> DataFrame:
    """Top-k districts by hourly rows -> per-district min-max scaling -> windows ->
    train/val/test by position (0.8 / 0.9)."""
    top = eda.topk_by_rows(features, top_k, key).select(key)   # at most k rows
    sel = features.join(F.broadcast(top), key, "left_semi")
    seq = sequence_windows(minmax_scale(sel, feats, key), feats, seq_len, key, ts)
    return sequence_split(seq, 0.8, 0.9, key, ts)


def flatten_x(df: DataFrame, x: str = "X", out: str = "features") -> DataFrame:
    """X as an ML vector (seq_len * p values, step-major) for ``pyspark.ml`` regressors."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.flatten(F.col(x))))


# -- ridge on windows without building them ----------------------------------------------
#
# The window that ends before row t holds rows t-L .. t-1. Entry ((i, f), (j, g)) of the Gram
# matrix of n consecutive windows is the sum over s = i .. i+n-1 of z[s, f] * z[s+j-i, g]: a sum
# of lag products that all windows share, less a few at the beginning, plus a few at the end.
# So one pass over the hours gives, per lag 0..L, p x p sums; the first and last 2 L rows
# of a district give the corrections.

CHUNK = 8192


def lag_moments(rows: DataFrame, p: int, seq_len: int, key: str = KEY, chunk: int = CHUNK) -> DataFrame:
    """(key, lag, f, g, s): s = sum of z[f] at position q times z[g] at position q + lag, over the
    positions q < n. ``rows``: (key, pos, n, z). A district is cut into chunks of positions that
    overlap by ``seq_len`` rows, so no task holds more than a chunk."""
    c = F.floor(F.col("pos") / chunk).cast("long")
    to = F.when((F.col("pos") % chunk < seq_len) & (c > 0), F.array(c, c - 1)).otherwise(F.array(c))
    kind = rows.schema[key].dataType.simpleString()

    def products(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        pos, n = table["pos"].to_numpy(), table["n"][0].as_py()
        z = table["z"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(pos), p)
        start = table["chunk"][0].as_py() * chunk
        own = int(((pos >= start) & (pos < min(start + chunk, n))).sum())
        out = np.zeros((seq_len + 1, p, p))
        for lag in range(seq_len + 1):
            m = min(own, len(pos) - lag)
            if m > 0:
                out[lag] = z[:m].T @ z[lag:lag + m]
        lag, f, g = np.indices(out.shape)
        k = table[key][0].as_py()
        return pa.table([pa.array([k] * out.size, table.schema.field(key).type), *[pa.array(a.ravel().astype("i4")) for a in (lag, f, g)],
                         pa.array(out.ravel())], names=[key, "lag", "f", "g", "s"])

    parts = (rows.withColumn("chunk", F.explode(to)).groupBy(key, "chunk")
             .applyInArrow(products, f"`{key}` {kind}, lag int, f int, g int, s double"))
    return parts.groupBy(key, "lag", "f", "g").agg(F.sum("s").alias("s"))


def _gram(core: np.ndarray, head: np.ndarray, tail: np.ndarray, n: int, L: int) -> tuple[np.ndarray, np.ndarray]:
    """Raw moments X'X and X'y of n windows. ``core[lag]``: lag products of
    positions 0 .. n-1; ``head``, ``tail``: rows 0 .. 2L-1 and n .. n+2L-1."""
    p = core.shape[1]

    def cut(rows, lag):       # running sums of the products that begin at its first L+1 rows
        m = min(L + 1, max(len(rows) - lag, 0))
        return np.concatenate([np.zeros((1, p, p)), np.cumsum(rows[:m, :, None] * rows[lag:lag + m, None, :], axis=0)])

    # position s < i leaves, position n <= s < n + i comes in
    shifted = [core[lag][None] - cut(head, lag) + _padded(cut(tail, lag), len(cut(head, lag))) for lag in range(L + 1)]
    xx = np.zeros((L, p, L, p))
    for i in range(L):
        for j in range(i, L):
            xx[i, :, j, :] = shifted[j - i][i]
            xx[j, :, i, :] = xx[i, :, j, :].T
    xy = np.stack([shifted[L - i][i][:, 0] for i in range(L)])
    return xx.reshape(L * p, L * p), xy.ravel()


def _padded(a: np.ndarray, n: int) -> np.ndarray:
    return a[:n] if len(a) >= n else np.concatenate([a, np.repeat(a[-1:], n - len(a), axis=0)])


def standardized_ridge(xx, xy, sx, sy: float, syy: float, n: int, reg: float) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of the ridge whose penalty is on coefficients of standardized
    columns and target, from raw moments; a constant column gets 0."""
    mx, my = sx / n, sy / n
    var, vy = np.diag(xx) / n - mx * mx, syy / n - my * my
    sd, sdy = np.sqrt(np.maximum(var, 0)), float(np.sqrt(max(vy, 0)))
    live = sd > 1e-9 * np.maximum(1, np.abs(mx))
    w = np.zeros(len(mx))
    if sdy > 0 and live.any():
        s = sd[live]
        r = (xx[np.ix_(live, live)] / n - np.outer(mx[live], mx[live])) / np.outer(s, s)
        c = (xy[live] / n - mx[live] * my) / (s * sdy)
        w[live] = np.linalg.solve(r + reg / sdy * np.eye(len(s)), c) * sdy / s
    return w, float(my - mx @ w)


def fit_sequence_ridge(scaled: DataFrame, feats=SEQ_FEATURES, seq_len: int = 24, reg: float = 1.0, train: float = 0.8,
                       key: str = KEY, ts: str = TS, chunk: int = CHUNK) -> DataFrame:
    """(key, coef, intercept): the ridge of the next hour's target on the flattened window, fitted
    on the first ``train`` of each district's windows, all districts in one run."""
    p, L = len(feats), seq_len
    w = Window.partitionBy(key)
    rows = scaled.select(key, ts, F.array(*[F.col(c).cast("double") for c in feats]).alias("z")).withColumns(
        {"pos": (F.row_number().over(w.orderBy(ts)) - 1).cast("long"), "total": F.count(F.lit(1)).over(w)})
    rows = rows.withColumn("n", F.floor(F.lit(train) * (F.col("total") - L).cast("double"))).where("n > 0 AND pos < n + 2 * " + str(L))
    core = lag_moments(rows.select(key, "pos", "n", "z"), p, L, key, chunk)
    ends = rows.where((F.col("pos") < 2 * L) | (F.col("pos") >= F.col("n"))).select(
        key, F.lit(-1).alias("lag"), F.col("pos").cast("int").alias("f"), F.col("n").cast("int").alias("g"), F.lit(0.0).alias("s"), "z")
    sums = rows.where(F.col("pos") < F.col("n")).groupBy(key).agg(
        F.array(*[F.sum(F.col("z")[f]) for f in range(p)]).alias("z"), F.sum(F.col("z")[0] * F.col("z")[0]).alias("s")).select(
        key, F.lit(-2).alias("lag"), F.lit(0).alias("f"), F.lit(0).alias("g"), "s", "z")
    kind = scaled.schema[key].dataType.simpleString()

    def solve(table: pa.Table) -> pa.Table:
        lag, f, g = (table[c].to_numpy() for c in ("lag", "f", "g"))
        s, z = table["s"].to_numpy(), table["z"].to_pylist()
        core = np.zeros((L + 1, p, p))
        m = lag >= 0
        core[lag[m], f[m], g[m]] = s[m]
        rim = {int(f[k]): z[k] for k in np.flatnonzero(lag == -1)}
        n = int(g[np.flatnonzero(lag == -1)[0]])
        at = lambda a, b: np.array([rim[q] for q in range(a, b) if q in rim]).reshape(-1, p)
        head, tail = at(0, 2 * L), at(n, n + 2 * L)
        xx, xy = _gram(core, head, tail, n, L)
        total = np.array(z[int(np.flatnonzero(lag == -2)[0])])
        sx = np.stack([total - head[:i].sum(0) + tail[:i].sum(0) for i in range(L)])
        sy = float(total[0] - head[:L, 0].sum() + tail[:L, 0].sum())
        syy = float(s[lag == -2][0] - (head[:L, 0] ** 2).sum() + (tail[:L, 0] ** 2).sum())
        coef, intercept = standardized_ridge(xx, xy, sx.ravel(), sy, syy, n, reg)
        return pa.table([pa.array([table[key][0].as_py()], table.schema.field(key).type), pa.array([coef.tolist()]),
                         pa.array([intercept])], names=[key, "coef", "intercept"])

    every = core.withColumn("z", F.lit(None).cast("array<double>")).unionByName(ends).unionByName(sums)
    return every.groupBy(key).applyInArrow(solve, f"`{key}` {kind}, coef array<double>, intercept double")


def predict_sequence_ridge(scaled: DataFrame, model: DataFrame, feats=SEQ_FEATURES, seq_len: int = 24, key: str = KEY,
                           ts: str = TS) -> DataFrame:
    """(key, ts, y, y_pred) for every row with a full history. Each hour is multiplied once with
    every step's coefficients; a window's value adds up what its hours gave at their steps."""
    p, L = len(feats), seq_len
    z = F.array(*[F.col(c).cast("double") for c in feats])
    dot = lambda i: F.aggregate(F.zip_with(F.slice("coef", i * p + 1, p), "z", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    j = scaled.select(key, ts, z.alias("z")).join(model, key).select(
        key, ts, F.col("z")[0].alias("y"), "intercept", F.transform(F.sequence(F.lit(0), F.lit(L - 1)), dot).alias("d"))
    w = Window.partitionBy(key).orderBy(ts)
    value = F.col("intercept")
    for i in range(L):
        value = value + F.lag(F.col("d")[i], L - i).over(w)
    return j.withColumn("y_pred", value).where(F.col("y_pred").isNotNull()).select(key, ts, "y", "y_pred")
