"""Tree ensembles of all districts in one job (SURVEY 2.9 ``rf_fit``, ``gbm_fit``,
``gbm_early_stop``, ``run_all_districts``).

A district's training rows are hours, not pickups: however many points there are, a group is
bounded by the hours covered (a hundred years are 876,600). So districts are the unit of
work: one shuffle brings each district's rows to a task, which grows all its trees; ten or a
thousand districts take the same number of jobs. Forests, whose trees are independent, are
dealt over (district, share of the trees). Models come back as rows, one per tree, and are
applied to other rows by a co-grouped join, so they can be stored, versioned and filtered
like any table. A model never passes through the driver.

Trees are grown leaf by leaf, best gain first, from histograms: features are binned once per
group (at every gap between distinct values, or at ``max_bins`` quantiles where there are
more), a node keeps count and target sum per (feature, bin), and of two siblings only the
smaller one is counted, the other being parent minus sibling. Thresholds lie midway between
values; a row goes left if its value is at most the threshold, NaN goes right.

Boosting adds one tree per round on the residuals. Rows are bagged anew every ``bag_every``
rounds, features are drawn per tree, both from the round's number and the district, so a fit
that continues from kept trees (``model=``) equals a longer one. The validation error is
carried from round to round; ``patience`` rounds without a lower one end the fit, and the
trees after the best round are marked, not refitted. Without validation rows all rounds
are fitted and kept.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "cd_name"
TARGET = "pickups"
MAX_BINS = 255

# The reference's model settings.
FOREST = dict(n_trees=500, min_leaf=5, max_leaves=None, max_depth=None, seed=42)
BOOST = dict(rounds=5000, rate=0.03, max_leaves=64, min_leaf=50, max_depth=None, patience=200,
             feature_share=1.0, bag_share=1.0, bag_every=5, seed=42)
# Fractions of features and rows of the single boosting model.
BOOST_SINGLE = dict(feature_share=0.8, bag_share=0.8)

MODEL_FIELDS = ("tree int, kept boolean, base double, feature array<int>, threshold array<double>, left array<int>, "
                "right array<int>, value array<double>, train_rmse double, valid_rmse double")


class Bins:
    """Columns cut into bins at values between the distinct ones."""

    def __init__(self, x: np.ndarray, max_bins: int = MAX_BINS):
        self.cuts = []
        for c in x.T:
            u = np.unique(c[~np.isnan(c)])
            mid = (u[1:] + u[:-1]) / 2
            if len(mid) >= max_bins:
                at = np.searchsorted(u, np.quantile(c[~np.isnan(c)], np.arange(1, max_bins) / max_bins, method="lower"))
                mid = mid[np.unique(np.minimum(at, len(mid) - 1))]
            self.cuts.append(mid)
        self.size = max((len(c) + 1 for c in self.cuts), default=1)
        self.codes = self.of(x)

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], axis=1).astype(np.int32)


class Grower:
    """Grows trees on the binned rows of one group."""

    def __init__(self, bins: Bins):
        self.bins, (self.n, self.p) = bins, bins.codes.shape
        self.flat = bins.codes + np.arange(self.p, dtype=np.int32) * bins.size

    def _histogram(self, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        index, m = self.flat[rows].ravel(), self.p * self.bins.size
        return np.stack([np.bincount(index, minlength=m), np.bincount(index, np.repeat(y[rows], self.p), m)]).reshape(2, self.p, -1)

    def _split(self, h: np.ndarray, min_leaf: int, allowed: np.ndarray):
        """(gain, feature, bin) of the best split, or None."""
        n, s = h[0, 0].sum(), h[1, 0].sum()
        if n < 2 * min_leaf:
            return None
        c = h[:, :, :-1].cumsum(2)
        nl, sl = c
        nr = n - nl
        ok = (nl >= min_leaf) & (nr >= min_leaf) & allowed[:, None]
        gain = np.where(ok, sl * sl / np.maximum(nl, 1) + (s - sl) ** 2 / np.maximum(nr, 1), -np.inf)
        if not gain.size:
            return None
        k = int(gain.argmax())
        best = gain.flat[k] - s * s / n
        return (float(best), k // gain.shape[1], k % gain.shape[1]) if best > 1e-10 * (1 + abs(s * s / n)) else None

    def grow(self, y: np.ndarray, rows: np.ndarray, others: np.ndarray, min_leaf: int, max_leaves: int | None = None,
             max_depth: int | None = None, allowed: np.ndarray | None = None) -> tuple[dict, np.ndarray]:
        """(tree, its value for every row of ``rows`` and ``others``). Only ``rows``, which may
        repeat, are learned from."""
        allowed = np.ones(self.p, bool) if allowed is None else allowed
        tree = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}
        codes, out = self.bins.codes, np.zeros(self.n)

        def node(rows, others, h, depth) -> None:
            n, s = h[0, 0].sum(), h[1, 0].sum()
            k = len(tree["feature"])
            for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", s / n if n else 0.0)):
                tree[name].append(v)
            members[k] = rows, others
            best = None if max_depth is not None and depth >= max_depth else self._split(h, min_leaf, allowed)
            if best:
                heapq.heappush(open_, (-best[0], k, best[1], best[2], rows, others, h, depth))

        open_: list = []
        members: dict[int, tuple] = {}
        node(rows, others, self._histogram(rows, y), 0)
        leaves = 1
        while open_ and (max_leaves is None or leaves < max_leaves):
            _, k, f, b, rows_k, others_k, h, depth = heapq.heappop(open_)
            goes, also = codes[rows_k, f] <= b, codes[others_k, f] <= b
            sides = [(rows_k[goes], others_k[also]), (rows_k[~goes], others_k[~also])]
            small = int(len(sides[1][0]) < len(sides[0][0]))
            hs = [None, None]
            hs[small] = self._histogram(sides[small][0], y)
            hs[1 - small] = h - hs[small]                       # the sibling without counting its rows
            del members[k]
            tree["feature"][k], tree["threshold"][k] = f, float(self.bins.cuts[f][b])
            tree["left"][k] = len(tree["feature"])
            node(*sides[0], hs[0], depth + 1)
            tree["right"][k] = len(tree["feature"])
            node(*sides[1], hs[1], depth + 1)
            leaves += 1
        for k, (a, o) in members.items():
            out[a] = out[o] = tree["value"][k]
        return tree, out


def tree_values(tree: dict, x: np.ndarray) -> np.ndarray:
    """The tree's value for each row of raw features."""
    feature, threshold = np.asarray(tree["feature"]), np.asarray(tree["threshold"])
    left, right = np.asarray(tree["left"]), np.asarray(tree["right"])
    at, live = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(live):
        live = live[feature[at[live]] >= 0]
        k = at[live]
        goes = x[live, feature[k]] <= threshold[k]
        at[live] = np.where(goes, left[k], right[k])
    return np.asarray(tree["value"])[at]


def _rng(seed: int, key, *numbers: int) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(repr(key).encode()), *numbers])


def _rmse(e: np.ndarray) -> float | None:
    return float(np.sqrt(np.mean(e * e))) if len(e) else None


def boost(x: np.ndarray, y: np.ndarray, valid: np.ndarray, key, params: dict, kept: list[dict] | None = None) -> list[dict]:
    """Model rows of one group; ``kept`` are the rows of a model to continue from."""
    fit = np.flatnonzero(~valid)
    if not len(fit):
        return []
    bins = Bins(x)
    grower, all_rows = Grower(bins), np.arange(len(y))
    base = kept[0]["base"] if kept else float(y[fit].mean())
    pred, out = np.full(len(y), base), list(kept or [])
    for t in out:
        pred += tree_values(t, x)
    best = min(((t["valid_rmse"], k) for k, t in enumerate(out) if t["valid_rmse"] is not None), default=(np.inf, -1))
    n_bag, n_features = max(1, round(params["bag_share"] * len(fit))), max(1, round(params["feature_share"] * x.shape[1]))
    rows, others = fit, np.flatnonzero(valid)
    for k in range(len(out), params["rounds"]):
        if best[1] >= 0 and k - 1 - best[1] >= params["patience"]:
            break
        if params["bag_share"] < 1 and (k % params["bag_every"] == 0 or k == len(kept or [])):
            rows = np.sort(_rng(params["seed"], key, 1, k // params["bag_every"]).choice(fit, n_bag, replace=False))
            others = np.setdiff1d(all_rows, rows, assume_unique=True)
        allowed = None
        if n_features < x.shape[1]:
            allowed = np.zeros(x.shape[1], bool)
            allowed[_rng(params["seed"], key, 2, k).choice(x.shape[1], n_features, replace=False)] = True
        tree, value = grower.grow(y - pred, rows, others, params["min_leaf"], params["max_leaves"], params["max_depth"], allowed)
        tree["value"] = [params["rate"] * v for v in tree["value"]]
        pred += params["rate"] * value
        error = _rmse((y - pred)[valid])
        out.append({**tree, "tree": k, "base": base, "train_rmse": _rmse((y - pred)[fit]), "valid_rmse": error})
        if error is not None and error < best[0]:
            best = (error, k)
    for k, t in enumerate(out):
        t["kept"] = best[1] < 0 or k <= best[1]
    return out


def forest(x: np.ndarray, y: np.ndarray, key, params: dict, numbers) -> list[dict]:
    """Model rows of the given tree numbers of one group's forest."""
    if not len(y):
        return []
    bins, out, nobody = Bins(x), [], np.zeros(0, np.int64)
    grower = Grower(bins)
    for k in numbers:
        rows = np.sort(_rng(params["seed"], key, 3, k).integers(0, len(y), len(y)))
        tree, _ = grower.grow(y, rows, nobody, params["min_leaf"], params["max_leaves"], params["max_depth"])
        out.append({**tree, "tree": k, "base": 0.0, "kept": True, "train_rmse": None, "valid_rmse": None})
    return out


def _matrix(table: pa.Table, features) -> np.ndarray:
    cols = [table.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features]
    return np.stack(cols, axis=1) if cols else np.zeros((table.num_rows, 0))


def _model_table(rows: list[dict], key_field: pa.Field, key, schema: pa.Schema) -> pa.Table:
    cols = [pa.array([key] * len(rows), key_field.type)]
    return pa.Table.from_arrays([*cols, *[pa.array([r[f.name] for r in rows], f.type) for f in schema]], names=[key_field.name, *schema.names])


def _fields() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(MODEL_FIELDS))


def _schema(df: DataFrame, key: str) -> T.StructType:
    return T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL(MODEL_FIELDS).fields])


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Groups over many tasks: they are small in bytes and long in work, so that the number of
    tasks is given here instead of being cut down by their size."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def fit_boosted(data: DataFrame, features, params: dict | None = None, target: str = TARGET, key: str = KEY,
                valid_col: str | None = None, model: DataFrame | None = None) -> DataFrame:
    """Boosted trees per ``key``: (key, tree, kept, base, feature, threshold, left, right, value,
    train_rmse, valid_rmse), one row per round. ``model``: continue from these rows."""
    p = {**BOOST, **(params or {})}
    feats, fields = list(features), _fields()
    valid = F.coalesce(F.col(valid_col).cast("boolean"), F.lit(False)) if valid_col else F.lit(False)
    rows = data.select(key, *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(feats)],
                       F.col(target).cast("double").alias("y"), valid.alias("valid")).where("y is not null")
    names = [f"x{i}" for i in range(len(feats))]

    def fit(table: pa.Table, kept: list[dict] | None) -> pa.Table:
        k = table.column(key)[0].as_py() if table.num_rows else None
        got = boost(_matrix(table, names), table.column("y").to_numpy(), table.column("valid").to_numpy(zero_copy_only=False).astype(bool),
                    k, p, kept) if table.num_rows else []
        return _model_table(got, pa.field(key, table.schema.field(key).type), k, fields)

    if model is None:
        return _dealt(rows, key).groupBy(key).applyInArrow(lambda t: fit(_in_order(t), None), _schema(data, key))

    def more(left: pa.Table, right: pa.Table) -> pa.Table:
        return fit(_in_order(left), sorted(right.select(fields.names).to_pylist(), key=lambda r: r["tree"]))

    return _dealt(rows, key).groupBy(key).cogroup(_dealt(model, key).groupBy(key)).applyInArrow(more, _schema(data, key))


def _in_order(table: pa.Table) -> pa.Table:
    """Rows in an order of their own values, so that draws do not depend on the shuffle's."""
    names = [c for c in table.column_names if c != "valid" and c[0] in "xy"]
    return table.sort_by([(c, "ascending") for c in names])


def fit_forest(data: DataFrame, features, params: dict | None = None, target: str = TARGET, key: str = KEY,
               shares: int = 10) -> DataFrame:
    """Bagged trees per ``key``, the trees of a district dealt over ``shares`` tasks (its rows go to each)."""
    p = {**FOREST, **(params or {})}
    feats, fields = list(features), _fields()
    names = [f"x{i}" for i in range(len(feats))]
    rows = data.select(key, *[F.col(f).cast("double").alias(n) for n, f in zip(names, feats)],
                       F.col(target).cast("double").alias("y")).where("y is not null")
    rows = rows.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(min(shares, p["n_trees"]) - 1))))

    def fit(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        k, share = table.column(key)[0].as_py(), table.column("share")[0].as_py()
        got = forest(_matrix(table, names), table.column("y").to_numpy(), k, p, range(share, p["n_trees"], min(shares, p["n_trees"])))
        return _model_table(got, pa.field(key, table.schema.field(key).type), k, fields)

    return _dealt(rows, key, "share").groupBy(key, "share").applyInArrow(fit, _schema(data, key))


def predict(df: DataFrame, model: DataFrame, features, mean: bool = False, key: str = KEY, out: str = "y_pred") -> DataFrame:
    """``df`` with the sum (boosting) or mean (forest) of the kept trees of its ``key``; rows of
    a key without a model get NULL."""
    feats = list(features)
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.DoubleType())])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        trees = right.to_pylist()
        left = left.select([f.name for f in schema.fields[:-1]])
        if not trees:
            return left.append_column(out, pa.nulls(left.num_rows, pa.float64()))
        x = _matrix(left, feats)
        total = np.zeros(len(x))
        for t in sorted(trees, key=lambda t: t["tree"]):
            total += tree_values(t, x)
        return left.append_column(out, pa.array(total / len(trees) if mean else total + trees[0]["base"]))

    return _dealt(df, key).groupBy(key).cogroup(_dealt(model.where("kept"), key).groupBy(key)).applyInArrow(apply, schema)
