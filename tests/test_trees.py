"""Grouped trees: splits against brute force, invariants of growth and boosting, models as rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonecast.operators import trees as TR


def _best_by_hand(x, y, min_leaf):
    best = (0.0, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            l = x[:, f] <= cut
            if l.sum() >= min_leaf and (~l).sum() >= min_leaf:
                gain = ((y - y.mean()) ** 2).sum() - ((y[l] - y[l].mean()) ** 2).sum() - ((y[~l] - y[~l].mean()) ** 2).sum()
                if gain > best[0] + 1e-9:
                    best = (gain, (f, l))
    return best


@pytest.mark.parametrize("seed", range(5))
def test_split_is_the_best_one(seed):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, 80).astype(float), rng.normal(size=80), rng.integers(0, 2, 80).astype(float)], axis=1)
    y = 3 * x[:, 0] + rng.normal(size=80)
    tree, value = TR.Grower(TR.Bins(x)).grow(y, np.arange(80), np.zeros(0, np.int64), 5, max_leaves=2)
    gain, (f, left) = _best_by_hand(x, y, 5)
    assert tree["feature"][0] == f and np.array_equal(x[:, f] <= tree["threshold"][0], left)
    assert np.allclose(value, np.where(left, y[left].mean(), y[~left].mean()))


def test_growth_keeps_its_limits_and_siblings_add_up():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(900, 4)), rng.normal(size=900)
    g = TR.Grower(TR.Bins(x))
    out = np.arange(700, 900)
    tree, value = g.grow(y, np.arange(700), out, 20, max_leaves=16)
    leaves = [k for k, f in enumerate(tree["feature"]) if f < 0]
    assert len(leaves) <= 16 and np.allclose(value, TR.tree_values(tree, x))
    sizes = [np.isclose(value[:700], tree["value"][k]).sum() for k in leaves]
    assert min(sizes) >= 20 and sum(sizes) == 700
    h = g._histogram(np.arange(700), y)
    assert np.allclose(h, g._histogram(np.arange(300), y) + g._histogram(np.arange(300, 700), y))


def test_many_distinct_values_and_nan_go_the_same_way_when_predicted():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 2))
    x[::50, 0] = np.nan
    y = np.nan_to_num(x[:, 0]) + rng.normal(size=2000) / 10
    bins = TR.Bins(x, max_bins=32)
    assert bins.size <= 32
    tree, value = TR.Grower(bins).grow(y, np.arange(2000), np.zeros(0, np.int64), 5, max_leaves=30)
    assert np.allclose(value, TR.tree_values(tree, x))


def _frame(spark, groups, n=160):
    rng = np.random.default_rng(3)
    rows = [(g, i, float(rng.integers(0, 30)), float(rng.normal())) for g in groups for i in range(n)]
    rows = [(*r, 2 * r[2] + r[3]) for r in rows]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["cd_name", "pos", "x0", "x1", "pickups"]))


PARAMS = {"rounds": 60, "rate": 0.3, "min_leaf": 5, "max_leaves": 8, "bag_share": 0.8, "feature_share": 0.5, "patience": 10}


def test_boosting_continues_stops_and_truncates_without_refit(spark):
    df = _frame(spark, ["a", "b"]).withColumn("v", F.col("pos") >= 130)
    full = TR.fit_boosted(df, ["x0", "x1"], PARAMS, valid_col="v").toPandas().sort_values(["cd_name", "tree"])
    for _, m in full.groupby("cd_name"):
        errors = m.valid_rmse.to_numpy()
        best = int(errors.argmin())
        assert (m.kept.to_numpy() == (np.arange(len(m)) <= best)).all()
        assert len(m) == 60 or len(m) == best + 1 + PARAMS["patience"]
    part = TR.fit_boosted(df, ["x0", "x1"], {**PARAMS, "rounds": 7}, valid_col="v")
    more = TR.fit_boosted(df, ["x0", "x1"], PARAMS, valid_col="v", model=part).toPandas().sort_values(["cd_name", "tree"])
    assert more.valid_rmse.tolist() == full.valid_rmse.tolist() and more.kept.tolist() == full.kept.tolist()


def test_no_validation_rows_keep_every_round(spark):
    m = TR.fit_boosted(_frame(spark, ["a"]), ["x0"], {**PARAMS, "rounds": 25})
    assert m.count() == m.where("kept").count() == 25 and m.where("valid_rmse is not null").count() == 0
    t = [r.train_rmse for r in TR.fit_boosted(_frame(spark, ["a"]), ["x0"], {**PARAMS, "rounds": 25, "bag_share": 1.0}).orderBy("tree").collect()]
    assert all(b <= a + 1e-12 for a, b in zip(t, t[1:]))        # boosting on all rows never worsens the fit


def test_jobs_do_not_grow_with_districts(spark):
    def jobs(n):
        df = _frame(spark, [f"d{i}" for i in range(n)], 40)
        spark.sparkContext.setJobGroup(f"trees-{n}", "")
        m = TR.fit_boosted(df, ["x0", "x1"], {**PARAMS, "rounds": 3})
        TR.predict(df, m, ["x0", "x1"]).write.format("noop").mode("overwrite").save()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{n}"))
    assert jobs(2) == jobs(60)


def test_forest_is_the_same_however_it_is_dealt(spark):
    df = _frame(spark, ["a", "b"], 60)
    p = {"n_trees": 7, "min_leaf": 3}
    one, many = (TR.predict(df, TR.fit_forest(df, ["x0", "x1"], p, shares=s), ["x0", "x1"], mean=True)
                 .orderBy("cd_name", "pos").toPandas().y_pred for s in (1, 5))
    assert np.allclose(one, many)
    empty = TR.fit_forest(df.where("false"), ["x0", "x1"], p)
    assert empty.count() == 0
    assert TR.predict(df, empty, ["x0", "x1"]).where("y_pred is null").count() == df.count()
