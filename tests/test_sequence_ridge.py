"""Ridge from lag products against the regressor fitted on built windows; mini-batch k-means
against full k-means; moments of badly scaled columns; cleaning report; model rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonecast.operators import clean as C
from zonecast.operators import clustering as CL
from zonecast.operators import models as MD
from zonecast.operators import sequences as sq
from zonecast.operators import splits as spl
from zonecast.sources import runs as RS


def _hours(spark, sizes, p, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in sizes.items():
        z = np.cumsum(rng.normal(size=(n, p)), axis=0) / 5 + rng.normal(size=(n, p))
        z[:, -1] = 0.25                                  # a constant column
        rows += [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), *map(float, r)) for i, r in enumerate(z)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["cd_name", "pickup_datetime", *[f"f{i}" for i in range(p)]]))


@pytest.mark.parametrize("chunk", [16, 8192])
def test_lag_products_give_the_ridge_of_the_windows(spark, chunk):
    p, L = 3, 5
    feats = [f"f{i}" for i in range(p)]
    df = _hours(spark, {"a": 90, "b": 41, "c": 12, "d": 5}, p)
    model = sq.fit_sequence_ridge(df, feats, L, 1.0, chunk=chunk)
    got = {(r.cd_name, r.pickup_datetime): r.y_pred for r in sq.predict_sequence_ridge(df, model, feats, L).collect()}
    seq = spl.sequence_split(sq.flatten_x(sq.sequence_windows(df, feats, L)))
    names = ["a", "b", "c"]
    want = MD.fit_predict_vector(seq.where("split = 'train'"), seq, "ridge", 1.0, "y", "cd_name", names).collect()
    assert len(want) == len(got) > 0                      # "d" has no window to learn from
    for r in want:
        assert got[r.cd_name, r.pickup_datetime] == pytest.approx(r.y_pred, abs=1e-8)


def test_minibatch_kmeans_is_near_full_kmeans(spark):
    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.normal(c, 0.05, (400, 2)) for c in ((0, 0), (1, 0), (0, 1), (1, 1))])
    df = spark.createDataFrame(pd.DataFrame({"event_id": range(len(xy)), "Lat": xy[:, 0], "Lon": xy[:, 1]}))
    centres, table = CL.minibatch_kmeans(df, (2, 4, 6), batch=300)
    got = {r.k: r.inertia for r in table.collect()}
    assert sorted(got) == [2, 4, 6] and got[2] > got[4] > got[6]
    by_hand = sum(((xy[:, None] - centres[4][None]) ** 2).sum(2).min(1))
    assert got[4] == pytest.approx(by_hand, rel=1e-9) and got[4] < 1.1 * sum(
        ((xy[i:i + 400] - xy[i:i + 400].mean(0)) ** 2).sum() for i in range(0, 1600, 400))
    same = {r.k: r.inertia for r in CL.minibatch_kmeans(df.repartition(7), (2, 4, 6), batch=300)[1].collect()}
    assert same == pytest.approx(got)
    assert CL.minibatch_kmeans(df.limit(0), (2,))[1].count() == 0


def test_elbow_stays_within_a_tenth_of_full_kmeans(spark):
    from pyspark.ml.clustering import KMeans
    from zonecast.plans.standins import pickups
    p = pickups(spark, "/root/testdata/sf0.01")
    got = {r.k: r.inertia for r in CL.kmeans_elbow(p, (3, 8, 15)).collect()}
    for k, v in got.items():
        full = KMeans(k=k, seed=1, featuresCol="features").fit(CL._vec(p)).summary.trainingCost
        assert v <= 1.1 * full


@pytest.mark.parametrize("kind,alpha", [("linear", 0.0), ("ridge", 1.0)])
def test_moments_survive_large_means(spark, kind, alpha):
    rng = np.random.default_rng(2)
    x = 1e8 + rng.normal(size=(200, 2))
    y = (x - 1e8) @ [2.0, -3.0] + 1e8 + rng.normal(size=200) / 100
    df = spark.createDataFrame(pd.DataFrame({"cd_name": [None] * 200, "x0": x[:, 0], "x1": x[:, 1], "y": y}), "cd_name string, x0 double, x1 double, y double")
    r = MD.fit_linear(df, ["x0", "x1"], kind, target="y").first()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
    assert np.allclose(r["coef"], w, atol=1e-6)


def test_cleaning_report_counts_every_step(spark):
    rows = [("1/2/2014 3:04", 40.7, -74.0, "B"), ("1/2/2014 3:04", 40.7, -74.0, "B"), ("bad", 40.7, -74.0, "B"), (None, 40.7, -74.0, "B")]
    rows += [(f"1/2/2014 {h}:00", 40.7 + h / 100, -74.0 + h / 100, "B") for h in range(20)]
    rows += [("1/3/2014 5:00", 90.0, -74.0, "B"), ("2014/01/03 06:00", 40.7, 10.0, "B")]
    df = spark.createDataFrame(rows, "`Date/Time` string, Lat double, Lon double, Base string")
    clean, report = C.clean_with_report(df)
    got = {r.step: (r.rows_before, r.rows_after) for r in report.collect()}
    assert got["parse_time"] == (26, 24) and got["duplicates"] == (24, 23) and got["iqr"] == (23, 21)
    assert got["bounding_box"][1] == clean.count() and list(got) == ["parse_time", "duplicates", "iqr", "bounding_box"]


def test_cleaning_nothing(spark):
    """No rows, and rows whose times cannot be read."""
    kind = "`Date/Time` string, Lat double, Lon double"
    for rows, n in (([], 0), ([("x", 1.0, 2.0), ("y", 1.0, 2.0)], 2)):
        clean, report = C.clean_with_report(spark.createDataFrame(rows, kind))
        got = {r.step: (r.rows_before, r.rows_after) for r in report.collect()}
        assert clean.count() == 0 and got["parse_time"] == (n, 0) and got["duplicates"] == (0, 0)


def test_models_come_back_by_run(spark, tmp_path):
    df = spark.createDataFrame([("a", float(i), 2.0 * i) for i in range(30)], "cd_name string, x double, pickups double")
    path = str(tmp_path / "m")
    for run, rounds in (("m_1", 2), ("m_2", 5)):
        RS.save_models(path, run, ["x"], trees=MD.trees.fit_boosted(df, ["x"], {"rounds": rounds, "min_leaf": 2}))
    latest = RS.load_models(spark, path, "m_", ("trees",))
    assert latest["run_id"] == "m_2" and latest["features"] == ["x"] and latest["trees"].count() == 5
    assert RS.load_models(spark, path, "m_", ("trees",), run_id="m_1")["trees"].count() == 2
    with pytest.raises(LookupError):
        RS.load_models(spark, path, "other_", ("trees",))
