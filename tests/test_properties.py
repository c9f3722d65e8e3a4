"""Invariants on the real stand-in data (row conservation, partitions of rows)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001


def test_hourly_count_conserves_points(spark):
    from zonecast.operators.features import hourly_count
    from zonecast.plans.standins import pickups
    p = pickups(spark, SF001)
    assert hourly_count(p).agg(F.sum("pickups")).first()[0] == p.count()


def test_grid_cells_partition_points(spark):
    from zonecast.plans.q_spatial import grid_points
    g = grid_points(spark, SF001)
    assert g.groupBy("event_id").count().where("count > 1").count() == 0


def test_splits_partition_rows(spark):
    from zonecast.operators import splits as spl
    from zonecast.plans.q_splits import features
    f = features(spark, SF001)
    s = spl.chrono_split(f)
    assert s.count() == f.count()
    per = {r["cd_name"]: r for r in s.groupBy("cd_name").agg(F.count_if(F.col("split") == "train").alias("tr"),
                                                             F.count(F.lit(1)).alias("n")).collect()}
    assert all(r["tr"] == int(r["n"] * 0.8) for r in per.values())
    # every train row precedes every test row of its district
    w = s.groupBy("cd_name", "split").agg(F.min("pickup_datetime").alias("a"), F.max("pickup_datetime").alias("b"))
    d = {(r["cd_name"], r["split"]): r for r in w.collect()}
    assert all(d[(k, "train")]["b"] < d[(k, "test")]["a"] for k, _ in d if (k, "test") in d)


def test_dense_hours_fills_gaps(spark):
    from zonecast.operators.features import dense_hours
    t = [dt.datetime(2024, 1, 1, h) for h in (0, 3, 4)]
    h = spark.createDataFrame([("a", x, 2) for x in t], "cd_name string, pickup_datetime timestamp_ntz, pickups long")
    out = sorted((r["pickup_datetime"].hour, r["pickups"]) for r in dense_hours(h).collect())
    assert out == [(0, 2), (1, 0), (2, 0), (3, 2), (4, 2)]


def test_pooled_tree_fit(spark):
    from zonecast.operators import models as MD
    rows = [(k, float(i), float(i % 7), float(2 * i + (5 if k == "b" else 0))) for k in ("a", "b") for i in range(60)]
    df = spark.createDataFrame(rows, "cd_name string, x0 double, x1 double, y double")
    out = MD.fit_predict_trees(df, df, ["x0", "x1"], "rf", {"numTrees": 5, "maxDepth": 5}, target="y", pooled=True)
    assert out.count() == 120 and "y_pred" in out.columns


def test_trees_fit_every_district_in_one_go(spark):
    from zonecast.operators import models as MD
    rows = [(k, float(i), float(2 * i)) for k in ("a", "b", "c") for i in range(40)]
    df = spark.createDataFrame(rows, "cd_name string, x0 double, y double")
    out = MD.fit_predict_trees(df, df, ["x0"], "rf", {"n_trees": 3, "max_depth": 3}, target="y")
    assert out.count() == 120
