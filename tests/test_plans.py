"""Physical plan checks: the spatial join is a hash join on the cell key (no nested loop
or cartesian product), the feature plan has no Python evaluation and at most two hash
exchanges, filters and projections reach the parquet scan."""

from pyspark.sql import functions as F

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_join_is_hash_join(spark):
    from zonecast.plans.q_spatial import grid_points
    p = _plan(grid_points(spark, SF001))
    assert "BroadcastHashJoin" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_feature_plan_no_python_and_two_exchanges(spark):
    import __spark_entry__ as E
    df = E.queries()["feature_job"](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    p = _plan(df)
    assert "Python" not in p and "ArrowEval" not in p
    assert p.count("Exchange hashpartitioning") <= 2


def test_pushdown_and_pruning(spark, tmp_path):
    from zonecast.operators.clean import bbox_filter
    from zonecast.plans.standins import pickups
    path = str(tmp_path / "pk")
    pickups(spark, SF001).select("event_id", F.col("Lat").alias("lat"), F.col("Lon").alias("lon"), "Base") \
        .write.parquet(path)
    df = bbox_filter(spark.read.parquet(path)).select("event_id")
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon), GreaterThanOrEqual(lat,40.5)" in s
    assert "ReadSchema: struct<event_id:bigint,lat:double,lon:double>" in s


def test_windows_share_one_exchange(spark):
    from zonecast.plans.q_features import hourly
    from zonecast.operators import features as feat
    df = feat.build_features(hourly(spark, SF001))
    df.write.format("noop").mode("overwrite").save()
    p = _plan(df)
    # one exchange for the aggregation, one for all windows on cd_name
    assert p.count("Exchange hashpartitioning(cd_name") <= 2
