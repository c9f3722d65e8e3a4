"""End to end: raw points + polygons -> every step -> forecast table and step log."""

from pyspark.sql import functions as F

from conftest import SF001


def test_pipeline_end_to_end(spark, tmp_path):
    from zonecast.plans import standins as si
    from zonecast.plans.runner import Config, run
    raw = si.pickups(spark, "/root/testdata/sf0.01").select(
        F.date_format("pickup_datetime", "M/d/yyyy H:mm:ss").alias("pickup_datetime"), "Lat", "Lon", "Base",
        F.when(F.col("Base").isin("view", "click"), "a.csv").otherwise("b.csv").alias("source_file"))
    polys = si.dense_district_polygons(spark)
    cfg = Config(out=str(tmp_path), rf_params={"n_trees": 10, "max_depth": 5},
                 gbm_params={"rounds": 10, "max_depth": 3, "min_leaf": 5})
    status = run(spark, cfg, raw, polys, run_id="run_20240101_000000")
    assert status and all(v == "success" for v in status.values()), status
    fc = spark.read.parquet(f"{tmp_path}/forecast_next_hour")
    assert fc.count() > 0
    assert set(fc.columns) == {"district", "model_type", "pred_next_hour", "y_true", "rmse", "cd_name", "lat",
                               "lon", "radius", "color"}
    log = spark.read.parquet(f"{tmp_path}/pipeline_log")
    assert log.count() == len(status)
    assert spark.read.parquet(f"{tmp_path}/forecast_latest").count() > 0


def test_streaming_equals_batch(spark, tmp_path):
    import __spark_entry__ as E
    a = E.queries()["stream_hourly_count"](spark, SF001)
    from zonecast.operators.features import hourly_count
    from zonecast.plans.standins import pickups
    b = hourly_count(pickups(spark, SF001))
    assert a.exceptAll(b).count() == 0
