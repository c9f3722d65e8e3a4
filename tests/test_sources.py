"""Sources and sinks: GeoJSON polygons, file-name keys, run tables, model store, EDA sink."""

import json

from pyspark.sql import functions as F

from conftest import SF001


def test_scan_polygons_geojson(spark, tmp_path):
    from zonecast.operators import spatial as sp
    from zonecast.sources.polygons import scan_polygons
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"boro_cd": 101},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4]],
                                                         [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]}},
        {"type": "Feature", "properties": {"boro_cd": "412", "boro_name": "Queens"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[10, 10], [11, 10], [11, 11], [10, 11], [10, 10]]],
             [[[20, 20], [21, 20], [21, 21], [20, 21], [20, 20]]]]}},
    ]}
    p = tmp_path / "d.geojson"
    p.write_text(json.dumps(fc))
    polys = scan_polygons(spark, str(p))
    rows = sorted((r["cd_name"], r["part_id"], len(r["rings"])) for r in polys.collect())
    assert rows == [("Manhattan CD 01", 0, 2), ("Queens CD 12", 0, 1), ("Queens CD 12", 1, 1)]
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 20.5, 20.5)], "id int, Lon double, Lat double")
    got = sorted((r["id"], r["cd_name"]) for r in sp.spatial_within_join(pts, polys, cell_size=1.0).collect())
    assert got == [(1, "Manhattan CD 01"), (3, "Queens CD 12")]


def test_scan_by_filename_key(spark, tmp_path):
    from zonecast.sources.files import scan_by_filename_key
    for slug in ("manhattan_cd_01", "brooklyn_cd_02"):
        (tmp_path / f"rf_preds_{slug}.csv").write_text("y_true,y_pred\n1,2\n3,4\n")
    df = scan_by_filename_key(spark, str(tmp_path), "rf_preds_", "y_true double, y_pred double")
    keys = sorted({r["district_key"] for r in df.collect()})
    assert keys == ["brooklyn cd 02", "manhattan cd 01"]


def test_model_store_roundtrip(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from zonecast.sources.runs import load_pipeline_model, save_model
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                         LinearRegression(labelCol="y")]).fit(df)
    save_model(m, str(tmp_path / "m"))
    m2 = load_pipeline_model(str(tmp_path / "m"))
    a = [r["prediction"] for r in m.transform(df).collect()]
    b = [r["prediction"] for r in m2.transform(df).collect()]
    assert a == b


def test_run_tables_latest(spark, tmp_path):
    from zonecast.sources import runs as RS
    df = spark.range(3).withColumnRenamed("id", "v")
    RS.sink_run(df, str(tmp_path / "t"), "x_20240101_000000")
    RS.sink_run(df.withColumn("v", F.col("v") + 10), str(tmp_path / "t"), "x_20240102_000000")
    t = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r["v"] for r in RS.latest_run_by_name(t, "x_").collect()) == [10, 11, 12]
    assert RS.publish_latest(spark, str(tmp_path / "t"), str(tmp_path / "latest"), "x_")
    assert not RS.publish_latest(spark, str(tmp_path / "none"), str(tmp_path / "latest2"), "x_")


def test_sink_eda_tables(spark, tmp_path):
    from zonecast.operators import eda
    from zonecast.plans.standins import pickups_with_parts
    p = pickups_with_parts(spark, SF001)
    names = [r["cd_name"] for r in eda.topk_by_pickups(p, 3).collect()]
    paths = eda.sink_eda_tables(p, names, str(tmp_path))
    assert len(paths) == 5
    h = spark.read.parquet(paths[0])
    assert set(h.columns) == {"Hour", *names}
    assert spark.read.parquet(paths[-1]).count() == (3 + 4) ** 2


def test_scan_many_union_skips_bad_files(spark, tmp_path):
    import pytest
    from zonecast.sources.files import scan_many_union
    good = tmp_path / "a.csv"
    good.write_text("Date/Time,Lat,Lon,Base\n4/1/2014 0:11:00,40.769,-73.9549,B\n")
    alias = tmp_path / "b.csv"
    alias.write_text("tpep_pickup_datetime,pickup_latitude,pickup_longitude\n2014-04-01 00:12:00,40.7,-73.9\n")
    nolatlon = tmp_path / "c.csv"
    nolatlon.write_text("Date/Time,x,y\n4/1/2014 0:11:00,1,2\n")
    missing = str(tmp_path / "does_not_exist.csv")
    df = scan_many_union(spark, [str(good), str(alias), str(nolatlon), missing])
    rows = sorted((str(r["pickup_datetime"]), r["Lat"]) for r in df.collect())
    assert rows == [("2014-04-01 00:11:00", 40.769), ("2014-04-01 00:12:00", 40.7)]
    with pytest.raises(ValueError):
        scan_many_union(spark, [str(nolatlon), missing])


def test_alias_resolution(spark):
    import pytest
    from zonecast.operators.clean import require_columns, require_latlon, resolve_aliases, resolve_time_alias
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.0, 2.0)], "`Pickup Time` string, LATITUDE double, lng double")
    r = resolve_aliases(df)
    assert r.columns == ["pickup_datetime", "Lat", "Lon"]
    assert require_latlon(r).columns == ["pickup_datetime", "Lat", "Lon", "pickups"]
    bad = spark.createDataFrame([(1.0, 2.0)], "lat double, latitude double")
    with pytest.raises(ValueError):
        resolve_aliases(bad)
    with pytest.raises(KeyError):
        resolve_time_alias(bad)
    with pytest.raises(KeyError):
        require_columns(bad, ["lat", "lon"])
    assert require_latlon(spark.createDataFrame([(1,)], "a int")) is None


def test_sink_csv_roundtrip(spark, tmp_path):
    from pyspark.sql import types as T
    from zonecast.sources.files import scan_csv, sink_csv
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    sink_csv(df, str(tmp_path / "o"))
    back = scan_csv(spark, str(tmp_path / "o"), T.StructType([T.StructField("k", T.StringType()),
                                                             T.StructField("v", T.DoubleType())]))
    assert sorted(back.collect(), key=lambda r: r["k"]) == sorted(df.collect(), key=lambda r: r["k"])


def test_ingest_json_array_documents(spark, tmp_path):
    import datetime as dt
    from zonecast.sources.files import ingest_json
    land = tmp_path / "landing"
    land.mkdir()
    (land / "response.json").write_text(json.dumps([{"pickup_datetime": "2024-01-01 00:10:00", "lat": 40.7, "lon": -73.9},
                                                    {"pickup_datetime": "2024-01-01 00:20:00", "lat": 40.8, "lon": -73.8}]))
    out = ingest_json(spark, str(land), str(tmp_path / "out"), dt.date(2024, 1, 2), array_documents=True)
    rows = sorted((r["lat"], r["ingest_date"]) for r in out.collect())
    assert rows == [(40.7, "20240102"), (40.8, "20240102")]


def test_bad_files_are_set_aside_one_by_one(spark, tmp_path):
    """Missing, empty, cut and column-less files are listed; a file whose name is part of
    another's stays; quoted headers and a byte order mark are read."""
    import gzip

    from zonecast.sources import files as FS
    good = "pickup_datetime,lat,lon\n2014-04-01 00:00:00,40.5,-74.0\n"
    (tmp_path / "a.csv").write_text(good)
    (tmp_path / "ba.csv").write_text('\ufeff"Date/Time","Lat","Lon"\n4/1/2014 1:00,40.6,-74.1\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "none.csv").write_text("x,y\n1,2\n")
    whole = gzip.compress(("pickup_datetime,lat,lon\n" + "".join(f"2014-04-01 00:00:{i % 60:02d},{40 + i % 997 / 1000},-74.0\n"
                                                                for i in range(30000))).encode())
    (tmp_path / "cut.csv.gz").write_bytes(whole[:-3000])
    names = ["a.csv", "ba.csv", "empty.csv", "none.csv", "cut.csv.gz", "gone.csv"]
    table, skipped = FS.scan_many_report(spark, [str(tmp_path / n) for n in names])
    assert sorted(r.Lat for r in table.collect()) == [40.5, 40.6]
    got = {r.file.rsplit("/", 1)[1]: r.reason for r in skipped.collect()}
    assert sorted(got) == ["cut.csv.gz", "empty.csv", "gone.csv", "none.csv"] and got["empty.csv"] == "empty file"
    assert "PATH_NOT_FOUND" in got["gone.csv"] and "FAILED_READ_FILE" in got["cut.csv.gz"]


def test_log_fields_may_hold_line_feeds(spark, tmp_path):
    from zonecast.operators import runlog as RL
    (tmp_path / "log.csv").write_text('timestamp_utc,step,status,duration_min,details\nt1,a,success,1,"two\nlines, one field"\n'
                                      't2,b,failed\n\nt3,c,success,2,x,\nt4,d,,3,""\ntimestamp_utc,step,status,duration_min,details\n')
    got = {r.step: tuple(r) for r in RL.read_log_csv(spark, str(tmp_path)).collect()}
    assert got == {"a": ("t1", "a", "success", "1", "two\nlines, one field"), "b": ("t2", "b", "failed", None, None),
                   "d": ("t4", "d", None, "3", None)}
