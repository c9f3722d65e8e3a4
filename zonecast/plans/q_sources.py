"""Registered queries: sources, sinks and the streaming count.

Each query first writes data derived from the test tables (CSV / JSON files, run
tables, a landing folder) under the shared checkpoint folder, then reads it back through
the operator being shown; the oracle reads the same rows from the original tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as feat
from ..session import scratch_path
from ..sources import files as FS
from ..sources import runs as RS
from ..streaming.hourly import hourly_counts_stream
from . import standins as si
from .registry import query

RAW_SCHEMA = T.StructType([T.StructField("Date/Time", T.StringType()), T.StructField("Lat", T.DoubleType()),
                           T.StructField("Lon", T.DoubleType()), T.StructField("Base", T.StringType())])


@query("scan_csv", "WITH " + si.RAW_SQL + '\nSELECT "Date/Time", Lat, Lon, Base FROM raw')
def q_scan_csv(spark, d):
    path = scratch_path(spark, "raw_csv")
    FS.sink_csv(si.raw_pickups(spark, d), path)
    return FS.scan_csv(spark, path, RAW_SCHEMA)


@query("scan_csv_dates", "WITH " + si.HOURLY_SQL + "\nSELECT cd_name, pickup_datetime, pickups FROM hourly")
def q_scan_csv_dates(spark, d):
    path = scratch_path(spark, "hourly_csv")
    h = feat.hourly_count(si.pickups(spark, d))
    h.select("cd_name", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
             "pickups").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("cd_name", T.StringType()), T.StructField("pickup_datetime", T.StringType()),
                           T.StructField("pickups", T.LongType())])
    return FS.scan_csv_dates(spark, path, schema)


@query("scan_many_union", "WITH " + si.PICKUPS_SQL + """
SELECT date_trunc('second', pickup_datetime) AS pickup_datetime, Lat, Lon, 1 AS pickups FROM pickups""")
def q_scan_many_union(spark, d):
    """Two groups of raw files with different header spellings ('Date/Time, Lat, Lon' and
    'pickup_datetime, latitude, longitude'), split by event type, read as one table."""
    base = scratch_path(spark, "many")
    p = si.pickups(spark, d)
    a = p.where(F.col("Base").isin("view", "click")).select(
        F.date_format("pickup_datetime", "M/d/yyyy H:mm:ss").alias("Date/Time"), "Lat", "Lon", "Base")
    b = p.where(~F.col("Base").isin("view", "click")).select(
        F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        F.col("Lat").alias("latitude"), F.col("Lon").alias("longitude"))
    a.write.option("header", True).csv(f"{base}/a")
    b.write.option("header", True).csv(f"{base}/b")
    files = [f for sub in ("a", "b") for f in spark.read.text(f"{base}/{sub}").inputFiles()]
    u = FS.scan_many_union(spark, files)
    return u.select("pickup_datetime", "Lat", "Lon", "pickups")


@query("ingest_json", """SELECT event_id, event_type, value, '20240131' AS ingest_date FROM events""")
def q_ingest_json(spark, d):
    landing = scratch_path(spark, "landing")
    si.table(spark, d, "events").select("event_id", "event_type", "value").write.json(landing)
    out = scratch_path(spark, "ingested")
    return FS.ingest_json(spark, landing, out, _dt.date(2024, 1, 31)).select("event_id", "event_type", "value",
                                                                             "ingest_date")


@query("sink_per_district", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, pickup_datetime, pickups FROM hourly""")
def q_sink_per_district(spark, d):
    """Hourly counts written as a run table partitioned by run and district, read back
    for the latest run (by name) with partition pruning."""
    path = scratch_path(spark, "runs")
    h = feat.hourly_count(si.pickups(spark, d))
    RS.sink_run(h.withColumn("pickups", F.col("pickups") * 0), path, "hourly_20240101_000000", ("run_id", "cd_name"))
    RS.sink_run(h, path, "hourly_20240102_000000", ("run_id", "cd_name"))
    t = spark.read.parquet(path)
    return RS.latest_run_by_name(t, "hourly_").select("cd_name", "pickup_datetime", "pickups")


@query("latest_run_by_mtime", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, COUNT(*) AS n_hours FROM hourly GROUP BY cd_name""")
def q_latest_run_by_mtime(spark, d):
    path = scratch_path(spark, "runs_mtime")
    h = feat.hourly_count(si.pickups(spark, d)).groupBy("cd_name").agg(F.count(F.lit(1)).alias("n_hours"))
    RS.sink_run(h.withColumn("n_hours", F.lit(0).cast("bigint")), path, "eval_b")
    RS.sink_run(h, path, "eval_a")          # written later, sorts first by name
    return RS.latest_run_by_mtime(spark.read.parquet(path), "eval_").select("cd_name", "n_hours")


@query("stream_hourly_count", "WITH " + si.HOURLY_SQL + """
SELECT cd_name, pickup_datetime, pickups FROM hourly
WHERE pickup_datetime + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR""")
def q_stream_hourly_count(spark, d):
    """Structured Streaming over the landed points: hourly windowed counts with a 2-hour
    watermark, append mode; hours still open at the final watermark are not emitted."""
    src = scratch_path(spark, "stream_src")
    si.pickups(spark, d).select("pickup_datetime", "cd_name").write.parquet(src)
    sink, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ck")
    schema = T.StructType([T.StructField("pickup_datetime", T.TimestampNTZType()),
                           T.StructField("cd_name", T.StringType())])
    stream = spark.readStream.schema(schema).parquet(src)
    q = (hourly_counts_stream(stream).writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("clean_job_per_file", "WITH " + si.PICKUPS_SQL + """,
raw AS (SELECT DISTINCT date_trunc('second', pickup_datetime) AS pickup_datetime, Lat AS lat, Lon AS lon, Base AS base,
               Base || '.csv' AS f FROM pickups),
q AS (SELECT f, quantile_cont(lat, 0.25) AS la1, quantile_cont(lat, 0.75) AS la3,
             quantile_cont(lon, 0.25) AS lo1, quantile_cont(lon, 0.75) AS lo3 FROM raw GROUP BY f)
SELECT pickup_datetime, lat, lon, base, f AS source_file FROM raw JOIN q USING (f)
WHERE lat BETWEEN la1 - 1.5 * (la3 - la1) AND la3 + 1.5 * (la3 - la1)
  AND lon BETWEEN lo1 - 1.5 * (lo3 - lo1) AND lo3 + 1.5 * (lo3 - lo1)
  AND lat BETWEEN 40.5 AND 41.0 AND lon BETWEEN -74.3 AND -73.7""")
def q_clean_job_per_file(spark, d):
    """The cleaning job over a folder of raw files (one per base / event type), with the
    IQR bounds computed per file from ``_metadata.file_name`` as the reference cleans
    each file separately."""
    base = scratch_path(spark, "raw_files")
    raw = si.raw_pickups(spark, d)
    raw.write.partitionBy("Base").option("header", True).csv(base)
    df = (spark.read.schema(T.StructType(RAW_SCHEMA.fields[:3])).option("header", True)
          .option("recursiveFileLookup", False).csv(base)
          .withColumn("Base", F.regexp_extract(F.col("_metadata.file_path"), "Base=([^/]+)", 1))
          .withColumn("source_file", F.concat(F.col("Base"), F.lit(".csv"))))
    from ..operators.clean import clean_pickups
    out = clean_pickups(df.withColumnRenamed("Date/Time", "pickup_datetime"), group_by=("source_file",))
    return out.select("pickup_datetime", "lat", "lon", "base", "source_file")


@query("union_all", "SELECT event_id, event_type, value FROM events")
def q_union_all(spark, d):
    """Row concatenation by name of two parts of a table (columns in different order)."""
    ev = si.table(spark, d, "events")
    a = ev.where(F.col("event_type").isin("view", "click")).select("event_id", "event_type", "value")
    b = ev.where(~F.col("event_type").isin("view", "click") | F.col("event_type").isNull()) \
          .select("value", "event_type", "event_id")
    return a.unionByName(b)
