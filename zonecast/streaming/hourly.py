"""Streaming hourly counts per district.

Pickup files landing in a folder are read with ``readStream``, assigned a district the
same way as in batch, and counted per (district, 1-hour event-time window) with a
watermark, so late points within the allowed delay still update their hour and the state
of closed hours is dropped. The output schema equals :func:`zonecast.operators.features.hourly_count`
(cd_name, pickup_datetime, pickups), so the feature step reads it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import naive_micros


def hourly_counts_stream(points: DataFrame, key: str = "cd_name", ts: str = "pickup_datetime",
                         watermark: str = "2 hours") -> DataFrame:
    """Streaming (or batch) DataFrame of points -> windowed hourly counts.

    Watermarks need a TIMESTAMP event time: the naive time's distance from a naive epoch is
    taken as an instant, and the window's start is turned back the same way, so that the
    session zone and its clock changes play no part and windows stay on naive hours."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    t = F.timestamp_micros(naive_micros(ts))
    w = (points.withColumn("_t", t).withWatermark("_t", watermark)
               .groupBy(F.col(key), F.window("_t", "1 hour"))
               .agg(F.count(F.lit(1)).alias("pickups")))
    start = F.timestamp_add("SECOND", F.unix_seconds(F.col("window.start")), epoch)
    return w.select(key, start.alias(ts), "pickups")


def start_hourly_stream(spark, source_dir: str, schema, sink_dir: str, checkpoint: str,
                        assign=None, trigger_once: bool = True):
    """Run the stream from parquet files in ``source_dir`` into a parquet sink
    (append mode: an hour is written once the watermark has passed it)."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    pts = assign(src) if assign else src
    q = (hourly_counts_stream(pts).writeStream.outputMode("append").format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if trigger_once else q
    return q.start()
