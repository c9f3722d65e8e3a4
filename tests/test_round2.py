"""Ingest and sampling cases that must not lose rows silently."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonecast.functions.scalars import parse_timestamp
from zonecast.operators.clustering import sample_n
from zonecast.operators.models import best_round
from zonecast.operators.quantiles import exact_quantiles_select


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_keep_the_written_clock(spark, zone):
    cases = {"2014-04-01 00:11:00.123": dt.datetime(2014, 4, 1, 0, 11, 0, 123000), "4/1/2014 0:11": dt.datetime(2014, 4, 1, 0, 11),
             "2014-04-01T00:11:00Z": dt.datetime(2014, 4, 1, 0, 11), "4/1/2014 12:11:00 AM": dt.datetime(2014, 4, 1, 0, 11),
             "4/1/2014 12:11 pm": dt.datetime(2014, 4, 1, 12, 11), "3/9/2014 2:30:00": dt.datetime(2014, 3, 9, 2, 30),
             "11/2/2014 1:30:00": dt.datetime(2014, 11, 2, 1, 30), "2014-04-01T02:00:00+02:00": dt.datetime(2014, 4, 1),
             "2014-04-01": dt.datetime(2014, 4, 1), "2014-02-30": None, "13/1/2014": None, "2014-04-01 24:00:00": None,
             "4/1/2014 13:00 PM": None, "x": None, "": None, None: None}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", parse_timestamp(F.col("s")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {r.s: r.t for r in rows} == cases


def test_sample_n_is_exact_for_any_seed(spark):
    df = spark.range(100).withColumnRenamed("id", "event_id")
    for seed in range(6):
        assert sample_n(df, 5, seed).count() == 5
    assert sample_n(df, 1000).count() == 100 and sample_n(df.limit(0), 5).count() == 0


def test_quantiles_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(9)] + [("a", float(i)) for i in range(5)], "g string, v double")
    got = {r.g: r.q50 for r in exact_quantiles_select(df, "v", (0.5,), ["g"], max_band=3, buckets=2).collect()}
    assert got == {None: 4.0, "a": 2.0}


def test_best_round_has_patience():
    errors = [5, 4, 4.5, 4.6, 3.9] + [4.0] * 300
    assert best_round(errors, 200) == (5, True) and best_round(errors, 2) == (2, True) and best_round(errors[:5], 200) == (5, False)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_streaming_hours_are_naive_hours(spark, zone):
    """Hours that a zone's clock skips or repeats are counted as written."""
    from zonecast.streaming.hourly import hourly_counts_stream
    t = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 59, 59), dt.datetime(2024, 3, 10, 3, 0),
         dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 11, 3, 0, 59), dt.datetime(1960, 1, 1, 5, 15)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("a", x) for x in t], "cd_name string, pickup_datetime timestamp_ntz")
        got = {r.pickup_datetime: r.pickups for r in hourly_counts_stream(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {dt.datetime(2024, 3, 10, 2): 2, dt.datetime(2024, 3, 10, 3): 1, dt.datetime(2024, 11, 3, 1): 1,
                   dt.datetime(2024, 11, 3, 0): 1, dt.datetime(1960, 1, 1, 5): 1}
