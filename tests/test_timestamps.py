"""Every written form of a time, in two session zones; detection is a hint only; the value is
parsed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonecast.functions.timestamps import FORMS, detect_forms, unparsed_shapes
from zonecast.operators import clean as C

D = dt.datetime
CASES = {
    "Apr 1 2014": D(2014, 4, 1), "2014/04/01 00:11": D(2014, 4, 1, 0, 11), "20140401": D(2014, 4, 1),
    "1-4-2014 3:00": D(2014, 1, 4, 3), "4/1/14 0:11": D(2014, 4, 1, 0, 11), "4/1/99": D(1999, 4, 1), "4.1.2014": D(2014, 4, 1),
    "20140401001122": D(2014, 4, 1, 0, 11, 22), "1 April 2014 5:06": D(2014, 4, 1, 5, 6), "1-Apr-2014": D(2014, 4, 1),
    "april 1st, 2014 05:06:07.25": D(2014, 4, 1, 5, 6, 7, 250000), "2014-04-01   03:00": D(2014, 4, 1, 3),
    "  2014-4-1 1:02 ": D(2014, 4, 1, 1, 2), "2014-04-01 10:00 -0500": D(2014, 4, 1, 15), "4/1/2014 1:02 AM +01:00": D(2014, 4, 1, 0, 2),
    "2014/4/1 12:30 pm": D(2014, 4, 1, 12, 30), "Sept 9, 2014 12:00 am": D(2014, 9, 9), "3/9/2014 2:30": D(2014, 3, 9, 2, 30),
    "99999999": None, "2014-02-30": None, "2014-04-01 10:00:61": None, "13/1/2014": None, "4/1-2014": None, "Abr 1 2014": None,
    "2014-04-01 25:00": None, "n/a": None, "": None, None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_forms(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in CASES], "pickup_datetime string").withColumn("s", F.col("pickup_datetime"))
        got = {r.s: r.pickup_datetime for r in C.parse_ts_coerce(df, drop=False).collect()}
        kept = C.parse_ts_coerce(df).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == CASES and kept == sum(v is not None for v in CASES.values())


def test_detection_only_orders_the_forms(spark):
    df = spark.createDataFrame([("20140401",)] * 3 + [("4/1/2014",)] * 2 + [("x",)], "t string")
    assert detect_forms(df, "t") == ["yyyymmdd", "m/d/y"]
    for first in ([], list(FORMS)[::-1], ["month d y"]):
        assert C.parse_ts_coerce(df, "t", first=first).count() == 5


def test_the_filter_does_not_parse_again(spark):
    df = spark.createDataFrame([("4/1/2014",)], "t string")
    plan = C.parse_ts_coerce(df, "t").where("t > timestamp_ntz'2014-01-01 00:00:00'")._jdf.queryExecution().optimizedPlan().toString()
    top = plan[:plan.index("Generate")]
    assert "Filter" in top and "regexp_replace" not in top and plan.count("Generate") == 1


def test_unparsed_values_are_counted_by_shape(spark):
    df = spark.createDataFrame([("12/99/2014",), ("13/77/2015",), ("n/a",), ("4/1/2014",), (None,)], "t string")
    assert {(r.shape, r.n, r.example) for r in unparsed_shapes(df, "t").collect()} == {("99/99/9999", 2, "12/99/2014"), ("a/a", 1, "n/a")}


def test_odd_column_names_and_empty_tables(spark):
    df = spark.createDataFrame([("4/1/2014", 1)], "`Date/Time` string, `a.b` int")
    assert C.parse_ts_coerce(df, "Date/Time").first()[0] == D(2014, 4, 1)
    assert C.parse_ts_coerce(df.limit(0), "Date/Time").count() == 0
