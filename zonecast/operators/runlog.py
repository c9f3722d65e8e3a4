"""Pipeline step log: append, tolerant read, and its analysis (SURVEY 2.1 ``sink_append_log``,
``scan_skip_bad_rows``; 2.4 ``step_duration``, ``success_rate``; 2.6 ``tail_log``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import conform_columns, to_numeric_coerce

LOG_COLUMNS = ["timestamp_utc", "step", "status", "duration_min", "details"]
# Columns the analysis expects (the log's own time column is mapped to it).
EXPECTED = ["timestamp", "step", "duration_min", "status", "details"]
LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LOG_COLUMNS])


def append_log(rows: DataFrame, path: str) -> None:
    """Append a batch of log rows; columns beyond the log's are left out, missing ones are NULL."""
    cols = [F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in LOG_COLUMNS]
    rows.select(*cols).write.mode("append").parquet(path)


def log_pipeline_step(spark: SparkSession, path: str, step: str, status: str, duration_min=None,
                      details=None, now: _dt.datetime | None = None) -> None:
    """Append one row to the step log table (parquet, append mode)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    row = (now.strftime("%Y-%m-%d %H:%M:%S UTC"), step, status,
           "" if duration_min is None else str(duration_min), details or "")
    append_log(spark.createDataFrame([row], LOG_SCHEMA), path)


def read_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tolerant CSV read of a text log, every field as text: a row with more fields than the
    columns is dropped (also when the extra field is empty), a short row is padded with
    NULLs, empty fields are NULL. Quoted fields may hold line feeds, so a file is read by
    one task (logs grow by files). Header lines are skipped."""
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("_other", T.StringType())])
    # records of another length come whole in ``_other``; their fields are counted outside quotes
    rows = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_other").csv(path)
    n_fields = F.size(F.split(F.regexp_replace("_other", r'"(?:[^"]|"")*"', "q"), ",", -1))
    header = F.lit(True)
    for c in LOG_COLUMNS:
        header = header & F.col(c).eqNullSafe(c)
    return rows.where((F.col("_other").isNull() | (n_fields <= len(LOG_COLUMNS))) & ~header).select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in LOG_COLUMNS])


def tidy_log(log: DataFrame) -> DataFrame:
    """Expected columns (time column mapped), duplicates dropped, duration numeric, rows
    without a step dropped."""
    if "timestamp" not in log.columns and "timestamp_utc" in log.columns:
        log = log.withColumnRenamed("timestamp_utc", "timestamp")
    t = conform_columns(log, EXPECTED)
    return to_numeric_coerce(t, "duration_min").where(F.col("step").isNotNull())


def step_duration(log: DataFrame) -> DataFrame:
    return tidy_log(log).groupBy("step").agg(F.avg("duration_min").alias("duration_min"))


def success_rate(log: DataFrame) -> DataFrame:
    ok = F.coalesce(F.lower(F.col("status")).contains("success"), F.lit(False)).cast("double")
    return tidy_log(log).agg((F.avg(ok) * 100).alias("success_rate"))


def tail_log(log: DataFrame, n: int = 10) -> DataFrame:
    """The n most recent rows (by time, then the other columns for a total order)."""
    t = tidy_log(log)
    return t.orderBy(F.col("timestamp").desc(), F.col("step").desc(), F.col("status").desc_nulls_last(),
                     F.col("duration_min").desc_nulls_last(), F.col("details").desc()).limit(n)
