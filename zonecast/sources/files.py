"""File sources and sinks.

Readers declare their schema (no inference pass over the data); a directory or glob is
read as one DataFrame; the source file name, when it matters (per-file cleaning,
district keys in file names), comes from the ``_metadata.file_name`` column.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import key_from_slug, parse_timestamp
from ..functions.timestamps import detect_forms
from ..operators.clean import LAT_ALIASES, LON_ALIASES, TIME_PRIORITY


def scan_csv(spark: SparkSession, path, schema=None, header: bool = True, with_file: bool = False,
             ignore_corrupt_files: bool = False) -> DataFrame:
    """Headered CSV. With no schema every column is read as text (a declared schema is
    preferred; inference would scan the data twice). An unreadable file is an error unless
    the caller asks to skip such files."""
    r = (spark.read.option("header", header).option("ignoreCorruptFiles", ignore_corrupt_files)
         .option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def scan_csv_dates(spark: SparkSession, path, schema: T.StructType, date_cols=("pickup_datetime",),
                   fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """CSV whose date columns are declared TIMESTAMP_NTZ and parsed with ``fmt``."""
    fields = [T.StructField(f.name, T.TimestampNTZType() if f.name in date_cols else f.dataType, True)
              for f in schema.fields]
    return (spark.read.schema(T.StructType(fields)).option("header", True)
            .option("timestampNTZFormat", fmt).csv(path))


def _plain(path: str) -> str:
    """A path as it compares: no escapes, and local files without their scheme."""
    return re.sub(r"^file:/+", "/", unquote(path))


def _headers(spark: SparkSession, files: list[str]) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """({file: column names}, [(file, reason) of those that cannot be read]).

    One distributed pass over the lines of all files finds the first of each, and shows that
    every file can be read to its end. A missing or broken file stops such a pass and is named
    by the error; it is set aside and the pass repeated with the others, so there is one job, and
    one more for each bad file."""
    left, bad = list(dict.fromkeys(files)), []
    while left:
        try:
            lines = spark.read.text(left).select("value", F.col("_metadata.file_path").alias("file"),
                                                 F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("i"))
            first = lines.groupBy("file").agg(F.min_by("value", F.struct("at", "i")).alias("head")).collect()
        except (PySparkException, Py4JJavaError) as e:      # the second: a task that failed while reading
            said = str(e)
            lost = [f for f in left if _plain(f) in _plain(said)]
            lost = [f for f in lost if not any(f != g and _plain(f) in _plain(g) for g in lost)]     # the longest name
            if not lost:
                raise
            why = re.search(r"\[[A-Z_.]+\][^\n]*", said)
            bad += [(f, why[0] if why else said.splitlines()[0]) for f in lost]
            left = [f for f in left if f not in lost]
            continue
        heads = {_plain(r["file"]): [c.strip() for c in next(csv.reader([r["head"].lstrip("\ufeff")]), [])] for r in first}
        bad += [(f, "empty file") for f in left if _plain(f) not in heads]
        return {f: heads[_plain(f)] for f in left if _plain(f) in heads}, bad
    return {}, bad


def scan_many_union(spark: SparkSession, files: list[str]) -> DataFrame:
    """The union of :func:`scan_many_report` without the list of skipped files."""
    return scan_many_report(spark, files)[0]


def scan_many_report(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """Read raw pickup files with differing header spellings as one table
    (pickup_datetime, Lat, Lon, pickups=1, source_file).

    Files are grouped by header; each group is one distributed read renamed to the common
    names; groups are united by name. A file that is missing, empty or breaks while it is read
    and one without a usable time or coordinate column are skipped and listed with the reason in
    the second result (file, reason); none left is an error.
    """
    heads, skipped = _headers(spark, files)
    groups: dict[tuple, list[str]] = {}
    for f, cols in heads.items():
        groups.setdefault(tuple(cols), []).append(f)
    parts = []
    for cols, paths in groups.items():
        low = [c.lower() for c in cols]
        tcol = next((cols[low.index(t)] for t in TIME_PRIORITY if t in low), None)
        lat = next((c for c, lc in zip(cols, low) if lc in LAT_ALIASES), None)
        lon = next((c for c, lc in zip(cols, low) if lc in LON_ALIASES), None)
        if not (tcol and lat and lon):
            skipped += [(f, "no time or coordinate column: " + ", ".join(cols)) for f in paths]
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        df = spark.read.schema(schema).option("header", True).csv(paths)
        value = parse_timestamp(F.col(f"`{tcol}`"), first=detect_forms(df, tcol))
        parts.append(df.select(F.explode(F.array(value)).alias("pickup_datetime"),      # parsed once, see clean.parse_ts_coerce
                               F.col(f"`{lat}`").try_cast("double").alias("Lat"),
                               F.col(f"`{lon}`").try_cast("double").alias("Lon"),
                               F.lit(1).alias("pickups"),
                               F.col("_metadata.file_name").alias("source_file")))
    if not parts:
        raise ValueError(f"no file has a time and a coordinate column; skipped: {skipped}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out, spark.createDataFrame(skipped, "file string, reason string")


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def ingest_json(spark: SparkSession, landing: str, out: str, ingest_date: _dt.date | None = None,
                array_documents: bool = False, schema=None) -> DataFrame:
    """JSON records landed by the fetcher -> tabular rows under
    ``out/ingest_date=YYYYMMDD``; ingesting a day again replaces that day.
    ``array_documents``: each file is one JSON array of records (an API response)
    instead of one record per line."""
    day = (ingest_date or _dt.datetime.now(_dt.timezone.utc).date()).strftime("%Y%m%d")
    r = spark.read.option("multiLine", array_documents)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(landing)
    df.withColumn("ingest_date", F.lit(day)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(out)
    return spark.read.parquet(f"{out}/ingest_date={day}").withColumn("ingest_date", F.lit(day))


def scan_by_filename_key(spark: SparkSession, path: str, prefix: str, schema=None) -> DataFrame:
    """Per-district CSV outputs named ``<prefix><slug>.csv`` (or folders named so): the
    district key is parsed from the path (prefix stripped, '_' -> ' ', lower case)."""
    df = scan_csv(spark, path, schema)
    slug = F.regexp_extract(F.col("_metadata.file_path"), prefix + r"([^/=.]+?)(?:\.csv)?(?:/|$)", 1)
    return df.withColumn("district_key", key_from_slug(slug))
