"""Cleaning: column-name normalisation, alias resolution, coercion, duplicates, IQR and
bounding-box filters, imputation (SURVEY 2.2).

Every function is DataFrame -> DataFrame. Name handling (normalise, alias resolution,
required columns) only looks at ``df.columns`` on the driver: metadata, no data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_timestamp
from ..functions.timestamps import detect_forms
from ..session import materialize

# Accepted spellings of the coordinate columns and of the time column.
LAT_ALIASES = ("lat", "latitude", "pickup_latitude")
LON_ALIASES = ("lon", "lng", "longitude", "pickup_longitude")
TIME_PRIORITY = ("pickup_datetime", "date/time", "datetime", "tpep_pickup_datetime")
# City bounding box (inclusive) and the IQR factor.
BBOX_LAT = (40.5, 41.0)
BBOX_LON = (-74.3, -73.7)
IQR_FACTOR = 1.5


def normalize_colnames(df: DataFrame) -> DataFrame:
    """strip, lower case, spaces to underscores on every column name."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def resolve_aliases(df: DataFrame) -> DataFrame:
    """Rename lat/lon spellings to Lat/Lon and any column whose name contains "date" or
    "time" to pickup_datetime. Two columns mapping to one name raise ValueError."""
    mapping = {}
    for c in df.columns:
        lc = c.lower()
        if lc in LAT_ALIASES:
            mapping[c] = "Lat"
        elif lc in LON_ALIASES:
            mapping[c] = "Lon"
        elif "date" in lc or "time" in lc:
            mapping[c] = "pickup_datetime"
    targets = list(mapping.values())
    dup = {t for t in targets if targets.count(t) > 1}
    if dup:
        raise ValueError(f"several columns map to {sorted(dup)}: {mapping}")
    return df.withColumnsRenamed(mapping) if mapping else df


def resolve_time_alias(df: DataFrame) -> DataFrame:
    """The first present of pickup_datetime, date/time, datetime, tpep_pickup_datetime
    becomes pickup_datetime; none present raises KeyError."""
    for c in TIME_PRIORITY:
        if c in df.columns:
            return df if c == "pickup_datetime" else df.withColumnRenamed(c, "pickup_datetime")
    raise KeyError(f"No valid datetime column found. Columns: {df.columns}")


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"Missing required columns: {missing}. Available columns: {df.columns}")
    return df


def require_latlon(df: DataFrame) -> DataFrame | None:
    """Project (pickup_datetime, Lat, Lon, pickups=1) or None when Lat/Lon are missing."""
    df = resolve_aliases(df) if not {"Lat", "Lon"} <= set(df.columns) else df
    if not {"Lat", "Lon"} <= set(df.columns):
        return None
    return df.select("pickup_datetime", "Lat", "Lon", F.lit(1).alias("pickups"))


def parse_ts_coerce(df: DataFrame, col: str = "pickup_datetime", formats=None, drop: bool = True,
                    first=None) -> DataFrame:
    """Text -> TIMESTAMP_NTZ; unparseable values become NULL and (by default) are dropped.
    Columns already of a timestamp type are kept as they are. ``first``: the forms tried first;
    by default those that a bounded look at the column shows (never which are read).

    The value is produced by a generator, so that filters on it are not pushed below and
    the text is parsed once."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        out = df.withColumn(col, F.col(f"`{col}`").cast("timestamp_ntz"))
    else:
        if first is None:
            first = detect_forms(df, col) if formats is None else ()
        value = parse_timestamp(F.col(f"`{col}`"), formats, first)
        out = df.select(*[F.explode(F.array(value)).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])
    return out.dropna(subset=[col]) if drop else out


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN -> NULL on floating columns (pandas treats NaN as missing)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (cols or fl) if c in fl]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in cols}) if cols else df


def drop_null_subset(df: DataFrame, subset) -> DataFrame:
    return df.dropna(subset=list(subset))


def drop_null_any(df: DataFrame) -> DataFrame:
    return df.dropna()


def dedup_all(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_subset(df: DataFrame, subset) -> DataFrame:
    return df.dropDuplicates(list(subset))


def exact_quantiles(df: DataFrame, col: str, qs=(0.25, 0.75), group_by=(), method: str = "select") -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default) per group, exact.

    method="select" (default): distributed selection (:mod:`zonecast.operators.quantiles`),
    no task holds more than a bounded band of values whatever the data.
    method="counts": values collapsed to (value, count) pairs by a shuffled aggregation,
    then ``percentile(value, qs, count)`` over the distinct values; one pass fewer, but
    the final state per group is one entry per distinct value (fine for columns of fixed
    precision, e.g. 6-decimal coordinates in a city box).
    """
    if method == "select":
        from .quantiles import exact_quantiles_select
        return exact_quantiles_select(df, col, qs, group_by)
    g = list(group_by)
    pairs = df.where(F.col(col).isNotNull() & ~F.isnan(col)).groupBy(*g, col).agg(F.count(F.lit(1)).alias("_n"))
    arr = F.array(*[F.lit(float(q)) for q in qs])
    out = pairs.groupBy(*g).agg(F.percentile(F.col(col), arr, F.col("_n")).alias("_q"))
    return out.select(*g, *[F.col("_q")[i].alias(f"q{int(round(q * 100)):02d}") for i, q in enumerate(qs)])


def iqr_bounds(df: DataFrame, cols=("lat", "lon"), factor: float = IQR_FACTOR, group_by=()) -> DataFrame:
    """One row per group: ``<c>_lo``/``<c>_hi`` = Q1 - f*IQR / Q3 + f*IQR for each column.
    All columns are handled in one quantile run: the values are stacked as
    (column name, value) rows and the column name becomes part of the group key."""
    g = list(group_by)
    cols = list(cols)
    stacked = df.select(*g, F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val"))
                                                 for c in cols])).alias("_s")).select(*g, "_s._col", "_s._val")
    q = exact_quantiles(stacked, "_val", (0.25, 0.75), g + ["_col"])
    iqr = F.col("q75") - F.col("q25")
    q = q.select(*g, "_col", (F.col("q25") - F.lit(factor) * iqr).alias("lo"), (F.col("q75") + F.lit(factor) * iqr).alias("hi"))
    aggs = []
    for c in cols:
        aggs += [F.first(F.when(F.col("_col") == c, F.col("lo")), ignorenulls=True).alias(f"{c}_lo"),
                 F.first(F.when(F.col("_col") == c, F.col("hi")), ignorenulls=True).alias(f"{c}_hi")]
    return q.groupBy(*g).agg(*aggs)


def _bound_cols(df: DataFrame, cols, factor, group_by):
    """(frame, {name: bound column}). Global bounds are scalar subqueries (one value each,
    evaluated once and inlined: no join); per-group bounds are equi-joined on the group
    keys (one row per group, e.g. per input file)."""
    g = list(group_by)
    if not g:
        b = iqr_bounds(df, cols, factor)
        bounds = {}
        for c in cols:
            bounds[f"{c}_lo"] = b.select(f"{c}_lo").scalar()
            bounds[f"{c}_hi"] = b.select(f"{c}_hi").scalar()
        return df, bounds
    b = iqr_bounds(df, cols, factor, g)
    from .quantiles import _null_safe
    return _null_safe(df, b, g), {n: F.col(n) for c in cols for n in (f"{c}_lo", f"{c}_hi")}


def _inside(bounds: dict, cols):
    cond = None
    for c in cols:
        cc = F.col(c).between(bounds[f"{c}_lo"], bounds[f"{c}_hi"])
        cond = cc if cond is None else cond & cc
    return cond


def iqr_filter(df: DataFrame, cols=("lat", "lon"), factor: float = IQR_FACTOR, group_by=()) -> DataFrame:
    """Keep rows whose every column lies within [Q1 - f*IQR, Q3 + f*IQR] (inclusive).
    ``group_by`` (e.g. the source file) computes the bounds per group."""
    j, b = _bound_cols(df, cols, factor, group_by)
    return j.where(_inside(b, cols)).select(*df.columns)


def iqr_outliers(df: DataFrame, cols=("Lat", "Lon"), factor: float = IQR_FACTOR, group_by=()) -> DataFrame:
    """Complement of :func:`iqr_filter` (strictly outside on any column)."""
    keep = df.columns
    j, b = _bound_cols(df, cols, factor, group_by)
    cond = None
    for c in cols:
        cc = (F.col(c) < b[f"{c}_lo"]) | (F.col(c) > b[f"{c}_hi"])
        cond = cc if cond is None else cond | cc
    return j.where(cond).select(*keep)


def bbox_filter(df: DataFrame, lat: str = "lat", lon: str = "lon", lat_bounds=BBOX_LAT, lon_bounds=BBOX_LON) -> DataFrame:
    return df.where(F.col(lat).between(*lat_bounds) & F.col(lon).between(*lon_bounds))


def bbox_outliers(df: DataFrame, lat: str = "Lat", lon: str = "Lon", lat_bounds=BBOX_LAT, lon_bounds=BBOX_LON) -> DataFrame:
    return df.where((F.col(lat) < lat_bounds[0]) | (F.col(lat) > lat_bounds[1])
                    | (F.col(lon) < lon_bounds[0]) | (F.col(lon) > lon_bounds[1]))


def positive_filter(df: DataFrame, col: str = "pickups") -> DataFrame:
    return df.where(F.col(col) > 0) if col in df.columns else df


def fill_unknown(df: DataFrame, cols=("cd_name", "borough"), value: str = "Unknown") -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def impute_train_mean(train: DataFrame, test: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """NULL features in both frames <- the *train* mean (one aggregation for all columns,
    used as one scalar subquery)."""
    cols = list(cols)
    if not cols:
        return train, test
    one = train.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    means = {c: one[f"m{i}"] for i, c in enumerate(cols)}

    def fill(df):
        return df.withColumns({c: F.coalesce(F.col(c), means[c]) for c in cols})
    return fill(train), fill(test)


def conform_columns(df: DataFrame, expected, dtype: str = "string") -> DataFrame:
    """Add missing expected columns as NULL, project them in order, drop duplicates."""
    cols = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(dtype).alias(c) for c in expected]
    return df.select(*cols).dropDuplicates()


def to_numeric_coerce(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).try_cast("double"))


def cast_columns(df: DataFrame, to_double=(), timestamps_to_string: bool = True) -> DataFrame:
    """Cast listed columns to DOUBLE and (optionally) every timestamp/date column to text."""
    out = {}
    for f in df.schema.fields:
        if f.name in to_double:
            out[f.name] = F.col(f.name).cast("double")
        elif timestamps_to_string and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out[f.name] = F.col(f.name).cast("string")
    return df.withColumns(out) if out else df


def select_by_prefix(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def drop_columns(df: DataFrame, *cols) -> DataFrame:
    return df.drop(*cols)


def filter_key(df: DataFrame, value, key: str = "cd_name") -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def all_duplicates(df: DataFrame, keys) -> DataFrame:
    """Every member of a group of rows sharing ``keys`` (pandas ``keep=False``).

    Group sizes come from a partially aggregated count (a hot key costs one partial row
    per task), and the rows are kept by a semi-join on the repeated keys, never by a
    window that would put a whole hot group into one task; AQE splits a skewed semi-join
    partition. Keys containing NULL match like equal values (pandas semantics)."""
    keys = list(keys)
    rep = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    cond = [df[k].eqNullSafe(rep[k]) for k in keys]
    return df.join(rep, cond, "left_semi")


def clean_pickups(df: DataFrame, group_by=(), factor: float = IQR_FACTOR) -> DataFrame:
    """The cleaning job for one or many raw files (reference step order):
    names -> time alias -> coerce + drop -> exact dedup -> IQR on lat/lon (per
    ``group_by``, e.g. the source file) -> bounding box -> positive count -> fill names.
    Sorting is left to the writer; Spark tables carry no order."""
    return clean_with_report(df, group_by, factor)[0]


def clean_with_report(df: DataFrame, group_by=(), factor: float = IQR_FACTOR) -> tuple[DataFrame, DataFrame]:
    """:func:`clean_pickups` and what every step removed: (step, rows_before, rows_after).

    The counts up to the duplicates are observed while the deduplicated table is written;
    those after it come from one aggregation, which runs only if the report is read."""
    df = normalize_colnames(df)
    try:
        df = resolve_time_alias(df)
    except KeyError:
        pass
    raw, parsed = Observation("raw"), Observation("parsed")
    # looked at before the counting, which ends with the first action
    first = detect_forms(df, "pickup_datetime") if "pickup_datetime" in df.columns else ()
    source = df
    df = df.observe(raw, F.count(F.lit(1)).alias("n"))
    if "pickup_datetime" in df.columns:
        df = parse_ts_coerce(df, "pickup_datetime", first=first)
    df = nan_to_null(df.observe(parsed, F.count(F.lit(1)).alias("n")))
    # written once: the bounds and the filter below both read it
    df = materialize(dedup_all(df), "deduplicated")
    if df.isEmpty():        # the plan may have been cut down to nothing, with the counters in it
        n_raw, n_parsed = source.count(), 0
    else:
        n_raw, n_parsed = raw.get["n"], parsed.get["n"]
    located = {"lat", "lon"} <= set(df.columns)
    j, conds = df, []
    if located:
        j, bounds = _bound_cols(df, ("lat", "lon"), factor, group_by)
        conds = [("iqr", _inside(bounds, ("lat", "lon"))),
                 ("bounding_box", F.col("lat").between(*BBOX_LAT) & F.col("lon").between(*BBOX_LON))]
    if "pickups" in df.columns:
        conds.append(("positive", F.col("pickups") > 0))
    out, passed, counts = j, F.lit(True), [F.count(F.lit(1))]
    for _, cond in conds:
        out, passed = out.where(cond), passed & cond
        counts.append(F.count_if(passed))
    steps = ["parse_time", "duplicates", *(name for name, _ in conds)]
    tail = j.agg(F.array(*counts).alias("n")).select(F.concat(
        F.array(F.lit(n_raw), F.lit(n_parsed)).cast("array<bigint>"), F.col("n")).alias("n"))
    report = tail.select(F.posexplode(F.array(*[F.lit(s) for s in steps])).alias("i", "step"), "n").select(
        "step", F.get("n", F.col("i")).alias("rows_before"), F.get("n", F.col("i") + 1).alias("rows_after"))
    return fill_unknown(out.select(*df.columns)), report
