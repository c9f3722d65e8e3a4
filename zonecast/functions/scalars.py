"""Scalar column expressions: calendar parts, cyclic encodings, names, slugs, labels.

All of these are built-in Spark expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timestamps import parse_forms

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Borough by first digit of a district code: 1 Manhattan, 2 Bronx, 3 Brooklyn,
# 4 Queens, 5 Staten Island; anything else Unknown.
BOROUGHS = {"1": "Manhattan", "2": "Bronx", "3": "Brooklyn", "4": "Queens", "5": "Staten Island"}
UNKNOWN_BOROUGH = "Unknown"
# Weekday labels, Monday first (weekday 0 = Monday).
WEEKDAY_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKDAY_LONG = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# RMSE classes of the forecast table: below 20 green, below 40 orange, else red.
RMSE_GREEN_BELOW = 20.0
RMSE_ORANGE_BELOW = 40.0
COLOR_GREEN = "#2ecc71"
COLOR_ORANGE = "#f39c12"
COLOR_RED = "#e74c3c"
# ---------------------------------------------------------------------------

TWO_PI = 2 * math.pi


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ------------------------------------------------------------------

def floor_hour(ts) -> Column:
    """Hour floor of a TIMESTAMP_NTZ, independent of the session time zone.

    (``date_trunc`` returns a session-zone TIMESTAMP; building the NTZ value from its
    fields keeps naive local times naive.)
    """
    t = col_(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def weekday0(ts) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(ts))


def is_weekend(ts) -> Column:
    return (F.weekday(col_(ts)) >= 5).cast("int")


def cyclic_sin(value, period: float) -> Column:
    """sin(2*pi*value/period), evaluated in that operator order."""
    return F.sin(F.lit(TWO_PI) * col_(value) / F.lit(float(period)))


def cyclic_cos(value, period: float) -> Column:
    return F.cos(F.lit(TWO_PI) * col_(value) / F.lit(float(period)))


def weekday_name(weekday, long: bool = False) -> Column:
    names = WEEKDAY_LONG if long else WEEKDAY_SHORT
    return F.element_at(F.array(*[F.lit(n) for n in names]), col_(weekday).cast("int") + 1)


def parse_timestamp(s, formats=None, first=()) -> Column:
    """Coercing parse to TIMESTAMP_NTZ; text that does not fit gives NULL.

    Without ``formats``: the forms of :mod:`zonecast.functions.timestamps`, those named in
    ``first`` tried first. With ``formats``: the first pattern that fits, parsed in the
    session zone."""
    c = col_(s).cast("string")
    if formats is not None:
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    return parse_forms(c, first)


def naive_micros(ts) -> Column:
    """Microseconds of a TIMESTAMP_NTZ since 1970 as its fields say (``timestamp_diff`` would go
    through the session zone)."""
    t = col_(ts).cast("timestamp_ntz")
    second = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return (F.unix_date(t.cast("date")).cast("bigint") * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60) * 1_000_000 + second


def timedelta_days(start, end) -> Column:
    """Whole days of ``end - start`` rounded towards minus infinity (``timedelta.days``)."""
    us = naive_micros(end) - naive_micros(start)
    return F.floor(us / F.lit(86400 * 1_000_000)).cast("bigint")


# -- names ------------------------------------------------------------------

def _borough_of(first_digit: Column) -> Column:
    m = F.create_map(*[x for k, v in BOROUGHS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, first_digit), F.lit(UNKNOWN_BOROUGH))


def district_name(code, variant: str = "features", boro_name=None, label=None) -> Column:
    """District display name from a borough-district code such as 101 or "205".

    variant="features": borough of the first digit + " CD " + the remaining characters.
    variant="padded":   borough + " CD " + the remaining digits as a 2-digit number
                        (412 -> "Queens CD 12", 1010 -> "Manhattan CD 10").
    variant="survey":   ``boro_name + " CD " + tail`` when a borough-name column is given,
                        else the "features" rule for 3-character codes and "CD_<code>"
                        otherwise; with no code at all the ``label`` column.
    The code is cast to an integer first so that 101.0 and "101" both give "101".
    """
    if code is None:
        return col_(label) if label is not None else F.lit(None).cast("string")
    s = col_(code).cast("double").cast("bigint").cast("string")
    head = F.substring(s, 1, 1)
    tail = F.substring(s, 2, 1 << 20)
    if variant == "features":
        return F.concat(_borough_of(head), F.lit(" CD "), tail)
    if variant == "padded":
        return F.concat(_borough_of(head), F.lit(" CD "),
                        F.format_string("%02d", tail.cast("int")))
    if variant == "survey":
        if boro_name is not None:
            return F.concat(col_(boro_name), F.lit(" CD "), tail)
        return F.when(F.length(s) == 3, F.concat(_borough_of(head), F.lit(" CD "), tail)) \
                .otherwise(F.concat(F.lit("CD_"), s))
    raise ValueError(f"unknown variant {variant!r}")


def slugify_tree(name) -> Column:
    """Every non-alphanumeric character becomes "_", lower case, "_" stripped at both ends."""
    return F.btrim(F.lower(F.regexp_replace(col_(name), r"[^\p{L}\p{N}]", "_")), F.lit("_"))


def slugify_collapse(name) -> Column:
    """Trim, lower case, space and "/" to "_", runs of "_" collapsed to one."""
    s = F.regexp_replace(col_(name), r"^\s+|\s+$", "")
    s = F.translate(F.lower(s), " /", "__")
    return F.regexp_replace(s, "_{2,}", "_")


def key_from_slug(slug) -> Column:
    """File-name district key used when reading per-district outputs: "_" -> " ", lower."""
    return F.lower(F.translate(col_(slug), "_", " "))


def model_label(col) -> Column:
    """"rmse_rf" -> "RF"."""
    return F.upper(F.replace(col_(col), F.lit("rmse_"), F.lit("")))


def color_bucket(rmse) -> Column:
    r = col_(rmse)
    return (F.when(r < RMSE_GREEN_BELOW, F.lit(COLOR_GREEN))
             .when(r < RMSE_ORANGE_BELOW, F.lit(COLOR_ORANGE))
             .otherwise(F.lit(COLOR_RED)))


def round_half_even(c, scale: int) -> Column:
    return F.bround(col_(c), scale)


def nan_to_null(c) -> Column:
    x = col_(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def pseudo_timestamp(month, day, hour, year: int = 1900) -> Column:
    """'YYYY-MM-DD HH' built from zero-padded parts and parsed; an impossible date
    (29 February of a common year) gives NULL."""
    s = F.concat(F.lit(f"{year}-"), F.lpad(col_(month).cast("string"), 2, "0"), F.lit("-"),
                 F.lpad(col_(day).cast("string"), 2, "0"), F.lit(" "), F.lpad(col_(hour).cast("string"), 2, "0"))
    return F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH")).cast("timestamp_ntz")
