"""Coercing timestamp parser: text of many forms to TIMESTAMP_NTZ, text that fits none to NULL.

Each form is one pattern that rewrites the text to year-month-day and a time, which the
built-in cast reads; the patterns exclude each other, so their order only decides how many
are tried. :func:`detect_forms` looks at a bounded number of rows and puts the forms seen
first; rows of any other form are still read. AM / PM and written zones go a longer way that
only such rows take. The fields are read as they are written, so the session zone and its
clock changes play no part; a written zone is turned to UTC.

Dates with one- or two-digit first fields are month first. Two-digit years up to 68 are
20yy, others 19yy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the detection looks at; a hint only, never a limit on what is parsed.
DETECT_ROWS = 10_000

_TIME = r"(?:[ T]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?))?\s*$"
_MONTHS = ["jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?",
           "sept?(?:ember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?"]
_NAME = "(" + "|".join(_MONTHS) + r")\.?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"

#: Form -> (pattern, its year-month-day and time as a replacement). A month name stands as ``#``.
FORMS: dict[str, tuple[str, str]] = {
    "y-m-d": (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME, "$1-$2-$3 $4"),
    "m/d/y": (r"^\s*(\d{1,2})([-/.])(\d{1,2})\2(\d{4})" + _TIME, "$4-$1-$3 $5"),
    "y/m/d": (r"^\s*(\d{4})([/.])(\d{1,2})\2(\d{1,2})" + _TIME, "$1-$3-$4 $5"),
    "m/d/yy": (r"^\s*(\d{1,2})([-/.])(\d{1,2})\2([0-5]\d|6[0-8])" + _TIME, "20$4-$1-$3 $5"),
    "m/d/yy (1900s)": (r"^\s*(\d{1,2})([-/.])(\d{1,2})\2(69|[7-9]\d)" + _TIME, "19$4-$1-$3 $5"),
    "yyyymmdd": (r"^\s*(\d{4})(\d{2})(\d{2})" + _TIME, "$1-$2-$3 $4"),
    "yyyymmddhhmmss": (r"^\s*(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})\s*$", "$1-$2-$3 $4:$5:$6"),
    "month d y": (r"(?i)^\s*" + _NAME + r"[ -]+" + _DAY + r",?[ -]+(\d{4}),?" + _TIME, "$3-#-$2 $4"),
    "d month y": (r"(?i)^\s*" + _DAY + r"[ -]*" + _NAME + r",?[ -]*(\d{4}),?" + _TIME, "$3-#-$1 $4"),
}
_CLOCK = r"^([^:]*:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)\s*([AaPp][Mm])?\s*(Z|z|UTC|[+-]\d{2}:?\d{2})?\s*$"
_MARKED = r":\d{2}(?:\.\d{1,9})?\s*(?:[AaPp][Mm]|Z|z|UTC|[+-]\d{2}:?\d{2})"


def _month(c: Column, pattern: str, group: int) -> Column:
    names = F.create_map(*[x for k, m in enumerate(_MONTHS) for x in (F.lit(m[:3]), F.lit(str(k + 1)))])
    return names[F.lower(F.substring(F.regexp_extract(c, pattern, group), 1, 3))]


def _plain(c: Column, forms) -> Column:
    """Text without AM / PM or zone; the first form whose pattern fits is read."""
    branch = None
    for name in forms:
        pattern, iso = FORMS[name]
        if "#" in iso:
            left, right = iso.split("#")
            text = F.concat(F.regexp_replace(c, pattern, left), _month(c, pattern, 1 if name.startswith("month") else 2),
                            F.regexp_replace(c, pattern, right))
        else:
            text = F.regexp_replace(c, pattern, iso)
        value = text.try_cast("timestamp_ntz")
        if name == "y-m-d":     # the cast reads most of these as they are
            value = F.coalesce(c.try_cast("timestamp_ntz"), value)
        branch = F.when(c.rlike(pattern), value) if branch is None else branch.when(c.rlike(pattern), value)
    return branch


def _marked(c: Column, forms) -> Column:
    """Text with AM / PM or a zone: the clock without them, then moved by both."""
    parts = F.struct(_plain(F.regexp_replace(c, _CLOCK, "$1"), forms).alias("t"),
                     F.lower(F.regexp_extract(c, _CLOCK, 2)).alias("half"),
                     F.regexp_replace(F.regexp_extract(c, _CLOCK, 3), "(?i):|z|utc", "").alias("zone"))

    def moved(x):
        hour = F.hour(x["t"])
        half = (F.when(x["half"] == "", F.lit(0)).when(~hour.between(1, 12), F.lit(None).cast("int"))
                .otherwise(hour % 12 + F.when(x["half"] == "pm", 12).otherwise(0) - hour))
        minutes = F.when(x["zone"] == "", F.lit(0)).otherwise(
            F.concat(F.substring(x["zone"], 1, 1), F.lit("1")).cast("int")
            * (F.substring(x["zone"], 2, 2).cast("int") * 60 + F.substring(x["zone"], 4, 2).cast("int")))
        return x["t"] + F.make_dt_interval(F.lit(0), half, -minutes)

    return F.transform(F.array(parts), moved)[0]      # a lambda binds the parsed parts once


def parse_forms(c: Column, first=()) -> Column:
    """The value of text in any form, the forms of ``first`` tried before the others."""
    forms = [*first, *(f for f in FORMS if f not in first)]
    return F.coalesce(_plain(c, forms), F.when(c.rlike(_MARKED), _marked(c, forms)))


def detect_forms(df: DataFrame, col: str, rows: int = DETECT_ROWS) -> list[str]:
    """Forms of the first ``rows`` values, the most frequent first."""
    c = F.col(f"`{col}`").cast("string")
    form = F.coalesce(*[F.when(c.rlike(p), F.lit(name)) for name, (p, _) in FORMS.items()])
    seen = df.select(form.alias("form")).limit(rows).groupBy("form").count().where("form is not null").collect()
    return [r["form"] for r in sorted(seen, key=lambda r: (-r["count"], r["form"]))]


def unparsed_shapes(df: DataFrame, col: str) -> DataFrame:
    """(shape, n, example) of the values that no form reads, digits shown as 9 and letters as a."""
    c = F.col(f"`{col}`").cast("string")
    shape = F.regexp_replace(F.regexp_replace(c, r"\d", "9"), r"\p{L}", "a")
    return (df.select(c.alias("_c"), shape.alias("shape"), F.explode(F.array(parse_forms(c))).alias("_t"))
            .where("_t is null and _c is not null").groupBy("shape")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_c").alias("example")))
