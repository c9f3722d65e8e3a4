"""Quality rules: a threshold table compiled into Spark projections.

Every metric is a built-in column expression over the words and lines of the whole text;
the table ``RULES`` of (rule, metric, comparison, bound) is turned into one boolean column
per rule and one verdict in a single select. No shuffle, no user function: the plan is a
scan followed by projections, so it scales with the bytes read.

Defined results: a null text counts as an empty one (no words, all base rules fail, so it
is rejected); ties do not occur (bounds are strict); repeated rows each get the same
result; an empty table gives no rows; extra columns pass through ``judge`` untouched
(working columns take names the input does not have, results replace same-named ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, words

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "as", "are",
    "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "mit", "den", "von", "sich", "auf",
    "le", "la", "les", "et", "de", "des", "un", "une", "du", "est", "que", "en", "pour", "dans",
    "el", "los", "las", "y", "que", "no", "se", "por", "con", "para", "es", "una", "al", "del",
)
#: Languages of the stop words, as a language column may name them.
STOP_LANGUAGES = ("en", "de", "fr", "es")
METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
           "n_no_letter", "n_foreign")
#: rule -> SQL condition under which a text FAILS, integer arithmetic over METRICS.
BASE_RULES = {
    "too_short": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
}
RULES = {
    "word_too_short": "word_chars < 2 * n_words",          # mean word length under 2
    # mean word length over 25, where blanks part words (Latin letters)
    "word_too_long": "2 * n_foreign <= word_chars AND word_chars > 25 * n_words",
    "symbols": "100 * n_symbols > 15 * n_words",           # over 15 symbols per 100 words
    "no_letter_words": "100 * n_no_letter > 30 * n_words", # over 30 % of words without a letter
    # under 1 % function words, where the words known are those of the script
    "few_stop_words": "2 * n_foreign <= word_chars AND n_words >= 50 AND 100 * n_stop_words < n_words",
    "repeated_lines": "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines",
}


def stop_forms() -> list[str]:
    """Stop words as written in lower case, with a capital, and in capitals."""
    return sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})


def _repeat_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Add ``out``: number of words lying in 5-word windows that occur twice or more.

    Windows are compared by a 64-bit hash of their five words inside one text. Texts
    without an equal pair (the usual case) stop after the distinct count."""
    h, s, p = fresh(df, "h"), fresh(df, "s"), fresh(df, "p")
    n = F.size(w)
    df = df.withColumn(h, F.when(n >= 6, F.expr(
        f"transform(sequence(0, size({w}) - 5), i -> xxhash64({', '.join(f'{w}[i + {k}]' for k in range(5))}))")))
    df = df.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    df = df.withColumn(p, F.expr(
        f"sort_array(transform(filter({s}, (x, i) -> (i > 0 AND {s}[i - 1].h = x.h) OR "
        f"(i < size({s}) - 1 AND {s}[i + 1].h = x.h)), x -> x.i))"))
    covered = F.expr(f"aggregate(sequence(1, size({p}) - 1), 5L, (a, i) -> a + least(5, {p}[i] - {p}[i - 1]))")
    return df.withColumn(out, F.when(F.size(p) > 1, covered).otherwise(F.lit(0)).cast("long")).drop(h, s, p)


def metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the metric columns of ``METRICS`` added (same-named columns replaced)."""
    df = df.drop(*[m for m in METRICS if m != text])
    w, ln = fresh(df, "w"), fresh(df, "ln")
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(w, words(F.col(text))).withColumn(
        ln, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(ln).cast("long"),
        "n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*stop_forms()))).cast("long"),
        # letters of other scripts than Latin; a text of ASCII characters has none
        "n_foreign": F.when(F.octet_length(t) > F.length(t), F.regexp_count(t, F.lit(r"[\p{L}&&[^\p{IsLatin}]]"))).otherwise(F.lit(0)).cast("long"),
        "n_no_letter": F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))).cast("long"),
    }).drop(ln)
    df = _repeat_words(df, w, "n_repeat_words").drop(w)
    # the generator keeps later filters on the metrics from being pushed below, which would
    # evaluate every metric again for the filter
    one = fresh(df, "m")
    rest = [c for c in df.columns if c not in METRICS]
    return df.select(*rest, F.explode(F.array(F.struct(*METRICS))).alias(one)).select(*rest, f"{one}.*")


def compiled(rules: dict[str, str]) -> Column:
    """The names of the rules that fail, as one array expression."""
    return F.array_compact(F.array(*[F.when(F.expr(cond), F.lit(name)) for name, cond in rules.items()]))


def judge(df: DataFrame, text: str = "text", rules: dict[str, str] | None = None, lang: str | None = None) -> DataFrame:
    """Metrics, ``base_failed``, ``failed_rules`` (names) and ``kept`` for every row. With a
    ``lang`` column, ``few_stop_words`` holds only where it names one of ``STOP_LANGUAGES`` or nothing."""
    m = metrics(df, text)
    rules = dict(RULES if rules is None else rules)
    if lang is not None and "few_stop_words" in rules:
        known = ", ".join(f"'{x}'" for x in STOP_LANGUAGES)
        rules["few_stop_words"] = f"({rules['few_stop_words']}) AND coalesce(lower(left(`{lang}`, 2)) IN ({known}), true)"
    return m.withColumns({
        "base_failed": F.expr(" OR ".join(f"({c})" for c in BASE_RULES.values())),
        "failed_rules": compiled(BASE_RULES | rules),
    }).withColumn("kept", F.size("failed_rules") == 0)
