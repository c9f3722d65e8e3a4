"""Token-count rollups kept up to date by signed deltas.

Totals per (source, language, tokenizer version) are sums, so a batch only has to add what
changed: an inserted document counts plus, a deleted one minus, a revised count minus the
old and plus the new. A batch is summed per key (map-side first, so a source that holds a
third of all rows costs one row per task) and written to its own partition of the delta
table. A batch is identified by its id and written to a folder of its own per attempt; a
commit list, one row per finished attempt, says which folder holds it. A batch committed
again, empty or not, replaces itself by a later row of the list, so a retry after a lost driver
or executor changes nothing, and readers, who follow the list, never see half a batch.

Defined results: null sources, languages or versions form keys of their own; a null count
is 0 tokens; a document in both states with equal key and count gives no delta; rows that
repeat (id, version) within a state are summed; empty states give empty batches, which
add nothing and clear what their id held; extra columns are ignored; keys whose documents are all gone stay with 0.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import words

KEYS = ["source", "lang", "version"]


def word_count(text: Column) -> Column:
    """Tokenizer version ``words-1``: words between white space."""
    return F.size(words(text)).cast("long")


def wordpunct_count(text: Column) -> Column:
    """Tokenizer version ``wordpunct-1``: runs of letters, digits and ``_``, and every other
    character that is not white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}_]+|[^\x20\x09-\x0D\p{L}\p{N}_]")).cast("long")


def deltas(old: DataFrame | None, new: DataFrame | None, id: str = "doc_id") -> DataFrame:
    """Signed rows (source, lang, version, docs, tokens) that lead from one state to the
    next. A state holds (id, source, lang, version, tokens); None is an empty state.

    No join is needed: old rows count minus, new ones plus, and what cancels sums to 0
    per document before it is summed per key."""
    parts = []
    for state, sign in ((old, -1), (new, 1)):
        if state is not None:
            parts.append(state.select(F.col(id).alias("id"), *KEYS, F.lit(sign).cast("long").alias("docs"),
                                      (sign * F.coalesce("tokens", F.lit(0))).cast("long").alias("tokens")))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return (both.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs != 0 OR tokens != 0"))


class Rollup:
    """A delta table at ``path`` (in storage that all executors share)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Write batch ``batch``; a second commit of the same id replaces the first."""
        attempt = uuid.uuid4().hex
        (changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .coalesce(1)  # one row per key
         .write.parquet(f"{self.path}/deltas/attempt={attempt}"))
        # the batch counts from here on: one small file, moved in as a whole
        (self.spark.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(attempt).alias("attempt"),
                                    F.unix_micros(F.current_timestamp()).alias("at"))
         .coalesce(1).write.mode("append").parquet(f"{self.path}/commits"))

    def current(self) -> DataFrame:
        """The delta rows of the latest commit of every batch."""
        commits = self.spark.read.schema("batch long, attempt string, at long").parquet(f"{self.path}/commits")
        latest = commits.groupBy("batch").agg(F.max(F.struct("at", "attempt"))["attempt"].alias("attempt"))
        rows = (self.spark.read.schema("source string, lang string, version string, docs long, tokens long, attempt string")
                .option("basePath", f"{self.path}/deltas").parquet(f"{self.path}/deltas"))
        return rows.join(latest, "attempt").drop("attempt")

    def totals(self) -> DataFrame:
        return self.current().groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
