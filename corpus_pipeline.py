"""Corpus pipeline: raw documents to packed training sequences.

Five stages, each one call of an operator in ``zonecast.llm``: toxic documents go, then
documents that a quality rule rejects, then near copies (one of each group stays), then
repeated passages, and what is left is tokenized and packed. Every stage works on all rows
its predecessor kept, is written as Parquet in the shared checkpoint folder and reread by
the next, so a lost executor costs tasks, not stages.

Defined results: null texts count as empty (not toxic, rejected by the quality rules); rows
that repeat an id count as one document where near copies are dropped, and each keeps its own
text; rows with a null id are packed under the null id;
columns beyond those of ``documents`` are not carried; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import minhash, packing, quality, substring, toxicity
from zonecast.llm.common import words
from zonecast.llm.queries import public_file
from zonecast.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted toxic (score >= 0.7), learning from ``labels`` as op2 does."""
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, evidence=False).where("predicted = 0").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a quality rule rejects."""
    return quality.judge(docs.select(*COLUMNS), lang="lang").where("kept").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of least id, of each group linked at 0.8 over five-word shingles."""
    docs = docs.select(*COLUMNS)
    kept = minhash.near_duplicates(docs, k=5, threshold=80).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 50 words or more that occur in a document of smaller id. A changed
    text is its kept words joined by one blank; a document left without words goes."""
    docs = docs.select(*COLUMNS)
    cut = (substring.remove_repeats(docs, width=50).where("n_removed > 0")
           .select("doc_id", "words_sha256", "kept_text", F.lit(True).alias("changed")).dropDuplicates(["doc_id", "words_sha256"]))
    text = F.when(F.col("changed"), F.coalesce("kept_text", F.lit(""))).otherwise(F.col("text"))
    # an id that repeats may stand for several texts: the digest of the words tells them apart
    out = docs.withColumn("words_sha256", F.sha2(F.array_join(words(F.col("text")), " "), 256))
    out = out.join(cut, ["doc_id", "words_sha256"], "left").withColumn("text", text).where("changed IS NULL OR text != ''")
    return out.withColumn("n_chars", F.when(F.col("changed"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack what is left into sequences of at most 4096 tokens."""
    return packing.pack_texts(docs, public_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("near duplicates", near_dedup_stage),
    ("repeated passages", substring_stage),
    ("packing", packing_stage),
]
#: The toxicity and packing stages cannot be said in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
