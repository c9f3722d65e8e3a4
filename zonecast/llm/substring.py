"""Repeated-passage removal with sharded Aho-Corasick automata.

A window is ``width`` consecutive words. A window of a document is removed when the same
word sequence also starts in a document with a smaller id. Steps:

1. *Copies.* Documents with the same word sequence form a class; the smallest id stands for
   it. The others are covered wholly (if they have a window at all) and leave the search.
2. *Anchors.* Each window is represented by the least hash among the ``width - gram + 1``
   word grams of ``gram`` words inside it; equal windows have equal anchors. A document
   sends its distinct anchors (about one per 20 words) through a partial aggregation;
   anchors of two or more documents are recurring.
3. *Confirm.* Only windows whose anchor recurs send their own hash; a window held by two or
   more documents is a recurring one and belongs to the smallest of them, its owner.
4. *Automata.* Runs of neighbouring windows with one owner are its passages. A passage is cut into
   blocks of ``width // 2`` words, so that every window in it holds a whole block; the
   blocks of a shard of owners are compiled into one Aho-Corasick automaton (pyahocorasick,
   over word numbers) and every document that shares a window with one of these owners is
   streamed through it. Each block found is widened word by word to the longest agreement
   with the passage, which also rules out hash collisions; agreements of at least ``width``
   words are covered.

Shards are keyed by owner, a document goes to the shards of its owners only, so the work
follows the amount of repeated text. A shard holds the owners of one hash bucket; passages
of an owner arrive as rows of bounded size and documents are streamed in batches behind
them. Everything between the steps is written to the shared checkpoint folder.

Defined results: null or word-less texts have no words (digest of the empty string);
rows that repeat an id are one document's texts: none of them is "smaller" than the
other; rows with a null id are kept whole and remove nothing; an empty table gives no
rows; very long texts are searched whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize

from .common import groups_for, words

GRAM = 10
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of every ``n`` consecutive word hashes, then mixed."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * _powers(_BASE, len(h)), dtype=np.uint64)])
    g = (sums[n:] - sums[:-n]) * _powers(_INVERSE, m)
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    return g


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values (doubling)."""
    if len(x) < n:
        return x[:0]
    span, cur = 1, x
    while span * 2 <= n:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    rest = n - span
    return np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur


def window_anchors(h: np.ndarray, width: int, gram: int) -> np.ndarray:
    return sliding_min(gram_hashes(h, gram), width - gram + 1)


def _lists(part: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    col = part.column(name)
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)
    for a, b in zip(off[:-1], off[1:]):
        yield flat[a:b]


def _list_column(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype("i4")
    flat = np.concatenate(arrays) if arrays else np.zeros(0, "i8")
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat).cast(kind))


class Shard:
    """Passages of some owners compiled into one automaton over word numbers."""

    def __init__(self, width: int):
        import ahocorasick

        self.width, self.block = width, width // 2
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.number: dict[str, int] = {}
        self.passages: list[tuple[object, tuple[int, ...]]] = []
        self.at: dict[tuple[int, ...], list[tuple[int, int]]] = {}

    def add(self, owner, passage: list[str]) -> None:
        number = self.number
        seq = tuple(number.setdefault(w, len(number) + 1) for w in passage)
        k = len(self.passages)
        self.passages.append((owner, seq))
        for at in range(0, len(seq) - self.block + 1, self.block):
            self.at.setdefault(seq[at:at + self.block], []).append((k, at))

    def compile(self) -> None:
        for block, places in self.at.items():
            self.auto.add_word(block, places)
        if self.at:
            self.auto.make_automaton()
        self.at = {}

    def covered(self, id, doc: list[str]) -> list[tuple[int, int]]:
        """Stretches of at least ``width`` words that agree with a passage of a smaller id."""
        if not self.passages or len(doc) < self.width:
            return []
        seq = tuple(self.number.get(w, 0) for w in doc)
        out: list[tuple[int, int]] = []
        done: dict[tuple[int, int], int] = {}  # (passage, diagonal) -> end of the last agreement
        for end, places in self.auto.iter(seq):
            begin = end + 1 - self.block
            for k, at in places:
                owner, p = self.passages[k]
                if not owner < id or done.get((k, begin - at), -1) >= end + 1:
                    continue
                i, j = begin, at
                while i > 0 and j > 0 and seq[i - 1] == p[j - 1]:
                    i, j = i - 1, j - 1
                e, f = end + 1, at + self.block
                while e < len(seq) and f < len(p) and seq[e] == p[f]:
                    e, f = e + 1, f + 1
                done[(k, begin - at)] = e
                if e - i >= self.width:
                    out.append((i, e))
        return merged(out)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(own: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word stretches [begin, end) made of neighbouring flagged windows."""
    at = np.flatnonzero(own)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + width).tolist()))


def _documents(df: DataFrame, width: int, gram: int) -> DataFrame:
    """One pass over the texts: (id, n_words, words_sha256, cls, anchors)."""
    w = df.withColumn("w", words(F.col("text")))
    base = w.select("id", F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
                    F.sha2(F.array_join("w", " "), 256).alias("words_sha256"))
    schema = T.StructType([T.StructField("id", df.schema["id"].dataType), T.StructField("words_sha256", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("anchors", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                hs = [h.view(np.uint64) for h in _lists(part, "h")]
                got = [np.unique(window_anchors(h, width, gram)).view(np.int64) for h in hs]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("words_sha256"), pa.array([len(h) for h in hs], pa.int64()),
                     _list_column(got, pa.int64())], names=["id", "words_sha256", "n_words", "anchors"])

    return base.mapInArrow(run, schema).withColumn("cls", F.xxhash64("words_sha256"))


def _windows(chosen: DataFrame, width: int, gram: int) -> DataFrame:
    """(id, x): hashes of the windows whose anchor recurs."""
    h = chosen.select("id", "recurring", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    schema = T.StructType([T.StructField("id", chosen.schema["id"].dataType), T.StructField("x", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                got = []
                for h, r in zip(_lists(part, "h"), _lists(part, "recurring")):
                    h = h.view(np.uint64)
                    held = np.isin(window_anchors(h, width, gram), r.view(np.uint64))
                    got.append(np.unique(gram_hashes(h, width)[held]).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("id"), _list_column(got, pa.int64())], names=["id", "x"])

    return h.mapInArrow(run, schema).select("id", F.explode("x").alias("x"))


def _search(rows: DataFrame, width: int) -> DataFrame:
    """Rows (shard, sub, kind, id, cls, text, h, x), sorted so that a shard's passages come
    before its documents -> (id, cls, begins, ends) of covered stretches."""
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("cls", T.LongType()),
                           T.StructField("begins", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])

    def first_held(h: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Flags of the windows in ``x``, each at its first place only."""
        g = gram_hashes(h.view(np.uint64), width)
        once = np.zeros(len(g), bool)
        once[np.unique(g, return_index=True)[1]] = True
        return once & np.isin(g, x.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, machine, ready = None, None, False
        for b in batches:
            got: list[tuple] = []
            for key, kind, i, cls, text, h, x in zip(
                    zip(b.column("shard").to_pylist(), b.column("sub").to_pylist()), b.column("kind").to_pylist(),
                    b.column("id").to_pylist(), b.column("cls").to_pylist(), b.column("text"), b.column("h"), b.column("x")):
                if key != current:
                    current, machine, ready = key, Shard(width), False
                doc = _WORD.findall(text.as_py())
                if kind == 0:
                    flags = first_held(h.values.to_numpy(zero_copy_only=False), x.values.to_numpy(zero_copy_only=False))
                    for a, e in _runs(flags, width):
                        machine.add(i, doc[a:e])
                    continue
                if not ready:
                    machine.compile()
                    ready = True
                spans = machine.covered(i, doc)
                if spans:
                    got.append((i, cls, [a for a, _ in spans], [e for _, e in spans]))
            cols = list(zip(*got)) if got else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.column("id").type), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int64()))],
                                             names=["id", "cls", "begins", "ends"])

    return rows.select("shard", "sub", "kind", "id", "cls", "text", "h", "x").mapInArrow(run, schema)


def _cut(chosen: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, cls, cut, kept_text): covered words counted and taken out."""
    kind = T.StructType([T.StructField("cut", T.LongType()), T.StructField("kept_text", T.StringType())])

    @F.pandas_udf(kind)
    def cut(text: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for t, bs, es in zip(text, begins, ends):
            doc, kept, at, n = _WORD.findall(t), [], 0, 0
            for b, e in merged(list(zip(map(int, bs), map(int, es)))):
                kept += doc[at:b]
                n, at = n + e - b, e
            out.append((n, " ".join(kept + doc[at:])))
        return pd.DataFrame(out, columns=["cut", "kept_text"])

    joined = chosen.select("id", "cls", "text").join(spans, ["id", "cls"]).dropDuplicates(["id", "cls"])
    return joined.select("id", "cls", cut("text", "begins", "ends").alias("r")).select("id", "cls", "r.*")


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", width: int = 50, gram: int = GRAM,
                   shard_windows: int = 100_000, shard_documents: int = 4_000) -> DataFrame:
    """Per row of ``df``: (id, n_words, n_removed, words_sha256, kept_text). ``kept_text``
    holds the kept words joined by one space where some but not all words go, else null;
    ``words_sha256`` is the digest of all words joined by one space.

    ``shard_windows`` and ``shard_documents`` set about how many recurring windows one
    automaton holds and how many documents one task streams through it: they shape the
    plan and leave nothing out."""
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    keyed = materialize(_documents(docs, width, gram), "passage-docs")
    classes = materialize(keyed.where(f"n_words >= {width} AND id IS NOT NULL").groupBy("cls").agg(F.min("id").alias("rep")),
                          "passage-classes")
    # anchors of two or more documents (class representatives), as lists beside their documents
    anchors = materialize(keyed.join(classes, "cls").where("id = rep").select("id", "cls", F.explode("anchors").alias("a")),
                          "passage-anchors")
    recurring = anchors.groupBy("a").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("a")
    lists = anchors.join(recurring, "a").groupBy("id", "cls").agg(F.collect_set("a").alias("recurring"))
    cls = F.xxhash64(F.sha2(F.array_join(words(F.col("text")), " "), 256))
    chosen = materialize(docs.join(lists, "id").where(cls == F.col("cls")), "passage-texts")
    windows = materialize(_windows(chosen, width, gram), "passage-windows")
    owners = materialize(windows.groupBy("x").agg(F.min("id").alias("owner"), F.max("id").alias("hi")).where("owner < hi")
                         .select("x", "owner"), "passage-owners")
    shards = groups_for(owners.count(), shard_windows)
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int")
    # documents go to the shards of their windows' owners; a crowded shard is split over tasks
    routes = materialize(windows.join(owners, "x").where("id > owner").select("id", shard.alias("shard")).distinct(), "passage-routes")
    load = materialize(routes.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(shard_documents)).cast("int").alias("subs")), "passage-load")
    owned = owners.groupBy("owner").agg(F.collect_set("x").alias("x")).withColumn("shard", shard)
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    passages = (chosen.select("id", "cls", "text").join(owned.withColumnRenamed("owner", "id"), "id").join(load, "shard")
                .select("shard", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.lit(0).alias("kind"),
                        "id", "cls", "text", "x"))
    streamed = (chosen.select("id", "cls", "text").join(routes, "id").join(load, "shard")
                .select("shard", F.pmod(F.xxhash64("id", "cls"), F.col("subs")).cast("int").alias("sub"), F.lit(1).alias("kind"),
                        "id", "cls", "text", F.expr("cast(array() as array<bigint>)").alias("x")))
    rows = (passages.union(streamed).repartition("shard", "sub").sortWithinPartitions("shard", "sub", "kind")
            .withColumn("h", F.when(F.col("kind") == 0, hashes).otherwise(F.expr("cast(array() as array<bigint>)"))))
    hits = _search(rows, width)
    spans = hits.groupBy("id", "cls").agg(F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends"))
    cut = materialize(_cut(chosen, spans), "passage-cuts")
    copy = F.coalesce(F.col("rep") < F.col("id"), F.lit(False))
    return (keyed.drop("anchors").join(classes, "cls", "left").join(cut, ["id", "cls"], "left")
            .select(F.col("id").alias(id), "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
                    "words_sha256", F.when(~copy & (F.col("cut") < F.col("n_words")), F.col("kept_text")).alias("kept_text")))
