"""Toxicity by nearest labelled examples under TF-IDF cosine over the model's terms.

Fitting uses labelled rows only, at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean ones
(those of least id hash; the bounds are parameters). From this sample come the vocabulary
and the example vectors: every term that only one class has, however rare, and of the terms
of both classes those of at least ``TERM_SUPPORT`` rows and log odds over 1 that are among
the ``MAX_TERMS`` of greatest gain (terms that both classes use alike only blur the cosine).
The document frequencies behind the TF-IDF weights are counted over all documents.

The index keeps examples in blocks of 128; per term it has the postings, and for every block
that holds the term the largest weight in it. A query adds up the block maxima of its terms,
visits the blocks of greatest bound, then all others whose bound reaches the k-th best cosine,
so the k nearest are exact. Their votes, weighted by cosine and by how many labelled rows an example stands
for, plus a small prior, give a raw score; a monotone calibration (pool adjacent
violators) fitted on leave-one-out votes of the sample turns it into a probability.

The fitted model is of bounded size and broadcast; scoring is one pass over the texts
without a shuffle. Neither ids, languages, sources nor labels enter a score.

Defined results: null or empty texts, and texts without a vocabulary term, get the score of
"no evidence" (the calibrated prior); equal texts get equal scores; without labelled rows
every score is 0; labels that are null are not used; an id labelled twice counts twice;
an empty table gives no rows; result columns replace same-named input columns.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize

from .common import worker_cache

MAX_TOXIC, MAX_CLEAN, MAX_TERMS = 2000, 4000, 2000
NEIGHBOURS, BLOCK, PRIOR_VOTES, TERM_SUPPORT, STEMS = 15, 128, 0.05, 5, (4, 5, 6)
FIRST_BLOCKS = 4
#: Memos of a worker: scores (texts with the same term counts have the same one), words.
MEMO_SIZE, WORDS_SIZE = 5_000, 100_000
#: Texts of a batch that are in Python at once.
SLICE = 500
_TERM = re.compile(r"\w+")


def held_out(id: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 modulo 3: never used for fitting."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def terms_of(word: str) -> list[str]:
    """A word and its beginnings of ``STEMS`` characters (word families share them)."""
    return [word, *[word[:n] + "-" for n in STEMS if len(word) > n]]


def term_counts(text: str | None, vocabulary: dict[str, int], seen: dict[str, tuple]) -> dict[int, int]:
    """Counts of the vocabulary terms; ``seen`` remembers the terms of words."""
    out: dict[int, int] = {}
    if len(seen) > WORDS_SIZE:
        seen.clear()
    for word, n in Counter(_TERM.findall((text or "").lower())).items():
        got = seen.get(word)
        if got is None:
            got = tuple(k for k in map(vocabulary.get, terms_of(word)) if k is not None)
            if len(word) < 64:
                seen[word] = got
        for k in got:
            out[k] = out.get(k, 0) + n
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: list = field(default_factory=list)
    labels: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0
    knots: tuple = ()
    vectors: list = field(default_factory=list)  # (terms, weights) of the examples until calibrated
    postings: tuple | None = None                # (example, weight), by term and example
    maxima: tuple | None = None                  # per term and block: (first posting, block, largest weight)
    at: np.ndarray | None = None                 # first of a term's maxima
    memo: dict = field(default_factory=dict)
    seen: dict = field(default_factory=dict)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(counts), int)
        w = (1 + np.log([counts[k] for k in t.tolist()])) * self.idf[t] if len(t) else np.zeros(0)
        return t, w / max(np.linalg.norm(w), 1e-12)

    def build(self, examples: list[tuple[object, int, float, dict[int, int]]]) -> None:
        """``examples``: (id, label, rows stood for, term counts); empty vectors never match."""
        rows = [(i, y, n, *self.vector(c)) for i, y, n, c in examples if c]
        rows.sort(key=lambda r: (int(r[3][np.argmax(r[4])]), r[1], str(r[0])))  # like next to like
        self.ids = [r[0] for r in rows]
        self.labels = np.array([r[1] for r in rows], float)
        self.weights = np.array([r[2] for r in rows], float)
        self.vectors, self.postings = [r[3:] for r in rows], None
        if not rows:
            return
        term = np.concatenate([r[3] for r in rows])
        pos = np.repeat(np.arange(len(rows)), [len(r[3]) for r in rows])
        order = np.lexsort((pos, term))
        term, pos, w = term[order], pos[order], np.concatenate([r[4] for r in rows])[order].astype(np.float32)
        first = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(pos // BLOCK, prepend=-1))
        self.postings = pos.astype(np.int32), w
        self.maxima = np.append(first, len(pos)), (pos[first] // BLOCK).astype(np.int32), np.maximum.reduceat(w, first)
        self.at = np.searchsorted(term[first], np.arange(len(self.vocabulary) + 1))

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples (ties by position), exact."""
        pos, cos = np.zeros(0, int), np.zeros(0)
        if not len(t) or self.postings is None:
            return pos, cos
        first, block, top = self.maxima
        size = self.at[t + 1] - self.at[t]
        entry, weight = _ranges(self.at[t], size), np.repeat(w, size)
        bound = np.bincount(block[entry], weight * top[entry], -(-len(self.ids) // BLOCK))
        order = np.argsort(-bound, kind="stable")
        for late in (False, True):
            turn = np.zeros(len(bound), bool)
            turn[order[FIRST_BLOCKS:] if late else order[:FIRST_BLOCKS]] = True
            turn &= bound > 0
            if len(pos) >= k:
                turn &= bound >= cos[k - 1] - 1e-6
            if not turn.any():
                continue
            use = turn[block[entry]]
            e = entry[use]
            n = first[e + 1] - first[e]
            p = _ranges(first[e], n)
            every = np.bincount(self.postings[0][p], np.repeat(weight[use], n) * self.postings[1][p], len(self.ids))
            if skip >= 0:
                every[skip] = 0
            found = np.flatnonzero(every > 0)
            if len(found) > k:
                found = found[every[found] >= np.partition(every[found], -k)[-k]]
            pos, cos = np.append(pos, found), np.append(cos, every[found])
            best = np.lexsort((pos, -cos))[:k]
            pos, cos = pos[best], cos[best]
        return pos, cos

    def vote(self, pos: np.ndarray, cos: np.ndarray) -> float:
        v = cos * self.weights[pos] if len(pos) else np.zeros(0)
        return float((v @ self.labels[pos] + PRIOR_VOTES * self.prior) / (v.sum() + PRIOR_VOTES)) if len(pos) else self.prior

    def calibrate(self, empty: list[tuple[int, float]]) -> None:
        """Pool adjacent violators over leave-one-out votes; ``empty``: (label, weight) of
        the sampled rows without a vocabulary term."""
        points = [(self.prior, y, n) for y, n in empty]
        for j, (t, w) in enumerate(self.vectors):
            points.append((self.vote(*self.nearest(t, w, skip=j)), self.labels[j], self.weights[j]))
        self.vectors = []
        stack: list[list[float]] = []  # [x sum, y sum, weight, least x, greatest x]
        for x, y, n in sorted(points):
            stack.append([x * n, y * n, n, x, x])
            while len(stack) > 1 and (stack[-2][1] / stack[-2][2] >= stack[-1][1] / stack[-1][2] or stack[-2][4] == stack[-1][3]):
                top = stack.pop()
                stack[-1] = [stack[-1][k] + top[k] for k in range(3)] + [stack[-1][3], top[4]]
        self.knots = (np.array([s[0] / s[2] for s in stack]), np.array([s[1] / s[2] for s in stack]))

    def score(self, text: str | None) -> tuple[float, list[tuple]]:
        counts = term_counts(text, self.vocabulary, self.seen)
        key = hashlib.blake2b(np.array(sorted(counts.items()), "<i8").tobytes(), digest_size=16).digest()
        if key not in self.memo:
            if len(self.memo) >= MEMO_SIZE:
                self.memo.clear()
            self.memo[key] = self._score(counts)
        return self.memo[key]

    def _score(self, counts: dict[int, int]) -> tuple[float, list[tuple]]:
        t, w = self.vector(counts)
        pos, cos = self.nearest(t, w)
        raw = self.vote(pos, cos)
        fitted = float(np.interp(raw, *self.knots)) if len(self.knots) and len(self.knots[0]) else raw
        return min(1.0, max(0.0, 0.98 * fitted + 0.02 * raw)), [(self.ids[p], int(self.labels[p]), float(c)) for p, c in zip(pos, cos)]


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_terms: int = MAX_TERMS) -> Model:
    """Learn from the rows of ``labels`` that are not held out; see the module text."""
    lab = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id)).select(
        F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = lambda y, n: lab.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = pick(1, max_toxic).union(pick(0, max_clean))  # at most max_toxic + max_clean rows, so broadcast
    sample = materialize(docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id"), "toxic-sample")

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(w, y) for t, y in zip(b["text"], b["y"]) for w in {x for w in set(_TERM.findall((t or "").lower())) for x in terms_of(w)}]
            yield pd.DataFrame(rows, columns=["term", "y"])

    n1 = F.sum("y")
    n0 = F.sum(1 - F.col("y"))
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    m1, m0 = size.get(1, 0), size.get(0, 0)
    if not m1 or not m0:
        return Model({}, np.zeros(0), prior=1.0 if m1 and not m0 else 0.0)
    p1, p0 = (n1 + 0.5) / (m1 + 1), (n0 + 0.5) / (m0 + 1)
    found = (sample.select("text", "y").mapInPandas(terms, "term string, y int").groupBy("term")
             .agg((n1 + n0).alias("n"), (F.sqrt(n1 + n0) * F.abs(F.log(p1) - F.log(p0))).alias("gain"),
                  (F.log(p1) - F.log(p0)).alias("odds"), ((n1 == 0) | (n0 == 0)).alias("single"))
             .withColumn("strong", (F.col("n") >= TERM_SUPPORT) & (F.abs("odds") > 1))
             .where("single OR strong").orderBy(F.desc("strong"), F.desc("gain"), "term").select("term", "single", "strong"))
    found = found.toArrow().to_pandas()  # terms of the bounded sample
    best = found["term"][found["single"] | (found["strong"] & (np.arange(len(found)) < max_terms))]
    vocabulary = {t: k for k, t in enumerate(best)}
    idf = _idf(docs, text, vocabulary)
    model = Model(vocabulary, idf)
    weight = {y: totals.get(y, 0) / size[y] for y in (0, 1)}
    model.prior = totals.get(1, 0) / max(1, sum(totals.values()))
    counted = F.pandas_udf(lambda s: s.map(lambda t: [x for kv in sorted(term_counts(t, vocabulary, {}).items()) for x in kv]),
                           T.ArrayType(T.IntegerType()))
    rows = [(r["id"], r["y"], weight[r["y"]], dict(zip(r["c"][::2], r["c"][1::2])))
            for r in sample.select("id", "y", counted("text").alias("c")).collect()]  # the bounded sample
    model.build(rows)
    model.calibrate([(y, n) for _, y, n, c in rows if not c])
    return model


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch, a few of them in Python at a time."""
    for at in range(0, len(column), SLICE):
        yield from column.slice(at, SLICE).to_pylist()


def _idf(docs: DataFrame, text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """Inverse document frequencies over all documents, counted per task and then summed."""
    n = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, words = np.zeros(n, "i8"), 0, {}
        for b in batches:
            for t in _texts(b.column(0)):
                seen[list(term_counts(t, vocabulary, words))] += 1
            total += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.flatnonzero(seen), -1)), pa.array(np.append(seen[seen > 0], total))],
                                         names=["term", "n"])

    got = (docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long").groupBy("term")
           .agg(F.sum("n").alias("n")).toArrow())  # one row per vocabulary term
    term, count = (got[c].to_numpy() for c in ("term", "n"))
    total = count[term == -1].sum()
    df = np.zeros(n)
    df[term[term >= 0]] = count[term >= 0]
    return np.log((1 + total) / (1 + df)) + 1


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7, evidence: bool = True) -> DataFrame:
    """Add ``score``, ``predicted`` (score >= threshold) and, unless told not to, ``evidence``
    (nearest examples: id as text, label, cosine)."""
    # as bytes that carry their classes, so that workers need not have the package installed
    shared, key = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), f"toxicity:{uuid.uuid4().hex}"
    found = T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("cosine", T.DoubleType())]))
    kind = T.StructType([T.StructField("score", T.DoubleType()), *([T.StructField("evidence", found)] if evidence else [])])
    listed = pa.list_(pa.struct([("id", pa.string()), ("label", pa.int32()), ("cosine", pa.float64())]))

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = worker_cache()
        if key not in cache:
            for old in [k for k in cache if k.startswith("toxicity:")]:
                del cache[old]
            cache[key] = cloudpickle.loads(shared.value)
        m = cache[key]
        for b in batches:
            scores, near = [], []
            for t in _texts(b):
                s, e = m.score(t)
                scores.append(s)
                if evidence:
                    near.append([{"id": str(i), "label": y, "cosine": c} for i, y, c in e])
            cols = [pa.array(scores, pa.float64()), *([pa.array(near, listed)] if evidence else [])]
            yield pa.StructArray.from_arrays(cols, names=kind.names)

    run = run.asNondeterministic()  # so that a filter on the score does not run it twice
    keep = [c for c in docs.columns if c == text or c not in ("score", "predicted", "evidence")]
    out = docs.select(*keep).withColumn("__r", run(F.col(text)))
    return out.select(*keep, F.col("__r.score").alias("score"), (F.col("__r.score") >= threshold).cast("int").alias("predicted"),
                      *([F.col("__r.evidence").alias("evidence")] if evidence else []))
