"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct k-word shingles (64-bit hashes). Two permutations of
the 32-bit universe make the whole signature: ``sigma`` places a shingle, ``pi`` ranks the
places, and coordinate k ranks them after a circular shift by k:
``min over v of pi((sigma(v) + k) mod 2^32)``. Coordinates are cut into bands of ``rows``;
documents that share a band value become candidates, and a link stands only when the
integer test ``100 * |A & B| >= threshold * |A | B|`` on the full sets holds.

With 36 bands of 5 rows a pair at similarity 0.8 meets in no band with probability
6e-7, at 0.85 with 6e-10.

Skew and size: equal sets form one class before banding (partial aggregation), so exact
copies are one row from then on. Inside a bucket no pairs are listed: every member is
tested against one centre, links are contracted into components, members still apart are
tested against a newly drawn centre, and at the end members of different components meet by
their rarest shingles, so that only pairs that can reach the threshold do, however much
boilerplate a bucket shares. A bucket of mutually near copies costs its size, and no link between
components is missed. Joins are by key, which adaptive execution splits when hot.
Intermediate tables go to the shared checkpoint folder.

Defined results: null or word-less texts have an empty set, are linked with nothing (not
even each other) and are kept; a text of fewer than k words has its whole word sequence as
its only shingle; rows that repeat an id count as one document of the graph; a null id can
take part in a class of copies but never names one, and a class with null ids only is its
own component (null) and kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize

from .common import ascii_lower, words
from .graph import components

BANDS, ROWS = 36, 5
#: Shingles handled at once by the signature kernel (times coordinates times 4 bytes).
BLOCK = 4096
#: Rounds in which members still apart are tested against newly drawn centres.
CENTRE_ROUNDS = 1


def with_sets(df: DataFrame, text: str, k: int, out: str = "set") -> DataFrame:
    """Add ``out``: the distinct k-word shingles of the ASCII-lower-cased text as 64-bit hashes."""
    df = df.withColumn("__w", words(ascii_lower(F.coalesce(F.col(text), F.lit("")))))
    args = ", ".join(f"__w[i + {j}]" for j in range(k))
    s = (F.when(F.size("__w") >= k, F.array_distinct(F.expr(f"transform(sequence(0, size(__w) - {k}), i -> xxhash64({args}))")))
         .when(F.size("__w") > 0, F.array(F.xxhash64("__w"))).otherwise(F.expr("cast(array() as array<bigint>)")))
    return df.withColumn(out, s).drop("__w")


def mix32(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of the 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(values: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of consecutive non-empty sets: ``values`` holds their 64-bit
    hashes, ``starts`` where each begins. Result: one row of coordinates per set."""
    v = values.view(np.uint64)
    placed = mix32((v ^ (v >> np.uint64(32))).astype(np.uint32) + np.uint32(0x9E3779B9))  # sigma
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    out = np.full((len(starts), coordinates), 0xFFFFFFFF, np.uint32)
    ends = np.append(starts[1:], len(v))
    for lo in range(0, len(v), BLOCK):
        hi = min(lo + BLOCK, len(v))
        first = int(np.searchsorted(ends, lo, "right"))
        last = int(np.searchsorted(starts, hi, "left"))  # sets [first, last) touch this block
        ranks = mix32(placed[None, lo:hi] + shifts)  # pi, shifted
        cuts = np.maximum(starts[first:last] - lo, 0)
        least = np.minimum.reduceat(ranks, cuts, axis=1).T
        out[first:last] = np.minimum(out[first:last], least)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band number is part of it."""
    s = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        key = (key ^ s[:, :, j]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _with_keys(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, set) -> (id, n_shingles, d1, d2, keys): size, set digest and band keys."""
    id_type = sets.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n_shingles", T.LongType()),
                           T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                col = part.column("set")
                n = np.diff(col.offsets.to_numpy())
                flat = col.flatten().to_numpy(zero_copy_only=False)
                full = np.flatnonzero(n)
                keys = np.zeros(0, np.int64)
                if len(full):
                    starts = (np.cumsum(n) - n)[full]
                    keys = band_keys(signatures(flat, starts, bands * rows), bands, rows).ravel()
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype("i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n.astype("i8")), part.column("d1"), part.column("d2"),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))],
                    names=["id", "n_shingles", "d1", "d2", "keys"])

    ordered = sets.withColumn("s", F.sort_array("set")).select(
        "id", "set", F.xxhash64("s").alias("d1"), F.xxhash64(F.lit(1), "s").alias("d2"))
    return ordered.mapInArrow(run, schema)


def linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold (per cent, exact integers)."""
    a = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    na, nb = F.size("set_a"), F.size("set_b")
    return (pairs.join(a, "a").join(b, "b")
            .where((100 * F.least(na, nb) >= threshold * F.greatest(na, nb)) & (100 * both >= threshold * (na + nb - both)))
            .select("a", "b"))


def _linked_across(apart: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """All links between members (key, rep, c) of different components that share a bucket
    with another one.

    Two sets that reach the threshold share one of their rarest shingles: of n shingles, put
    in one order for all sets, the first n - ceil(threshold * n) + 1 hold one of the other's.
    The order is by frequency among the members, so what many texts have in common (boilerplate)
    comes last and brings nobody together. Pairs meet on such a shingle only if their sizes, and
    what is left of both sets after it, still allow the threshold; those are tested in full."""
    full = materialize(apart.select("rep", "c").distinct().join(sets.select(F.col("id").alias("rep"), "set"), "rep"), "minhash-apart")
    each = full.select("rep", "c", F.size("set").alias("n"), F.explode("set").alias("s"))
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("f"))
    ordered = each.join(common, "s").groupBy("rep", "c", "n").agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("o"))
    first = F.expr(f"n - int(ceil({threshold} * n / 100.0)) + 1")
    prefix = materialize(ordered.select("rep", "c", "n", F.posexplode(F.slice("o", F.lit(1), first)).alias("i", "e"))
                         .where("e.f > 1").select("rep", "c", "n", "i", F.col("e.s").alias("s")), "minhash-prefix")
    x, y = prefix.alias("x"), prefix.alias("y")
    meet = F.expr(f"""x.s = y.s AND x.c < y.c AND 100 * least(x.n, y.n) >= {threshold} * greatest(x.n, y.n)
        AND (100 + {threshold}) * (1 + least(x.n - x.i - 1, y.n - y.i - 1)) >= {threshold} * (x.n + y.n)""")
    pairs = x.join(y, meet).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    return linked(pairs, sets, threshold)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, threshold: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``df``; ``component_id`` is
    the smallest id reachable over links, ``kept`` marks the row that carries it."""
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    keyed = materialize(_with_keys(with_sets(docs, "text", k), bands, rows), "minhash-keys")
    # one representative per set: copies are one row from here on
    classes = materialize(keyed.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep")), "minhash-classes")
    reps = keyed.where("n_shingles > 0").join(classes.where("rep IS NOT NULL"), ["d1", "d2"]).where("id = rep")
    members = reps.select(F.explode("keys").alias("key"), "rep")
    crowded = (members.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("top"))
               .where("centre < top").select("key", "centre"))
    buckets = materialize(members.join(crowded, "key").distinct(), "minhash-buckets")
    wanted = buckets.groupBy(F.col("rep").alias("id")).agg(F.sort_array(F.collect_set("key")).alias("keys"))
    sets = materialize(with_sets(docs.join(wanted, "id"), "text", k).drop("text"), "minhash-sets")
    # each member against its bucket's centre
    star = buckets.where("centre != rep").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialize(linked(star, sets, threshold), "minhash-links")
    comp = components(links)
    for draw in range(CENTRE_ROUNDS + 1):
        # members of different components in one bucket: against another centre, finally each other
        placed = buckets.select("key", "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("c"))
        mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(F.struct(
            F.xxhash64("rep", F.lit(draw)).alias("h"), "rep", "c")).alias("m")).where("lo < hi")
        apart = placed.join(mixed, "key")
        if draw < CENTRE_ROUNDS:
            new = apart.where("c != m.c").select(F.least("rep", "m.rep").alias("a"), F.greatest("rep", "m.rep").alias("b"))
            more = linked(new.distinct(), sets, threshold)
        else:
            more = _linked_across(apart.select("key", "rep", "c"), sets, threshold)
        more = materialize(more, "minhash-links")
        if not more.isEmpty():
            links = links.union(more)
            comp = components(links)
    found = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    single = keyed.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return (keyed.where("n_shingles > 0").join(found, ["d1", "d2"]).select("id", "n_shingles", "component_id").union(single)
            .select(F.col("id").alias(id), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
