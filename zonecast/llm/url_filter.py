"""URL filters: a sorted array of 64-bit xxhash keys, memory-mapped, probed by vectorised
binary search, every hit confirmed against the stored full string.

A list entry is ``host/path-prefix`` (``net/`` covers the host ``net`` and all its
subdomains; ``example.com/de/`` also asks that the path start with ``/de/``). For a URL
the probe keys are every (suffix of the host at label borders) x (prefix of the path of a
length that occurs in the list): their number depends on the URL and on the number of
distinct prefix lengths, never on the size of the list. The longest matching entry wins,
``block`` before ``allow`` on equal strings.

The list is turned into one compact blob (sorted ``uint64`` keys, string offsets, string
bytes, verdicts) on the driver only behind a check of its size (``max_list_bytes``); the
blob is broadcast, and each Python worker maps it with ``mmap`` so that batches share one
copy. A larger list is handled by ``judge_large``: the distinct probe keys are joined with
the list on the digest in Spark (a shuffle join on evenly spread keys), strings confirmed,
and the longest match taken per URL pair.

Defined results: a null URL or one without ``://`` has an empty host and path, so no entry
fits; an empty list gives ``default`` everywhere; repeated URLs each get the same result;
an empty table gives no rows; the result columns are ``host``, ``path``, ``rule``,
``verdict`` (same-named input columns are replaced), all others pass through.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, fresh

#: Largest list (bytes of its strings) that is broadcast as one mapped array.
MAX_LIST_BYTES = 64 << 20


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and ``path``
    (from there up to ``? #``); both empty without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    r, keep = fresh(df, "rest"), [c for c in df.columns if c not in ("host", "path")]
    return (df.withColumn(r, F.coalesce(rest, F.lit("")))
            .select(*keep, F.translate(F.regexp_extract(r, r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                    F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1).alias("path")))


class DigestArray:
    """Sorted digests with the strings they stand for, inside one buffer."""

    def __init__(self, blob: bytes):
        self.map = mmap.mmap(-1, max(1, len(blob)))
        self.map.write(blob)
        n, = struct.unpack_from("<q", self.map, 0)
        self.keys = np.frombuffer(self.map, "<u8", n, 8)
        self.offsets = np.frombuffer(self.map, "<i8", n + 1, 8 + 8 * n)
        self.verdicts = np.frombuffer(self.map, "u1", n, 16 + 16 * n)
        self.text_at = 16 + 17 * n
        self.path_lengths = sorted({len(s) - len(s.partition("/")[0]) for s in map(self.string, range(n))})

    @staticmethod
    def build(entries: list[tuple[str, str]]) -> bytes:
        """``entries``: (string, verdict); of equal strings ``block`` wins."""
        best = {}
        for s, v in entries:
            best[s] = 1 if v == "block" or best.get(s) == 1 else 0
        rows = sorted((xxhash.xxh64_intdigest(s.encode()), s.encode(), v) for s, v in best.items())
        offsets = np.cumsum([0, *[len(s) for _, s, _ in rows]]).astype("<i8")
        return (struct.pack("<q", len(rows)) + np.array([k for k, _, _ in rows], "<u8").tobytes() + offsets.tobytes()
                + np.array([v for _, _, v in rows], "u1").tobytes() + b"".join(s for _, s, _ in rows))

    def string(self, i: int) -> str:
        a, b = self.text_at + int(self.offsets[i]), self.text_at + int(self.offsets[i + 1])
        return self.map[a:b].decode()

    def find(self, strings: list[str]) -> np.ndarray:
        """Index of the entry equal to each string, -1 if none: binary search on the digest,
        then the stored string decides (also among entries that share a digest)."""
        want = np.fromiter((xxhash.xxh64_intdigest(s.encode()) for s in strings), "u8", len(strings))
        at = np.searchsorted(self.keys, want)
        out = np.full(len(strings), -1, "i8")
        n = len(self.keys)
        for j in np.flatnonzero(at < n):
            i = int(at[j])
            while i < n and self.keys[i] == want[j]:
                if self.string(i) == strings[j]:
                    out[j] = i
                    break
                i += 1
        return out


def probes(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """Every list entry that would fit this host and path, longest first."""
    out = []
    labels = host.split(".") if host else []
    for k in range(len(labels)):
        suffix = ".".join(labels[k:])
        out += [suffix + path[:n] for n in path_lengths if len(path) >= n]
    return sorted(out, key=len, reverse=True)


def judge(pages: DataFrame, entries: DataFrame, url: str = "url", default: str = "allow",
          max_list_bytes: int = MAX_LIST_BYTES) -> DataFrame:
    """``host``, ``path``, ``rule`` (the winning entry or null) and ``verdict`` per row.

    ``entries``: (entry, verdict), any size. The mapped array serves lists up to
    ``max_list_bytes``; larger ones go through ``judge_large`` with equal results."""
    entries = entries.where("entry IS NOT NULL").select("entry", "verdict")
    size = entries.agg(F.coalesce(F.sum(F.octet_length("entry") + 17), F.lit(0))).first()[0]
    if size > max_list_bytes:
        return judge_large(pages, entries, url, default)
    blob = DigestArray.build([(r["entry"], r["verdict"]) for r in entries.collect()])  # bounded by the check above
    shared = pages.sparkSession.sparkContext.broadcast(blob)
    df = with_host_path(pages, url).drop("rule", "verdict")
    arr: list[DigestArray] = []
    result = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if not arr:
            arr.append(DigestArray(shared.value))
        a = arr[0]
        for hosts, paths in batches:
            asked, owner = [], []
            for k, (h, p) in enumerate(zip(hosts, paths)):
                c = probes(h, p, a.path_lengths)
                asked += c
                owner += [k] * len(c)
            rule, verdict = [None] * len(hosts), [default] * len(hosts)
            found = a.find(asked)
            for j in np.flatnonzero(found >= 0)[::-1]:  # the longest comes first, so it is set last
                rule[owner[j]] = asked[j]
                verdict[owner[j]] = "block" if a.verdicts[found[j]] else "allow"
            yield pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    # wide columns (page bodies) never reach Python: the function sees host and path only
    hit = fresh(df, "hit")
    udf = F.pandas_udf(probe, result)
    return df.withColumn(hit, udf("host", "path")).select(
        *df.columns, F.col(f"{hit}.rule").alias("rule"), F.col(f"{hit}.verdict").alias("verdict"))


def judge_large(pages: DataFrame, entries: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The same for a list too large to map: distinct (host, path) pairs are expanded into
    probe strings and hash-joined with the list on digest and string."""
    df = with_host_path(pages, url).drop("rule", "verdict")
    e = (entries.groupBy("entry").agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocked"))
         .withColumn("key", F.xxhash64("entry")))
    lengths = [r[0] for r in e.select((F.length("entry") - F.length(F.substring_index("entry", "/", 1))).alias("n"))
               .distinct().orderBy("n").collect()]  # one per distinct length, bounded by the longest path
    pairs = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.when(F.col("host") == "", F.expr("cast(array() as array<string>)")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    # the path prefixes: one per length that occurs in the list
    prefixes = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]) if lengths else F.expr("cast(array() as array<int>)"),
                                    lambda n: F.when(F.length("path") >= n, F.left(F.col("path"), n))), lambda p: p.isNotNull())
    asked = (pairs.withColumn("s", F.explode(suffixes)).withColumn("p", F.explode(prefixes))
             .select("host", "path", F.concat("s", "p").alias("entry")).withColumn("key", F.xxhash64("entry")))
    won = (asked.join(e, ["key", "entry"]).groupBy("host", "path")
           .agg(F.max_by(F.struct("entry", "blocked"), F.length("entry")).alias("w"))
           .select("host", "path", F.col("w.entry").alias("rule"),
                   F.when(F.col("w.blocked") == 1, "block").otherwise("allow").alias("verdict")))
    return (df.join(won, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(*df.columns, "rule", "verdict"))
