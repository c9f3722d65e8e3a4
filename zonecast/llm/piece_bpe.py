"""Piece encoding and decoding by a merge-type prefix table.

A byte-pair encoding has, for every prefix of a text, one last token. The encoder fills
that table from left to right: an Aho-Corasick automaton over the vocabulary gives the
tokens that end at each position, and a candidate ``t`` after the prefix that ends in
token ``a`` is accepted when the pair is compatible, that is when merging the characters
of ``a + t`` gives exactly ``[a, t]`` again. The ids are then read backwards through the
table. Candidates per position are at most the longest token's length, so the work is
linear in the text.

Text is cut first where no token can cross: before a run of ``U+2581`` (no piece holds it
after another character) and around characters that no piece contains (these are spelled
as byte tokens). The encodings of such chunks are kept in a bounded per-worker memo.

The model is read by the ``sentencepiece`` library; only its vocabulary and scores are
used for encoding, and its ``decode`` for decoding. Equality with the library's own
``encode`` is tested over all words of the test tables and random strings.

Defined results: a null text counts as empty; an empty text has only the begin and end
ids (if asked for) and decodes to the empty string; very long texts and chunks are encoded
whole; repeated rows get equal results; an empty table gives no rows; result columns
replace same-named input columns, all others pass through.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, worker_cache

SPACE = "▁"
#: Chunks and token pairs remembered by a worker before the memo starts anew.
MEMO_SIZE = 400_000


class PrefixTableEncoder:
    """Exact encoder for one SentencePiece BPE model file with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp, n = self.sp, self.sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.ids, self.score, self.bytes = {}, {}, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or len(self.bytes) != 256:
            raise ValueError("a byte-fallback BPE model whose pieces hold the space mark only in front is needed")
        self.known = set("".join(self.ids))
        auto = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for p in self.ids:
            auto.add_word(p, p)
        auto.make_automaton()
        self.auto = auto
        self.alone = {p for p in self.ids if self.merged(p) == [p]}  # tokens that merging can produce
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}  # two generations: when the young one is full, the old one goes
        self.old: dict[str, bytes] = {}
        # a line feed ends a chunk too where no piece holds it
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if "\n" not in self.known else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, s: str) -> list[str]:
        """The merge rule on a short string: best score first, leftmost of equals."""
        parts, score = list(s), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                v = score.get(parts[k] + parts[k + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        key = (a, b)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= MEMO_SIZE:
                self.pairs.clear()
            ok = self.pairs[key] = self.merged(a + b) == [a, b]
        return ok

    def tokens(self, chunk: str) -> list[str]:
        """Tokens of a chunk of known characters, by the prefix table."""
        last: list[str | None] = [None] * (len(chunk) + 1)
        alone = self.alone
        for end, t in self.auto.iter(chunk):
            end += 1
            if last[end] is not None or t not in alone:
                continue
            begin = end - len(t)
            if begin == 0 or (last[begin] is not None and self.compatible(last[begin], t)):
                last[end] = t
        out, at = [], len(chunk)
        while at:
            t = last[at]
            out.append(t)
            at -= len(t)
        return out[::-1]

    def packed(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian unsigned 32-bit integers."""
        got = self.memo.get(chunk)
        if got is None:
            got = self.old.get(chunk)
            if got is None:
                ids = []
                for known, run in itertools.groupby(chunk, self.known.__contains__):
                    run = "".join(run)
                    ids += [self.ids[t] for t in self.tokens(run)] if known else [self.bytes[x] for x in run.encode()]
                got = np.array(ids, "<u4").tobytes()
            if len(chunk) <= 64:  # long chunks rarely return
                if len(self.memo) >= MEMO_SIZE:
                    self.old, self.memo = self.memo, {}
                self.memo[chunk] = got
        return got

    def encode(self, text: str | None, ends: bool = True) -> bytes:
        body = b"".join(map(self.packed, self.chunk.findall(SPACE + text.replace(" ", SPACE)))) if text else b""
        if not ends:
            return body
        return np.array([self.bos], "<u4").tobytes() + body + np.array([self.eos], "<u4").tobytes()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


def encoder(model_file: str) -> PrefixTableEncoder:
    """One encoder per model and Python worker."""
    cache, key = worker_cache(), f"piece_bpe:{model_file}"
    if key not in cache:
        cache[key] = PrefixTableEncoder(model_file)
    return cache[key]


def encode(df: DataFrame, model_file: str, text: str = "text", out: str = "ids", ends: bool = True) -> DataFrame:
    """``out``: array of ids of every whole text."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(model_file)
        for b in batches:
            yield pd.Series([np.frombuffer(enc.encode(t, ends), "<u4").astype("i4") for t in b], dtype=object)

    return df.withColumn(out, run(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``out``: the text of an id array (null: null)."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(model_file)
        for b in batches:
            yield pd.Series([None if x is None else enc.decode([int(i) for i in x]) for x in b], dtype=object)

    return df.withColumn(out, run(F.col(ids)))


def round_trip(df: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Encode and decode every text: ``n_tokens``, ``ids_sha256`` (ids as little-endian
    unsigned 32-bit integers) and ``decoded_sha256``, without shipping the ids back."""
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(model_file)
        for b in batches:
            rows = []
            for t in b:
                ids = enc.encode(t)
                decoded = enc.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(decoded.encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    r = fresh(df, "r")
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return (df.drop(*[c for c in names if c != text]).withColumn(r, run(F.coalesce(F.col(text), F.lit(""))))
            .select(*[F.col(c) for c in df.columns if c not in names or c == text], *[F.col(f"{r}.{c}").alias(c) for c in names]))
