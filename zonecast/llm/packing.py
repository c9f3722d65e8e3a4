"""Packing examples into fixed-length training sequences by vector bin packing.

An example asks for a vector (tokens, segments, loss-bearing tokens); a sequence offers
what is left of three limits at once. Each example goes, whole, to the open sequence that
it fits and whose remaining room has the greatest dot product with its demand (both scaled
by the limits). Where none fits, a new sequence is opened while fewer than ``open_bins``
are open; beyond that the best gap is filled by cutting the example, so full sequences
have no padding. At the end of a task the fullest open sequences are topped up with the examples
of the least filled ones, which are cut for it, until one sequence is left; its content is cut
into runs whose lengths are powers of two, which need no padding either.

Each Spark task packs the rows of its own partition in one streaming pass next to the
tokenizer: no shuffle, memory bounded by the open sequences, and a lost task is redone by
itself. ``sequence_id`` is the partition number times 2^40 plus a counter.

Defined results: a null text counts as empty and has the end id only; every example with
at least one token is covered exactly once, longer ones than a sequence are cut; repeated
rows and ids are packed like any others; an empty table gives no rows; extra columns are
ignored. A single token always fits (limits are at least 1).
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_ids import SIGNS, byte_signs
from .common import worker_cache

#: Sequences a task keeps open, and remembered words of a worker's tokenizer.
OPEN_BINS, MEMO_SIZE = 64, 600_000
#: The pre-tokenizer that the short way for plain words is made for (fixed value), and their letters.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_1 = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


class Packer:
    """Places examples one by one; ``closed`` collects finished sequences as lists of
    pieces (example, start, bytes of ids, loss flags or None)."""

    def __init__(self, tokens: int, segments: int, loss: int, open_bins: int = OPEN_BINS):
        self.cap = np.array([tokens, segments, loss], float)
        self.room = np.zeros((open_bins, 3))
        self.live = np.zeros(open_bins, bool)
        self.bins: list[list] = [[] for _ in range(open_bins)]
        self.closed: list[list] = []

    def _put(self, k: int, piece: tuple, demand: np.ndarray) -> None:
        self.bins[k].append(piece)
        self.room[k] -= demand
        if (self.room[k] < 1).any():
            self._close(k)

    def _close(self, k: int) -> None:
        self.closed.append(self.bins[k])
        self.bins[k], self.live[k] = [], False

    def _open(self) -> int:
        k = int(np.argmin(self.live))
        self.room[k], self.live[k] = self.cap, True
        return k

    def _best(self, mask: np.ndarray, demand: np.ndarray) -> int:
        score = (self.room / self.cap) @ (demand / self.cap)
        return int(np.argmax(np.where(mask, score, -1.0)))

    @staticmethod
    def _loss(flags: np.ndarray | None, n: int) -> int:
        return n if flags is None else int(flags.sum())

    def _cut(self, room: np.ndarray, n: int, flags: np.ndarray | None) -> int:
        """The most tokens, from the front, that the room takes."""
        n = min(n, int(room[0]))
        if flags is None:
            return min(n, int(room[2]))
        spent = np.cumsum(flags[:n])
        return int(np.searchsorted(spent, int(room[2]), "right"))

    def add(self, example, ids: bytes, flags: np.ndarray | None = None) -> None:
        start, n = 0, len(ids) // 4
        while start < n:
            size = min(n - start, int(self.cap[0]))
            f = None if flags is None else flags[start:start + size]
            demand = np.array([size, 1, self._loss(f, size)], float)
            fits = self.live & (self.room >= demand).all(axis=1)
            if fits.any():
                k = self._best(fits, demand)
            elif not self.live.all():
                k = self._open()
            else:
                k = self._best(self.live, demand)
            take = self._cut(self.room[k], size, f)
            f = None if flags is None else flags[start:start + take]
            self._put(k, (example, start, ids[4 * start:4 * (start + take)], f), np.array([take, 1, self._loss(f, take)]))
            start += take

    def finish(self) -> None:
        """Top up the fullest open sequences from the least filled; the rest in powers of two."""
        order = sorted(np.flatnonzero(self.live).tolist(), key=lambda k: (self.room[k][0], k))
        first, last = 0, len(order) - 1
        while first < last:
            t, giver = order[first], self.bins[order[last]]
            example, start, ids, flags = giver.pop()
            n = len(ids) // 4
            take = self._cut(self.room[t], n, flags)
            f = None if flags is None else flags[:take]
            self._put(t, (example, start, ids[:4 * take], f), np.array([take, 1, self._loss(f, take)]))
            if take < n:
                giver.append((example, start + take, ids[4 * take:], None if flags is None else flags[take:]))
            first += not self.live[t]
            if not giver:
                self.live[order[last]] = False
                last -= 1
        rest = [p for k in order[first:last + 1] for p in self.bins[k]]
        self.bins, self.live[:] = [[] for _ in self.bins], False
        n = sum(len(p[2]) // 4 for p in rest)
        while n:  # the largest power of two first
            left = 1 << (n.bit_length() - 1)
            n -= left
            run = []
            while left:
                example, start, ids, flags = rest.pop(0)
                take = min(left, len(ids) // 4)
                run.append((example, start, ids[:4 * take], None if flags is None else flags[:take]))
                if 4 * take < len(ids):
                    rest.insert(0, (example, start + take, ids[4 * take:], None if flags is None else flags[take:]))
                left -= take
            self.closed.append(run)


def _pack(rows: DataFrame, prepare: Callable, limits: tuple[int, int, int], open_bins: int) -> DataFrame:
    """``rows`` has ``id`` first; ``prepare()`` gives a function from a record batch to a
    list of (ids as packed bytes, loss flags or None)."""
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss")]])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        read, packer = prepare(), Packer(*limits, open_bins)
        ctx = TaskContext.get()
        number, kind = (ctx.partitionId() if ctx else 0) << 40, None

        def flush() -> pa.RecordBatch:
            nonlocal number
            out: list[tuple] = []
            for seq in packer.closed:
                at = 0
                for (i, doc_tokens), start, ids, flags in seq:
                    n = len(ids) // 4
                    out.append((i, start, n, zlib.crc32(ids), doc_tokens, number, at, Packer._loss(flags, n)))
                    at += n
                number += 1
            packer.closed = []
            cols = list(zip(*out)) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=names)

        for b in batches:
            kind = b.column("id").type
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                for i, (ids, flags) in zip(part.column("id").to_pylist(), read(part)):
                    packer.add((i, len(ids) // 4), ids, flags)
                yield flush()
        if kind is not None:
            packer.finish()
            yield flush()

    return rows.mapInArrow(run, schema)


class WordIds:
    """Ids of a text by a ``tokenizers`` file whose pre-tokenizer never joins across blanks
    and line feeds: blank-separated words are encoded once and remembered."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file)
        # a special token of the file, cut out of texts before anything else, parts the words
        # of one call (a call per word costs more than its encoding)
        special = [(i, t) for i, t in sorted(self.tok.get_added_tokens_decoder().items())
                   if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.part_id, self.part = (special[0][0], special[0][1].content) if special else (None, None)
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        # where case is folded and runs of letters and of signs are pre-tokens, a plain word needs the model only
        self.simple = (steps == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in pre] == ["Split", "ByteLevel"]
                       and pre[0].get("pattern", {}).get("Regex") == LETTER_RUNS and not pre[1].get("add_prefix_space"))
        self.model, self.signs, self.runs = self.tok.model, byte_signs(), {"": b""}
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _pretoken(self, s: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(s if s.isascii() else s.encode().decode("latin-1").translate(self.signs))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, word: str) -> bytes | None:
        """Ids of Latin letters with ASCII signs after them; None for other words."""
        core = word.rstrip(SIGNS)
        if not core or not (core.isascii() and core.isalpha() or LATIN_1.fullmatch(core)):
            return None
        signs = word[len(core):]
        run = self.runs.get(signs)
        if run is None:
            run = self._pretoken(signs)
            if len(signs) <= 8 and len(self.runs) < 10_000:
                self.runs[signs] = run
        return self._pretoken(core.lower()) + run

    def learn(self, words: list[str]) -> None:
        if self.simple:
            rest = []
            for w in words:
                got = self._plain(w)
                if got is None:
                    rest.append(w)
                else:
                    self.memo[w] = got
            words = rest
        plain = [w for w in words if self.part not in w] if self.part else []
        for k in range(0, len(plain), 2000):
            run = plain[k:k + 2000]
            ids = np.array(self.tok.encode(self.part.join(run), add_special_tokens=False).ids, "<u4")
            cut = 4 * np.flatnonzero(ids == self.part_id)
            raw = ids.tobytes()
            for w, a, b in zip(run, [0, *(cut + 4).tolist()], [*cut.tolist(), len(raw)]):
                self.memo[w] = raw[a:b]
        for w in words if not self.part else [w for w in words if self.part in w]:
            self.memo[w] = np.array(self.tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        missing = []
        for w in set().union(*split):
            if w not in self.memo:
                if w in self.old:
                    self.memo[w] = self.old[w]
                else:
                    missing.append(w)
        if missing:
            self.learn(missing)
        out = [b"".join(map(self.memo.__getitem__, ws)) for ws in split]
        if len(self.memo) > MEMO_SIZE:
            self.old, self.memo = self.memo, {}
        return out


def pack_texts(df: DataFrame, tokenizer_file: str, id: str = "doc_id", text: str = "text", end_id: int = 2,
               tokens: int = 4096, segments: int = 256, loss: int = 4096, open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenize every whole text, append ``end_id`` and pack; every token bears loss.

    One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss)."""
    end = np.array([end_id], "<u4").tobytes()

    def prepare():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, key = worker_cache(), f"word_ids:{tokenizer_file}"
        if key not in cache:
            cache[key] = WordIds(tokenizer_file)
        words = cache[key]

        def read(part: pa.RecordBatch):
            texts = part.column("text").to_pylist()
            out = []
            for k in range(0, len(texts), 100):
                out += [(body + end, None) for body in words.of([t or "" for t in texts[k:k + 100]])]
            return out

        return read

    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return _pack(rows, prepare, (tokens, segments, loss), open_bins).withColumnRenamed("id", id)


def pack_ids(df: DataFrame, id: str, ids: str, flags: str | None = None, tokens: int = 4096, segments: int = 256,
             loss: int = 4096, open_bins: int = OPEN_BINS) -> DataFrame:
    """The same for examples tokenized already: ``ids`` an array of integers, ``flags`` an
    array of booleans of the same length that marks loss-bearing tokens (null: all bear).
    Null or empty ids give no piece."""
    mask = F.col(flags).cast("array<boolean>") if flags else F.expr("cast(null as array<boolean>)")
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(ids).cast("array<bigint>"), F.expr("cast(array() as array<bigint>)")).alias("ids"),
                     mask.alias("flags"))

    def prepare():
        def read(part: pa.RecordBatch):
            return [(np.array(i, "<u4").tobytes(), None if f is None else np.array(f, bool))
                    for i, f in zip(part.column("ids").to_pylist(), part.column("flags").to_pylist())]

        return read

    return _pack(rows, prepare, (tokens, segments, loss), open_bins).withColumnRenamed("id", id)
