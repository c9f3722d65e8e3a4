"""Best-fit decreasing packing into sequences of fixed length.

Every text is tokenized beside the scan; what leaves that pass is one small row per piece
(id, start, length, checksum). Only texts longer than a sequence are cut, from the end into
whole sequences, so that the first piece takes the remainder. The pieces, a few dozen bytes
each, are dealt evenly into groups of about ``rows_per_group`` whatever their ids, and a
task packs one group: pieces in decreasing length, each into the open sequence with the
least room that still takes it. That sequence is found in a segment tree over the possible
remaining capacities (0 to the limit), in logarithmic time per piece; where none fits, a
sequence is opened. Memory of a task is bounded by its group, and a lost task is redone
from the written pieces.

``sequence_id`` is the group number times 2^40 plus a counter.

Defined results: a null text counts as empty and has the end id only; repeated rows and
ids are packed like any others; very long texts give many pieces; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize

from .byte_ids import ByteIds
from .common import groups_for, worker_cache


class CapacityTree:
    """Open bins by remaining capacity: leaf ``c`` of a segment tree says whether a bin with
    room ``c`` is open, inner nodes whether any leaf below them does."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()      # leaves 0 .. capacity
        self.any = bytearray(2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int, on: int) -> None:
        node, tree = self.size + room, self.any
        tree[node] = on
        node >>= 1
        while node:
            value = tree[2 * node] | tree[2 * node + 1]
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    def put(self, bin_id: int, room: int) -> None:
        if not self.bins[room]:
            self._mark(room, 1)
        self.bins[room].append(bin_id)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the open bin of least room that is at least ``need``: (bin, room)."""
        tree, node = self.any, self.size + need
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # up until a right sibling has bins
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.size
        bin_id = self.bins[room].pop()
        if not self.bins[room]:
            self._mark(room, 0)
        return bin_id, room


def best_fit_decreasing(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of every length, and the number of bins; equal lengths in given order."""
    lengths = np.asarray(lengths, np.int64)
    if lengths.size and (lengths.min() < 1 or lengths.max() > capacity):
        raise ValueError("lengths must be between 1 and the capacity")
    where, offset = np.zeros(lengths.size, np.int64), np.zeros(lengths.size, np.int64)
    tree, n_bins = CapacityTree(capacity), 0
    order = np.argsort(-lengths, kind="stable")
    for k, need in zip(order.tolist(), lengths[order].tolist()):
        hit = tree.tightest(need)
        if hit is None:
            hit, n_bins = (n_bins, capacity), n_bins + 1
        where[k], offset[k] = hit[0], capacity - hit[1]
        if hit[1] > need:
            tree.put(hit[0], hit[1] - need)
    return where, offset, n_bins


def token_pieces(df: DataFrame, tokenizer_file: str, id: str = "doc_id", text: str = "text", end_id: int | None = 2,
                 tokens: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32) and, ``with_ids``, the ids
    as packed little-endian unsigned 32-bit integers. No shuffle."""
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")],
                           *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    names = schema.names
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key = worker_cache(), f"byte_ids:{tokenizer_file}"
        if key not in cache:
            cache[key] = ByteIds(tokenizer_file)
        enc = cache[key]
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                where, cols = [], [[], [], [], [], []]
                for k, ids in enumerate(enc.of([t or "" for t in part.column("text").to_pylist()])):
                    ids += end
                    n, view = len(ids) // 4, memoryview(ids)
                    cuts = [0, *range(n % tokens or tokens, n + 1, tokens)] if n else []
                    for j, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        where.append(k)
                        for c, v in zip(cols, (j, s, e - s, zlib.crc32(view[4 * s:4 * e]), ids[4 * s:4 * e] if with_ids else None)):
                            c.append(v)
                arrays = [part.column("id").take(pa.array(where, pa.int64())), pa.array(cols[0], pa.int32()),
                          *[pa.array(c, pa.int64()) for c in cols[1:4]], *([pa.array(cols[4], pa.binary())] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int, length: str = "length", rows_per_group: int = 20_000) -> DataFrame:
    """Best-fit decreasing over groups of about ``rows_per_group`` rows, dealt evenly:
    ``pieces`` with ``sequence_id`` and ``offset``. It counts the rows and reads them again,
    so they should be a written table."""
    if not 1 <= capacity < 1 << 24:
        raise ValueError("capacity must be between 1 and 2^24 - 1")
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(*names)
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group = list(batches)
        if not group:
            return
        ctx = TaskContext.get()
        first = (ctx.partitionId() if ctx else 0) << 40
        where, offset, _ = best_fit_decreasing(np.concatenate([b.column(length).to_numpy(zero_copy_only=False) for b in group]), capacity)
        at = 0
        for b in group:
            w, o = where[at:at + b.num_rows] + first, offset[at:at + b.num_rows]
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(w), pa.array(o)], names=schema.names)

    return rows.repartition(groups_for(rows.count(), rows_per_group)).mapInArrow(run, schema)


def pack_best_fit(df: DataFrame, tokenizer_file: str, id: str = "doc_id", text: str = "text", end_id: int | None = 2,
                  tokens: int = 1024, rows_per_group: int = 20_000, with_ids: bool = False) -> DataFrame:
    """Tokenize every whole text, append ``end_id`` and pack best-fit decreasing.

    One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset), and the
    packed ids if asked for."""
    pieces = materialize(token_pieces(df, tokenizer_file, id, text, end_id, tokens, with_ids), "best-fit-pieces")
    return place(pieces, tokens, rows_per_group=rows_per_group).withColumnRenamed("id", id)
