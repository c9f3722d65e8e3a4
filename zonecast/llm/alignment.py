"""Alignment of two tokenizers by an inverted index of id pairs.

Every text is read by a byte-level tokenizer (A) and a piece tokenizer (B). Where tokens of
both end at the same byte, the tokens since the last such place form a group, and the two
tokens that end there are linked. The corpus is indexed by linked pair: per pair and block
of documents one posting holds compressed bitmaps of the documents with that link, as
bit planes of its multiplicity (plane ``k`` has the documents whose link count has bit
``k``). The documents of a pair are the OR of its planes, its links the popcounts weighted by
2^k; blocks have different documents, so counts of a pair add over blocks. A link scores by
its pair's corpus count; the scores go back to the blocks, whose postings hand them to their
documents.

How it runs: one pass tokenizes beside the scan and writes documents and postings as one
table (blocks end at ``BLOCK_DOCS`` documents or ``BLOCK_LINKS`` links, so that a task's
memory is bounded, and nothing is left out). Pair counts are a partially aggregated sum
over two id columns and a length. Counts meet postings in a join of keys only, whose hot
keys (one row per block) Spark may split; then keys and postings of a block, never of the
corpus, come together once. Texts are cut before blanks and line feeds that follow another
character, where a token of both always ends; the alignment of such a chunk is remembered
by the worker, in two generations of a bounded memo.

Defined results: texts null, empty, or that the tokens of either do not spell back byte for
byte (for B, a literal U+2581) have no tokens, all counts 0 and the digest ''. Special
tokens' strings inside texts are plain text. Repeated rows and ids are documents of their
own; very long texts are aligned whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize

from .byte_ids import UNSURE, ByteIds
from .common import worker_cache

#: A block ends at so many documents (at most 2^16) or links; remembered chunks of a worker.
BLOCK_DOCS, BLOCK_LINKS, MEMO_SIZE = 16_384, 3_000_000, 250_000
PIECE_SPACE = "▁"


class Aligner:
    """Groups and links of the tokens that two tokenizer files give for a text."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        self.a = ByteIds(byte_file, special_as_text=True)
        back = {c: b for b, c in self.a.signs.items()}
        self.a_bytes = {i: bytes(back[c] for c in t) for t, i in self.a.tok.get_vocab().items() if all(c in back for c in t)}
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.b_bytes = {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.b_bytes[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.b_bytes[i] = sp.id_to_piece(i).replace(PIECE_SPACE, " ").encode()
        pieces = [sp.id_to_piece(i) for i in self.b_bytes]
        # a cut before a blank or line feed needs that no piece holds either after another character
        blanks = all(PIECE_SPACE not in p.lstrip(PIECE_SPACE) for p in pieces)
        feeds = not any("\n" in p for p in pieces)
        self.cut = re.compile(r"(?<=\S)(?=[ \n])" if feeds else r"(?<=\S)(?= )") if blanks and self.a.can_cut else None
        self.space = sp.piece_to_id(PIECE_SPACE)
        self.memo: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def chunks(self, text: str) -> list[str]:
        text = " " + text
        return [text] if self.cut is None or UNSURE.search(text) else self.cut.split(text)

    def _b_ids(self, chunks: list[str]) -> list[list[int]]:
        """B puts a blank in front of what it reads, so that of a chunk is left out; where
        there is none, the piece of the added one goes."""
        got = self.sp.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [[self.space] if c == " " else ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, got)]

    def align(self, chunk: str, a_ids: list[int], b_ids: list[int]) -> tuple | None:
        """(tokens of A, tokens of B, groups as text, packed link codes); None if the tokens
        do not spell the chunk."""
        raw = chunk.encode()
        a_parts, b_parts = [self.a_bytes.get(i) for i in a_ids], [self.b_bytes.get(i) for i in b_ids]
        if None in a_parts or None in b_parts or b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return None
        groups, links = [], []
        i = j = i0 = j0 = at_a = at_b = 0
        while i < len(a_ids) or j < len(b_ids):
            if at_a <= at_b:
                at_a += len(a_parts[i])
                i += 1
            else:
                at_b += len(b_parts[j])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, a_ids[i0:i])) + "|" + ",".join(map(str, b_ids[j0:j])))
                links.append(a_ids[i - 1] << 24 | b_ids[j - 1])
                i0, j0 = i, j
        return len(a_ids), len(b_ids), ";".join(groups), struct.pack(f"<{len(links)}q", *links)

    def of(self, texts: list[str]) -> list[list[tuple] | None]:
        """Aligned chunks of every text; None for a text without tokens."""
        split = [self.chunks(t) if t else [] for t in texts]
        memo, missing = self.memo, []
        for c in set().union(*split):
            if c not in memo:
                if c in self.old:
                    memo[c] = self.old[c]
                else:
                    missing.append(c)
        for c, a, b in zip(missing, self.a.encode_chunks(missing), self._b_ids(missing)):
            memo[c] = self.align(c, struct.unpack(f"<{len(a) // 4}I", a), b)
        out = []
        for s in split:
            got = [memo[c] for c in s]
            out.append(None if not got or None in got else got)
        if len(memo) > MEMO_SIZE:
            self.old, self.memo = memo, {}
        return out


def pack_planes(docs: np.ndarray, counts: np.ndarray, n_docs: int) -> bytes:
    """Bit planes of the counts of ascending documents (below ``n_docs``). A plane is its
    number, its kind, its popcount less one, and the documents: 16-bit numbers, or a bitmap
    where that is shorter."""
    out, width = [], -(-n_docs // 8)
    for k in range(int(counts.max()).bit_length()):
        d = docs[(counts >> k) & 1 == 1]
        if len(d):
            if 2 * len(d) <= width:
                out.append(struct.pack("<BBH", k, 0, len(d) - 1) + d.astype("<u2").tobytes())
            else:
                bits = np.zeros(8 * width, bool)
                bits[d] = True
                out.append(struct.pack("<BBH", k, 1, len(d) - 1) + np.packbits(bits).tobytes())
    return b"".join(out)


def planes(packed: bytes, n_docs: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, documents) of every plane."""
    at, width = 0, -(-n_docs // 8)
    while at < len(packed):
        k, kind, n = struct.unpack_from("<BBH", packed, at)
        at += 4
        if kind:
            yield k, np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, width, at)))
            at += width
        else:
            yield k, np.frombuffer(packed, "<u2", n + 1, at)
            at += 2 * (n + 1)


def index(df: DataFrame, byte_file: str, piece_file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents and postings as one table. Documents: (block, idx, id, n_a, n_b, n_groups,
    groups_sha256), postings: (block, a, b, n_docs, n_links, planes); the other columns null."""
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("block_docs", T.IntegerType()), T.StructField("idx", T.IntegerType()),
        T.StructField("id", kind), *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")],
        T.StructField("groups_sha256", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
        T.StructField("n_docs", T.LongType()), T.StructField("n_links", T.LongType()), T.StructField("planes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, key = worker_cache(), f"aligner:{byte_file}:{piece_file}"
        if key not in cache:
            cache[key] = Aligner(byte_file, piece_file)
        aligner, ctx = cache[key], TaskContext.get()
        number = (ctx.partitionId() if ctx else 0) << 32
        ids, facts, codes, n_links = [], [], [], 0

        def batch(n: int, **given) -> pa.RecordBatch:
            types = {f.name: pa.int64() if isinstance(f.dataType, T.LongType) else pa.int32() if isinstance(f.dataType, T.IntegerType)
                     else pa.string() if isinstance(f.dataType, T.StringType) else pa.binary() for f in schema if f.name != "id"}
            given["block"] = pa.array(np.full(n, number))
            id_type = ids[0].type
            return pa.RecordBatch.from_arrays(
                [given[c] if c in given else pa.nulls(n, types.get(c, id_type)) for c in schema.names], names=schema.names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, facts, codes, n_links, number
            n = len(facts)
            if n:
                cols = list(zip(*facts))
                yield batch(n, block_docs=pa.array(np.full(n, n, "i4")), idx=pa.array(np.arange(n, dtype="i4")),
                            id=pa.concat_arrays(ids), n_a=pa.array(cols[0], pa.int64()), n_b=pa.array(cols[1], pa.int64()),
                            n_groups=pa.array(cols[2], pa.int64()), groups_sha256=pa.array(cols[3], pa.string()))
                yield from postings(n)
            ids, facts, codes, n_links, number = [], [], [], 0, number + 1

        def postings(n: int) -> Iterator[pa.RecordBatch]:
            flat = np.frombuffer(b"".join(codes), "<i8")
            if not len(flat):
                return
            # (pair, document) sorted once; runs of equal keys are the multiplicities
            pair, link = np.unique(flat, return_inverse=True)
            keys = (link.astype(np.int64) << 16) | np.repeat(np.arange(n), [len(c) // 8 for c in codes])
            del flat, link
            keys.sort()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            count = np.diff(np.append(first, len(keys)))
            keys = keys[first]
            docs, of = keys & 0xFFFF, keys >> 16
            cuts = np.append(np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])), len(of))
            links = np.add.reduceat(count, cuts[:-1])
            for lo in range(0, len(pair), 20_000):
                hi = min(lo + 20_000, len(pair))
                packed = [pack_planes(docs[s:e], count[s:e], n) for s, e in zip(cuts[lo:hi].tolist(), cuts[lo + 1:hi + 1].tolist())]
                yield batch(hi - lo, block_docs=pa.array(np.full(hi - lo, n, "i4")), a=pa.array((pair[lo:hi] >> 24).astype("i4")),
                            b=pa.array((pair[lo:hi] & 0xFFFFFF).astype("i4")), n_docs=pa.array(np.diff(cuts)[lo:hi]),
                            n_links=pa.array(links[lo:hi]), planes=pa.array(packed, pa.binary()))

        for b in batches:
            for at in range(0, b.num_rows, 100):
                part = b.slice(at, 100)
                begin = 0
                for k, got in enumerate(aligner.of(part.column("text").to_pylist())):
                    if got is None:
                        facts.append((0, 0, 0, ""))
                        codes.append(b"")
                    else:
                        na, nb, groups, links = zip(*got)
                        codes.append(b"".join(links))
                        facts.append((sum(na), sum(nb), len(codes[-1]) // 8, hashlib.sha256(";".join(groups).encode()).hexdigest()))
                    n_links += len(codes[-1]) // 8
                    if len(facts) >= BLOCK_DOCS or n_links >= BLOCK_LINKS:
                        ids.append(part.column("id").slice(begin, k + 1 - begin))
                        begin = k + 1
                        yield from flush()
                if begin < part.num_rows:
                    ids.append(part.column("id").slice(begin))
        yield from flush()

    return rows.mapInArrow(run, schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best) over the corpus; ``best``: no pair with this ``b`` has more links."""
    pairs = (table.where("a is not null").groupBy("a", "b")
             .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")))
    most = pairs.groupBy(F.col("b").alias("m_b")).agg(F.max("n_links").alias("most"))
    return pairs.join(most, F.col("b") == F.col("m_b")).select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scores(table: DataFrame) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document
    of a written ``index``."""
    counts = materialize(pair_counts(table), "pair-counts").select("a", "b", F.col("n_links").alias("total"), "best")
    none = {"total": F.lit(None).cast("bigint"), "best": F.lit(None).cast("boolean")}
    keys = table.where("a is not null").select("block", "a", "b").join(counts, ["a", "b"])
    held = table.drop("n_docs", "n_links").withColumns(none)
    both = held.unionByName(keys, allowMissingColumns=True)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([table.schema["id"], *[T.StructField(c, T.LongType()) for c in names], table.schema["groups_sha256"]])

    def block(rows: pa.Table) -> pa.Table:
        docs = rows.filter(pa.compute.is_valid(rows["idx"]))
        docs = docs.take(pa.compute.sort_indices(docs["idx"]))
        best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        code = lambda t: (t["a"].to_numpy().astype(np.int64) << 24) | t["b"].to_numpy()
        scored = rows.filter(pa.compute.is_valid(rows["total"]))
        posted = rows.filter(pa.compute.is_valid(rows["planes"]))
        if posted.num_rows:
            order = np.argsort(code(scored))
            at = order[np.searchsorted(code(scored), code(posted), sorter=order)]
            value, top = scored["total"].to_numpy()[at].tolist(), scored["best"].to_numpy(zero_copy_only=False)[at].tolist()
            for packed, v, is_best in zip(posted["planes"].to_pylist(), value, top):
                for k, d in planes(packed, docs.num_rows):
                    total[d] += v << k
                    if is_best:
                        best[d] += 1 << k
        cols = [docs["id"], docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_groups"], pa.array(best), pa.array(total), docs["groups_sha256"]]
        return pa.table(cols, names=schema.names)

    return both.groupBy("block").applyInArrow(block, schema)


def align(df: DataFrame, byte_file: str, piece_file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Index the corpus and score every document by its links."""
    return scores(materialize(index(df, byte_file, piece_file, id, text), "pair-index")).withColumnRenamed("id", id)
