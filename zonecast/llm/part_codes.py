"""Vector codes by parts (product quantisation), trained exactly over metric trees.

Components become integers, so that distances, sums and codebooks are exact. Vectors are
cut into equal parts; every part position has a codebook of its own, refined by rounds of
nearest-entry assignment and componentwise floored means.

Each Spark task turns its rows into blocks of at most ``block_rows`` vectors and builds, per
block and part, a metric tree by the anchors hierarchy: about sqrt(n) anchors are placed,
each at the point farthest from its own anchor, stealing the points that are nearer to it
(lists sorted by distance say where stealing can stop); the anchors are merged pairwise
into ever larger balls up to the root, and the points of each anchor are treated the same
way below it (middle-out). A ball keeps its centre, radius, count and the sums of its
points. The blocks with their trees are written once; every round is one job over them.

A round walks each tree from the root with a list of candidate entries, which children
inherit: an entry goes when another one is strictly nearer for every point of the ball. When
one is left the ball is wholly owned and its cached sum and count are added without a look
at its points; leaves with more candidates are settled point by point in integers. Pruning
uses floating point with a margin, so an entry is only dropped when it surely loses and
ties reach the integer test. A round sends back one sum per (part, entry, position) and task;
the codebooks (parts x entries rows) are the only thing the driver holds.

Defined results: rows whose vector is null or empty or has a null or non-finite component are dropped;
with fewer rows than entries the codebooks have as many entries as rows (rows without an id
start none); equal ids start entries in the order of their components; repeated rows are
coded each; an empty table gives no rows; other columns are ignored. All vectors kept must
have one length that ``parts`` divides, and integer components below 2^27 in magnitude (else
ValueError).
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import materialize


#: Balls of at most so many points are leaves; magnitudes up to 2^27 keep sums in 64 bits.
LEAF, LIMIT = 24, 1 << 27
#: What is written of a tree: slices, children (-1: none), sums, balls and the order of the points.
TREE = ("lo", "hi", "first", "second", "sums", "center", "radius", "order")


class BallTree:
    """Anchors-hierarchy metric tree over integer points; node 0 is the root. ``order`` lists
    the points so that every ball is the slice ``lo:hi`` of it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.nodes: list[list] = []          # lo, hi, children
        order: list[np.ndarray] = []
        self.at = 0
        self.leaf = leaf
        if len(points):
            self._build(points.astype(float), np.arange(len(points)), order)
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        p = points[self.order]
        n = len(self.nodes)
        self.lo = np.array([x[0] for x in self.nodes], np.int64)
        self.hi = np.array([x[1] for x in self.nodes], np.int64)
        self.first = np.array([x[2][0] if x[2] else -1 for x in self.nodes], np.int64)
        self.second = np.array([x[2][1] if x[2] else -1 for x in self.nodes], np.int64)
        total = np.concatenate([np.zeros((1, p.shape[1]), np.int64), np.cumsum(p, axis=0)])
        self.sums = total[self.hi] - total[self.lo]
        self.center = self.sums / np.maximum(self.hi - self.lo, 1)[:, None]
        self.radius = np.array([np.sqrt(((p[self.lo[k]:self.hi[k]] - self.center[k]) ** 2).sum(1).max()) for k in range(n)])

    def _leaf(self, index: np.ndarray, order: list) -> int:
        order.append(index)
        self.nodes.append([self.at, self.at + len(index), ()])
        self.at += len(index)
        return len(self.nodes) - 1

    def _build(self, points: np.ndarray, index: np.ndarray, order: list) -> int:
        own = points[index]
        if len(index) <= self.leaf or (own == own[0]).all():
            return self._leaf(index, order)
        owner, pivots = anchors(own, max(2, int(np.sqrt(len(index)))))
        plan = merge_plan(pivots, np.array([np.sqrt(((own[owner == k] - p) ** 2).sum(1).max()) for k, p in enumerate(pivots)]),
                          np.bincount(owner, minlength=len(pivots)))

        def walk(part) -> int:
            if isinstance(part, int):
                return self._build(points, index[owner == part], order)
            node = len(self.nodes)
            self.nodes.append([self.at, 0, ()])
            kids = (walk(part[0]), walk(part[1]))
            self.nodes[node][1:] = [self.at, kids]
            return node

        return walk(plan)


def anchors(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner of every point, pivots): each new anchor is the point farthest from its own
    anchor over all anchors, and takes the points that are nearer to it. The points of an
    anchor are sorted by falling distance, and those nearer than half the distance between
    two anchors cannot change hands."""
    dist = np.sqrt(((points - points[0]) ** 2).sum(1))
    lists = [np.argsort(-dist, kind="stable")]
    pivots = [points[0]]
    while len(pivots) < k:
        far = max(range(len(lists)), key=lambda a: dist[lists[a][0]])
        if dist[lists[far][0]] == 0:
            break
        new = points[lists[far][0]].copy()
        taken = []
        for a, (own, pivot) in enumerate(zip(lists, pivots)):
            half = np.sqrt(((new - pivot) ** 2).sum()) / 2
            stop = int(np.searchsorted(-dist[own], -half, "left"))    # distances above half come first
            if not stop:
                continue
            d = np.sqrt(((points[own[:stop]] - new) ** 2).sum(1))
            nearer = d < dist[own[:stop]]
            if nearer.any():
                moved = own[:stop][nearer]
                dist[moved] = d[nearer]
                taken.append(moved)
                lists[a] = np.concatenate([own[:stop][~nearer], own[stop:]])
        got = np.concatenate(taken)
        lists.append(got[np.argsort(-dist[got], kind="stable")])
        pivots.append(new)
        if any(len(own) == 0 for own in lists):
            keep = [a for a, own in enumerate(lists) if len(own)]
            lists, pivots = [lists[a] for a in keep], [pivots[a] for a in keep]
    owner = np.empty(len(points), np.int64)
    for a, own in enumerate(lists):
        owner[own] = a
    return owner, np.array(pivots)


def merge_plan(centers: np.ndarray, radii: np.ndarray, counts: np.ndarray):
    """Nested pairs of anchor numbers: the two balls whose common ball is least are merged first."""
    n = len(centers)
    if n == 1:
        return 0
    c, r, w = centers.astype(float).copy(), radii.astype(float).copy(), counts.astype(float).copy()
    plans: list = list(range(n))

    def cost(i: int) -> np.ndarray:
        gap = np.sqrt(((c - c[i]) ** 2).sum(1))
        out = np.maximum(np.maximum(r, r[i]), (gap + r + r[i]) / 2)
        out[~alive] = np.inf
        out[i] = np.inf
        return out

    alive = np.ones(n, bool)
    table = np.array([cost(i) for i in range(n)])
    for _ in range(n - 1):
        i, j = divmod(int(np.argmin(table)), n)
        m = (c[i] * w[i] + c[j] * w[j]) / (w[i] + w[j])
        r[i] = max(np.sqrt(((c[k] - m) ** 2).sum()) + r[k] for k in (i, j))
        c[i], w[i], plans[i] = m, w[i] + w[j], (plans[i], plans[j])
        alive[j] = False
        table[j], table[:, j] = np.inf, np.inf
        table[i] = table[:, i] = cost(i)
    return plans[int(np.flatnonzero(alive)[0])]


class Walk:
    """One walk over a tree with a codebook: ``entry`` of every point in tree order, ``balls``
    and ``ball_entry`` the balls found wholly owned, ``left`` the points settled one by one.
    Levels of the tree are treated together; ties go to the lower entry."""

    def __init__(self, tree: BallTree, points: np.ndarray, book: np.ndarray):
        n = len(points)
        self.entry = np.zeros(n, np.int64)
        left = np.zeros(n, bool)
        b = book.astype(float)
        norm = (b ** 2).sum(1)
        gap = np.sqrt(((b[:, None] - b[None]) ** 2).sum(2))
        d = norm - 2 * (tree.center @ b.T)                   # squared distances less that of the origin
        margin = 1e-9 * (norm.max() + (tree.center ** 2).sum(1) + tree.radius ** 2 + 1)
        nodes, cand = np.zeros(min(1, len(tree.lo)), np.int64), np.ones((min(1, len(tree.lo)), len(book)), bool)
        balls, ball_entry = [], []
        while len(nodes):
            masked = np.where(cand, d[nodes], np.inf)
            best = masked.argmin(1)
            reach = 2 * tree.radius[nodes][:, None] * gap[best] + margin[nodes][:, None]
            cand = cand & (masked - masked[np.arange(len(nodes)), best][:, None] <= reach)
            owned = cand.sum(1) == 1
            balls.append(nodes[owned])
            ball_entry.append(best[owned])
            rest = ~owned
            leaf = rest & (tree.first[nodes] < 0)
            for k in nodes[leaf].tolist():
                left[tree.lo[k]:tree.hi[k]] = True
            inner = rest & ~leaf
            nodes, cand = np.concatenate([tree.first[nodes[inner]], tree.second[nodes[inner]]]), np.concatenate([cand[inner], cand[inner]])
        self.balls = np.concatenate(balls) if balls else np.zeros(0, np.int64)
        self.ball_entry = np.concatenate(ball_entry) if balls else np.zeros(0, np.int64)
        for k, e in zip(self.balls.tolist(), self.ball_entry.tolist()):
            self.entry[tree.lo[k]:tree.hi[k]] = e
        self.left = np.flatnonzero(left)
        for at in range(0, len(self.left), 4096):
            some = self.left[at:at + 4096]
            self.entry[some] = ((points[some][:, None] - book[None]) ** 2).sum(2).argmin(1)


def part_sums(tree: BallTree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(count per entry, component sums per entry, points settled by owned balls)."""
    walk = Walk(tree, points, book)
    count, total = np.bincount(walk.entry, minlength=len(book)), np.zeros(book.shape, np.int64)
    np.add.at(total, walk.ball_entry, tree.sums[walk.balls])
    np.add.at(total, walk.entry[walk.left], points[walk.left])
    return count, total, len(points) - len(walk.left)


def _blocks(rows: DataFrame, parts: int, block_rows: int) -> DataFrame:
    """Rows (id, label, v) as blocks: ids, labels and, pickled, the points in tree order and
    the trees of all parts."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
                           T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
                           T.StructField("trees", T.BinaryType())])

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column("v")
        n = batch.num_rows
        flat = v.flatten().to_numpy(zero_copy_only=False)
        if len(flat) % max(n, 1) or (n and len(set(np.diff(v.offsets.to_numpy()).tolist())) > 1):
            raise ValueError("all vectors must have the same length")
        if len(flat) and np.abs(flat).max() >= LIMIT:
            raise ValueError("integer components must be below 2^27 in magnitude")
        x = flat.reshape(n, parts, -1)
        made = []
        for p in range(parts):
            tree = BallTree(x[:, p])
            made.append((tree, x[tree.order, p]))
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column("id")),
             pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column("label")),
             pa.array([pickle.dumps([({k: getattr(t, k) for k in TREE}, y) for t, y in made])], pa.binary())],
            names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, block_rows):
                part = b.slice(at, block_rows)
                if n + part.num_rows > block_rows:
                    yield block(_joined(held))
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield block(_joined(held))

    return rows.mapInArrow(run, schema)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _trees(payload: bytes) -> list[tuple[BallTree, np.ndarray]]:
    out = []
    for fields, points in pickle.loads(payload):
        tree = BallTree.__new__(BallTree)
        tree.__dict__.update(fields)
        out.append((tree, points))
    return out


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The next codebooks: one job, whose result has a row per (part, entry, position)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for payload in batch.column("trees").to_pylist():
                for p, (tree, points) in enumerate(_trees(payload)):
                    c, t, _ = part_sums(tree, points, books[p])
                    count[p] += c
                    total[p] += t
        rows = [(p, e, i, int(count[p][e]), int(total[p][e, i])) for p, b in enumerate(books)
                for e in range(len(b)) for i in range(b.shape[1]) if count[p][e]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*rows) if rows else [[]] * 5, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["p", "e", "i", "n", "s"])

    sums = blocks.select("trees").mapInArrow(run, "p int, e int, i int, n bigint, s bigint")
    out = [b.copy() for b in books]
    for r in sums.groupBy("p", "e", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out[r["p"]][r["e"], r["i"]] = r["s"] // r["n"]
    return out


def _codes(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    schema = T.StructType([T.StructField("id", blocks.schema["ids"].dataType.elementType),
                           T.StructField("label", blocks.schema["labels"].dataType.elementType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = batch.column("ids")[k].values, batch.column("labels")[k].values
                code = np.zeros((len(ids), len(books)), np.int64)
                error = np.zeros(len(ids), np.int64)
                for p, (tree, points) in enumerate(_trees(batch.column("trees")[k].as_py())):
                    entry = Walk(tree, points, books[p]).entry
                    code[tree.order, p] = entry
                    error[tree.order] += ((points - books[p][entry]) ** 2).sum(1)
                hexed = ["".join(f"{c:02x}" for c in row) for row in code.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(hexed), pa.array(error)], names=schema.names)

    return blocks.mapInArrow(run, schema)


def encode(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8,
           entries: int = 16, rounds: int = 6, scale: int = 4096, block_rows: int = 4096) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks). Codes: (id, code, error, label, label_error), the code being two hex
    digits per part and ``label_error`` the error summed over equal labels (nulls together)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256 (two hex digits)")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = df.where((F.size(vector) > 0) & finite).select(
        F.col(id).alias("id"), F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))
    first = [r["v"] for r in rows.where("id is not null").orderBy("id", "v").limit(entries).select("v").collect()]
    if any(len(v) % parts or len(v) != len(first[0]) for v in first):
        raise ValueError("vector lengths must be equal and divisible by the number of parts")
    if not first:                                          # no row to start a codebook with
        none = rows.where("false").select("id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), "label",
                                          F.lit(0).cast("bigint").alias("label_error"))
        return none.withColumnsRenamed({"id": id, "label": label}), [np.zeros((0, 0), np.int64)] * parts
    start = np.array(first, np.int64).reshape(len(first), parts, -1)
    books = [start[:, p] for p in range(parts)]
    blocks = materialize(_blocks(rows, parts, block_rows), "part-trees")
    for _ in range(rounds):
        books = _round(blocks, books)
    codes = materialize(_codes(blocks, books), "part-codes")
    by_label = codes.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    out = codes.join(by_label, F.col("label").eqNullSafe(F.col("l")), "left").select("id", "code", "error", "label", "label_error")
    return out.withColumnsRenamed({"id": id, "label": label}), books


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
