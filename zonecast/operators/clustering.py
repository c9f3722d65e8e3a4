"""Spatial clustering of pickup points (SURVEY 2.6 ``sample_n``; 2.9 ``kmeans_elbow``,
``kmeans_assign``; 2.4 ``cluster_summary``, ``cluster_radius``; 2.3 ``cluster_left_join``).

The elbow is mini-batch k-means for all k at once: every job assigns one batch to the centres
of every k, and per-centre counts set the learning rates. The clusters themselves come from
``pyspark.ml.clustering.KMeans`` (distributed Lloyd iterations, k-means||
initialisation). Centres (k rows) are the only thing brought to the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

# Elbow range 3..15, the 100,000-point sample with seed 42, k = 10, batches of 10,000.
ELBOW_K = range(3, 16)
SAMPLE_N = 100_000
SEED = 42
K = 10
BATCH = 10_000
EPOCHS = 3          # passes over the batches at most


def sample_n(df: DataFrame, n: int = SAMPLE_N, seed: int = SEED, id_col: str = "event_id") -> DataFrame:
    """Exactly min(n, count) rows: those of least md5 of "<id>:<seed>" (ties by id).

    A pre-filter on the leading 32 hash bits lets about n + 6 sqrt(n) rows through, so the
    final top-n sees little more than n. Should fewer than n pass (about one draw in 10^9),
    all rows are ordered instead, with the same result by definition.
    """
    total = df.count()
    h = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    hashed = df.withColumn("_h", h)
    share = (n + 6 * math.sqrt(n) + 20) / max(1, total)
    if share < 1:
        cut = f"{int(share * (1 << 32)):08x}"
        pre = hashed.where(F.col("_h") < cut)
        if pre.count() >= n:
            hashed = pre
    return hashed.orderBy("_h", id_col).limit(n).drop("_h")


def _vec(df, lat="Lat", lon="Lon"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=[lat, lon], outputCol="features").transform(df)


def _seeds(xy: np.ndarray, k: int, rng: np.random.Generator, tries: int = 3, rounds: int = 10) -> np.ndarray:
    """k-means++ centres (each drawn by its squared distance to those before it), moved by a few
    rounds over the seed points; the best of ``tries``."""
    best = (np.inf, xy[:1])
    for _ in range(tries):
        c = xy[rng.integers(len(xy))][None]
        d = ((xy - c[0]) ** 2).sum(1)
        while len(c) < k:
            at = rng.choice(len(xy), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(xy))
            c = np.vstack([c, xy[at]])
            d = np.minimum(d, ((xy - c[-1]) ** 2).sum(1))
        for _ in range(rounds):
            near = ((xy[:, None] - c[None]) ** 2).sum(2).argmin(1)
            n = np.bincount(near, minlength=k)
            sums = np.stack([np.bincount(near, xy[:, i], k) for i in (0, 1)], axis=1)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        cost = float(((xy[:, None] - c[None]) ** 2).sum(2).min(1).sum())
        if cost < best[0]:
            best = (cost, c)
    return best[1]


def _cluster_sums(points: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """(k, c, n, lat, lon, d): per task and centre of every k the points nearest to it (the
    smaller number of equally near ones), their sums and squared distances."""
    centres = {k: c.copy() for k, c in centres.items()}

    def run(batches):
        total = {k: np.zeros((len(c), 4)) for k, c in centres.items()}
        for b in batches:
            xy = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
            for k, c in centres.items():
                d = (xy[:, :1] - c[:, 0]) ** 2 + (xy[:, 1:] - c[:, 1]) ** 2
                near = d.argmin(1)
                for i, w in enumerate((None, xy[:, 0], xy[:, 1], d[np.arange(len(xy)), near])):
                    total[k][:, i] += np.bincount(near, w, len(c))
        rows = [(k, i, int(t[0]), *map(float, t[1:])) for k, ts in total.items() for i, t in enumerate(ts) if t[0]]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        cols = zip(*rows) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["k", "c", "n", "lat", "lon", "d"])

    return points.select("Lat", "Lon").mapInArrow(run, "k int, c int, n bigint, lat double, lon double, d double")


def minibatch_kmeans(points: DataFrame, ks=ELBOW_K, batch: int = BATCH, epochs: int = EPOCHS, seed: int = SEED,
                     id_col: str = "event_id", tol: float = 1e-6) -> tuple[dict[int, np.ndarray], DataFrame]:
    """({k: centres}, table (k, inertia)) for all ``ks`` from one run over batches of about
    ``batch`` points. A batch moves each centre towards the mean of its points by the share that
    they have in all points the centre has seen. Passes over the batches end when no centre of any
    k has moved by more than ``tol`` over a whole pass, or after ``epochs``.

    Seeds come from at most one batch's worth of points; a batch's job returns one row
    per (k, centre)."""
    ks = [int(k) for k in ks]
    spark = points.sparkSession
    pts = points.where(F.col("Lat").isNotNull() & F.col("Lon").isNotNull()).select(
        F.col("Lat").cast("double").alias("Lat"), F.col("Lon").cast("double").alias("Lon"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("_h"))
    path = materialize(pts, "kmeans_points")
    total = path.count()
    if not total:
        return {}, spark.createDataFrame([], "k int, inertia double")
    n_batches = max(1, round(total / batch))
    # batches of their own files, so that a step reads its batch only
    whole = scratch_path(spark, "kmeans_batches")
    (path.withColumn("_b", F.pmod("_h", F.lit(n_batches))).repartition(n_batches, "_b")
         .write.option("maxRecordsPerFile", 4 * batch).partitionBy("_b").parquet(whole))
    rng = np.random.default_rng(seed)
    first = np.array([[r["Lat"], r["Lon"]] for r in path.orderBy("_h", "Lat", "Lon").limit(batch).collect()])
    centres = {k: _seeds(first, k, rng) for k in ks}
    seen = {k: np.zeros(k) for k in ks}
    table = spark.read.parquet(whole)

    for _ in range(epochs):
        before = {k: centres[k].copy() for k in ks}
        for b in range(n_batches):
            got: dict = {}
            for r in _cluster_sums(table.where(F.col("_b") == b), centres).collect():     # sum(ks) rows per task of a batch
                at = got.setdefault((r["k"], r["c"]), np.zeros(3))
                at += (r["n"], r["lat"], r["lon"])
            for (k, c), (n, lat, lon) in got.items():
                seen[k][c] += n
                at = centres[k][c]
                at += (np.array([lat, lon]) - n * at) / seen[k][c]
        if max(float(np.abs(centres[k] - before[k]).max()) for k in ks) <= tol:
            break
    return centres, _cluster_sums(table, centres).groupBy("k").agg(F.sum("d").alias("inertia"))


def kmeans_elbow(points: DataFrame, ks=ELBOW_K, n: int = SAMPLE_N, seed: int = SEED) -> DataFrame:
    """Within-cluster sum of squares for each k on a reproducible sample, by mini-batches."""
    return minibatch_kmeans(sample_n(points, n, seed).select("event_id", "Lat", "Lon"), ks, seed=seed)[1]


def kmeans_assign(points: DataFrame, k: int = K, seed: int = SEED):
    """(points with Cluster, centroids DataFrame(Cluster, Centroid_Lat, Centroid_Lon))."""
    from pyspark.ml.clustering import KMeans
    spark = points.sparkSession
    v = _vec(points)
    m = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="Cluster").fit(v)
    cents = spark.createDataFrame([(i, float(c[0]), float(c[1])) for i, c in enumerate(m.clusterCenters())],
                                  "Cluster int, Centroid_Lat double, Centroid_Lon double")
    return m.transform(v).drop("features"), cents


def assign_nearest(points: DataFrame, cents: DataFrame) -> DataFrame:
    """``points`` with the ``Cluster`` of the nearest of the given centres (k rows, brought to
    the driver; of equally near ones the smaller number)."""
    def gap(c):
        return F.pow(F.col("Lat") - c["Centroid_Lat"], 2) + F.pow(F.col("Lon") - c["Centroid_Lon"], 2)
    near = F.array_min(F.array(*[F.struct(gap(c).alias("d"), F.lit(c["Cluster"]).alias("k")) for c in cents.collect()]))
    return points.withColumn("Cluster", near["k"])


def cluster_report(assigned: DataFrame, cents: DataFrame) -> DataFrame:
    """Count, share, mean point and mean distance to the centre of every centroid's cluster,
    in one grouped pass over the points, left-joined to the centroids (k rows, broadcast)."""
    c = F.broadcast(cents)
    d = F.sqrt(F.pow(F.col("Lat") - F.col("Centroid_Lat"), 2) + F.pow(F.col("Lon") - F.col("Centroid_Lon"), 2))
    s = assigned.join(c, "Cluster").groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("Pickups"), F.avg("Lat").alias("Avg_Lat"), F.avg("Lon").alias("Avg_Lon"),
        F.bround(F.avg(d), 4).alias("Radius"))
    s = s.withColumn("Pct_of_Total", F.bround(F.col("Pickups") / F.sum("Pickups").over(Window.partitionBy(F.lit(1))) * 100, 2))
    return cents.join(s, "Cluster", "left").select("Cluster", "Pickups", "Pct_of_Total", "Avg_Lat", "Avg_Lon", "Radius")


def cluster_summary(assigned: DataFrame) -> DataFrame:
    tot = assigned.agg(F.count(F.lit(1))).scalar()
    s = assigned.groupBy("Cluster").agg(F.count(F.lit(1)).alias("Pickups"), F.avg("Lat").alias("Avg_Lat"),
                                        F.avg("Lon").alias("Avg_Lon"))
    return s.withColumn("Pct_of_Total", F.bround(F.col("Pickups") / tot * 100, 2))


def cluster_radius(assigned: DataFrame, cents: DataFrame) -> DataFrame:
    """Mean Euclidean distance (degrees) to the cluster centre, 4 decimals. Centres are k
    rows: broadcast."""
    j = assigned.join(F.broadcast(cents), "Cluster")
    d = F.sqrt(F.pow(F.col("Lat") - F.col("Centroid_Lat"), 2) + F.pow(F.col("Lon") - F.col("Centroid_Lon"), 2))
    return j.groupBy("Cluster").agg(F.bround(F.avg(d), 4).alias("Radius"))


def kmeans_report(points: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """Cluster, Pickups, Pct_of_Total, Avg_Lat, Avg_Lon, Radius: centroids left-joined
    with the per-cluster statistics."""
    assigned, cents = kmeans_assign(points, k, seed)
    return cluster_report(assigned, cents)
