"""Exact quantiles without holding a whole group in one task: a mergeable rank sketch
brackets every rank, an exact pass settles it.

Pass 1 is one aggregation with ``percentile_approx``, whose partial sketches merge: per
group the count, the range and, for every quantile, two values whose ranks surely lie on
either side of the wanted one. Pass 2 counts each value inside a bracket and, as one number
each, the values of the stretches between brackets; a running count over these few rows
gives the two ranks around ``q * (n - 1)``, which are interpolated as ``percentile`` does
(numpy's "linear"). Where a bracket of a very large group would still hold more than
``max_band`` times ``SLACK`` values, further sketch passes over the brackets shrink it first.

Both passes shuffle partial aggregates only. The result is checked against its bracket; a
bracket that does not hold its rank (the sketch's error bound makes that impossible) is
widened to the whole range and settled again, so the result is exact in any case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_BAND = 50_000
SLACK = 20
BUCKETS = 512
ACCURACY = 10_000       # ranks of the sketch are off by at most n / ACCURACY

SMALL_STATE = 256


def _null_safe(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner equi-join on ``keys`` that also pairs NULL keys; the keys appear once."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = one if cond is None else cond & one
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def _keep(tgt: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of the per-group state: a local relation when small, else a table
    under the checkpoint folder."""
    rows = tgt.limit(SMALL_STATE + 1).collect()
    if len(rows) <= SMALL_STATE:
        return tgt.sparkSession.createDataFrame(rows, tgt.schema)
    return materialize(tgt, name)


def exact_quantiles_select(df: DataFrame, col: str, qs=(0.25, 0.75), group_by=(), max_band: int = MAX_BAND,
                           buckets: int = BUCKETS, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles per group (a NULL key is a group of its own): columns q25, q75, ...
    NULL and NaN values are left out. The column is scanned twice, so a costly input should
    be a written table."""
    g = list(group_by)
    x = df.where(F.col(col).isNotNull() & ~F.isnan(col)).select(*g, F.col(col).cast("double").alias("_v"))
    bounds = _keep(_bracketed(x, g, qs, max_band, accuracy), "quantile_brackets")
    while not bounds.where(F.greatest(F.lit(0.0), *[F.col(f"est{i}") for i in range(len(qs))]) > max_band * SLACK).isEmpty():
        bounds = _keep(_narrowed(x, bounds, g, qs, buckets, accuracy), "quantile_brackets")
    out = _keep(_settled(x, bounds, g, qs), "quantiles")
    missed = out.where("NOT ok").select(*g)
    if not missed.isEmpty():
        whole = _null_safe(bounds, missed, g) if g else bounds
        whole = whole.withColumns({f"{b}{i}": F.col(end) for i in range(len(qs)) for b, end in (("L", "low"), ("U", "high"))})
        redone = _settled(x, whole, g, qs)
        out = _keep(out.where("ok").unionByName(redone), "quantiles")
    return out.drop("ok")


def _bracketed(x: DataFrame, g, qs, max_band, accuracy) -> DataFrame:
    """Per group n, low, high and per quantile: position, the two ranks, bracket, rows expected in it."""
    eps = 1 / accuracy
    grid = [min(max(q + side * 2 * eps, 0.0), 1.0) for q in qs for side in (-1, 1)]
    s = x.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"),
                          F.percentile_approx("_v", [float(p) for p in grid], accuracy).alias("s")).where("n > 0")
    few = F.col("n") <= max_band
    cols = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("n") - 1).cast("double")
        lo = F.floor(pos).cast("bigint")
        cols += [pos.alias(f"pos{i}"), lo.alias(f"a{i}"), F.least(lo + 1, F.col("n") - 1).alias(f"b{i}"),
                 (F.col("low") if grid[2 * i] <= 0 else F.when(few, F.col("low")).otherwise(F.col("s")[2 * i])).alias(f"L{i}"),
                 (F.col("high") if grid[2 * i + 1] >= 1 else F.when(few, F.col("high")).otherwise(F.col("s")[2 * i + 1])).alias(f"U{i}"),
                 F.when(few, F.col("n").cast("double")).otherwise(F.col("n") * 6 * eps).alias(f"est{i}")]
    return s.select(*g, "n", "low", "high", *cols)


def _regions(x: DataFrame, bounds: DataFrame, g, qs) -> DataFrame:
    """Each value with its region (rising with the value, one per bracket or stretch between)
    and, inside a bracket, itself as ``val``."""
    j = _null_safe(x, bounds, g) if g else _with_constants(x, bounds)
    m = range(len(qs))
    region = sum(((F.col("_v") >= F.col(f"L{i}")).cast("int") + (F.col("_v") > F.col(f"U{i}")).cast("int") for i in m), F.lit(0))
    inside = F.col("_v").between(F.col("L0"), F.col("U0"))
    for i in m[1:]:
        inside = inside | F.col("_v").between(F.col(f"L{i}"), F.col(f"U{i}"))
    return j.withColumn("region", region).withColumn("val", F.when(inside, F.col("_v")))


def _with_constants(x: DataFrame, bounds: DataFrame) -> DataFrame:
    """The one row of ``bounds`` as constant columns."""
    row = bounds.first()
    if row is None:
        return x.where(F.lit(False)).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in bounds.schema.fields])
    return x.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in bounds.schema.fields])


def _settled(x: DataFrame, bounds: DataFrame, g, qs) -> DataFrame:
    counts = _regions(x, bounds, g, qs).groupBy(*g, "region", "val").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*g).orderBy("region", F.col("val").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("upto", F.sum("c").over(w))
    ranks = bounds.select(*g, "n", *[c for i in range(len(qs)) for c in (f"pos{i}", f"a{i}", f"b{i}")])
    cum = _null_safe(cum, ranks, g) if g else _with_constants(cum, ranks)
    at = lambda k: F.min(F.when(F.col("upto") > F.col(k), F.struct("upto", "val")))["val"]
    picked = cum.groupBy(*g).agg(*[e for i in range(len(qs)) for e in (
        at(f"a{i}").alias(f"x{i}"), at(f"b{i}").alias(f"y{i}"), F.first(f"pos{i}").alias(f"pos{i}"))], F.count(F.lit(1)).alias("_rows"))
    picked = picked.where("_rows > 0")
    ok, cols = F.lit(True), []
    for i, q in enumerate(qs):
        x_, y_, p = F.col(f"x{i}"), F.col(f"y{i}"), F.col(f"pos{i}")
        fl, ce = F.floor(p), F.ceil(p)
        cols.append(F.when((fl == ce) | (x_ == y_), x_).otherwise((ce - p) * x_ + (p - fl) * y_).alias(f"q{int(round(q * 100)):02d}"))
        ok = ok & x_.isNotNull() & y_.isNotNull()
    return picked.select(*g, *cols, ok.alias("ok"))


def _narrowed(x: DataFrame, bounds: DataFrame, g, qs, buckets, accuracy) -> DataFrame:
    """Brackets after one more sketch pass: per region a grid of quantiles, from which the two
    values around each rank pair are taken."""
    eps = 1 / accuracy
    grid = [k / buckets for k in range(buckets + 1)]
    r = _regions(x, bounds, g, qs).groupBy(*g, "region").agg(
        F.count(F.lit(1)).alias("c"), F.min("_v").alias("least"), F.max("_v").alias("most"),
        F.percentile_approx("val", grid, accuracy).alias("s"))
    w = Window.partitionBy(*g).orderBy("region").rowsBetween(Window.unboundedPreceding, 0)
    cum = r.withColumn("upto", F.sum("c").over(w))
    cum = _null_safe(cum, bounds, g) if g else _with_constants(cum, bounds)
    hit = lambda k: F.min(F.when(F.col("upto") > F.col(k), F.struct("upto", "c", "least", "most", "s")))
    picked = cum.groupBy(*g).agg(*[e for i in range(len(qs)) for e in (hit(f"a{i}").alias(f"h{i}"), hit(f"b{i}").alias(f"j{i}"))],
                                 *[F.first(c).alias(c) for c in bounds.columns if c not in g])
    cols = {}
    for i in range(len(qs)):
        h, j = F.col(f"h{i}"), F.col(f"j{i}")
        spot = lambda t, k: (F.col(k) - (t["upto"] - t["c"]) + 0.5) / t["c"]
        lo = F.floor((spot(h, f"a{i}") - 2 * eps) * buckets).cast("int")
        hi = F.ceil((spot(j, f"b{i}") + 2 * eps) * buckets).cast("int")
        cols[f"L{i}"] = F.when((lo <= 0) | h["s"].isNull(), h["least"]).otherwise(F.get(h["s"], F.greatest(lo, F.lit(0))))
        cols[f"U{i}"] = F.when((hi >= buckets) | j["s"].isNull(), j["most"]).otherwise(F.get(j["s"], F.least(hi, F.lit(buckets))))
        # one value, or ends that no longer move: heavily repeated values, of which few differ
        still = (cols[f"L{i}"] == F.col(f"L{i}")) & (cols[f"U{i}"] == F.col(f"U{i}")) | (cols[f"L{i}"] == cols[f"U{i}"])
        cols[f"est{i}"] = F.when(still, F.lit(0.0)).when(h["upto"] == j["upto"], h["c"] * (3 / buckets + 6 * eps)).otherwise(h["c"] * (2 / buckets + 4 * eps) * 2)
    return picked.withColumns(cols).select(*bounds.columns)
