"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id reachable, for every id that has
    an edge to another.

    Each round every node joins the neighbour (or itself) of least priority, priorities
    being hashes so that no numbering of the nodes makes long chains; one pointer jump
    follows, and the edges between the merged nodes form the next, smaller graph. Every
    table is written to the shared checkpoint folder; nodes of any degree are handled by
    grouped minima and joins only."""
    prio = lambda c: F.struct(F.xxhash64(c).alias("p"), F.col(c).alias("v"))
    cur = materialize(edges.where("a != b").select("a", "b").union(edges.where("a != b").select(F.col("b"), F.col("a")))
                      .distinct(), "edges")
    labels = materialize(cur.select(F.col("a").alias("id")).distinct().withColumn("c", F.col("id")), "labels")
    while not cur.isEmpty():
        step = materialize(cur.groupBy("a").agg(F.min(prio("b")).alias("m"))
                           .select("a", F.least(F.col("m"), prio("a"))["v"].alias("c")), "step")
        jump = step.alias("s").join(step.alias("t"), F.col("s.c") == F.col("t.a"), "left").select(
            F.col("s.a").alias("x"), F.coalesce("t.c", "s.c").alias("y"))
        jump = materialize(jump, "jump")
        labels = materialize(labels.join(jump, F.col("c") == F.col("x"), "left")
                             .select("id", F.coalesce("y", "c").alias("c")), "labels")
        left = jump.select(F.col("x").alias("a"), F.col("y").alias("ca"))
        right = jump.select(F.col("x").alias("b"), F.col("y").alias("cb"))
        cur = materialize(cur.join(left, "a").join(right, "b").where("ca != cb")
                          .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "edges")
    least = labels.groupBy("c").agg(F.min("id").alias("component"))
    return materialize(labels.join(least, "c").select("id", "component"), "components")
