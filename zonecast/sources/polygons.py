"""Polygon layers: GeoJSON reader and the fallback grid.

Output schema everywhere: ``cd_name STRING, part_id INT, rings ARRAY<ARRAY<STRUCT<x,y>>>``
(plus any feature properties for the GeoJSON reader). Polygon layers are small
dimension tables (tens to thousands of districts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import district_name

# Fallback grid of the exploration step, lon -74.05..-73.70,
# lat 40.55..40.95, 5 x 5 cells named Grid_i_j (i along longitude, j along latitude).
GRID_BOUNDS = (-74.05, 40.55, -73.70, 40.95)
GRID_N = 5

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))


def grid_polygons(spark: SparkSession, bounds=GRID_BOUNDS, n: int = GRID_N) -> DataFrame:
    """n x n rectangular cells over ``bounds`` as closed rings."""
    x_min, y_min, x_max, y_max = bounds
    x_step = (x_max - x_min) / n
    y_step = (y_max - y_min) / n
    i = (F.col("id") / n).cast("bigint")
    j = F.col("id") % n
    x0 = F.lit(x_min) + i.cast("double") * F.lit(x_step)
    x1 = F.lit(x_min) + (i + 1).cast("double") * F.lit(x_step)
    y0 = F.lit(y_min) + j.cast("double") * F.lit(y_step)
    y1 = F.lit(y_min) + (j + 1).cast("double") * F.lit(y_step)

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))
    return (spark.range(n * n)
            .select(F.concat(F.lit("Grid_"), i.cast("string"), F.lit("_"), j.cast("string")).alias("cd_name"),
                    F.lit(0).alias("part_id"),
                    F.array(ring).cast(RINGS).alias("rings")))


_FEATURES_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),   # raw JSON, parsed per type
        ])),
    ]))),
])


def _close(ring):
    """Append the first vertex when a ring is not closed."""
    first = F.get(ring, 0)
    last = F.get(ring, F.size(ring) - 1)
    return F.when((first["x"] == last["x"]) & (first["y"] == last["y"]), ring) \
            .otherwise(F.concat(ring, F.array(first)))


def scan_polygons(spark: SparkSession, path: str, name_col: str | None = None) -> DataFrame:
    """Read a GeoJSON FeatureCollection (EPSG:4326) into the ring schema.

    The district name comes from ``name_col`` if given, else ``cd_name`` if present,
    else from ``boro_cd`` (with ``boro_name`` when present) by
    :func:`zonecast.functions.scalars.district_name`.
    """
    raw = spark.read.schema(_FEATURES_SCHEMA).option("multiLine", True).json(path)
    feats = raw.select(F.posexplode("features").alias("feature_id", "f"))
    poly = F.from_json(F.col("f.geometry.coordinates"), "array<array<array<double>>>")
    multi = F.from_json(F.col("f.geometry.coordinates"), "array<array<array<array<double>>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(poly)) \
             .when(F.col("f.geometry.type") == "MultiPolygon", multi)
    props = F.col("f.properties")
    if name_col:
        name = props[name_col]
    else:
        name = F.coalesce(props["cd_name"],
                          F.when(props["boro_name"].isNotNull(),
                                 district_name(props["boro_cd"], "survey", boro_name=props["boro_name"])),
                          district_name(props["boro_cd"], "features"),
                          F.concat(F.lit("CD_"), F.col("feature_id").cast("string")))
    out = (feats.select(name.alias("cd_name"), props.alias("properties"),
                        F.posexplode(parts).alias("part_id", "part"))
                .select("cd_name", "properties", "part_id",
                        F.transform("part", lambda r: _close(F.transform(
                            r, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))))
                         .cast(RINGS).alias("rings")))
    return out.where(F.size(F.get("rings", 0)) >= 4)
