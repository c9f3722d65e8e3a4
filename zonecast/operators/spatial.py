"""Spatial operators: point-in-polygon join, polygon centroids, centroid lookups.

Point-in-polygon join plan
--------------------------
Points are never compared with every polygon. The polygon layer (small) is turned into
a cell index (``cell_size`` degrees): for each polygon part, the cells that can hold an
inside point, flagged ``interior`` when the whole cell is inside (no test at all) and
otherwise carrying only the edges of the cell's row band that a ray towards +x can meet.
Each point gets the one cell it falls in (``floor``), the two sides are equi-joined on
the cell key, and only boundary-cell candidates run the exact predicate (crossing
parity + boundary exclusion) over their few edges. With the index broadcast (its row
count is checked first) the points are read once, never shuffled, and the join is a
``BroadcastHashJoin``; above the limit the same plan runs as a shuffled join on the cell
key, where AQE splits skewed cells. Per point the cost no longer grows with the number of
polygon vertices, which is what dominates with real district outlines at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo

DEFAULT_CELL_SIZE = 0.01
# Rows of the polygon-cell table above which it is not broadcast (about 100 bytes per
# vertex-free row plus the ring arrays; the check keeps it far below executor memory).
BROADCAST_MAX_CELLS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20   # of the cell table: every cell row carries rings or edges
# Polygon parts with at most this many vertices are tested whole (no cell index).
SIMPLE_MAX_VERTICES = 64


def polygon_cells(polygons: DataFrame, cell_size: float = DEFAULT_CELL_SIZE,
                  name_col: str = "cd_name") -> DataFrame:
    """One row per (polygon part, covering cell): name, part_id, rings, _cx, _cy."""
    b = geo.ring_bounds("rings")
    cs = F.lit(float(cell_size))
    return (polygons
            .select(name_col, "part_id", "rings",
                    F.floor(b["minx"] / cs).alias("_x0"), F.floor(b["maxx"] / cs).alias("_x1"),
                    F.floor(b["miny"] / cs).alias("_y0"), F.floor(b["maxy"] / cs).alias("_y1"))
            .withColumn("_cx", F.explode(F.sequence("_x0", "_x1")))
            .withColumn("_cy", F.explode(F.sequence("_y0", "_y1")))
            .drop("_x0", "_x1", "_y0", "_y1"))


def polygon_cell_index(polygons: DataFrame, cell_size: float = DEFAULT_CELL_SIZE,
                       name_col: str = "cd_name") -> DataFrame:
    """Cell index of a polygon layer: one row per (polygon part, cell) that can hold an
    inside point, with ``interior`` (every point of the cell is strictly inside: no test
    needed) or, for boundary cells, ``edges``: the part's edges (all rings) whose y-range
    meets the cell's row and which reach the cell's column or further right - exactly the
    edges a ray from a point of the cell towards +x can cross or touch.

    Built on the polygon side only (small): every edge is assigned to the cells of its
    rows from the part's leftmost column to its own rightmost column; a cell is a
    boundary cell when some edge's bounding box covers it; a cell without any covering
    edge is uniform and classified once by its centre. Cells without edges are outside.
    """
    cs = F.lit(float(cell_size))
    rings = polygons.select(name_col, "part_id", F.explode("rings").alias("ring"))
    edges = rings.select(name_col, "part_id", F.explode(F.arrays_zip(
        F.slice("ring", 1, F.size("ring") - 1).alias("a"), F.slice("ring", 2, F.size("ring") - 1).alias("b")))
        .alias("e")).select(name_col, "part_id", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"),
                            F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))
    left = polygons.select(name_col, "part_id", F.floor(geo.ring_bounds("rings")["minx"] / cs).alias("_c0"))
    e = edges.join(left, [name_col, "part_id"])
    ec = e.select(name_col, "part_id", "ax", "ay", "bx", "by",
                  F.floor(F.least("ax", "bx") / cs).alias("_ex0"),
                  F.explode(F.sequence(F.floor(F.least("ay", "by") / cs), F.floor(F.greatest("ay", "by") / cs)))
                  .alias("_cy"),
                  F.sequence(F.col("_c0"), F.floor(F.greatest("ax", "bx") / cs)).alias("_cols"))
    ec = ec.select("*", F.explode("_cols").alias("_cx")).drop("_cols")
    edge = F.struct("ax", "ay", "bx", "by")
    cells = ec.groupBy(name_col, "part_id", "_cx", "_cy").agg(
        F.collect_list(edge).alias("edges"),
        F.max((F.col("_cx") >= F.col("_ex0")).cast("int")).alias("_boundary"))
    cx = (F.col("_cx").cast("double") + F.lit(0.5)) * cs
    cy = (F.col("_cy").cast("double") + F.lit(0.5)) * cs
    centre_in = (geo.edges_crossings("edges", cx, cy) % 2) == 1
    interior = (F.col("_boundary") == 0) & centre_in
    out = cells.where((F.col("_boundary") == 1) | centre_in)
    return out.select(name_col, "part_id", "_cx", "_cy", interior.alias("interior"),
                      F.when(interior, F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>"))
                       .otherwise(F.col("edges")).alias("edges"))


def bounded_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only if its counted size is within ``max_rows``."""
    n = df.count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def district_ids(polygons: DataFrame, name_col: str = "cd_name", id_col: str = "district_id") -> DataFrame:
    """Dense integer id per polygon name (name order): one row per district, a small
    dimension used to attach names after aggregating by id."""
    from pyspark.sql import Window
    names = polygons.select(name_col).distinct()
    return names.withColumn(id_col, F.row_number().over(Window.orderBy(name_col)).cast("int"))


def spatial_within_join(points: DataFrame, polygons: DataFrame, lon: str = "Lon", lat: str = "Lat",
                        name_col: str = "cd_name", cell_size: float = DEFAULT_CELL_SIZE,
                        broadcast_max_cells: int = BROADCAST_MAX_CELLS, method: str = "auto",
                        key: str = "name") -> DataFrame:
    """Points strictly within polygons (inner join; one row per point and hit polygon).

    ``polygons``: name, part_id, rings (see :mod:`zonecast.functions.geo`). A point on a
    boundary is in no polygon; a point in the overlap of two districts yields two rows.
    method="index" joins with :func:`polygon_cell_index`: interior cells need no test and
    boundary cells test only their row band's edges. method="bbox" tests every ring
    vertex of each candidate polygon. method="auto" (default) looks at the largest
    polygon part (one aggregate over the small polygon table): up to
    ``SIMPLE_MAX_VERTICES`` vertices the per-point cost of both is the same and the bbox
    form needs no index build; beyond it the index is used.

    key="id": the output carries ``district_id`` (INT, see :func:`district_ids`) instead of
    the name, so that the following aggregation hashes an integer per point; attach the
    names after aggregating (one row per district and hour).
    """
    if key == "id":
        ids = district_ids(polygons, name_col)
        polygons = polygons.join(ids, name_col).drop(name_col) \
                           .withColumnRenamed("district_id", name_col)
    # one small aggregate over the polygon table: its complexity (for method="auto") and
    # the number of bounding-box cells, which is the exact row count of the bbox cell
    # table and an upper bound of the index (for the broadcast check)
    b = geo.ring_bounds("rings")
    csl = F.lit(float(cell_size))
    n_cells_expr = ((F.floor(b["maxx"] / csl) - F.floor(b["minx"] / csl) + 1)
                    * (F.floor(b["maxy"] / csl) - F.floor(b["miny"] / csl) + 1))
    meta = polygons.agg(F.max(F.size(F.flatten("rings"))).alias("nv"), F.sum(n_cells_expr).alias("nc"),
                        F.sum(n_cells_expr * (F.size(F.flatten("rings")) * 24 + 100)).alias("nb")).first()
    nv, n_cells, n_bytes = (meta["nv"] or 0), (meta["nc"] or 0), (meta["nb"] or 0)
    small = n_cells <= broadcast_max_cells and n_bytes <= BROADCAST_MAX_BYTES
    if method == "auto":
        method = "bbox" if nv <= SIMPLE_MAX_VERTICES else "index"
    cs = F.lit(float(cell_size))
    pts = (points.withColumn("_cx", F.floor(F.col(lon) / cs))
                 .withColumn("_cy", F.floor(F.col(lat) / cs)))
    if method == "index":
        idx = polygon_cell_index(polygons, cell_size, name_col)
        right = F.broadcast(idx) if small else idx
        hit = F.col("interior") | geo.point_within_edges("edges", F.col(lon), F.col(lat))
        out = (pts.join(right, ["_cx", "_cy"], "inner").where(hit)
                  .drop("_cx", "_cy", "edges", "interior", "part_id"))
    else:
        cells = polygon_cells(polygons, cell_size, name_col)
        right = F.broadcast(cells) if small else cells
        hit = geo.point_within(F.col("rings"), F.col(lon), F.col(lat))
        out = (pts.join(right, ["_cx", "_cy"], "inner").where(hit)
                  .drop("_cx", "_cy", "rings", "part_id"))
    return out.withColumnRenamed(name_col, "district_id") if key == "id" else out


def polygon_centroids(polygons: DataFrame, name_col: str = "cd_name") -> DataFrame:
    """Area centroid per name, computed in EPSG:3857 and returned as lat/lon degrees.

    Exterior rings count positively and holes negatively (by absolute area), summed over
    all parts of a multipolygon.
    """
    rings = polygons.select(name_col, F.posexplode("rings").alias("ring_idx", "ring"))
    m = rings.select(name_col, "ring_idx", geo.ring_area_moments("ring").alias("m"))
    sign = F.when(F.col("ring_idx") == 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.signum(F.col("m.a"))
    # centroid of the ring = (x0 + ax/a, y0 + ay/a); weight = |a| signed by role
    w = sign * F.col("m.a")
    cx = F.col("m.x0") + F.col("m.ax") / F.col("m.a")
    cy = F.col("m.y0") + F.col("m.ay") / F.col("m.a")
    agg = (m.where(F.col("m.a") != 0)
             .groupBy(name_col)
             .agg(F.sum(w * cx).alias("_wx"), F.sum(w * cy).alias("_wy"), F.sum(w).alias("_w")))
    return agg.select(name_col,
                      geo.mercator_lat(F.col("_wy") / F.col("_w")).alias("lat"),
                      geo.mercator_lon(F.col("_wx") / F.col("_w")).alias("lon"))


def centroid_join(preds: DataFrame, centroids: DataFrame, left_key: str = "district",
                  right_key: str = "cd_name", broadcast_max_rows: int = 1_000_000) -> DataFrame:
    """Predictions joined to polygon centroids (inner). Centroids hold one row per
    polygon name; they are broadcast after their row count is checked."""
    right, _ = bounded_broadcast(centroids, broadcast_max_rows)
    return preds.join(right, preds[left_key] == centroids[right_key], "inner")
