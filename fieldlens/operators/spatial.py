"""D3: point-in-polygon join (stations within counties).

Spark has no containment predicate, so the join is an equi join on grid cells
followed by the even-odd ray-crossing rule on the polygon edges:

1. each polygon's bounding box is exploded into the grid cells it covers
   (bounded by box area / cell area per polygon) and equi-joined to the
   point's cell, then filtered by the box: candidate (point, polygon) pairs;
2. each edge is exploded into the horizontal bands (grid rows) it spans and
   equi-joined to the candidates on (polygon, band); a horizontal ray from the
   point toward +x crosses the edge when the edge straddles the point's
   latitude and meets the ray to the right of the point;
3. one aggregate per (point, polygon) counts crossings and on-edge hits: the
   point is within when the count is odd and it lies on no edge (a point on
   the boundary is not "within").

Holes and multi-part polygons need nothing extra: the even-odd rule over all
rings of a polygon handles them.  No pair of points or of edges is formed;
skewed cells are handled by AQE's skew join (the edge side is replicated).

:func:`polygon_cover` and :func:`points_in_cover` are the form for many points:
a written cover of every polygon by hierarchical cells sized from the polygon
itself.  Points in inner cells need no ray test and no exchange beyond the
lookup; only points in cells that an edge crosses are tested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import materialize

DEPTH = 5

def _cells(lo, hi, cell: float):
    return F.sequence(F.floor(lo / F.lit(cell)).cast("bigint"),
                      F.floor(hi / F.lit(cell)).cast("bigint"))


def _ray():
    """(the ray from (_px, _py) toward +x crosses the edge, the point lies on it)."""
    px, py = F.col("_px"), F.col("_py")
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    straddles = (y1 > py) != (y2 > py)
    x_at = F.try_divide((x2 - x1) * (py - y1), y2 - y1) + x1
    crosses = F.when(straddles, px < x_at).otherwise(F.lit(False))
    on_edge = (
        ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1))
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )
    return crosses, on_edge


def points_in_polygons(
    points: DataFrame,
    edges: DataFrame,
    *,
    point_id: str = "id",
    x: str = "longitude",
    y: str = "latitude",
    polygon_id: str = "geoid",
    cell: float = 1.0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pairs (polygon_id, point_id, *carry) with the point strictly inside the
    polygon.  Points with a null coordinate never match."""
    pts = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(point_id).alias("_pid"),
        F.col(x).alias("_px"),
        F.col(y).alias("_py"),
        *carry,
        F.floor(F.col(x) / F.lit(cell)).cast("bigint").alias("_cx"),
        F.floor(F.col(y) / F.lit(cell)).cast("bigint").alias("_cy"),
    )
    e = edges.select(F.col(polygon_id).alias("_g"), "x1", "y1", "x2", "y2")
    bbox = e.groupBy("_g").agg(
        F.min(F.least("x1", "x2")).alias("_x0"), F.max(F.greatest("x1", "x2")).alias("_x1"),
        F.min(F.least("y1", "y2")).alias("_y0"), F.max(F.greatest("y1", "y2")).alias("_y1"),
    )
    cells = (
        bbox.withColumn("_cx", F.explode(_cells(F.col("_x0"), F.col("_x1"), cell)))
        .withColumn("_cy", F.explode(_cells(F.col("_y0"), F.col("_y1"), cell)))
    )
    cand = pts.join(cells, ["_cx", "_cy"]).where(
        F.col("_px").between(F.col("_x0"), F.col("_x1"))
        & F.col("_py").between(F.col("_y0"), F.col("_y1"))
    ).select("_pid", "_px", "_py", *carry, "_cy", "_g")

    bands = e.withColumn(
        "_cy", F.explode(_cells(F.least("y1", "y2"), F.greatest("y1", "y2"), cell))
    )
    j = cand.join(bands, ["_g", "_cy"])
    crosses, on_edge = _ray()
    agg = j.groupBy("_g", "_pid", *carry).agg(
        F.count_if(crosses).alias("_n"), F.count_if(on_edge).alias("_on")
    )
    inside = agg.where((F.col("_n") % 2 == 1) & (F.col("_on") == 0))
    return inside.select(F.col("_g").alias(polygon_id), F.col("_pid").alias(point_id), *carry)


# ---- cover by hierarchical cells -----------------------------------------

def _side(exp):
    """Cells of level ``exp`` have the side 2^exp, so that dividing a coordinate
    by it is exact and a point's cell never depends on rounding."""
    return F.pow(F.lit(2.0), exp.cast("double"))


def _at(value, exp):
    return F.floor(value / _side(exp)).cast("bigint")


def _shapes(e: DataFrame, depth: int) -> DataFrame:
    """Per polygon: the top level (a cell is at least as wide as the polygon),
    the finest level, and horizontal bands, as many as keep the edges' entries
    below twice their number."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    shape = e.groupBy("_g").agg(
        (F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))).alias("_w"),
        F.min(low).alias("_y0"), (F.max(high) - F.min(low)).alias("_height"),
        F.max(F.greatest(*(F.abs(c) for c in ("x1", "y1", "x2", "y2")))).alias("_far"),
        F.count(F.lit(1)).alias("_n"), F.sum(high - low).alias("_rise"),
    ).where((F.col("_w") > 0) & (F.col("_height") > 0))
    top = F.ceil(F.log2(F.greatest("_w", "_height")) + 1e-9).cast("int")
    finest = F.greatest(top - depth, F.ceil(F.log2("_far")).cast("int") - 30)
    bands = F.greatest(F.lit(1), F.floor(F.col("_n") * F.col("_height") / F.col("_rise"))).cast("bigint")
    return shape.select("_g", top.alias("_top"), F.least(top, finest).alias("_fine"), "_y0",
                        (F.col("_height") / bands).alias("_step"), bands.alias("_bands"))


def _band(y):
    """Band of ``y`` in its polygon; never falls as y grows, so a point's band is
    one of those of every edge that its ray can meet."""
    return F.greatest(F.lit(0), F.least(F.col("_bands") - 1, F.floor((y - F.col("_y0")) / F.col("_step")))).cast("bigint")


def _edge_bands(e: DataFrame, shapes: DataFrame) -> DataFrame:
    s = e.join(shapes, "_g")
    return s.select("_g", "x1", "y1", "x2", "y2", F.explode(
        F.sequence(_band(F.least("y1", "y2")), _band(F.greatest("y1", "y2")))).alias("_band"))


def _edge_cells(e: DataFrame, shapes: DataFrame) -> DataFrame:
    """(polygon, level, cell) of every cell that an edge may touch, from the
    finest level to the top one.  An edge is clipped to each column of cells;
    a slack of a 1024th of the side is far above the clipping's rounding."""
    s = e.join(shapes, "_g").withColumn("_s", _side(F.col("_fine")))
    x0, x9 = F.least("x1", "x2"), F.greatest("x1", "x2")
    y0, y9 = F.least("y1", "y2"), F.greatest("y1", "y2")
    s = s.withColumn("_cx", F.explode(F.sequence(_at(x0, F.col("_fine")), _at(x9, F.col("_fine")))))
    left = F.greatest(x0, F.col("_cx") * F.col("_s"))
    right = F.least(x9, (F.col("_cx") + 1) * F.col("_s"))
    rise = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    ya = F.coalesce(F.col("y1") + (left - F.col("x1")) * rise, F.col("y1"))
    yb = F.coalesce(F.col("y1") + (right - F.col("x1")) * rise, F.col("y2"))
    slack = F.col("_s") / 1024
    s = s.withColumn("_cy", F.explode(F.sequence(
        _at(F.greatest(F.least(ya, yb) - slack, y0), F.col("_fine")),
        _at(F.least(F.greatest(ya, yb) + slack, y9), F.col("_fine")))))
    fine = s.select("_g", "_top", "_fine", "_cx", "_cy").distinct()
    up = fine.withColumn("_up", F.explode(F.sequence(F.lit(0), F.col("_top") - F.col("_fine"))))
    return up.select("_g", "_fine", (F.col("_fine") + F.col("_up")).alias("_exp"),
                     F.expr("shiftright(_cx, _up)").alias("_cx"), F.expr("shiftright(_cy, _up)").alias("_cy")).distinct()


def _inside(cand: DataFrame, bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``cand`` (unique by ``keys``) whose point is inside."""
    crosses, on_edge = _ray()
    hits = cand.join(bands, ["_g", "_band"]).groupBy(*keys).agg(
        F.count_if(crosses).alias("_n"), F.count_if(on_edge).alias("_on"))
    return hits.where((F.col("_n") % 2 == 1) & (F.col("_on") == 0)).drop("_n", "_on")


def polygon_cover(edges: DataFrame, *, polygon_id: str = "geoid", depth: int = DEPTH) -> DataFrame:
    """A written table of cells that cover each polygon (even-odd rule, holes and
    parts as rings): (polygon_id, _exp, _cx, _cy, _inner, and the polygon's
    bands).  The cells of one polygon are disjoint.

    A polygon starts with cells as wide as itself; those that an edge touches
    are quartered ``depth`` times.  A quarter without an edge is wholly inside
    or outside, which one ray test of its centre decides; inner ones are kept
    as they are, so a cell is as large as the polygon allows.  Nothing is set by
    hand: a polygon a thousand times larger has cells a thousand times larger.
    Edges with a null, NaN or infinite end, and polygons without area, are left
    out.
    """
    ends = ("x1", "y1", "x2", "y2")
    e = edges.select(F.col(polygon_id).alias("_g"), *(F.col(c).cast("double").alias(c) for c in ends))
    for c in ends:
        e = e.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    e = e.where(F.col("_g").isNotNull())
    shapes = materialize(_shapes(e, depth), "polygon-shapes")
    touched = materialize(_edge_cells(e, shapes), "edge-cells")
    quarter = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    empty = touched.where("_exp > _fine").withColumn("_q", quarter).select(
        "_g", (F.col("_exp") - 1).alias("_exp"), (F.col("_cx") * 2 + F.col("_q.i")).alias("_cx"),
        (F.col("_cy") * 2 + F.col("_q.j")).alias("_cy")).join(touched, ["_g", "_exp", "_cx", "_cy"], "left_anti")
    centres = empty.join(shapes, "_g").withColumn("_px", (F.col("_cx") + 0.5) * _side(F.col("_exp"))).withColumn(
        "_py", (F.col("_cy") + 0.5) * _side(F.col("_exp"))).withColumn("_band", _band(F.col("_py")))
    cell = ["_g", "_exp", "_cx", "_cy"]
    inner = _inside(centres.select(*cell, "_px", "_py", "_band"), _edge_bands(e, shapes), cell)
    cells = inner.withColumn("_inner", F.lit(True)).unionByName(
        touched.where("_exp = _fine").select(*cell, F.lit(False).alias("_inner")))
    cover = cells.join(shapes.select("_g", "_y0", "_step", "_bands"), "_g")
    return materialize(cover.withColumnRenamed("_g", polygon_id), "polygon-cover")


def points_in_cover(points: DataFrame, edges: DataFrame, cover: DataFrame, *, point_id: str = "id", x: str = "longitude",
                    y: str = "latitude", polygon_id: str = "geoid", carry: Sequence[str] = ()) -> DataFrame:
    """Pairs (polygon_id, point_id, *carry) with the point strictly inside the
    polygon, by the cover of the same edges.

    A point looks its cell up on every level that occurs in the cover.  In an
    inner cell it is inside; in an edge's cell it takes the ray test against
    the polygon's edges of its band.  Repeated points are counted before the
    test and come out as often as they came in.  Null and NaN coordinates
    never match.
    """
    levels = [r[0] for r in cover.select("_exp").distinct().collect()]  # at most one per power of two
    if not levels:
        return points.where(F.lit(False)).select(
            F.lit(None).cast(cover.schema[polygon_id].dataType).alias(polygon_id), point_id, *carry)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    pts = points.where(px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py)).select(
        F.col(point_id).alias("_pid"), px.alias("_px"), py.alias("_py"), *carry)
    pts = pts.withColumn("_exp", F.explode(F.array(*(F.lit(v) for v in sorted(levels)))))
    pts = pts.withColumn("_cx", _at(F.col("_px"), F.col("_exp"))).withColumn("_cy", _at(F.col("_py"), F.col("_exp")))
    met = pts.join(cover.withColumnRenamed(polygon_id, "_g"), ["_exp", "_cx", "_cy"])
    out = ["_g", "_pid", *carry]
    sure = met.where("_inner").select(*out)
    keys = [*out, "_px", "_py", "_band"]
    unsure = met.where("NOT _inner").withColumn("_band", _band(F.col("_py"))).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"))
    e = edges.select(F.col(polygon_id).alias("_g"), *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))
    shapes = cover.select(F.col(polygon_id).alias("_g"), "_y0", "_step", "_bands").distinct()
    tested = _inside(unsure, _edge_bands(e, shapes), [*keys, "_copies"]).withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(*out)
    return sure.unionByName(tested).select(F.col("_g").alias(polygon_id), F.col("_pid").alias(point_id), *carry)
