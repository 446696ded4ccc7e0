"""D3 point-in-polygon and E7/E8 exact quantiles against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.operators.quantiles import exact_quantiles
from fieldlens.operators.spatial import points_in_cover, points_in_polygons, polygon_cover


def ring(pts):
    return [(pts[i], pts[(i + 1) % len(pts)]) for i in range(len(pts))]


def brute_inside(px, py, edges):
    n, on = 0, False
    for (x1, y1), (x2, y2) in edges:
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            n += 1
        if ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)
                and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2)):
            on = True
    return n % 2 == 1 and not on


EDGES = "geoid string, x1 double, y1 double, x2 double, y2 double"


def star(x, y, r, n, rnd):
    """A closed ring of n spikes around (x, y)."""
    at = [(r * rnd.uniform(0.4, 1.0), 2 * np.pi * i / n) for i in range(n)]
    return ring([(float(x + a * np.cos(t)), float(y + a * np.sin(t))) for a, t in at])


def test_cover_equals_brute_force_for_sizes_a_thousand_apart(spark):
    """One polygon is a thousand times wider than the others, which lie on it;
    points stand at random, on cell borders, on corners and on edges."""
    rnd = random.Random(11)
    polys = {"big": star(0, 0, 1000, 60, rnd) + ring([(-50, -50), (50, -50), (50, 50), (-50, 50)]),
             "cell": ring([(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]),  # exactly one cell
             "flat": ring([(3.0, 3.0), (9.0, 3.0), (3.0, 3.0)]), "line": ring([(1.0, 1.0), (1.0, 4.0)])}
    for i in range(12):
        polys[f"s{i}"] = star(rnd.uniform(-900, 900), rnd.uniform(-900, 900), 1, 9, rnd)
    rows = [(g, *map(float, (x1, y1, x2, y2))) for g, es in polys.items() for (x1, y1), (x2, y2) in es]
    e = spark.createDataFrame(rows + [("bad", None, 1.0, 2.0, 2.0), (None, 0.0, 0.0, 1.0, 1.0), ("bad", float("nan"), 0.0, 1.0, 5.0)], EDGES)
    pts = [(f"r{i}", rnd.uniform(-1100, 1100), rnd.uniform(-1100, 1100)) for i in range(400)]
    pts += [(f"c{i}", 4.0 * rnd.randint(-20, 20), 4.0 * rnd.randint(-20, 20)) for i in range(200)]
    for g, es in polys.items():
        (x1, y1), (x2, y2) = es[0]
        pts += [(f"v{g}", x1, y1), (f"m{g}", (x1 + x2) / 2, (y1 + y2) / 2)]
        if g.startswith("s"):
            cx, cy = np.mean([p[0][0] for p in es]), np.mean([p[0][1] for p in es])
            pts += [(f"n{g}{i}", float(cx + rnd.uniform(-1, 1)), float(cy + rnd.uniform(-1, 1))) for i in range(12)]
    pts += pts[:40]  # repeated points
    p = spark.createDataFrame([(*q, q[0] + "!") for q in pts] + [("null", None, 1.0, ""), ("nan", float("nan"), 1.0, "")],
                              "id string, longitude double, latitude double, note string")
    cover = polygon_cover(e)
    got = sorted(map(tuple, points_in_cover(p, e, cover, carry=["note"]).collect()))
    want = sorted((g, i, i + "!") for i, x, y in pts for g, es in polys.items()
                  if brute_inside(x, y, [(tuple(map(float, a)), tuple(map(float, b))) for a, b in es]))
    assert got == want and len({g for g, *_ in got}) > 10
    # the cells follow the polygon: about as many for the big one as for a small one of its shape
    n = {r["geoid"]: r["count"] for r in cover.groupBy("geoid").count().collect()}
    assert "flat" not in n and "line" not in n and n["big"] < 20 * max(n[f"s{i}"] for i in range(12))
    # most of the big polygon's area needs no ray test
    area = {r["_inner"]: r["a"] for r in cover.where("geoid = 'big'").groupBy("_inner").agg(
        F.sum(F.pow(F.lit(4.0), "_exp")).alias("a")).collect()}
    assert area[True] > area[False]
    assert points_in_cover(p, e.limit(0), polygon_cover(e.limit(0))).collect() == []
    assert points_in_cover(p.limit(0), e, cover).collect() == []


def test_points_in_polygons_with_hole_and_edges(spark):
    polys = {
        # square with a square hole (even-odd rule)
        "sq": ring([(0, 0), (10, 0), (10, 10), (0, 10)]) + ring([(4, 4), (6, 4), (6, 6), (4, 6)]),
        # concave polygon
        "cv": ring([(20, 0), (30, 0), (30, 10), (25, 3), (20, 10)]),
        # two parts
        "mp": ring([(40, 0), (42, 0), (42, 2), (40, 2)]) + ring([(45, 5), (47, 5), (47, 7)]),
    }
    edges = [(g, float(x1), float(y1), float(x2), float(y2))
             for g, es in polys.items() for (x1, y1), (x2, y2) in es]
    e = spark.createDataFrame(edges, "geoid string, x1 double, y1 double, x2 double, y2 double")
    rnd = random.Random(7)
    pts = [(f"p{i}", rnd.uniform(-2, 50), rnd.uniform(-2, 12)) for i in range(600)]
    pts += [("edge1", 0.0, 5.0), ("edge2", 5.0, 10.0), ("vertex", 10.0, 10.0),
            ("hole_edge", 4.0, 5.0), ("in_hole", 5.0, 5.0), ("nullx", None, 3.0)]
    p = spark.createDataFrame(pts, "id string, longitude double, latitude double")
    got = {(r["geoid"], r["id"]) for r in points_in_polygons(p, e, cell=3.0).collect()}
    exp = {(g, pid) for pid, x, y in pts if x is not None for g, es in polys.items()
           if brute_inside(x, y, es)}
    assert got == exp
    assert not any(pid in ("edge1", "edge2", "vertex", "hole_edge", "in_hole", "nullx")
                   for _, pid in got)


@pytest.mark.parametrize("blocks", [None, 1, 32])
def test_exact_quantiles_match_numpy(spark, blocks):
    rnd = random.Random(3)
    vals = [rnd.gauss(0, 10) for _ in range(1000)] + [1.5] * 200 + [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0, 0.333]
    got = exact_quantiles(df, "x", probs, blocks=blocks)
    arr = np.array([v for v in vals if v is not None])
    exp = [np.percentile(arr, p * 100) for p in probs]
    assert got == pytest.approx(exp, rel=1e-12, abs=1e-12)


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_exact_quantiles_hot_value_is_one_row(spark):
    """A column that is 70 % zero: the ranked table holds the value once."""
    from fieldlens.operators.partitioning import BLOCK

    df = spark.range(4000).selectExpr("CASE WHEN id % 10 < 7 THEN 0D ELSE CAST(id AS DOUBLE) END AS x").repartition(6)
    seen = []
    import fieldlens.operators.quantiles as Q

    real = Q.range_blocks
    try:
        Q.range_blocks = lambda *a: seen.append(real(*a)) or seen[-1]
        got = exact_quantiles(df, "x", [0.5, 0.75, 0.9], blocks=8)
    finally:
        Q.range_blocks = real
    vals = np.array([0.0 if i % 10 < 7 else float(i) for i in range(4000)])
    assert got == pytest.approx([np.percentile(vals, p) for p in (50, 75, 90)])
    per_block = [r["count"] for r in seen[0].groupBy(BLOCK).count().collect()]
    assert sum(per_block) == 1201 and max(per_block) <= 3 * 1201 / 8


def test_nan_is_a_stated_choice(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [1.5]
    assert np.isnan(exact_quantiles(df, "x", [0.5], drop_nan=False)[0])


def test_sketches_merge_and_keep_their_error(spark):
    """Sketches per year, one year rewritten: merged estimates against exact
    ranks; half of the values are one number."""
    import numpy as np
    from pyspark.sql import functions as F

    from fieldlens.operators.quantiles import RANK_ERROR, sketch_quantiles, write_sketches
    from fieldlens.session import shared_path

    df = spark.range(60_000).select((F.col("id") % 6 + 2000).alias("Year"), F.when(F.col("id") % 2 == 0, F.lit(7.0)).otherwise(
        F.pmod(F.hash("id"), F.lit(100_000)) / 7.0).alias("v"))
    path = shared_path(spark, "sketches")
    write_sketches(df.withColumn("v", F.when(F.col("Year") == 2003, F.lit(-1.0)).otherwise(F.col("v"))), "v", path)
    table = write_sketches(df.where("Year = 2003").unionByName(
        spark.createDataFrame([(2003, None), (2003, float("nan"))], "Year long, v double")), "v", path)
    v = np.sort([r[0] for r in df.select("v").collect()])
    for r in sketch_quantiles(table, [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        assert r["n"] == len(v)
        lo, hi = (np.searchsorted(v, r["value"], side) / len(v) for side in ("left", "right"))
        assert lo - RANK_ERROR <= r["p"] <= hi + RANK_ERROR
    assert sketch_quantiles(table.where("false"), [0.5]).collect() == []
