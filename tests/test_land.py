"""Land mask on synthetic layers: exact expected cells and distances (brute force)."""
import math

import pytest
from pyspark.sql import functions as F

from seawake.functions.geo import cell_bounds, cell_center, cell_id
from seawake.operators import land as ld
from seawake.sources import geojson as gj


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("geo"))
    out = []
    for name, feats in (("land", gj.TEST_LAND), ("lakes", gj.TEST_LAKES), ("rivers", gj.TEST_RIVERS)):
        gj.write_geojson(spark, f"{root}/{name}.geojson", feats)
        out.append(gj.read_edges(spark, f"{root}/{name}.geojson", name))
    return out


def cells_at(spark, pts):
    df = spark.createDataFrame(pts, "lat double, lon double")
    return (df.select(cell_id("lat", "lon").alias("h3")).distinct()
              .withColumn("posiciones", F.lit(5)).withColumn("buques", F.lit(1)))


def brute(box):
    L = (-81.497, 26.003, -80.503, 26.997)
    K = (-81.297, 26.303, -81.103, 26.497)
    x0, y0, x1, y1 = box
    within = L[0] < x0 and x1 < L[2] and L[1] < y0 and y1 < L[3]
    lake = not (x1 < K[0] or x0 > K[2] or y1 < K[1] or y0 > K[3])
    best = 1e9
    for i in range(2001):
        s = i / 2000
        x, y = -81.497 + s * 0.994, 26.801 + s * 0.05
        dx, dy = max(x0 - x, 0, x - x1), max(y0 - y, 0, y - y1)
        best = min(best, math.hypot(dx, dy))
    return within and not lake and best > 0.02


def test_base_land_matches_brute_force(spark, layers):
    land, lakes, rivers = layers
    pts = [(26.0 + i * 0.011, -81.6 + j * 0.013) for i in range(0, 100, 3) for j in range(0, 90, 3)]
    cells = cells_at(spark, pts)
    m = ld.land_mask(cells, land, lakes, rivers)
    la0, la1, lo0, lo1 = cell_bounds("h3")
    rows = m.select("h3", "es_tierra_base", lo0.alias("x0"), la0.alias("y0"), lo1.alias("x1"), la1.alias("y1")).collect()
    assert len(rows) > 500
    wrong = [r.h3 for r in rows if r.es_tierra_base != brute((r.x0, r.y0, r.x1, r.y1))]
    assert wrong == []
    assert sum(r.es_tierra_base for r in rows) > 50


def test_water_distance_is_exact(spark, layers):
    land, lakes, rivers = layers
    cells = cells_at(spark, [(26.65, -80.9), (26.2, -80.7)])
    m = {r.h3: r for r in ld.land_mask(cells, land, lakes, rivers).collect()}
    la, lo = cell_center("h3")
    cen = {r.h3: (r.la, r.lo) for r in cells.select("h3", la.alias("la"), lo.alias("lo")).collect()}
    segs = [((-81.497, 26.003), (-80.503, 26.003)), ((-80.503, 26.003), (-80.503, 26.997)),
            ((-80.503, 26.997), (-81.497, 26.997)), ((-81.497, 26.997), (-81.497, 26.003)),
            ((-81.297, 26.303), (-81.103, 26.303)), ((-81.103, 26.303), (-81.103, 26.497)),
            ((-81.103, 26.497), (-81.297, 26.497)), ((-81.297, 26.497), (-81.297, 26.303)),
            ((-81.497, 26.801), (-80.503, 26.851))]

    def d(p, a, b):
        (px, py), (x1, y1), (x2, y2) = p, a, b
        dx, dy = x2 - x1, y2 - y1
        t = max(0, min(1, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - x1 - t * dx, py - y1 - t * dy)

    for h, r in m.items():
        if r.es_tierra_base:
            la_, lo_ = cen[h]
            exp = min(d((lo_, la_), a, b) for a, b in segs) * 111
            assert r.dist_agua_km == pytest.approx(exp, abs=1e-9)


def test_antimeridian_polygon(spark, layers):
    land, lakes, rivers = layers
    cells = cells_at(spark, [(10.5, 179.5), (10.5, -179.5), (10.5, 0.0), (10.5, -170.0), (10.5, -178.9)])
    m = {r.h3: r for r in ld.land_mask(cells, land, lakes, rivers).collect()}
    for lon in (179.5, -179.5):
        inside = cells.where(F.col("h3") == cell_id(F.lit(10.5), F.lit(lon))).first().h3
        assert m[inside].es_tierra_base is True
        assert 48 < m[inside].dist_agua_km < 56          # half a degree to the coast on that side
    assert sum(r.es_tierra_base for r in m.values()) == 2          # the band outside the polygon is not land


def test_sensitivity_table(spark, layers):
    land, lakes, rivers = layers
    cells = cells_at(spark, [(26.0 + i * 0.02, -81.4 + i * 0.01) for i in range(50)])
    t = ld.land_sensitivity(ld.land_mask(cells, land, lakes, rivers)).collect()
    assert len(t) == 18
    by = {(r.dist_min_km, r.buques_max, r.pos_max): r.celdas for r in t}
    assert by[(2, 3, "∞")] >= by[(5, 3, "∞")] >= by[(10, 3, "∞")]


def test_tile_size_does_not_change_the_mask(spark, layers):
    land, lakes, rivers = layers
    pts = [(26.0 + i * 0.023, -81.6 + j * 0.029) for i in range(0, 45, 2) for j in range(0, 40, 2)]
    cells = cells_at(spark, pts + [(10.5, 179.5)])
    cols = ["h3", "es_tierra_base", "es_tierra", "dist_agua_km"]
    a = sorted(map(tuple, ld.land_mask(cells, land, lakes, rivers, tile=1.0).select(*cols).collect()))
    b = sorted(map(tuple, ld.land_mask(cells, land, lakes, rivers, tile=0.25).select(*cols).collect()))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3]
        assert (x[3] is None and y[3] is None) or abs(x[3] - y[3]) < 1e-9


def coast(spark, name, n, x, y, r, dent=0.3):
    """A jagged ring of ``n`` edges around (x, y)."""
    pts = [(x + r * (1 + dent * (k % 2)) * math.cos(2 * math.pi * k / n), y + r * (1 + dent * (k % 2)) * math.sin(2 * math.pi * k / n))
           for k in range(n)]
    return [(name, f"{name}-0", *a, *b) for a, b in zip(pts, pts[1:] + pts[:1])]


EDGE = "layer string, poly string, x1 double, y1 double, x2 double, y2 double"


@pytest.fixture(scope="module")
def dense(spark):
    rows = {"land": coast(spark, "land", 3000, 20.51, 30.49, 0.4) + coast(spark, "land", 40, 24.3, 33.2, 0.6),
            "lakes": coast(spark, "lakes", 500, 20.55, 30.5, 0.1), "rivers": [("rivers", "r", 20.3, 30.3, 20.7, 30.6)]}
    return [spark.createDataFrame(rows[k], EDGE) for k in ("land", "lakes", "rivers")]


def test_crowded_tiles_are_split_and_nothing_changes(spark, dense):
    edges = dense[0].unionByName(dense[1]).unionByName(dense[2])
    tree = ld.build_tiling(edges, most=200, levels=7)
    sizes = {(r.lvl, r.tx, r.ty): r["count"] for r in tree.edges.groupBy("lvl", "tx", "ty").count().collect()}
    assert max(sizes.values()) <= 200 and tree.levels > 1
    whole = ld.build_tiling(edges, most=10**9)
    assert whole.levels == 0 and whole.nodes.count() == 0
    assert whole.edges.groupBy("lvl", "tx", "ty").count().agg(F.max("count")).first()[0] > 2000
    # every split tile has its four children, and a tile is a leaf or split
    nodes = {(r.lvl, r.tx, r.ty): r.leaf for r in tree.nodes.collect()}
    assert len(nodes) == tree.nodes.count()
    for (lvl, x, y), leaf in nodes.items():
        assert leaf or all((lvl + 1, 2 * x + i, 2 * y + j) in nodes for i in (0, 1) for j in (0, 1))
        assert lvl == 0 or nodes[lvl - 1, x // 2, y // 2] is False
    cells = cells_at(spark, [(30.0 + i * 0.023, 20.0 + j * 0.027) for i in range(45) for j in range(40)] + [(33.2, 24.3), (-5.0, 120.0)])
    cols = ["h3", "es_tierra_base", "es_tierra", "dist_agua_km"]
    a = sorted(map(tuple, ld.land_mask(cells, *dense, most=200).select(*cols).collect()))
    b = sorted(map(tuple, ld.land_mask(cells, *dense, most=10**9).select(*cols).collect()))
    assert [x[:3] for x in a] == [x[:3] for x in b] and sum(x[1] for x in a) > 100
    assert all(x[3] is None and y[3] is None or abs(x[3] - y[3]) < 1e-9 for x, y in zip(a, b))


def test_nearest_water_over_the_globe(spark, dense):
    """Against every segment: far away, near the poles, and across the antimeridian."""
    edges = dense[0].unionByName(dense[2]).unionByName(spark.createDataFrame(
        [("lakes", "w", -179.9, 10.0, -179.8, 10.1), ("lakes", "e", 179.2, -60.0, 179.3, -60.1), ("rivers", "n", 0.0, 89.9, 1.0, 90.0)], EDGE))
    pts = [(179.95, 10.0), (-179.5, -60.0), (179.9999, 89.0), (-180.0, -90.0), (20.5, 30.5), (100.0, 0.0), (-100.0, 50.0), (20.9, 30.9), (0.0, 0.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "h3 long, lon_c double, lat_c double")
    segs = [(r.x1, r.y1, r.x2, r.y2) for r in edges.collect()]

    def d(px, py, x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        t = max(0, min(1, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - x1 - t * dx, py - y1 - t * dy)

    want = {i: min(d(x + turn, y, *s) for s in segs for turn in (-360, 0, 360)) for i, (x, y) in enumerate(pts)}
    assert want[0] < 1 and want[1] < 2                      # both nearest across the antimeridian
    for most in (100, 10**9):
        tree = ld.build_tiling(edges, most=most)
        got = {r.h3: r.dist_deg for r in ld.water_distance(points, tree).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
        # few leaves are left to search, however many there are
        left = ld.water_candidates(points, tree).groupBy("h3").count().agg(F.max("count")).first()[0]
        assert left <= 24


def test_no_edges_at_all(spark):
    none = spark.createDataFrame([], EDGE)
    cells = cells_at(spark, [(10.0, 10.0)])
    row = ld.land_mask(cells, none, none, none).first()
    assert row.es_tierra_base is False and row.es_tierra is False and row.dist_agua_km is None
