"""Land mask of observed cells, computed as Spark joins on adaptive tiles.

A cell is "base land" when its box lies inside a land polygon, touches no lake and stays
more than 0.02° from every river. It is finally "land" (positions there are quarantined)
when it is also ≥ 5 km from any water, seen by ≤ 3 ships and ≤ 100 positions.

**Tiles.** The edges of all layers form a quadtree: a 1° tile with more than ``MOST_EDGES`` edges is split into four, and so on
down to ``MAX_LEVEL`` levels, so a dense coast does not pile up in one join key. The tree and the edges by leaf are stored once
and read by every step. A tile is (lvl, tx, ty): column tx and row ty of the grid of 1° / 2^lvl.

* Point in polygon: the parity of a point equals the parity of its leaf's reference point
  XOR the number of polygon edges crossed on the straight path between them (inside the
  leaf). Reference-point parities come from one pass per row of leaves: edge crossings of the
  row's reference latitude, counted from the east with a window over (polygon, row).
* Box vs edge (lakes, land boundaries) and box vs river distance: equi-join on leaves.
* Distance to the nearest water: the occupied tiles form a pyramid, from a few wide ones down to the leaves. Every point
  descends it by distance bounds: of the tiles met on a level it keeps those whose nearest point is not farther than the
  farthest point of some occupied one, and goes on with their children. What is left are the leaves that may hold the nearest
  segment. One plan, exact; segments are also searched one turn of the globe away, so distances pass the antimeridian.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.functions.geo import CELL_STEP_R7, cell_bounds, cell_center, cell_id
from seawake.functions.numeric import fixed
from seawake.plans.layout import scratch_dir

# Fixed thresholds of the land rule (and of its sensitivity table).
RIVER_BUFFER_DEG = 0.02
DIST_MIN_KM = 5.0
SHIPS_MAX = 3
POSITIONS_MAX = 100
DEG_KM = 111.0
SENSITIVITY = {"dist_min_km": [2, 5, 10], "buques_max": [3, 1], "pos_max": [None, 1000, 100]}
RULE_TEXT = (f"tierra sin lagos, >{RIVER_BUFFER_DEG}deg de rios, >={int(DIST_MIN_KM)}km de agua, "
             f"<={SHIPS_MAX} buques, <={POSITIONS_MAX} posiciones")
TILE_DEG = 1.0                      # root tiles
MOST_EDGES = 256                    # a tile with more edges is split,
MAX_LEVEL = 5                       # at most so many times
PYRAMID = (64, 16, 4, 1)            # sizes of the levels above the leaves, in root tiles
# reference point of a tile: its centre nudged off any round coordinate
_EX, _EY = 0.5 + 1.234567e-7, 0.5 + 7.654321e-8


# ------------------------------------------------------------------ planar geometry columns

def _orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _cross(p1x, p1y, p2x, p2y, q1x, q1y, q2x, q2y) -> Column:
    """Proper crossing of segments p1p2 and q1q2."""
    return ((_orient(p1x, p1y, p2x, p2y, q1x, q1y) * _orient(p1x, p1y, p2x, p2y, q2x, q2y) < 0)
            & (_orient(q1x, q1y, q2x, q2y, p1x, p1y) * _orient(q1x, q1y, q2x, q2y, p2x, p2y) < 0))


def _corners(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def _seg_box_hit(ex1, ey1, ex2, ey2, bx0, by0, bx1, by1) -> Column:
    """Segment intersects the closed box: bounding boxes overlap and the box straddles the line."""
    overlap = ((F.least(ex1, ex2) <= bx1) & (F.greatest(ex1, ex2) >= bx0)
               & (F.least(ey1, ey2) <= by1) & (F.greatest(ey1, ey2) >= by0))
    s = [_orient(ex1, ey1, ex2, ey2, cx, cy) for cx, cy in _corners(bx0, by0, bx1, by1)]
    return overlap & (F.greatest(*s) >= 0) & (F.least(*s) <= 0)


def _pt_seg_dist(px, py, x1, y1, x2, y2) -> Column:
    dx, dy = x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - x1) * dx + (py - y1) * dy) / l2))) \
         .otherwise(F.lit(0.0))
    return F.hypot(px - (x1 + t * dx), py - (y1 + t * dy))


def _pt_box_dist(px, py, bx0, by0, bx1, by1) -> Column:
    dx = F.greatest(bx0 - px, F.lit(0.0), px - bx1)
    dy = F.greatest(by0 - py, F.lit(0.0), py - by1)
    return F.hypot(dx, dy)


def _box_seg_dist(ex1, ey1, ex2, ey2, bx0, by0, bx1, by1) -> Column:
    d = F.least(_pt_box_dist(ex1, ey1, bx0, by0, bx1, by1), _pt_box_dist(ex2, ey2, bx0, by0, bx1, by1),
                *[_pt_seg_dist(cx, cy, ex1, ey1, ex2, ey2) for cx, cy in _corners(bx0, by0, bx1, by1)])
    return F.when(_seg_box_hit(ex1, ey1, ex2, ey2, bx0, by0, bx1, by1), F.lit(0.0)).otherwise(d)


def _tiles(x0: Column, y0: Column, x1: Column, y1: Column, tile: float = TILE_DEG) -> Column:
    """Array of (tx, ty) of the tiles overlapping a box."""
    return F.flatten(F.transform(F.sequence(F.floor(y0 / tile), F.floor(y1 / tile)), lambda ty: F.transform(
        F.sequence(F.floor(x0 / tile), F.floor(x1 / tile)), lambda tx: F.struct(tx.alias("tx"), ty.alias("ty")))))


# ------------------------------------------------------------------ inputs

def cell_stats(bronze: DataFrame, step: float = CELL_STEP_R7) -> DataFrame:
    """Observed cells: positions and distinct ships per cell (raw bronze text).

    Rows off the globe have no cell; their group is dropped after counting, so that the coordinates are parsed
    once a row and not a second time in a filter at the scan.
    """
    lat, lon = F.col("LAT").try_cast("double"), F.col("LON").try_cast("double")
    ok = lat.between(-90, 90) & lon.between(-180, 180)
    return (bronze.groupBy(F.when(ok, cell_id(lat, lon, step)).alias("h3"))
                  .agg(F.count_if(ok).alias("posiciones"), F.count_distinct("MMSI").alias("buques"))
                  .where("posiciones > 0"))


def _cell_boxes(cells: DataFrame, step: float) -> DataFrame:
    y0, y1, x0, x1 = cell_bounds("h3", step)
    return cells.select("h3", x0.alias("bx0"), y0.alias("by0"), x1.alias("bx1"), y1.alias("by1"))


def _edge_tiles(edges: DataFrame, margin: float = 0.0, tile: float = TILE_DEG) -> DataFrame:
    x0, x1 = F.least("x1", "x2") - margin, F.greatest("x1", "x2") + margin
    y0, y1 = F.least("y1", "y2") - margin, F.greatest("y1", "y2") + margin
    return edges.select("*", F.explode(_tiles(x0, y0, x1, y1, tile)).alias("t")).select("*", "t.tx", "t.ty").drop("t")


# ------------------------------------------------------------------ quadtree

TILE = ["lvl", "tx", "ty"]


def _size(tile: float) -> Column:
    """Width of the row's tile in degrees."""
    return F.lit(tile) * F.pow(F.lit(0.5), F.col("lvl"))


def _root(c: str) -> Column:
    """Column or row of the root tile above the row's tile."""
    return F.floor(F.col(c) * F.pow(F.lit(0.5), F.col("lvl")))


def _turn(tile: float) -> Column:
    """Columns of the row's level in one turn of the globe."""
    return (F.lit(round(360 / tile)) * F.pow(F.lit(2.0), F.col("lvl"))).cast("long")


def _touches(tile: float) -> Column:
    """Whether the edge and the closed tile of a row meet."""
    size = _size(tile)
    x0, y0 = F.col("tx") * size, F.col("ty") * size
    return _seg_box_hit(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), x0, y0, x0 + size, y0 + size)


def _children() -> Column:
    return F.array(*[F.struct((F.col("tx") * 2 + i).alias("tx"), (F.col("ty") * 2 + j).alias("ty")) for i in (0, 1) for j in (0, 1)])


class Tiling:
    """Quadtree over edges: ``nodes`` (lvl, tx, ty, leaf) of the split root tiles and all below, ``edges`` by leaf."""

    def __init__(self, nodes: DataFrame, edges: DataFrame, tile: float, levels: int):
        self.nodes, self.edges, self.tile, self.levels = nodes, edges, tile, levels

    def leaves_of(self, rows: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
        """``rows`` with every leaf (lvl, tx, ty) that their box overlaps: of each level's tiles those that are leaves.

        Root tiles that were not split are leaves too, though the tree does not list them.
        """
        tiles = F.concat(*[_level_tiles(x0, y0, x1, y1, self.tile, lvl) for lvl in range(self.levels + 1)])
        keyed = rows.select("*", F.explode(tiles).alias("_t")).select("*", "_t.lvl", "_t.tx", "_t.ty").drop("_t")
        if not self.levels:                               # no tile was split
            return keyed
        known = keyed.join(self.nodes, TILE, "left")
        return known.where(F.coalesce("leaf", F.col("lvl") == 0)).drop("leaf")


def _level_tiles(x0: Column, y0: Column, x1: Column, y1: Column, tile: float, lvl: int) -> Column:
    return F.transform(_tiles(x0, y0, x1, y1, tile / 2 ** lvl),
                       lambda t: F.struct(F.lit(lvl).alias("lvl"), t["tx"].alias("tx"), t["ty"].alias("ty")))


def build_tiling(edges: DataFrame, tile: float = TILE_DEG, most: int = MOST_EDGES, levels: int = MAX_LEVEL) -> Tiling:
    """The quadtree of ``edges`` (layer, poly, x1, y1, x2, y2), stored; both tables are read back by every step.

    Level by level: the edges of a level's tiles are written, and only those of crowded tiles go on to the next. A feed without
    crowded tiles ends after the first level.
    """
    spark, root = edges.sparkSession, scratch_dir(edges.sparkSession, "tiling")
    shape = ["layer", "poly", "x1", "y1", "x2", "y2"]
    at = _edge_tiles(edges, tile=tile).withColumn("lvl", F.lit(0)).where(_touches(tile)).select(*shape, *TILE)
    done, nodes = None, spark.createDataFrame([], "lvl int, tx bigint, ty bigint, leaf boolean")
    for lvl in range(levels + 1):
        at.write.parquet(f"{root}/level={lvl}")
        at = spark.read.schema(at.schema).parquet(f"{root}/level={lvl}")
        split = at.groupBy(*TILE).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*TILE)
        last = lvl == levels or split.isEmpty()
        stay = at if last else at.join(split, TILE, "left_anti")
        done = stay if done is None else done.unionByName(stay)
        if last:
            break
        below = split.select((F.col("lvl") + 1).alias("lvl"), F.explode(_children()).alias("t")).select("lvl", "t.tx", "t.ty")
        nodes = (nodes.join(split.withColumn("_split", F.lit(True)), TILE, "left")
                 .select(*TILE, (F.col("leaf") & F.col("_split").isNull()).alias("leaf"))
                 .unionByName(below.withColumn("leaf", F.lit(True))))
        if lvl == 0:
            nodes = nodes.unionByName(split.withColumn("leaf", F.lit(False)))
        at = (at.join(split, TILE, "left_semi").select(*shape, (F.col("lvl") + 1).alias("lvl"), F.explode(_children()).alias("t"))
                .select(*shape, "lvl", "t.tx", "t.ty").where(_touches(tile)))
    nodes.write.parquet(f"{root}/nodes")
    done.write.parquet(f"{root}/edges")
    return Tiling(spark.read.schema(nodes.schema).parquet(f"{root}/nodes"),
                  spark.read.schema(done.schema).parquet(f"{root}/edges"), tile, lvl)


def edge_traffic(edges: DataFrame, bronze: DataFrame) -> DataFrame:
    """Each edge with the positions observed in the 1° tiles its bounding box touches.

    Positions are counted per tile first (partial aggregation), so the join is between the
    edge-tile table and one row per occupied tile.
    """
    lat, lon = F.col("LAT").try_cast("double"), F.col("LON").try_cast("double")
    tiles = (bronze.where(lat.between(-90, 90) & lon.between(-180, 180))
                   .groupBy(F.floor(lon).alias("tx"), F.floor(lat).alias("ty")).agg(F.count(F.lit(1)).alias("n")))
    return (_edge_tiles(edges, tile=1.0).join(tiles, ["tx", "ty"], "left")
            .groupBy("layer", "poly", "x1", "y1", "x2", "y2")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("posiciones_en_teselas")))


# ------------------------------------------------------------------ point in polygon

def corners_inside(boxes: DataFrame, layer: str, tiling: Tiling) -> DataFrame:
    """(h3, poly, n_inside): how many of the 4 cell corners lie inside each candidate polygon of a layer."""
    corners = boxes.select("h3", F.posexplode(F.array(*[F.struct(cx.alias("px"), cy.alias("py"))
                                                        for cx, cy in _corners(F.col("bx0"), F.col("by0"),
                                                                                F.col("bx1"), F.col("by1"))]))
                           .alias("k", "p")).select("h3", "k", "p.px", "p.py")
    corners = tiling.leaves_of(corners, F.col("px"), F.col("py"), F.col("px"), F.col("py"))
    roots = [_root(c).alias(f"r{c}") for c in ("tx", "ty")]
    ctiles = corners.select(*TILE).distinct().select(*TILE, *roots)

    # candidate (polygon, leaf) pairs: root tiles of the polygons' bounding boxes, and the corners' leaves in them
    tile = tiling.tile
    edges = tiling.edges.where(F.col("layer") == layer)
    whole = edges.select("poly", "x1", "y1", "x2", "y2").distinct()            # an edge is stored once a leaf
    bbox = whole.groupBy("poly").agg(F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x1"),
                                     F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y1"))
    cand = (bbox.select("poly", F.explode(_tiles(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), tile)).alias("t"))
                .select("poly", F.col("t.tx").alias("rtx"), F.col("t.ty").alias("rty")).join(ctiles, ["rtx", "rty"])
                .select("poly", *TILE))

    # parity of each leaf's reference point: crossings of its row's reference latitude east of it
    y0 = (F.col("ty") + _EY) * _size(tile)
    spans = F.concat(*[_rows_at(tile, lvl) for lvl in range(tiling.levels + 1)])
    rows = (whole.select("*", F.explode(spans).alias("t")).select("poly", "x1", "y1", "x2", "y2", "t.lvl", "t.ty")
                 .join(cand.select("poly", "lvl", "ty").distinct(), ["poly", "lvl", "ty"], "left_semi"))
    events = (rows.where((F.col("y1") > y0) != (F.col("y2") > y0))
                  .select("poly", "lvl", "ty", (F.col("x1") + (y0 - F.col("y1")) * (F.col("x2") - F.col("x1"))
                                                 / (F.col("y2") - F.col("y1"))).alias("x"),
                          F.lit(1).alias("ev"), F.lit(None).cast("bigint").alias("tx")))
    queries = cand.select("poly", "lvl", "ty", ((F.col("tx") + _EX) * _size(tile)).alias("x"), F.lit(0).alias("ev"), "tx")
    w = (Window.partitionBy("poly", "lvl", "ty").orderBy(F.desc("x"), F.desc("ev"))
         .rowsBetween(Window.unboundedPreceding, 0))
    parity = (events.unionByName(queries).withColumn("n_east", F.sum("ev").over(w))
                    .where(F.col("ev") == 0).select("poly", *TILE, (F.col("n_east") % 2).alias("par0")))

    # crossings on the path reference point → corner, with the polygon's edges of that leaf
    et = edges.select("poly", *TILE, "x1", "y1", "x2", "y2")
    pc = corners.join(parity, TILE)
    rx, ry = (F.col("tx") + _EX) * _size(tile), (F.col("ty") + _EY) * _size(tile)
    hits = (pc.join(et, ["poly", *TILE], "left")
              .groupBy("h3", "k", "poly", "par0")
              .agg(F.count_if(_cross(rx, ry, F.col("px"), F.col("py"), F.col("x1"), F.col("y1"),
                                     F.col("x2"), F.col("y2"))).alias("n_cross")))
    inside = hits.where((F.col("par0") + F.col("n_cross")) % 2 == 1)
    return inside.groupBy("h3", "poly").agg(F.count(F.lit(1)).alias("n_inside"))


def _rows_at(tile: float, lvl: int) -> Column:
    """(lvl, ty) of the rows of one level that an edge spans."""
    size = tile / 2 ** lvl
    return F.transform(F.sequence(F.floor(F.least("y1", "y2") / size), F.floor(F.greatest("y1", "y2") / size)),
                       lambda ty: F.struct(F.lit(lvl).alias("lvl"), ty.alias("ty")))


def boxes_by_leaf(boxes: DataFrame, tiling: Tiling, margin: float = 0.0) -> DataFrame:
    return tiling.leaves_of(boxes, F.col("bx0") - margin, F.col("by0") - margin, F.col("bx1") + margin, F.col("by1") + margin)


def edges_hitting(boxes: DataFrame, layer: str, tiling: Tiling) -> DataFrame:
    """(h3, poly) pairs where an edge of ``poly`` intersects the cell box."""
    j = boxes_by_leaf(boxes, tiling).join(tiling.edges.where(F.col("layer") == layer), TILE)
    return (j.where(_seg_box_hit(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"),
                                 F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1")))
             .select("h3", "poly").distinct())


def near_lines(boxes: DataFrame, layer: str, dist_deg: float, tiling: Tiling) -> DataFrame:
    """Cells whose box is within ``dist_deg`` of a line segment: the segment's nearest point lies in a leaf of the widened box."""
    j = boxes_by_leaf(boxes, tiling, dist_deg).join(tiling.edges.where(F.col("layer") == layer), TILE)
    d = _box_seg_dist(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"),
                      F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"))
    return j.where(d <= dist_deg).select("h3").distinct()


# ------------------------------------------------------------------ nearest water

def _bounds(size: Column) -> tuple[Column, Column]:
    """Least and greatest distance from the row's point to its tile."""
    x0, y0 = F.col("tx") * size, F.col("ty") * size
    far = F.hypot(F.greatest(F.abs(F.col("lon_c") - x0), F.abs(F.col("lon_c") - (x0 + size))),
                  F.greatest(F.abs(F.col("lat_c") - y0), F.abs(F.col("lat_c") - (y0 + size))))
    return _pt_box_dist(F.col("lon_c"), F.col("lat_c"), x0, y0, x0 + size, y0 + size), far


def _promising(cand: DataFrame, size: Column) -> DataFrame:
    """Candidates that may hold the nearest segment: every tile holds one, so none is farther than the nearest far corner."""
    near, far = _bounds(size)
    kept = cand.withColumn("_near", near).withColumn("_far", F.min(far).over(Window.partitionBy("h3")))
    return kept.where(F.col("_near") <= F.col("_far")).drop("_near", "_far")


def water_candidates(points: DataFrame, tiling: Tiling) -> DataFrame:
    """(h3, lon_c, lat_c, lvl, tx, ty): the leaves that may hold the segment nearest to each point; tx one turn east or west too."""
    leaves = tiling.edges.select(*TILE).distinct().select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(-1))).alias("t")).select(
        "lvl", (F.col("tx") + F.col("t") * _turn(tiling.tile)).alias("tx"), "ty")
    roots = leaves.select(_root("tx").alias("a1"), _root("ty").alias("b1"), *TILE)
    up = roots
    for size in PYRAMID[:-1]:
        up = up.select("*", F.floor(F.col("a1") / size).alias(f"a{size}"), F.floor(F.col("b1") / size).alias(f"b{size}"))
    top = PYRAMID[0]
    # the widest level has at most 17 x 4 tiles: each point starts with all of them
    widest = up.agg(F.collect_set(F.struct(F.col(f"a{top}").alias("tx"), F.col(f"b{top}").alias("ty")))).scalar()
    cand = points.select("h3", "lon_c", "lat_c", F.explode(widest).alias("t")).select("h3", "lon_c", "lat_c", "t.tx", "t.ty")
    cand = _promising(cand, F.lit(top * tiling.tile))
    for above, size in zip(PYRAMID, PYRAMID[1:], strict=False):
        step = up.select(F.col(f"a{above}").alias("pa"), F.col(f"b{above}").alias("pb"), F.col(f"a{size}").alias("na"),
                         F.col(f"b{size}").alias("nb")).distinct()
        cand = (cand.join(step, (F.col("tx") == F.col("pa")) & (F.col("ty") == F.col("pb")))
                    .select("h3", "lon_c", "lat_c", F.col("na").alias("tx"), F.col("nb").alias("ty")))
        cand = _promising(cand, F.lit(size * tiling.tile))
    below = roots.select("a1", "b1", "lvl", F.col("tx").alias("lx"), F.col("ty").alias("ly"))
    cand = (cand.join(below, (F.col("tx") == F.col("a1")) & (F.col("ty") == F.col("b1")))
                .select("h3", "lon_c", "lat_c", "lvl", F.col("lx").alias("tx"), F.col("ly").alias("ty")))
    return _promising(cand, _size(tiling.tile))


def water_distance(points: DataFrame, tiling: Tiling) -> DataFrame:
    """(h3, dist_deg) from each point (lon_c, lat_c) to the nearest segment of any layer (planar degrees, across the antimeridian)."""
    turn = _turn(tiling.tile)
    half = turn / 2
    # candidate columns back on the globe, and by how many degrees their segments are moved
    turns = F.when(F.col("tx") >= half, 1).when(F.col("tx") < -half, -1).otherwise(0)
    cand = (water_candidates(points, tiling).withColumn("turns", turns)
            .select("h3", "lon_c", "lat_c", "lvl", (F.col("tx") - F.col("turns") * turn).alias("tx"), "ty",
                    (F.col("turns") * 360.0).alias("moved")))
    j = cand.join(tiling.edges, TILE)
    d = _pt_seg_dist(F.col("lon_c") - F.col("moved"), F.col("lat_c"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return j.groupBy("h3").agg(F.min(d).alias("dist_deg"))


# ------------------------------------------------------------------ the mask

def land_mask(cells: DataFrame, land: DataFrame, lakes: DataFrame, rivers: DataFrame,
              step: float = CELL_STEP_R7, tile: float = TILE_DEG, most: int = MOST_EDGES) -> DataFrame:
    """h3, resolucion, es_tierra, es_tierra_base, lat, lon, dist_agua_km, posiciones, buques, regla."""
    named = [df.withColumn("layer", F.lit(name)) for name, df in (("land", land), ("lakes", lakes), ("rivers", rivers))]
    tiling = build_tiling(named[0].unionByName(named[1]).unionByName(named[2]), tile, most)
    spark, root = cells.sparkSession, scratch_dir(cells.sparkSession, "land-mask")
    cells.write.parquet(f"{root}/cells")                     # the observed cells are counted once and read by every step
    cells = spark.read.schema(cells.schema).parquet(f"{root}/cells")
    boxes = _cell_boxes(cells, step)
    inside = corners_inside(boxes, "land", tiling).where("n_inside = 4")
    land_hit = edges_hitting(boxes, "land", tiling)
    within = inside.join(land_hit, ["h3", "poly"], "left_anti").select("h3").distinct()
    lake_touch = (edges_hitting(boxes, "lakes", tiling).select("h3")
                  .unionByName(corners_inside(boxes, "lakes", tiling).select("h3")).distinct())
    river_near = near_lines(boxes, "rivers", RIVER_BUFFER_DEG, tiling)
    base = within.join(lake_touch, "h3", "left_anti").join(river_near, "h3", "left_anti")
    base.write.parquet(f"{root}/base")                       # read for the distances and for the mask
    base = spark.read.schema(base.schema).parquet(f"{root}/base")

    lat_c, lon_c = cell_center("h3", step)
    dist = water_distance(base.select("h3", lat_c.alias("lat_c"), lon_c.alias("lon_c")), tiling)

    lat_all, lon_all = cell_center("h3", step)
    out = (cells.join(base.withColumn("es_tierra_base", F.lit(True)), "h3", "left")
                .join(dist, "h3", "left")
                .select("h3", F.lit(7 if step == CELL_STEP_R7 else 8).alias("resolucion"),
                        F.coalesce("es_tierra_base", F.lit(False)).alias("es_tierra_base"),
                        lat_all.alias("lat"), lon_all.alias("lon"),
                        (F.col("dist_deg") * DEG_KM).alias("dist_agua_km"), "posiciones", "buques"))
    rule = (F.col("es_tierra_base") & (F.col("dist_agua_km") >= DIST_MIN_KM)
            & (F.col("buques") <= SHIPS_MAX) & (F.col("posiciones") <= POSITIONS_MAX))
    return out.withColumn("es_tierra", F.coalesce(rule, F.lit(False))).withColumn("regla", F.lit(RULE_TEXT))


def land_sensitivity(mask: DataFrame) -> DataFrame:
    """Cells / positions / pct caught by each threshold combination (one aggregation pass)."""
    combos = [(d, b, p) for d in SENSITIVITY["dist_min_km"] for b in SENSITIVITY["buques_max"]
              for p in SENSITIVITY["pos_max"]]
    aggs = [F.sum("posiciones").alias("_tot")]
    for i, (d, b, p) in enumerate(combos):
        m = F.col("es_tierra_base") & (F.col("dist_agua_km") >= d) & (F.col("buques") <= b)
        if p is not None:
            m = m & (F.col("posiciones") <= p)
        m = F.coalesce(m, F.lit(False))
        aggs += [F.count_if(m).alias(f"c{i}"), F.sum(F.when(m, F.col("posiciones")).otherwise(0)).alias(f"p{i}")]
    wide = mask.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(d).alias("dist_min_km"), F.lit(b).alias("buques_max"),
                              F.lit("∞" if p is None else str(p)).alias("pos_max"),
                              F.col(f"c{i}").alias("celdas"), F.col(f"p{i}").cast("long").alias("posiciones"))
                     for i, (d, b, p) in enumerate(combos)])
    return (wide.select("_tot", F.inline(rows))
                .withColumn("pct", fixed(F.try_divide(F.col("posiciones") * 100, F.col("_tot")), 4)).drop("_tot"))


def top_land_cells(mask: DataFrame, k: int = 15) -> DataFrame:
    return (mask.where("es_tierra").orderBy(F.desc("posiciones"), "h3")
                .select("h3", "lat", "lon", "dist_agua_km", "posiciones", "buques").limit(k))
