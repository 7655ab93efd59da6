"""Properties of the distance and cell functions (hypothesis)."""
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from seawake.functions.geo import CELL_STEP_R7, CELL_STEP_R8, cell_center, cell_id, haversine_km, ring_cells

lat_s = st.floats(min_value=-89.99, max_value=89.99, allow_nan=False)
lon_s = st.floats(min_value=-180.0, max_value=179.999, allow_nan=False)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(lat_s, lon_s, lat_s, lon_s), min_size=1, max_size=30))
def test_haversine_symmetric_nonnegative(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    rows = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y"),
                     haversine_km("a", "b", "a", "b").alias("z")).collect()
    for r in rows:
        assert r.x >= 0 and abs(r.x - r.y) < 1e-9 and r.z == 0 and r.x <= math.pi * 6371.0 + 1e-6


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(lat_s, lon_s), min_size=1, max_size=50), st.sampled_from([CELL_STEP_R7, CELL_STEP_R8]))
def test_cell_centre_maps_back(spark, pts, step):
    df = spark.createDataFrame(pts, "lat double, lon double").withColumn("c", cell_id("lat", "lon", step))
    la, lo = cell_center("c", step)
    back = df.withColumn("c2", cell_id(la, lo, step)).where("c <> c2").count()
    assert back == 0


def test_ring_covers_radius(spark):
    # every cell whose centre is within 5 km of the point is in the ring (checked on a fine lattice)
    pts = [(26.0 + i * 0.37, -80.0 + i * 0.53) for i in range(5)] + [(70.3, 20.1), (-45.2, 170.9)]
    df = spark.createDataFrame(pts, "lat double, lon double").withColumn("pid", F.monotonically_increasing_id())
    ring = df.select("pid", "lat", "lon", F.explode(ring_cells("lat", "lon", 5.0)).alias("c"))
    grid = df.select("pid", "lat", "lon", F.explode(F.sequence(F.lit(-40), F.lit(40))).alias("i")) \
             .select("*", F.explode(F.sequence(F.lit(-40), F.lit(40))).alias("j")) \
             .select("pid", "lat", "lon", (F.col("lat") + F.col("i") * 0.0025).alias("qa"),
                     (F.col("lon") + F.col("j") * 0.0025 / F.cos(F.radians("lat"))).alias("qo"))
    near = grid.select("pid", "lat", "lon", cell_id("qa", "qo").alias("c"))
    la, lo = cell_center("c")
    near = near.where(haversine_km("lat", "lon", la, lo) <= 5.0).select("pid", "c").distinct()
    missing = near.join(ring.select("pid", "c"), ["pid", "c"], "left_anti").count()
    assert missing == 0
