"""GeoJSON layers (land, lakes, rivers) → an edge table, read and exploded by Spark.

Coordinates are read as raw JSON text and parsed per geometry type, so Polygon,
MultiPolygon, LineString and MultiLineString features can share one file.
Edge table: (layer, poly, x1, y1, x2, y2) with ``poly`` = feature:part (rings of one
polygon part share it, holes included). Parts whose edges jump across the antimeridian
are unwrapped by +360° on their negative longitudes and given a second time one turn to the west,
so that cells on either side of ±180° meet them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "features array<struct<geometry: struct<type: string, coordinates: string>>>"
_PT = "array<double>"


def _ring_edges(ring):
    """Consecutive vertex pairs of a ring / line as structs (x1, y1, x2, y2)."""
    idx = F.sequence(F.lit(0), F.size(ring) - 2)
    return F.transform(idx, lambda i: F.struct(ring[i][0].alias("x1"), ring[i][1].alias("y1"),
                                               ring[i + 1][0].alias("x2"), ring[i + 1][1].alias("y2")))


def read_edges(spark: SparkSession, path: str, layer: str) -> DataFrame:
    raw = spark.read.schema(_SCHEMA).option("multiLine", True).json(path)
    feats = raw.select(F.posexplode("features").alias("fid", "f")).where(F.col("f.geometry").isNotNull())
    g = feats.select("fid", F.col("f.geometry.type").alias("t"), F.col("f.geometry.coordinates").alias("c"))
    # every geometry as array<part> of array<ring> of array<point>
    parts = (F.when(F.col("t") == "Polygon", F.array(F.from_json("c", f"array<array<{_PT}>>")))
              .when(F.col("t") == "MultiPolygon", F.from_json("c", f"array<array<array<{_PT}>>>"))
              .when(F.col("t") == "LineString", F.array(F.array(F.from_json("c", f"array<{_PT}>"))))
              .when(F.col("t") == "MultiLineString", F.transform(F.from_json("c", f"array<array<{_PT}>>"),
                                                                 lambda ln: F.array(ln))))
    p = g.select("fid", F.posexplode(parts).alias("pid", "rings"))
    e = (p.select("fid", "pid", F.explode("rings").alias("ring"))
          .select("fid", "pid", F.explode(_ring_edges(F.col("ring"))).alias("e"))
          .select(F.lit(layer).alias("layer"), F.concat_ws(":", "fid", "pid").alias("poly"), "e.*"))
    # antimeridian: a part with an edge longer than 180° in longitude is shifted to [0, 360)
    wraps = e.groupBy("poly").agg(F.max(F.abs(F.col("x2") - F.col("x1")) > 180).alias("wrap"))
    e = e.join(wraps, "poly")
    shift = lambda x: F.when(F.col("wrap") & (F.col(x) < 0), F.col(x) + 360).otherwise(F.col(x))
    east = e.select("layer", "poly", shift("x1").alias("x1"), "y1", shift("x2").alias("x2"), "y2", "wrap")
    # cells keep longitudes in [-180, 180): their western side meets the same part one turn back
    west = east.where("wrap").select("layer", F.concat("poly", F.lit(":west")).alias("poly"),
                                     (F.col("x1") - 360).alias("x1"), "y1", (F.col("x2") - 360).alias("x2"), "y2")
    return east.drop("wrap").unionByName(west)


def write_geojson(spark: SparkSession, path: str, features: list[dict]) -> None:
    """Write a small FeatureCollection (test layers) as one JSON document, through Spark.

    Going through the DataFrame writer works on any shared file system the cluster uses.
    """
    doc = json.dumps({"type": "FeatureCollection", "features": features})
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def polygon(*rings) -> dict:
    return {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [list(r) for r in rings]}}


def line(*pts) -> dict:
    return {"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": list(pts)}}


def box(x0, y0, x1, y1) -> list:
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


# Test layers placed on the simulated tracks (fixed test values). Coordinates avoid the
# 0.02° cell grid so no cell corner lies exactly on an edge.
TEST_LAND = [polygon(box(-81.497, 26.003, -80.503, 26.997)),
             polygon([[179.003, 10.003], [-179.003, 10.003], [-179.003, 10.997], [179.003, 10.997], [179.003, 10.003]])]
TEST_LAKES = [polygon(box(-81.297, 26.303, -81.103, 26.497))]
TEST_RIVERS = [line([-81.497, 26.801], [-80.503, 26.851])]
