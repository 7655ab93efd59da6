"""Storage layouts and the box query that compares them.

Three layouts of the same positions: unpartitioned, partitioned by day, and partitioned by
day + 1° latitude / longitude buckets. The box query (distinct ships and mean speed inside a
lat/lon box on one day) reads the fewest files on the last layout: the day and bucket
predicates become ``PartitionFilters`` and the exact lat/lon predicates ``PushedFilters``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.functions.numeric import fixed
from seawake.session import checkpoint_dir

LAYOUTS = {
    "flat": [],
    "day": ["date"],
    "day_box": ["date", "lat_bucket", "lon_bucket"],
}

# Box of the comparison query (a 10° × 10° box over the test tracks) and its day.
BOX = {"lat_min": 25, "lat_max": 35, "lon_min": -85, "lon_max": -75}
BOX_DAY = "2024-01-05"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/seawake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_layout(opt: DataFrame, path: str, layout: str) -> None:
    """Write the partition-column frame in one layout.

    Rows are grouped by the partition keys before writing (few files per partition value,
    no swarm of tiny files) and clustered by ship and time inside each file.
    """
    cols = LAYOUTS[layout]
    # REBALANCE keeps a partition value's rows together but lets AQE split a hot value
    # (one busy day or box) into advisory-size files and merge small ones
    w = opt.hint("rebalance", *cols) if cols else opt
    w = w.sortWithinPartitions("MMSI", "BaseDateTime")
    writer = w.write.mode("overwrite").option("compression", "snappy")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


Z_BITS = 10                 # of day, latitude and longitude each: steps of a day, 0.18° and 0.35°


def z_order(day: Column, lat: Column, lon: Column) -> Column:
    """Place on the Z-order curve through (day, latitude, longitude): their bits interleaved, so that rows near in all three lie near."""
    cells = 1 << Z_BITS
    axes = [F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(cells)),
            F.least(F.floor((lat + 90) / 180 * cells), F.lit(cells - 1)), F.least(F.floor((lon + 180) / 360 * cells), F.lit(cells - 1))]
    bits = [F.shiftleft(F.shiftright(axis.cast("long"), b).bitwiseAND(F.lit(1)), 3 * b + k)
            for k, axis in enumerate(axes) for b in range(Z_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_z_order(opt: DataFrame, path: str, files: int | None = None) -> None:
    """Write positions unpartitioned, ranged over files and sorted inside them along the Z-order curve.

    Every file covers a short stretch of the curve, so its minima and maxima of day, latitude and longitude exclude it from most
    boxes; a crowded place takes several files, and no folder per box is needed. Rows without a place on the curve come first.
    """
    keyed = opt.withColumn("_z", z_order(F.to_date("BaseDateTime"), F.col("LAT"), F.col("LON")))
    ranged = keyed.repartitionByRange(files, "_z", "MMSI", "BaseDateTime") if files else keyed.repartitionByRange("_z", "MMSI", "BaseDateTime")
    ranged.sortWithinPartitions("_z", "MMSI", "BaseDateTime").drop("_z").write.mode("overwrite").parquet(path)


def files_met(spark: SparkSession, path: str, day: str = BOX_DAY, box: dict = BOX) -> tuple[int, int, int, int]:
    """Files, bytes of those whose minima and maxima meet the box and its day; then of all files."""
    per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.max("_metadata.file_size").alias("b"), F.min("LAT").alias("lat0"), F.max("LAT").alias("lat1"),
        F.min("LON").alias("lon0"), F.max("LON").alias("lon1"),
        F.min(F.to_date("BaseDateTime")).alias("d0"), F.max(F.to_date("BaseDateTime")).alias("d1"))
    d = F.lit(day).cast("date")
    met = ((F.col("lat0") <= box["lat_max"]) & (F.col("lat1") >= box["lat_min"]) & (F.col("lon0") <= box["lon_max"])
           & (F.col("lon1") >= box["lon_min"]) & (F.col("d0") <= d) & (F.col("d1") >= d))
    return tuple(per.agg(F.count_if(met), F.coalesce(F.sum(F.when(met, F.col("b"))), F.lit(0)), F.count("*"),
                         F.coalesce(F.sum("b"), F.lit(0))).first())


def _partition_paths(spark: SparkSession, path: str, layout: str, day: str, box: dict) -> list[str]:
    """Only the partition folders the query can touch (no listing of the other days / boxes).

    Without a metastore, reading the table root lists every partition folder before pruning;
    globbing the day (and the bucket ranges) lists just those folders.
    """
    pattern = f"{path}/date={day}"
    if layout == "day_box":
        lat = ",".join(str(i) for i in range(box["lat_min"], box["lat_max"] + 1))
        lon = ",".join(str(i) for i in range(box["lon_min"], box["lon_max"] + 1))
        pattern += f"/lat_bucket={{{lat}}}/lon_bucket={{{lon}}}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [str(f.getPath().toString()) for f in (found or [])]


def box_input(spark: SparkSession, path: str, layout: str, day: str = BOX_DAY, box: dict = BOX) -> DataFrame:
    """The stored rows whose folders the box query opens."""
    if layout == "flat":
        return spark.read.parquet(path)
    paths = _partition_paths(spark, path, layout, day, box)
    reader = spark.read.option("basePath", path)
    return reader.parquet(*paths) if paths else reader.parquet(path).where(F.lit(False))


def box_query(spark: SparkSession, path: str, layout: str, day: str = BOX_DAY, box: dict = BOX) -> DataFrame:
    """Distinct ships and mean speed in ``box`` on ``day``, written for each layout's pruning."""
    return box_query_frame(box_input(spark, path, layout, day, box), layout, day, box)


def box_files(spark: SparkSession, path: str, layout: str) -> tuple[int, int]:
    """Files and bytes the box query opens in a layout."""
    files = box_input(spark, path, layout).select(F.col("_metadata.file_path").alias("f"),
                                                  F.col("_metadata.file_size").alias("b")).distinct()
    return tuple(files.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first())


def box_query_frame(df: DataFrame, layout: str, day: str = BOX_DAY, box: dict = BOX) -> DataFrame:
    """The box query over an already loaded frame (e.g. the typed CSV scan for ``flat``)."""
    pred = (F.col("LAT").between(box["lat_min"], box["lat_max"])
            & F.col("LON").between(box["lon_min"], box["lon_max"]))
    if layout == "flat":
        pred = pred & (F.col("BaseDateTime") >= F.lit(day).cast("timestamp")) & \
            (F.col("BaseDateTime") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp"))
    else:
        pred = pred & (F.col("date") == F.lit(day).cast("date"))
    if layout == "day_box":
        # bucket = round(coordinate); a box edge at x covers buckets round(x)
        pred = pred & F.col("lat_bucket").between(box["lat_min"], box["lat_max"]) \
                    & F.col("lon_bucket").between(box["lon_min"], box["lon_max"])
    return df.where(pred).agg(F.count_distinct("MMSI").alias("buques"),
                              fixed(F.avg("SOG"), 6).alias("velocidad_media"))
