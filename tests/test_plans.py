"""Plan shapes: pruning reaches the scan, no Python in the hot paths, no cartesian products."""
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests._paths import SF_MID, SF_SMALL
from seawake.plans import catalog as C
from seawake.plans import layout as ly


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_box_query_prunes_partitions(spark, tmp_root):
    path = os.path.join(tmp_root, "opt")
    ly.write_layout(C.optimized(spark, SF_SMALL), path, "day_box")
    p = plan(ly.box_query(spark, path, "day_box"))
    assert "PartitionFilters: [isnotnull(date" in p and "lat_bucket" in p.split("PartitionFilters")[1]
    assert "PushedFilters: [IsNotNull(LAT), IsNotNull(LON)" in p
    assert ly.box_query(spark, path, "day_box").collect() == ly.box_query(spark, path, "day").collect()


def test_scan_reads_only_needed_columns(spark):
    p = plan(C.trajectories(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p or \
           "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in p


@pytest.mark.parametrize("name", ["daily_trajectories", "traffic_cell_hour", "port_presence", "silver_typed",
                                  "quality_summary", "top_distance", "day_kpis", "speed_features"])
def test_no_python_and_no_cartesian(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def exchanges(p):
    """Row shuffles of a plan (broadcasts left out)."""
    return re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning)", p)


def stored_silver(spark, tmp_root):
    path = os.path.join(tmp_root, "silver")
    C.silver(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_ship_day_windows_share_the_grouping_shuffle(spark, tmp_root):
    from seawake.operators import forest as fo, gold
    s = stored_silver(spark, tmp_root)
    traj = plan(gold.daily_trajectories(s))
    assert len(exchanges(traj)) == 1 and "mmsi" in exchanges(traj)[0] and "fecha" in exchanges(traj)[0]
    assert traj.count("Scan parquet") == 1
    assert len(exchanges(plan(fo.speed_features(s, gold.daily_trajectories(s))))) <= 3
    # a ship-day is bounded: silver holds one row per ship and second
    assert s.groupBy("mmsi", "fecha").count().agg({"count": "max"}).first()[0] <= 86_400
    assert s.count() == s.select("mmsi", "ts").distinct().count()


def test_period_segments_are_windowed_per_ship_and_day_once(spark):
    p = plan(E.queries()["segments_period"](spark, SF_SMALL))
    assert not re.search(r"hashpartitioning\(MMSI#\d+, \d+\)", p)          # rows never by ship alone
    assert len(re.findall(r"row_number\(\) windowspecdefinition", p)) == 1


def test_duplicates_shuffle_hashes_not_rows(spark, tmp_root):
    from seawake.operators import study as st
    path = os.path.join(tmp_root, "typed")
    C.typed(spark, SF_SMALL).write.parquet(path)
    p = plan(st.duplicate_profile(spark.read.parquet(path)))
    whole = [e for e in exchanges(p) if "VesselName" in e]
    assert len(whole) == 1                                  # of the rows that share key and hash only ...
    after = p[p.index(whole[0]):]
    assert "LeftSemi" in after.split("Exchange hashpartitioning", 1)[0]     # ... the join lies right below that exchange
    assert any(re.search(r"MMSI#\d+, BaseDateTime#\d+, h1#\d+L, h2#\d+L", e) for e in exchanges(p))
    dd = plan(C.deduped(spark, SF_SMALL))
    assert "partial_min(struct(" in dd


def test_metrics_never_reach_the_driver_per_day(spark):
    # the long-form metrics are an unpivot on executors: no Python, no local relation from collected rows
    p = plan(C.metrics(spark, SF_SMALL))
    assert "Expand" in p or "Generate" in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_box_query_on_missing_day_or_box(spark, tmp_root):
    path = os.path.join(tmp_root, "opt2")
    ly.write_layout(C.optimized(spark, SF_SMALL), path, "day_box")
    empty_day = ly.box_query(spark, path, "day_box", day="2030-01-01").first()
    assert empty_day.buques == 0 and empty_day.velocidad_media is None
    far_box = ly.box_query(spark, path, "day_box", box={"lat_min": -10, "lat_max": -5, "lon_min": 0, "lon_max": 5}).first()
    assert far_box.buques == 0


def test_z_order_opens_few_files(spark, tmp_root):
    path, flat = os.path.join(tmp_root, "z"), os.path.join(tmp_root, "flat")
    opt = C.optimized(spark, SF_MID)
    ly.write_z_order(opt, path, files=64)
    opt.repartition(64).write.parquet(flat)
    files, size, all_files, all_size = ly.files_met(spark, path)
    assert all_files == 64 and files <= 24 and size < all_size / 2       # a quarter: four of the stretches a day, the box fills the rest
    assert ly.files_met(spark, flat)[0] == 64                      # without an order every file meets the box
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan(ly.box_query(spark, path, "flat"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in p and "GreaterThanOrEqual(LAT" in p and "GreaterThanOrEqual(BaseDateTime" in p
    assert ly.box_query(spark, path, "flat").collect() == ly.box_query(spark, flat, "flat").collect()


def test_z_order_interleaves_bits(spark):
    rows = [("2024-01-05", 26.3, -80.1), ("2024-01-06", 26.3, -80.1), ("2024-01-05", -90.0, -180.0), ("2024-01-05", 90.0, 180.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d string, lat double, lon double").select(F.to_date("d").alias("d"), "lat", "lon")
    got = [r[0] for r in df.select(ly.z_order(F.col("d"), F.col("lat"), F.col("lon"))).collect()]

    def slow(day, lat, lon):
        axes = [day % 1024, min(int((lat + 90) / 180 * 1024), 1023), min(int((lon + 180) / 360 * 1024), 1023)]
        return sum((a >> b & 1) << (3 * b + k) for k, a in enumerate(axes) for b in range(10))

    days = [19727, 19728, 19727, 19727]
    assert got == [*(slow(d, r[1], r[2]) for d, r in zip(days, rows, strict=False)), None]
