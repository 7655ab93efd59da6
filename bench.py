"""Benchmark of the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf", ...}.
Each query is run once to warm up, then three times; the median is reported. Actions use
the ``noop`` sink so the whole plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from seawake.operators import gold, ports as pt, silver as sv  # noqa: E402
from seawake.plans import catalog as C  # noqa: E402
from seawake.plans import layout as ly  # noqa: E402
from seawake.session import checkpoint_dir, get_session  # noqa: E402
from seawake.sources.fixture import load_events, raw_positions  # noqa: E402
from seawake.sources import sinks  # noqa: E402
from seawake.sources.csv import read_typed, write_day_files  # noqa: E402
from seawake.sources.ports import fixture_ports  # noqa: E402
from seawake.streaming import bronze as br, silver as ss  # noqa: E402
from seawake.streaming.silver import Lake  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    fn()   # warm-up
    times = []
    for _ in range(RUNS):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    spark = get_session()
    checkpoint_dir(spark)
    sf = SF_DIR
    queries: dict[str, float] = {}
    extra: dict[str, float] = {}

    # bronze and silver are stored tables in the pipeline: write them once, as the jobs do
    bronze_path = ly.scratch_dir(spark, "bench-bronze")
    C.bronze(spark, sf).write.parquet(bronze_path)
    b = spark.read.parquet(bronze_path)
    n_in = b.count()
    silver_path = ly.scratch_dir(spark, "bench-silver")
    cells = C.land_cells(spark, sf)                 # the stored land mask, as in the daily chain
    sv.silver_rows(sv.dedup_valid(sv.checked(b, cells))).write.partitionBy("fecha").parquet(silver_path)
    s = spark.read.parquet(silver_path)

    # a fixed job of the engine alone, to tell a slow machine from slow code
    extra["calibration_s"] = round(timed(lambda: run(spark.range(20_000_000).selectExpr("xxhash64(id) % 1000 AS k")
                                                     .groupBy("k").count())), 3)
    queries["silver_batch"] = timed(lambda: run(sv.silver_rows(sv.dedup_valid(sv.checked(b, cells)))))
    extra["silver_rows_per_s"] = round(n_in / queries["silver_batch"], 1)
    queries["daily_trajectories"] = timed(lambda: run(gold.daily_trajectories(s)))
    queries["traffic_cell_hour"] = timed(lambda: run(gold.traffic_cell_hour(s)))
    zones = pt.port_cells(fixture_ports(spark)).cache()
    zones.count()
    queries["port_presence"] = timed(lambda: run(pt.port_presence(s, zones)))

    # silver as a micro-batch stream (foreachBatch, three outputs per batch) from CSV day files
    landing = ly.scratch_dir(spark, "bench-landing")
    write_day_files(raw_positions(load_events(spark, sf)), landing)

    def stream_once():
        lake = Lake(ly.scratch_dir(spark, "bench-lake"))
        br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"))
        t0 = time.perf_counter()
        ss.run_silver(spark, lake, cells, max_bytes_per_trigger=1 << 30)     # 1 GiB per micro-batch
        return time.perf_counter() - t0

    stream_once()
    st_times = sorted(stream_once() for _ in range(RUNS))
    queries["silver_stream"] = st_times[len(st_times) // 2]
    extra["silver_stream_rows_per_s"] = round(n_in / queries["silver_stream"], 1)

    # the box query on the raw CSV files (the unpartitioned starting point) ...
    csv = read_typed(spark, f"{landing}/*/*.csv")
    queries["box_query_csv"] = timed(lambda: ly.box_query_frame(csv, "flat").collect())

    # ... and on the same positions in three Parquet layouts
    opt = C.optimized(spark, sf)
    paths = {}
    for layout in ("flat", "day", "day_box"):
        path = paths[layout] = ly.scratch_dir(spark, f"bench-{layout}")
        ly.write_layout(opt, path, layout)
        queries[f"box_query_{layout}"] = timed(lambda p=path, lo=layout: ly.box_query(spark, p, lo).collect())
        extra[f"box_files_{layout}"], extra[f"box_bytes_{layout}"] = ly.box_files(spark, path, layout)
    path = ly.scratch_dir(spark, "bench-z")
    ly.write_z_order(opt, path, files=32)
    queries["box_query_z_order"] = timed(lambda: ly.box_query(spark, path, "flat").collect())
    extra["box_files_z_order"], extra["box_bytes_z_order"], extra["z_order_files"], _ = ly.files_met(spark, path)
    extra["box_speedup_csv_to_day_box"] = round(queries["box_query_csv"] / queries["box_query_day_box"], 2)
    # stored bytes: raw CSV day files against the day + box Parquet layout (Snappy)
    csv_bytes = sinks.total_bytes(spark.read.text(f"{landing}/*/*.csv"))
    pq_bytes = sinks.total_bytes(spark.read.parquet(paths["day_box"]))
    extra["csv_bytes"], extra["parquet_day_box_bytes"] = csv_bytes, pq_bytes
    extra["parquet_vs_csv"] = round(pq_bytes / csv_bytes, 3)

    try:
        from seawake.operators import forest as fo
        feats = fo.speed_features(s, gold.daily_trajectories(s)).cache()
        feats.count()
        queries["forest_fit"] = timed(lambda: fo.fit(feats).nodes.count())
        model = fo.fit(feats)
        queries["forest_score"] = timed(lambda: run(fo.score(feats, model)))
    except ImportError:
        pass

    queries = {k: round(v, 3) for k, v in queries.items()}
    sfv = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(queries.values()), 3),
                      "unit": "sec", "queries": queries, "sf": sfv,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8")), **extra}))


if __name__ == "__main__":
    main()
