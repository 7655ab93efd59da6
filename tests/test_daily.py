"""The daily chain end to end on the smallest tables, and the SQL surface against the DataFrame jobs."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests._paths import SF_SMALL
from seawake.operators import dashboard as db, ports as pt, quality as qa, study as st
from seawake.plans import catalog as C
from seawake.plans import daily, views
from seawake.sources.csv import write_day_files
from seawake.sources.fixture import load_events, raw_positions
from seawake.sources.ports import fixture_ports
from seawake.streaming.silver import Lake

DAY = "2024-01-08"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    landing = os.path.join(root, "landing")
    write_day_files(raw_positions(load_events(spark, SF_SMALL)), landing)
    lk = Lake(os.path.join(root, "lake"))
    with pytest.raises(qa.QualityGateFailed):      # the test data has ~5 % bad rows: the gate stops
        daily.run_days(spark, lk, landing, "2024-01-08,2024-01-09", fixture_ports(spark))
    out = daily.run_days(spark, lk, landing, "2024-01-08,2024-01-09", fixture_ports(spark), enforce_gate=False)
    assert len(out["days"]) == 2
    return lk


def test_outputs_only_requested_days(spark, lake):
    for path in (lake.traffic, lake.trajectories, lake.presence, lake.anomalies):
        days = {str(r[0]) for r in spark.read.parquet(path).select("fecha").distinct().collect()}
        assert days <= {"2024-01-08", "2024-01-09"}
    log = spark.read.parquet(lake.gate_log)
    assert log.count() == 4 and log.where(F.col("resultado").startswith("FALLA")).count() == 4


def test_rerun_is_idempotent(spark, lake):
    before = spark.read.parquet(lake.trajectories).count()
    daily.build_gold(spark, lake, [dt.date(2024, 1, 8), dt.date(2024, 1, 9)], fixture_ports(spark))
    assert spark.read.parquet(lake.trajectories).count() == before


def test_contract_holds(spark, lake):
    bad = daily.contract(spark, lake).where("violaciones > 0").collect()
    assert bad == []
    meta = spark.read.parquet(lake.trajectories).schema["distancia_km"].metadata
    assert "comment" in meta


def test_dashboard_sql_equals_dataframe_jobs(spark, lake):
    views.register_layer_views(spark, lake)
    traj, pres = spark.read.parquet(lake.trajectories), spark.read.parquet(lake.presence)
    metr, traf = spark.read.parquet(lake.metrics), spark.read.parquet(lake.traffic)
    dim = pt.ship_type_dim(spark)
    pairs = {"kpis_dia": db.day_kpis(traj, pres, metr, DAY), "mapa_trafico": db.day_map(traf, DAY),
             "ranking_puertos": db.port_ranking(pres, dim, DAY), "buques_en_puerto": db.port_ships(pres, dim, DAY),
             "anomalias_dia": db.day_anomalies(traj, metr, DAY)}
    for name, df in pairs.items():
        sql = views.dashboard(spark, name, DAY)
        a = sorted(map(tuple, sql.select(*df.columns).collect()), key=str)
        b = sorted(map(tuple, df.collect()), key=str)
        assert a == b, name


def test_study_views_equal_dataframe_versions(spark):
    opt = C.optimized(spark, SF_SMALL)
    views.create_study_views(spark, opt)
    for view, df in (("v_daily_traffic_summary", st.daily_summary(opt)),
                     ("v_traffic_by_vessel_type", st.type_summary(opt)),
                     ("v_spatial_concentration", st.box_summary(opt))):
        v = spark.table(view)
        assert sorted(map(tuple, v.select(*df.columns).collect()), key=str) == \
               sorted(map(tuple, df.collect()), key=str), view


def test_next_feed_day(spark, lake, tmp_root):
    assert daily.next_feed_day(spark, lake, "2024-01-01") == dt.date(2024, 1, 31)
    assert daily.next_feed_day(spark, Lake(os.path.join(tmp_root, "empty")), "2024-01-01") == dt.date(2024, 1, 1)


def test_backfill_with_land_mask_quarantines_land_positions(spark, tmp_path_factory):
    from seawake.sources import geojson as gj
    root = str(tmp_path_factory.mktemp("backfill"))
    landing = os.path.join(root, "landing")
    write_day_files(raw_positions(load_events(spark, SF_SMALL)), landing)
    layers = []
    for name, feats in (("land", gj.TEST_LAND), ("lakes", gj.TEST_LAKES), ("rivers", gj.TEST_RIVERS)):
        gj.write_geojson(spark, f"{root}/{name}.geojson", feats)
        layers.append(gj.read_edges(spark, f"{root}/{name}.geojson", name))
    lk = Lake(os.path.join(root, "lake"))
    daily.run_days(spark, lk, landing, "todas", fixture_ports(spark), enforce_gate=False, geo_layers=tuple(layers))
    mask = spark.read.parquet(lk.land)
    land_cells = {r.h3 for r in mask.where("es_tierra").select("h3").collect()}
    assert land_cells
    q = spark.read.parquet(lk.quarantine)
    on_land = q.where(F.array_contains("causas", "posible_en_tierra")).count()
    assert on_land > 0
    s = spark.read.parquet(lk.silver)
    assert s.where(F.col("h3_r7").isin(list(land_cells))).count() == 0


def test_stored_model_scores_like_the_fitted_one(spark, lake):
    from seawake.operators import forest as fo
    stored = fo.load_latest_model(spark, lake.model, lake.model_runs)
    feats = spark.read.parquet(lake.features)
    a = fo.score(feats, stored).select("mmsi", "fecha", "s")
    runs = spark.read.parquet(lake.model_runs)
    assert runs.count() >= 1 and stored.threshold is not None
    anom = spark.read.parquet(lake.anomalies)
    got = {(r.mmsi, str(r.fecha)): r.puntaje for r in anom.collect()}
    exp = {(r.mmsi, str(r.fecha)): r.s - stored.threshold for r in a.collect()}
    assert got and all(abs(got[k] - exp[k]) < 1e-12 for k in got)


def test_gate_without_any_input_fails_cleanly(spark, tmp_root):
    lk = Lake(os.path.join(tmp_root, "nothing"))
    with pytest.raises(qa.QualityGateFailed) as e:
        daily.gate(spark, lk, [dt.date(2024, 1, 8)])
    assert "sin filas de entrada" in str(e.value)
    assert spark.read.parquet(lk.gate_log).count() == 1


def test_late_rows_rebuild_only_the_days_they_touch(spark, tmp_root):
    from seawake.plans.catalog import LATE_DAYS, two_feeds
    from seawake.functions.dates import parse_days
    from seawake.sources.sinks import child_names, stored_days
    from seawake.streaming import silver as ss
    first, late = two_feeds(spark, SF_SMALL)
    lk, zones = Lake(os.path.join(tmp_root, "lake")), pt.port_cells(fixture_ports(spark))
    late_days = parse_days(LATE_DAYS)

    def files():
        return {(n, d): set(child_names(spark, f"{getattr(lk, n)}/fecha={d}"))
                for n in daily.GOLD for d in stored_days(spark, getattr(lk, n))}

    write_day_files(first, os.path.join(tmp_root, "landing", "a"))
    daily.ingest(spark, lk, os.path.join(tmp_root, "landing", "a"))
    assert set(daily.refresh_marks(spark, lk).values()) == {-1}
    daily.refresh_gold(spark, lk, fixture_ports(spark))
    before, mark = files(), daily.refresh_marks(spark, lk)
    assert daily.due_days(spark, lk) == {n: [] for n in daily.GOLD}        # nothing new: nothing due

    write_day_files(late, os.path.join(tmp_root, "landing", "b"))
    daily.ingest(spark, lk, os.path.join(tmp_root, "landing", "b"))
    asked = [dt.date(2024, 1, 20)]
    assert daily.due_days(spark, lk, asked) == {n: sorted([*late_days, *asked]) for n in daily.GOLD}
    assert daily.refresh_gold(spark, lk, fixture_ports(spark)) == {n: late_days for n in daily.GOLD}
    after = files()
    for n in daily.GOLD:
        changed = {d for (m, d), names in after.items() if m == n and names != before.get((n, d))}
        assert changed <= {str(d) for d in late_days} and (changed or n == "presence")
        assert daily.refresh_marks(spark, lk)[n] > mark[n]
        table, build, _ = daily.GOLD[n]
        want = build(ss.silver_table(spark, lk), zones)
        got = daily.gold_table(spark, lk, n).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # the same feed once more: its rows are known, so no day changed
    ss.SilverBatch(lk)(spark.read.parquet(lk.bronze).where(F.col("_source_file").contains("/b/")), ss.committed_batch(spark, lk) + 1)
    assert ss.changed_days(spark, lk, ss.committed_batch(spark, lk), 10**6) == []
    assert ss.touched_days(spark, lk, ss.committed_batch(spark, lk)).count() == len(late_days)
