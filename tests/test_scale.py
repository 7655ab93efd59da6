"""Work that must grow no faster than the input: one scan task, code the JVM does not compile, silver derived again and again."""
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from seawake.functions.geo import cell_id
from seawake.operators import land as ld, silver as sv
from seawake.plans import catalog as C
from seawake.session import checkpoint_dir, prepare
from seawake.sources import csv
from seawake.sources.fixture import load_events
from tests._paths import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def one_file(spark, tmp_root):
    """An ``events`` table of one file and row group, with repeated and null keys."""
    rows = spark.range(0, 4000, 1, 1).select(
        F.when(F.col("id") % 97 > 0, F.col("id") % 3900).alias("event_id"),
        (F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 3900)).alias("ts"),
        F.when(F.col("id") % 89 > 0, F.col("id") % 15).alias("user_id"))
    rows.write.parquet(f"{tmp_root}/events.parquet")
    return tmp_root


def used_tasks(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().select("count").toPandas()["count"].tolist()


def test_one_row_group_is_dealt_over_the_tasks(spark, one_file):
    events = load_events(spark, one_file)
    assert max(used_tasks(events)) <= 0.5 * sum(used_tasks(events)) and len(used_tasks(events)) >= 3
    plain = spark.read.parquet(f"{one_file}/events.parquet").select(*events.columns)
    assert plain.exceptAll(events).count() == 0 and events.exceptAll(plain).count() == 0


def test_code_stays_compilable(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_cells_parse_coordinates_once(spark):
    below = plan(ld.cell_stats(C.bronze(spark, SF_SMALL))).split("partial_count")[-1]
    assert "Filter (" not in below                       # a filter on LAT and LON would be evaluated again in the scan's task


def test_cells_leave_out_positions_off_the_globe(spark):
    at = [("a", "26.5", "-81.0"), ("a", "26.5", "-81.0"), (None, "26.5", "-81.0"), ("b", "95.0", "-81.0"), ("b", None, "-81.0"),
          ("b", "x", "1"), ("b", "NaN", "1"), ("b", "-1e300", "1"), ("b", "1", "1e300"), ("c", "-90", "180")]
    rows = spark.createDataFrame(at, "MMSI string, LAT string, LON string")
    cell = {p: spark.range(1).select(cell_id(F.lit(p[0]), F.lit(p[1]))).first()[0] for p in ((26.5, -81.0), (-90.0, 180.0))}
    got = {r.h3: (r.posiciones, r.buques) for r in ld.cell_stats(rows).collect()}
    assert got == {cell[26.5, -81.0]: (3, 1), cell[-90.0, 180.0]: (1, 1)}


def test_late_feeds_are_dealt_over_the_tasks(spark, one_file):
    first, late = C.two_feeds(spark, one_file)
    assert len(used_tasks(first)) >= 3
    whole = C.bronze(spark, one_file).count()
    assert first.count() + late.count() == whole


def test_streams_run_compilable_code(spark, tmp_root):
    checkpoint_dir(spark)
    prepare(spark)
    seen = []
    spark.range(10).write.parquet(f"{tmp_root}/in")
    (spark.readStream.schema("id long").parquet(f"{tmp_root}/in").writeStream
        .foreachBatch(lambda df, n: seen.append(df.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit")))
        .option("checkpointLocation", f"{tmp_root}/cp").trigger(availableNow=True).start().awaitTermination())
    assert seen == ["8000"]


@pytest.mark.parametrize("name", ["isolation_forest_fit", "anomaly_overlap", "top_anomalies", "model_runs"])
def test_models_derive_silver_once(spark, name):
    """A model's query reads stored ship-days; no part of it goes back to the raw table."""
    result = E.queries()[name](spark, SF_SMALL)
    assert "events.parquet" not in plan(result)
    assert result.count() == (200 if name == "isolation_forest_fit" else 1)


def test_stored_ship_days_are_the_derived_ones(spark):
    stored, moved = C.stored_ship_days(spark, SF_SMALL)
    derived = C.features(spark, SF_SMALL)
    assert stored.columns == derived.columns and moved.columns == C.trajectories(spark, SF_SMALL).columns
    key = ["mmsi", "fecha"]
    for a, b in zip(stored.orderBy(*key).collect(), derived.orderBy(*key).collect(), strict=True):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9)) for x, y in zip(a, b, strict=True))
    assert moved.count() == C.trajectories(spark, SF_SMALL).count()


def test_causes_are_compiled(spark):
    rows = C.checked(spark, SF_SMALL)
    assert "lambdafunction" not in plan(rows.select("causas")).split("Generate")[0] and rows.schema["causas"].dataType.containsNull is False


def test_valid_rows_are_chosen_above_the_scan(spark):
    below = plan(sv.dedup_valid(C.checked(spark, SF_SMALL))).split("Generate")[1].split("events.parquet")[0]
    assert "Filter (" not in below


def test_causes_of_unknown_conditions(spark):
    rows = spark.createDataFrame(
        [("1", "2024-01-01", True, False, 3.0), (None, None, None, True, 51.0), ("1", "2024-01-01", False, None, None)],
        "mmsi string, ts string, _coord_ok boolean, en_tierra boolean, sog double")
    got = [(r.causas, r.valido) for r in sv.with_causes(rows).collect()]
    assert got == [([], True), (list(sv.REJECTED_WHEN), False), (["coord_fuera_rango"], False)]


def test_only_header_lines_are_cut_into_names(spark, tmp_root):
    lines = ["MMSI,BaseDateTime", '\ufeff" B ase DateTime ","M MSI"', "367000001,2024-01-01T00:00:00", "SHIPm eDB,x", "", None]
    marks = spark.createDataFrame([(v,) for v in lines], "v string").select(csv.is_header(F.col("v"))).collect()
    assert [m[0] for m in marks] == [True, True, False, False, False, None]
    for name, text in (("a", "MMSI,BaseDateTime\n1,2"), ("b", "1,2\n1,2"), ("c", "MMSI,BaseDateTime\nBaseDateTime,MMSI\n")):
        spark.createDataFrame([(text,)], "v string").coalesce(1).write.text(f"{tmp_root}/in/{name}")
    heads = csv.file_headers(spark, f"{tmp_root}/in/*")
    got = sorted((r._source_file.split("/")[-2], r.header, r.modified is not None) for r in heads.collect())
    assert got == [("a", "MMSI,BaseDateTime", True), ("b", None, True), ("c", "BaseDateTime,MMSI", True)]
    scan = plan(heads).split("Exchange")[-1]                       # up to the first shuffle
    assert "HashAggregate" in scan and "SortAggregate" not in scan


def test_kept_rows_hold_the_raw_text_of_rejected_rows_only(spark):
    rows = C.checked(spark, SF_SMALL)
    kept = sv.raw_of_rejected(rows)
    assert kept.where("valido AND raw IS NOT NULL").isEmpty()
    a, b = (sv.quarantine_rows(r).drop("_quarantined_at", "_ingested_at") for r in (rows, kept))
    assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_feeds_are_landed_in_one_pass(spark, one_file, tmp_root, monkeypatch):
    writes, write = [], C.write_day_files
    monkeypatch.setattr(C, "write_day_files", lambda *a, **k: (writes.append(1), write(*a, **k)))
    for sf, n in ((SF_SMALL, 0), (one_file, 1)):                    # the second has no late rows
        folders = C.land_two_feeds(spark, sf, f"{tmp_root}/landing{n}")
        assert len(writes) == n + 1
        for feed, folder in zip(C.two_feeds(spark, sf), folders, strict=True):
            assert csv.file_headers(spark, f"{folder}/*" if n == 0 else folder).count() == feed.select("_source_file").distinct().count()
            lines = spark.read.option("recursiveFileLookup", True).text(folder).where(~F.col("value").startswith("MMSI,"))
            assert lines.count() == feed.count()
