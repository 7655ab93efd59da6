"""Stream faults: files exactly once after a failed batch; silver retry gives the same numbers."""
import os

import pytest
from pyspark.sql import functions as F

from seawake.schema import RAW_COLUMNS
from seawake.sources.csv import raw_line_counts
from seawake.streaming import bronze as br
from seawake.streaming import silver as ss

HEADER = ",".join(RAW_COLUMNS)


def line(i, mmsi="367000001", day="2024-01-05", lat="26.5"):
    return (f"{mmsi},{day}T10:{i:02d}:00,{lat},-80.5,10.0,90.0,90,SHIP 1,IMO9000001,CS1,70,0,100,20,5,70,A")


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join([HEADER] + lines) + "\n")


@pytest.fixture()
def landing(tmp_root):
    src = os.path.join(tmp_root, "landing")
    write(src, "AIS_2024_01_05.csv", [line(i) for i in range(3)])
    write(src, "AIS_2024_01_06.csv", [line(i, day="2024-01-06") for i in range(3)])
    write(src, "AIS_2024_01_07.csv", [line(i, day="2024-01-07") for i in range(4)])
    return src


def test_fail_then_resume_loses_and_repeats_nothing(spark, tmp_root, landing):
    lake = ss.Lake(os.path.join(tmp_root, "lake"))
    with pytest.raises(Exception):
        br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"),
                      max_files_per_trigger=1, fail_on="AIS_2024_01_07")
    before = spark.read.parquet(lake.bronze).count()
    assert before == 6
    br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger=1)
    b = spark.read.parquet(lake.bronze)
    per_file = {os.path.basename(r._source_file): r.filas for r in br.bronze_check(b).collect()}
    assert per_file == {"AIS_2024_01_05.csv": 3, "AIS_2024_01_06.csv": 3, "AIS_2024_01_07.csv": 4}
    rec = br.reconcile_files(spark, b, f"{landing}/*.csv").collect()
    assert all(r.diferencia == 0 for r in rec) and len(rec) == 3
    # a re-run with no new file adds nothing
    br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"))
    assert spark.read.parquet(lake.bronze).count() == 10


def test_too_many_fields_is_rescued(spark, tmp_root):
    src = os.path.join(tmp_root, "landing2")
    write(src, "AIS_2024_01_08.csv", [line(0), line(1) + ",EXTRA,FIELDS"])
    lake = ss.Lake(os.path.join(tmp_root, "lake2"))
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"))
    rescued = spark.read.parquet(lake.bronze).where(F.col("_rescued_data").isNotNull()).collect()
    assert len(rescued) == 1 and "EXTRA" in rescued[0]._rescued_data


def _run_pipeline(spark, root, src, fail_after=None):
    lake = ss.Lake(root)
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger=1)
    if fail_after is not None:
        with pytest.raises(Exception):
            ss.run_silver(spark, lake, max_files_per_trigger=1, fail_after_silver=fail_after)
    ss.run_silver(spark, lake, max_files_per_trigger=1)
    return lake


def test_silver_retry_after_partial_write_is_exact(spark, tmp_root):
    src = os.path.join(tmp_root, "landing3")
    # day 5 sent twice (second file repeats two rows: duplicates against history), a bad row
    write(src, "AIS_a.csv", [line(i) for i in range(4)] + [line(9, mmsi="X1")])
    write(src, "AIS_b.csv", [line(0), line(1), line(5)])
    write(src, "AIS_c.csv", [line(i, day="2024-01-06") for i in range(3)] + [line(0, day="2024-01-06")])
    clean = _run_pipeline(spark, os.path.join(tmp_root, "clean"), src)
    retried = _run_pipeline(spark, os.path.join(tmp_root, "retried"), src, fail_after=1)

    def snapshot(lake):
        s = sorted(tuple(r) for r in spark.read.parquet(lake.silver).select("mmsi", "ts", "batch_id").collect())
        m = sorted((str(r.fecha), r.metrica, r.valor, r.batch_id) for r in
                   spark.read.parquet(lake.metrics).select("fecha", "metrica", "valor", "batch_id").collect())
        q = spark.read.parquet(lake.quarantine).count()
        return s, m, q

    assert snapshot(clean) == snapshot(retried)
    s, m, q = snapshot(clean)
    assert len(s) == 4 + 1 + 3 and q == 1
    tot = {}
    for _, k, v, _ in m:
        tot[k] = tot.get(k, 0) + v
    assert tot["duplicados_contra_historico"] == 2 and tot["duplicados"] == 1
    # conservation: bronze = silver + quarantine + duplicates
    bal = __import__("seawake.operators.quality", fromlist=["x"]).layer_balance(
        spark.read.parquet(clean.bronze), spark.read.parquet(clean.silver), spark.read.parquet(clean.quarantine),
        spark.read.parquet(clean.metrics)).first()
    assert bal.diferencia == 0 and bal.bronce == 12
    days = {str(r.fecha) for r in ss.touched_days(spark, clean, after_batch=-1).collect()}
    assert days == {"2024-01-05", "2024-01-06"}


def test_raw_line_counts(spark, landing):
    c = {os.path.basename(r._source_file): r.lineas_csv for r in raw_line_counts(spark, f"{landing}/*.csv").collect()}
    assert c == {"AIS_2024_01_05.csv": 3, "AIS_2024_01_06.csv": 3, "AIS_2024_01_07.csv": 4}


def test_silver_byte_capped_batches(spark, tmp_root, landing):
    lake = ss.Lake(os.path.join(tmp_root, "lake4"))
    br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger=1)
    ss.run_silver(spark, lake, max_bytes_per_trigger=1)           # one file per batch at most
    batches = spark.read.parquet(lake.metrics).select("batch_id").distinct().count()
    assert batches == 3 and spark.read.parquet(lake.silver).count() == 10


def test_typed_csv_and_port_csv(spark, tmp_root, landing):
    from seawake.sources.csv import read_typed
    from seawake.sources.ports import read_port_csv
    t = read_typed(spark, f"{landing}/*.csv")
    assert t.count() == 10 and dict(t.dtypes)["SOG"] == "float" and dict(t.dtypes)["BaseDateTime"] == "timestamp"
    p = os.path.join(tmp_root, "ports.csv")
    with open(p, "w") as fh:
        fh.write("PORT_NAME,COUNTRY,LATITUDE,LONGITUDE,OTHER\nA,US,25.1,-80.1,x\nB,US,,-80.2,y\nC,MX,20.0,-97.0,z\n")
    ports = read_port_csv(spark, p)
    assert sorted(r.puerto for r in ports.collect()) == ["A", "C"]


def test_typed_csv_nulls_bad_fields_like_the_typed_projection(spark, tmp_root):
    from seawake.operators.silver import typed_positions
    from seawake.sources.csv import read_typed
    src = os.path.join(tmp_root, "typed")
    write(src, "AIS_x.csv", [line(0), line(1).replace("2024-01-05T10:01:00", "bad-date"),
                             line(2).replace(",10.0,", ",abc,")])
    got = sorted((tuple(r) for r in read_typed(spark, f"{src}/*.csv").drop("_source_file").collect()), key=str)
    raw = spark.read.option("header", True).csv(f"{src}/*.csv").withColumn("_source_file", F.lit("x"))
    exp = sorted((tuple(r) for r in typed_positions(raw).drop("_source_file").collect()), key=str)
    assert len(got) == 3 and got == exp


def test_compaction_keeps_rows_and_history(spark, tmp_root):
    src = os.path.join(tmp_root, "landing5")
    write(src, "AIS_1.csv", [line(i) for i in range(3)])
    write(src, "AIS_2.csv", [line(i) for i in range(3, 6)] + [line(0)])          # one copy of a day-5 key
    write(src, "AIS_3.csv", [line(i, day="2024-01-06") for i in range(2)])
    lake = _run_pipeline(spark, os.path.join(tmp_root, "lake5"), src)
    before = sorted(tuple(r) for r in spark.read.parquet(lake.silver).select("mmsi", "ts").collect())
    out = ss.compact_days(spark, lake, None)
    after = spark.read.parquet(lake.silver)
    assert sorted(tuple(r) for r in after.select("mmsi", "ts").collect()) == before
    assert out["days"] == 2 and out["removed_batches"] >= 1
    per_day = {str(r.fecha): r.n for r in after.groupBy("fecha").agg(F.countDistinct("batch_id").alias("n")).collect()}
    assert per_day == {"2024-01-05": 1, "2024-01-06": 1}
    assert ss.compact_days(spark, lake, None)["removed_batches"] == 0             # idempotent
    # a later batch still treats the compacted rows as history
    write(src, "AIS_4.csv", [line(1), line(7)])
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"))
    ss.run_silver(spark, lake, max_files_per_trigger=1)
    s = spark.read.parquet(lake.silver)
    assert s.count() == len(before) + 1
    m = spark.read.parquet(lake.metrics).where(F.col("metrica") == "duplicados_contra_historico")
    assert m.agg(F.sum("valor")).first()[0] >= 1


def test_empty_landing_runs_cleanly(spark, tmp_root):
    src = os.path.join(tmp_root, "empty_landing")
    os.makedirs(src)
    lake = ss.Lake(os.path.join(tmp_root, "lake6"))
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"))
    ss.run_silver(spark, lake)
    assert not os.path.exists(os.path.join(lake.root, "silver"))


def test_all_rejected_batch_leaves_a_readable_lake(spark, tmp_root):
    src = os.path.join(tmp_root, "landing7")
    write(src, "AIS_1.csv", [line(i, mmsi="X1") for i in range(3)])
    root = os.path.join(tmp_root, "lake7")
    lake = _run_pipeline(spark, root, src)
    assert ss.silver_table(spark, lake).count() == 0
    write(src, "AIS_2.csv", [line(i) for i in range(3)])
    lake = _run_pipeline(spark, root, src)
    assert ss.silver_table(spark, lake).count() == 3


def test_replay_after_compaction_changes_nothing(spark, tmp_root):
    src = os.path.join(tmp_root, "landing8")
    write(src, "AIS_1.csv", [line(i) for i in range(3)])
    write(src, "AIS_2.csv", [line(i) for i in range(2, 6)])
    lake = _run_pipeline(spark, os.path.join(tmp_root, "lake8"), src)

    def rows():
        return sorted((r.mmsi, str(r.ts)) for r in ss.silver_table(spark, lake).collect())

    before = rows()
    ss.compact_days(spark, lake, None)
    assert rows() == before and {r.batch_id for r in ss.silver_table(spark, lake).collect()} == {ss.COMPACTED}
    # the newest batch once more, as after a lost commit record of a later run
    files = spark.read.parquet(lake.bronze).where(F.col("_source_file").contains("AIS_2"))
    ss.SilverBatch(lake)(files, 1)
    assert rows() == before


def test_uncommitted_batches_are_not_compacted(spark, tmp_root):
    src = os.path.join(tmp_root, "landing9")
    write(src, "AIS_1.csv", [line(i) for i in range(3)])
    write(src, "AIS_2.csv", [line(i) for i in range(3, 6)])
    lake = ss.Lake(os.path.join(tmp_root, "lake9"))
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger=1)
    with pytest.raises(Exception):
        ss.run_silver(spark, lake, max_files_per_trigger=1, fail_after_silver=1)
    ss.compact_days(spark, lake, None)
    assert {r.batch_id for r in ss.silver_table(spark, lake).collect()} == {ss.COMPACTED, 1}
    ss.run_silver(spark, lake, max_files_per_trigger=1)
    assert ss.silver_table(spark, lake).count() == 6


def write_text(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def fields(columns, **values):
    base = dict(zip(RAW_COLUMNS, line(1).split(","), strict=True)) | values
    return ",".join(base[c] for c in columns)


def test_columns_come_by_the_header_of_their_file(spark, tmp_root):
    src = os.path.join(tmp_root, "landing10")
    lake = ss.Lake(os.path.join(tmp_root, "lake10"))
    write(src, "AIS_1.csv", [line(0)])
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"))
    swapped = [*RAW_COLUMNS[:2], "LON", "LAT", *RAW_COLUMNS[4:]]
    write_text(src, "AIS_2.csv", "\ufeff" + ",".join(swapped), fields(swapped), fields(swapped) + ",one,two")
    few = ["BaseDateTime", "MMSI", "LON", "LAT"]
    write_text(src, "AIS_3.csv", ",".join(f'"{c}"' for c in few), "", fields(few, LAT=""), fields(few, LAT='""'))
    more = [*RAW_COLUMNS, "Extra"]
    write_text(src, "AIS_4.csv", ", ".join(more), fields(more, Extra="x"), fields(more, Extra=""), ",".join(more[:3]))
    write_text(src, "AIS_5.csv", "no,header,here", "1,2,3")
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger=1)     # same checkpoint, other reader
    got = {}
    for r in spark.read.parquet(lake.bronze).collect():
        got.setdefault(os.path.basename(r._source_file), []).append(r)
    assert {k: len(v) for k, v in got.items()} == {"AIS_1.csv": 1, "AIS_2.csv": 2, "AIS_3.csv": 2, "AIS_4.csv": 3, "AIS_5.csv": 2}
    assert {(r.LAT, r.LON) for f in ("AIS_1.csv", "AIS_2.csv") for r in got[f]} == {("26.5", "-80.5")}
    assert sorted(r._rescued_data or "" for r in got["AIS_2.csv"]) == ["", fields(swapped) + ",one,two"]
    assert {(r.MMSI, r.LAT, r.LON, r.SOG, r._rescued_data) for r in got["AIS_3.csv"]} == {
        ("367000001", None, "-80.5", None, None), ("367000001", "", "-80.5", None, None)}
    assert sorted(r._rescued_data or "" for r in got["AIS_4.csv"]) == ["", ",".join(more[:3]), '{"Extra":"x"}']
    assert all(r.MMSI is None and r._rescued_data in ("no,header,here", "1,2,3") for r in got["AIS_5.csv"])


def test_routed_lines_equal_the_csv_reader(spark, tmp_root):
    from pyspark.sql import types as T
    from seawake.sources import csv
    src = os.path.join(tmp_root, "landing11")
    write(src, "AIS_1.csv", [line(0), line(1) + ",EXTRA", fields(RAW_COLUMNS, VesselName='"A, ""B"""', IMO="", CallSign='""'),
                             "", "only,three,fields", fields(RAW_COLUMNS, LAT=" 1 ", VesselName="é😀")])
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
    headers = csv.file_headers(spark, src)
    a = csv.routed(csv.text_lines(spark.read, src), headers, csv.distinct_headers(headers), wanted, csv.TEXT_OPTIONS)
    b = (spark.read.schema(csv.file_schema(HEADER, wanted)).options(**csv.TEXT_OPTIONS).option("header", True).csv(src)
         .withColumn("_source_file", F.col("_metadata.file_path")))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())) and a.count() == 5


def test_typed_scan_of_reordered_columns(spark, tmp_root):
    from seawake.sources.csv import read_typed
    swapped = [*RAW_COLUMNS[:2], "LON", "LAT", *RAW_COLUMNS[4:]]
    src = os.path.join(tmp_root, "landing12")
    write_text(src, "AIS_2.csv", ",".join(swapped), fields(swapped), fields(swapped, SOG="fast"))
    for _ in range(2):                              # one header for all files, then two
        rows = read_typed(spark, src).where(F.col("_source_file").endswith("AIS_2.csv")).collect()
        assert {(r.LAT, r.LON) for r in rows} == {(26.5, -80.5)} and sorted(str(r.SOG) for r in rows) == ["10.0", "None"]
        write(src, "AIS_1.csv", [line(0)])


def test_a_file_whose_header_was_not_looked_up_fails_its_batch(spark, tmp_root):
    src = os.path.join(tmp_root, "landing13")
    lake = ss.Lake(os.path.join(tmp_root, "lake13"))
    swapped = [*RAW_COLUMNS[:2], "LON", "LAT", *RAW_COLUMNS[4:]]
    write(src, "AIS_1.csv", [line(0)])
    write_text(src, "AIS_2.csv", ",".join(swapped), fields(swapped))
    headers = br.known_headers(spark, src, os.path.join(tmp_root, "headers13"))
    write(src, "AIS_3.csv", [line(2)])
    q = br.bronze_source(spark, src, headers).writeStream.format("parquet").option(
        "checkpointLocation", lake.checkpoint("bronze")).trigger(availableNow=True).start(lake.bronze)
    with pytest.raises(Exception, match="no header was looked up"):
        q.awaitTermination()
    br.run_bronze(spark, src, lake.bronze, lake.checkpoint("bronze"))
    assert spark.read.parquet(lake.bronze).count() == 3
