"""Day replacement, insert-only merge, the quality gate and the day-set parser."""
import datetime as dt
import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from seawake.functions.dates import parse_days
from seawake.operators import quality as qa
from seawake.sources import sinks


def _digest(path, day):
    h = hashlib.sha256()
    for f in sorted(glob.glob(f"{path}/fecha={day}/*.parquet")):
        h.update(open(f, "rb").read())
    return h.hexdigest()


def test_replace_days_leaves_other_days_untouched(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    df = spark.createDataFrame([(dt.date(2024, 1, d), d, v) for d in (1, 2, 3) for v in range(3)],
                               "fecha date, d int, v int")
    sinks.replace_days(df, path, None)
    before = _digest(path, "2024-01-01")
    new = df.where("d <> 3").withColumn("v", F.col("v") + 10)       # day 3 now has no rows
    sinks.replace_days(new, path, parse_days("2024-01-02, 2024-01-03"))
    out = spark.read.parquet(path)
    assert _digest(path, "2024-01-01") == before
    assert sorted(r.v for r in out.where("d = 2").collect()) == [10, 11, 12]
    assert out.where("d = 3").count() == 0 and out.where("d = 1").count() == 3


def test_replacing_all_days_drops_vanished_ones_and_computes_once(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    df = spark.createDataFrame([(dt.date(2024, 1, d), v) for d in (1, 2, 3) for v in range(3)], "fecha date, v int")
    sinks.replace_days(df, path, None)
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    sinks.replace_days(df.where("fecha <> DATE'2024-01-02'").mapInArrow(counted, df.schema), path, None)
    assert sinks.stored_days(spark, path) == ["2024-01-01", "2024-01-03"]
    assert runs.value == 6                                   # every row once
    sinks.replace_days(df.where("false"), path, None)
    assert sinks.stored_days(spark, path) == [] and sinks.stored(spark, path, df.schema).count() == 0


def test_insert_only(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    h = spark.createDataFrame([(2, "x")], "k int, v string")
    assert sorted(r.k for r in sinks.insert_only(b, h, ["k"]).collect()) == [1, 3]
    assert sinks.insert_only(b, None, ["k"]).count() == 3


def _metrics(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), m, v) for d, m, v in rows],
                                 "fecha date, metrica string, valor long")


def test_gate_rounds_before_strict_comparison(spark):
    m = _metrics(spark, [("2024-01-01", "filas_entrada", 1000000), ("2024-01-01", "cuarentena", 10000),
                         ("2024-01-02", "filas_entrada", 1000000), ("2024-01-02", "cuarentena", 10001),
                         ("2024-01-03", "filas_entrada", 100), ("2024-01-03", "cuarentena", 2)])
    s = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "fecha date")
    days = parse_days("2024-01-01,2024-01-02,2024-01-03,2024-01-04")
    g = {str(r.fecha): r for r in qa.quality_gate(spark, m, s, days).collect()}
    assert g["2024-01-01"].resultado == "OK" and g["2024-01-01"].cuarentena_pct == 1.0
    assert g["2024-01-02"].cuarentena_pct == 1.0001 and g["2024-01-02"].resultado.startswith("FALLA: cuarentena 1.0001%")
    assert g["2024-01-03"].resultado == "FALLA: cuarentena 2.0% > umbral 1.0%"
    assert g["2024-01-04"].cuarentena_pct is None
    assert g["2024-01-04"].resultado == "FALLA: sin filas de entrada para la fecha; plata vacía para la fecha"
    with pytest.raises(qa.QualityGateFailed) as e:
        qa.enforce_gate(qa.quality_gate(spark, m, s, days))
    assert "2024-01-02" in str(e.value) and "2024-01-04" in str(e.value) and "2024-01-01" not in str(e.value)


def test_parse_days():
    assert parse_days("todas") is None and parse_days(None) is None
    assert parse_days("2024-01-03, 2024-01-02,2024-01-03") == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
