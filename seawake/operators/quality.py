"""Quality metrics, layer balance and the per-day quality gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.functions.numeric import fixed

GATE_MAX_PCT = 1.0

# Verdict texts of the gate log.
GATE_OK = "OK"
GATE_FAIL_PREFIX = "FALLA: "
GATE_NO_INPUT = "sin filas de entrada para la fecha"
GATE_NO_SILVER = "plata vacía para la fecha"
GATE_OVER = "cuarentena {pct}% > umbral {max}%"


def merge_metrics(candidates: DataFrame, inserted: DataFrame) -> DataFrame:
    """The two undated counts of a batch: rows inserted into silver, and duplicates against history.

    ``candidates`` are the batch's valid, deduplicated rows; ``inserted`` the subset not
    already in silver. Both counts come from the same two frames, so a replay of the batch
    reproduces them exactly.
    """
    n_cand = candidates.agg(F.count(F.lit(1))).scalar()
    return inserted.agg(F.count(F.lit(1)).alias("plata_insertadas"),
                        (n_cand - F.count(F.lit(1))).alias("duplicados_contra_historico")) \
        .unpivot([], ["plata_insertadas", "duplicados_contra_historico"], "metrica", "valor") \
        .select(F.lit(None).cast("date").alias("fecha"), "metrica", F.col("valor").cast("long"))


def merge_counts(spark: SparkSession, candidates: int, inserted: int) -> DataFrame:
    """``merge_metrics`` from counts already taken while the batch was written."""
    return spark.createDataFrame([(None, "plata_insertadas", inserted),
                                  (None, "duplicados_contra_historico", candidates - inserted)],
                                 "fecha date, metrica string, valor long")


def stamp(metrics: DataFrame, batch_id: int) -> DataFrame:
    return (metrics.withColumn("batch_id", F.lit(batch_id).cast("long"))
                   .withColumn("ts_proceso", F.current_timestamp()))


def layer_balance(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, metrics: DataFrame) -> DataFrame:
    """bronze = silver + quarantine + duplicates (within batches and against history)."""
    dups = (metrics.where(F.col("metrica").isin("duplicados", "duplicados_contra_historico"))
                   .agg(F.coalesce(F.sum("valor"), F.lit(0)))).scalar()
    q = quarantine.agg(F.count(F.lit(1))).scalar()
    s = silver.agg(F.count(F.lit(1))).scalar()
    return (bronze.agg(F.count(F.lit(1)).alias("bronce"))
                  .select("bronce", s.alias("plata"), q.alias("cuarentena"), dups.cast("long").alias("duplicados"))
                  .withColumn("diferencia", F.col("bronce") - F.col("plata") - F.col("cuarentena") - F.col("duplicados")))


def quarantine_by_cause(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(F.explode("causas").alias("causa")).groupBy("causa").agg(F.count(F.lit(1)).alias("n"))


def metric_totals(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metrica").agg(F.sum("valor").cast("long").alias("total"))


def quality_gate(spark: SparkSession, metrics: DataFrame, silver: DataFrame, days: list[dt.date],
                 max_pct: float = GATE_MAX_PCT) -> DataFrame:
    """Verdict per requested day: input rows, quarantine, pct (4 decimals), silver rows.

    All days are evaluated by two grouped aggregates left-joined from the requested day
    list (no loop of per-day jobs). A day without input or without silver rows fails; so
    does a quarantine share strictly above ``max_pct`` after rounding.
    """
    want = spark.createDataFrame([(d,) for d in days], "fecha date")
    m = (metrics.where(F.col("fecha").isin(days))
                .groupBy("fecha")
                .agg(F.sum(F.when(F.col("metrica") == "filas_entrada", F.col("valor"))).alias("filas_entrada"),
                     F.sum(F.when(F.col("metrica") == "cuarentena", F.col("valor"))).alias("cuarentena")))
    s = silver.where(F.col("fecha").isin(days)).groupBy("fecha").agg(F.count(F.lit(1)).alias("filas_plata"))
    g = (want.join(m, "fecha", "left").join(s, "fecha", "left")
             .select("fecha",
                     F.coalesce("filas_entrada", F.lit(0)).cast("long").alias("filas_entrada"),
                     F.coalesce("cuarentena", F.lit(0)).cast("long").alias("cuarentena"),
                     F.coalesce("filas_plata", F.lit(0)).cast("long").alias("filas_plata")))
    pct = F.when(F.col("filas_entrada") > 0, fixed(F.col("cuarentena") * 100 / F.col("filas_entrada"), 4))
    g = g.withColumn("cuarentena_pct", pct).withColumn("umbral_pct", F.lit(float(max_pct)))
    over = F.lit(GATE_OVER)
    over = F.replace(over, F.lit("{pct}"), F.col("cuarentena_pct").cast("string"))
    over = F.replace(over, F.lit("{max}"), F.col("umbral_pct").cast("string"))
    problems = F.array_compact(F.array(
        F.when(F.col("filas_entrada") == 0, F.lit(GATE_NO_INPUT)),
        F.when(F.col("filas_plata") == 0, F.lit(GATE_NO_SILVER)),
        F.when(F.col("cuarentena_pct") > F.col("umbral_pct"), over)))
    return g.withColumn("resultado", F.when(F.size(problems) == 0, F.lit(GATE_OK))
                        .otherwise(F.concat(F.lit(GATE_FAIL_PREFIX), F.concat_ws("; ", problems))))


class QualityGateFailed(Exception):
    pass


def enforce_gate(verdicts: DataFrame) -> None:
    """Raise once if any day failed (one row per requested day)."""
    bad = verdicts.where(F.col("resultado") != GATE_OK).select("fecha", "resultado").collect()
    if bad:
        raise QualityGateFailed("Quality gate no superado → " + " | ".join(f"{r.fecha}: {r.resultado}" for r in bad))
