"""The five parameterised datasets of the operations dashboard (one day each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.functions.numeric import fixed
from seawake.operators.ports import with_category

MAP_MIN_POSITIONS = 50
JUMP_LABEL = "Salto de posición (MMSI posiblemente compartido)"
QUALITY_PREFIX = "Calidad: "


def _day(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("fecha") == F.lit(day).cast("date"))


def day_kpis(traj: DataFrame, presence: DataFrame, metrics: DataFrame, day: str) -> DataFrame:
    """Active ships, ships in port, input positions and quarantine share, as scalar subqueries."""
    m = _day(metrics, day)
    active = _day(traj, day).agg(F.count_distinct("mmsi")).scalar()
    in_port = _day(presence, day).agg(F.count_distinct("mmsi")).scalar()
    return m.agg(
        active.alias("buques_activos"),
        in_port.alias("buques_en_puerto"),
        F.sum(F.when(F.col("metrica") == "filas_entrada", F.col("valor"))).cast("long").alias("posiciones"),
        fixed(F.try_divide(F.sum(F.when(F.col("metrica") == "cuarentena", F.col("valor"))) * 100,
                           F.sum(F.when(F.col("metrica") == "filas_entrada", F.col("valor")))), 3)
        .alias("pct_cuarentena"))


def day_map(traffic: DataFrame, day: str, min_positions: int = MAP_MIN_POSITIONS) -> DataFrame:
    """Cells of the day with at least ``min_positions`` positions and their peak-hour ships."""
    return (_day(traffic, day).groupBy("h3_r7")
            .agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"),   # constant per cell
                 F.sum("posiciones").alias("posiciones"), F.max("buques").alias("buques_hora_pico"))
            .where(F.col("posiciones") >= min_positions))


def port_ships(presence: DataFrame, dim: DataFrame, day: str) -> DataFrame:
    p = with_category(_day(presence, day), dim)
    return (p.select("puerto", "mmsi", "vessel_name", "categoria", "primera_posicion", "ultima_posicion",
                     "horas_en_puerto")
             .orderBy(F.desc("horas_en_puerto"), "puerto", "mmsi"))


def port_ranking(presence: DataFrame, dim: DataFrame, day: str, k: int = 15) -> DataFrame:
    """Ships and ship-hours per (port, category) for the day's top-``k`` ports by ships."""
    base = with_category(_day(presence, day), dim).select("puerto", "pais", "mmsi", "horas_en_puerto", "categoria")
    top = (base.groupBy("puerto").agg(F.count_distinct("mmsi").alias("buques_total"))
               .orderBy(F.desc("buques_total"), "puerto").limit(k))
    # ``top`` has at most k rows: broadcasting it is bounded by construction
    return (base.join(F.broadcast(top), "puerto")
                .groupBy("puerto", "categoria")
                .agg(F.min("pais").alias("pais"), F.count_distinct("mmsi").alias("buques"),
                     fixed(F.sum("horas_en_puerto"), 1).alias("horas_buque"),
                     F.max("buques_total").alias("_rank_key"))
                .orderBy(F.desc("_rank_key"), "categoria", "puerto").drop("_rank_key"))


def day_anomalies(traj: DataFrame, metrics: DataFrame, day: str) -> DataFrame:
    """Jump rows of the day's trajectories plus non-zero per-cause quarantine counts."""
    jumps = (_day(traj, day).where(F.col("saltos_anomalos") > 0)
             .select(F.lit(JUMP_LABEL).alias("tipo"), "mmsi", "vessel_name",
                     F.col("saltos_anomalos").cast("long").alias("eventos"), F.col("v_impl_max_kn").alias("detalle")))
    causes = (_day(metrics, day).where(F.col("metrica").like("cuarentena\\_%") & (F.col("valor") > 0))
              .select(F.concat(F.lit(QUALITY_PREFIX), F.replace("metrica", F.lit("cuarentena_"), F.lit(""))).alias("tipo"),
                      F.lit(None).cast("string").alias("mmsi"), F.lit(None).cast("string").alias("vessel_name"),
                      F.col("valor").cast("long").alias("eventos"), F.lit(None).cast("double").alias("detalle")))
    return jumps.unionByName(causes).orderBy(F.desc("eventos"), "tipo", "mmsi")


def kpi_widgets(kpis: DataFrame) -> DataFrame:
    """The KPI tiles: ``MAX`` of each KPI over the one-row dataset."""
    return kpis.agg(*[F.max(c).alias(f"max_{c}") for c in kpis.columns])


def ranking_bars(ranking: DataFrame) -> DataFrame:
    """The stacked bars: ships per (port, category) of the ranking dataset."""
    return ranking.groupBy("puerto", "categoria").agg(F.sum("buques").alias("sum_buques"))
