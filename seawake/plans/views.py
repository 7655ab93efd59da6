"""SQL surface: the stored layers, the study's three summaries and the dashboard's five datasets as temp views.

Every view is the DataFrame operator of the same result; registering it lets SQL users select
from it, and the optimiser plans their query through it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seawake.operators import dashboard as db, study as st
from seawake.operators.ports import ship_type_dim
from seawake.plans import daily
from seawake.schema import metrics_schema, silver_schema
from seawake.sources.sinks import path_exists, stored

# Published view name of each stored layer.
LAYER_VIEWS = {
    "bronze_ais_raw": "bronze", "silver_ais_posiciones": "silver", "silver_ais_cuarentena": "quarantine",
    "ops_calidad_metricas": "metrics", "ops_quality_gate_log": "gate_log", "gold_trafico_celda_hora": "traffic",
    "gold_trayectorias_diarias": "trajectories", "silver_ref_puerto_celdas": "port_cells",
    "gold_presencia_puertos": "presence", "ml_features_anomalia_velocidad": "features",
    "ml_anomalias_velocidad": "anomalies",
}
TYPES_VIEW = "gold_dim_tipo_buque"


def layer_table(spark: SparkSession, lake, attr: str) -> DataFrame:
    """A stored layer; those that may hold no file yet are read by their known schema."""
    if attr in daily.GOLD:
        return daily.gold_table(spark, lake, attr)
    known = {"silver": silver_schema, "metrics": metrics_schema}
    path = getattr(lake, attr)
    return stored(spark, path, known[attr]()) if attr in known else spark.read.parquet(path)


def register_layer_views(spark: SparkSession, lake) -> list[str]:
    """One temp view per stored layer that exists, plus the ship-type dimension."""
    made = [view for view, attr in LAYER_VIEWS.items() if path_exists(spark, getattr(lake, attr))]
    for view in made:
        layer_table(spark, lake, LAYER_VIEWS[view]).createOrReplaceTempView(view)
    ship_type_dim(spark).createOrReplaceTempView(TYPES_VIEW)
    return [*made, TYPES_VIEW]


# The study's summaries of the partitioned positions.
STUDY_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "v_daily_traffic_summary": st.daily_summary,
    "v_traffic_by_vessel_type": st.type_summary,
    "v_spatial_concentration": st.box_summary,
}


def create_study_views(spark: SparkSession, optimized: DataFrame) -> None:
    optimized.createOrReplaceTempView("data_points_optimized")
    for name, summary in STUDY_VIEWS.items():
        summary(optimized).createOrReplaceTempView(name)


# The dashboard's datasets of one day, from the registered layer views.
DASHBOARD: dict[str, Callable[[Callable[[str], DataFrame], str], DataFrame]] = {
    "kpis_dia": lambda t, day: db.day_kpis(t("gold_trayectorias_diarias"), t("gold_presencia_puertos"),
                                           t("ops_calidad_metricas"), day),
    "mapa_trafico": lambda t, day: db.day_map(t("gold_trafico_celda_hora"), day),
    "ranking_puertos": lambda t, day: db.port_ranking(t("gold_presencia_puertos"), t(TYPES_VIEW), day),
    "buques_en_puerto": lambda t, day: db.port_ships(t("gold_presencia_puertos"), t(TYPES_VIEW), day),
    "anomalias_dia": lambda t, day: db.day_anomalies(t("gold_trayectorias_diarias"), t("ops_calidad_metricas"), day),
}


def dashboard(spark: SparkSession, name: str, day: str) -> DataFrame:
    """One dashboard dataset for a day; also registered as a temp view of its name."""
    out = DASHBOARD[name](spark.table, day)
    out.createOrReplaceTempView(name)
    return out
