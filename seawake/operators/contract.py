"""Data contract of the gold tables, checked as Spark aggregates.

One row per (table, rule) with the number of violations: duplicate keys, null keys, null
counts, and missing / retyped columns against the declared schema (extra columns are allowed:
adding a column is a compatible change).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared contract (fixed values): key columns, never-null count columns, column types.
CONTRACTS = {
    "gold_trafico_celda_hora": {
        "key": ["fecha", "hora", "h3_r7"],
        "counts": ["posiciones", "buques"],
        "columns": {"fecha": "date", "hora": "timestamp", "h3_r7": "bigint", "posiciones": "bigint",
                    "buques": "bigint", "sog_promedio": "double", "lat": "double", "lon": "double"},
    },
    "gold_trayectorias_diarias": {
        "key": ["mmsi", "fecha"],
        "counts": ["posiciones", "saltos_anomalos"],
        "columns": {"mmsi": "string", "fecha": "date", "posiciones": "bigint", "ts_inicio": "timestamp",
                    "ts_fin": "timestamp", "lat_inicio": "double", "lon_inicio": "double", "lat_fin": "double",
                    "lon_fin": "double", "distancia_km": "double", "sog_promedio": "double", "sog_max": "double",
                    "saltos_anomalos": "bigint", "v_impl_max_kn": "double", "vessel_name": "string",
                    "vessel_type": "int", "length": "double", "horas_activo": "double"},
    },
    "gold_presencia_puertos": {
        "key": ["fecha", "mmsi", "puerto"],
        "counts": ["posiciones"],
        "columns": {"fecha": "date", "mmsi": "string", "puerto": "string", "pais": "string", "posiciones": "bigint",
                    "primera_posicion": "timestamp", "ultima_posicion": "timestamp", "horas_en_puerto": "double",
                    "vessel_name": "string", "vessel_type": "int", "lat_puerto": "double", "lon_puerto": "double"},
    },
}


def contract_check(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tabla, regla, violaciones) for every contract rule of every given table."""
    parts = []
    for name, df in tables.items():
        c = CONTRACTS[name]
        key = c["key"]
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .agg(F.count(F.lit(1)))).scalar()
        null_key = F.count_if(F.greatest(*[F.col(k).isNull() for k in key]) if len(key) > 1 else F.col(key[0]).isNull())
        null_counts = F.count_if(F.greatest(*[F.col(k).isNull() for k in c["counts"]])
                                 if len(c["counts"]) > 1 else F.col(c["counts"][0]).isNull())
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        schema_bad = sum(1 for col, typ in c["columns"].items() if actual.get(col) != typ)
        row = df.agg(dup.cast("long").alias("llave_duplicada"), null_key.alias("llave_nula"),
                     null_counts.alias("conteo_nulo"), F.lit(schema_bad).cast("long").alias("esquema"))
        parts.append(row.select(F.lit(name).alias("tabla"), F.inline(F.array(*[
            F.struct(F.lit(r).alias("regla"), F.col(r).cast("long").alias("violaciones"))
            for r in ("llave_duplicada", "llave_nula", "conteo_nulo", "esquema")]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
