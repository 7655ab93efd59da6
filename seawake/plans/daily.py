"""The daily job chain: bronze → silver → gate → gold → speed anomalies.

Each step reads only stored tables and writes idempotently, so any step can be re-run (or
retried by a scheduler) for the same days without duplicating rows:

* bronze / silver: streams with checkpoints (each file once; retry-safe batches);
* gate: evaluates every requested day, logs all verdicts, then raises once;
* gold and model outputs: the requested days are replaced, other days are untouched;
* late rows: every gold table remembers the silver batch it has seen last, and the days that later batches
  added rows to are rebuilt with the requested ones, whatever their age.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.functions.dates import day_filter, parse_days
from seawake.operators import contract as ct, forest as fo, gold, land as ld, ports as pt, quality as qa
from seawake.schema import describe, metrics_schema, silver_schema
from seawake.sources.sinks import replace_days, stored, stored_days
from seawake.streaming import bronze as br
from seawake.streaming import silver as ss


def ingest_bronze(spark: SparkSession, lake: ss.Lake, landing: str, max_files_per_trigger: int | None = None) -> None:
    """Landing CSV files → bronze (drained with ``availableNow``)."""
    br.run_bronze(spark, landing, lake.bronze, lake.checkpoint("bronze"), max_files_per_trigger)


BATCH_BYTES = 8 << 30      # bronze bytes one silver micro-batch takes at most


def ingest(spark: SparkSession, lake: ss.Lake, landing: str, land_cells: DataFrame | None = None,
           max_files_per_trigger: int | None = None, max_bytes_per_trigger: int = BATCH_BYTES) -> None:
    """Landing CSV files → bronze → silver (both drained with ``availableNow``, silver in capped batches)."""
    ingest_bronze(spark, lake, landing, max_files_per_trigger)
    ss.run_silver(spark, lake, land_cells, max_bytes_per_trigger=max_bytes_per_trigger)


def build_land_mask(spark: SparkSession, lake: ss.Lake, land: DataFrame, lakes: DataFrame,
                    rivers: DataFrame) -> DataFrame:
    """Rebuild the land mask from all bronze cells (an explicit, not daily, step) and store it."""
    ld.land_mask(ld.cell_stats(spark.read.parquet(lake.bronze)), land, lakes, rivers) \
      .write.mode("overwrite").parquet(lake.land)
    return spark.read.parquet(lake.land)


def gate(spark: SparkSession, lake: ss.Lake, days: list[dt.date], max_pct: float = qa.GATE_MAX_PCT,
         enforce: bool = True) -> DataFrame:
    """Evaluate the days once (a day without any input fails), log every verdict, then raise once on the log."""
    metrics, silver = stored(spark, lake.metrics, metrics_schema()), ss.silver_table(spark, lake)
    verdicts = qa.quality_gate(spark, metrics, silver, days, max_pct)
    rows = verdicts.withColumn("ts_evaluacion", F.current_timestamp()).collect()      # one per requested day
    logged = spark.createDataFrame(rows, verdicts.withColumn("ts_evaluacion", F.current_timestamp()).schema)
    logged.coalesce(1).write.mode("append").parquet(lake.gate_log)
    if enforce:
        qa.enforce_gate(logged)
    return logged.drop("ts_evaluacion")


# Stored gold tables and how each is built from (silver, port cells); an empty table has the builder's schema.
GOLD = {
    "traffic": ("gold_trafico_celda_hora", lambda s, z: gold.traffic_cell_hour(s), ["h3_r7", "hora"]),
    "trajectories": ("gold_trayectorias_diarias", lambda s, z: gold.daily_trajectories(s), ["mmsi"]),
    "presence": ("gold_presencia_puertos", pt.port_presence, ["puerto", "mmsi"]),
}
ZONES = "h3_r7 bigint, puerto string, pais string, lat_puerto double, lon_puerto double, dist_km double"


def gold_table(spark: SparkSession, lake: ss.Lake, name: str) -> DataFrame:
    """A stored gold table; empty, with its full schema, while no day of it has rows."""
    table, build, _ = GOLD[name]
    shape = describe(build(spark.createDataFrame([], silver_schema()), spark.createDataFrame([], ZONES)), table)
    return stored(spark, getattr(lake, name), shape.schema)


def _silver_days(spark: SparkSession, lake: ss.Lake, days: list[dt.date] | None) -> DataFrame:
    """Silver rows of the days; only the folders between the first and the last are listed."""
    first, last = (min(days), max(days)) if days else (None, None)
    return ss.read_days(spark, lake.silver, silver_schema(), first, last).where(day_filter("fecha", days))


def _stored_zones(spark: SparkSession, lake: ss.Lake, ports: DataFrame) -> DataFrame:
    pt.port_cells(ports).write.mode("overwrite").parquet(lake.port_cells)
    return spark.read.schema(ZONES).parquet(lake.port_cells)


def _build_table(spark: SparkSession, lake: ss.Lake, name: str, days: list[dt.date] | None, zones: DataFrame) -> None:
    table, build, order = GOLD[name]
    replace_days(describe(build(_silver_days(spark, lake, days), zones), table), getattr(lake, name), days, sort_cols=order)


def build_gold(spark: SparkSession, lake: ss.Lake, days: list[dt.date] | None, ports: DataFrame) -> None:
    """Traffic, trajectories, port cells and presence for the requested days (None: all)."""
    zones = _stored_zones(spark, lake, ports)
    for name in GOLD:
        _build_table(spark, lake, name, days, zones)


# One row per rebuild of a gold table: the newest silver batch it saw and the days it replaced.
REFRESH_SCHEMA = "tabla string, hasta_batch bigint, dias array<date>, ts_proceso timestamp"


def refresh_marks(spark: SparkSession, lake: ss.Lake) -> dict[str, int]:
    """Newest silver batch that each gold table has seen; -1 before its first refresh."""
    log = stored(spark, lake.refreshes, T.StructType.fromDDL(REFRESH_SCHEMA))
    seen = {r.tabla: r.hasta for r in log.groupBy("tabla").agg(F.max("hasta_batch").alias("hasta")).collect()}
    return {name: seen.get(name, -1) for name in GOLD}


def due_days(spark: SparkSession, lake: ss.Lake, requested: list[dt.date] | None = None) -> dict[str, list[dt.date]]:
    """Per gold table, the days to rebuild: the requested ones, and those that committed silver batches changed since its mark.

    With ``requested`` days, a changed day counts only if gold holds it already (of other days nothing is out of
    date); without, every changed day counts.
    """
    upto, by_mark, out = ss.committed_batch(spark, lake), {}, {}
    known = {d for name in GOLD for d in stored_days(spark, getattr(lake, name))}
    for name, mark in refresh_marks(spark, lake).items():
        if mark not in by_mark:                       # usually all tables have the same mark
            by_mark[mark] = ss.changed_days(spark, lake, mark, upto) if upto > mark else []
        late = [d for d in by_mark[mark] if requested is None or d.isoformat() in known]
        out[name] = sorted({*late, *(requested or [])})
    return out


def refresh_gold(spark: SparkSession, lake: ss.Lake, ports: DataFrame, requested: list[dt.date] | None = None
                 ) -> dict[str, list[dt.date]]:
    """Rebuild the due days of every gold table, move its mark, and return the days.

    The mark moves after the table's days are replaced: a run that stops in between is repeated in full by
    the next one and yields the same rows. Batches that commit while it runs lie above its mark, so their days come
    again next time.
    """
    upto = ss.committed_batch(spark, lake)
    due = due_days(spark, lake, requested)
    zones = _stored_zones(spark, lake, ports) if any(due.values()) else None
    for name, days in due.items():
        if days:
            _build_table(spark, lake, name, days, zones)
        (spark.createDataFrame([(name, upto, days, None)], REFRESH_SCHEMA).withColumn("ts_proceso", F.current_timestamp())
            .coalesce(1).write.mode("append").parquet(lake.refreshes))
    return due


def contract(spark: SparkSession, lake: ss.Lake) -> DataFrame:
    return ct.contract_check(spark, {table: gold_table(spark, lake, name) for name, (table, *_) in GOLD.items()})


def speed_anomalies(spark: SparkSession, lake: ss.Lake, days: list[dt.date] | None) -> fo.ForestModel:
    """Features for the days, refit on the whole feature history, score and store the days."""
    trajectories = gold_table(spark, lake, "trajectories")
    features = fo.speed_features(_silver_days(spark, lake, days), trajectories, days)
    replace_days(features, lake.features, days)
    history = stored(spark, lake.features, features.schema)
    model, flagged = fo.fit_and_score(history)
    model.nodes.withColumn("modelo_version", F.lit(model.run_id)).write.mode("append") \
        .partitionBy("modelo_version").parquet(lake.model)
    params = {"n_arboles": fo.N_TREES, "muestra": fo.SAMPLE_SIZE, "contaminacion": fo.CONTAMINATION,
              "semilla": fo.SEED, "min_posiciones": fo.MIN_POSITIONS}
    fo.run_record(spark, history, flagged, model, params).write.mode("append").parquet(lake.model_runs)
    # score the days with the stored model (latest run), not the in-memory object
    saved = fo.load_latest_model(spark, lake.model, lake.model_runs)
    today = fo.flag(fo.score(history.where(day_filter("fecha", days)), saved), saved.threshold)
    replace_days(fo.anomalies(today, trajectories, saved, days), lake.anomalies, days, sort_cols=["mmsi"])
    return saved


def next_feed_day(spark: SparkSession, lake: ss.Lake, first_day: str) -> dt.date:
    """The day after the newest silver day that has rows, or ``first_day`` when silver is empty."""
    for d in reversed(stored_days(spark, lake.silver)):                  # newest folder first
        if not ss.read_days(spark, lake.silver, silver_schema(), d, d).isEmpty():
            return dt.date.fromisoformat(d) + dt.timedelta(days=1)
    return dt.date.fromisoformat(first_day)


def run_days(spark: SparkSession, lake: ss.Lake, landing: str, day_spec: str, ports: DataFrame,
             land_cells: DataFrame | None = None, enforce_gate: bool = True,
             geo_layers: tuple[DataFrame, DataFrame, DataFrame] | None = None,
             max_bytes_per_trigger: int = BATCH_BYTES) -> dict:
    """The whole chain for a day set ("todas" or "YYYY-MM-DD[,…]").

    Days outside the set that gold holds and that received late rows since its last refresh pass the gate and are
    rebuilt too. With ``geo_layers`` (land, lakes, rivers edges) the land mask is rebuilt from bronze
    before silver runs, as in a backfill; otherwise ``land_cells`` (or none) is used.
    """
    days = parse_days(day_spec)
    ingest_bronze(spark, lake, landing)
    if geo_layers is not None:
        land_cells = build_land_mask(spark, lake, *geo_layers)
    ss.run_silver(spark, lake, land_cells, max_bytes_per_trigger=max_bytes_per_trigger)
    if days is None:
        days = [r[0] for r in stored(spark, lake.metrics, metrics_schema()).where(F.col("fecha").isNotNull())
                .select("fecha").distinct().orderBy("fecha").collect()]       # one row per calendar day
    days = sorted({d for due in due_days(spark, lake, days).values() for d in due})
    verdicts = gate(spark, lake, days, enforce=enforce_gate)
    refresh_gold(spark, lake, ports, days)
    model = speed_anomalies(spark, lake, days)
    return {"days": days, "gate": verdicts, "model": model}
