"""Independent DuckDB formulations of every checked query (the correctness oracle).

The driver runs each string on DuckDB over the parquet views and compares the result with
the Spark job of the same name. Literals that feed floating-point arithmetic are written as
``::DOUBLE`` because DuckDB would otherwise compute them as exact decimals.
"""

from __future__ import annotations

from seawake.functions.geo import CELL_STEP_R7, _ROW_FACTOR, _nrows
from seawake.sources.fixture import duckdb_raw_sql


def fixed(x: str, n: int) -> str:
    return f"CAST(round(TRY_CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"(12742.0::DOUBLE * asin(sqrt(CASE WHEN ({a}) > 1.0 THEN 1.0::DOUBLE ELSE ({a}) END)))"


def _row(lat: str, step: float) -> str:
    return f"CAST(least(floor(({lat} + 90.0::DOUBLE) / {step}::DOUBLE), {_nrows(step) - 1}) AS BIGINT)"


def _ncol(row: str, step: float) -> str:
    return (f"CAST(greatest(1, floor(360.0::DOUBLE * cos(radians(-90.0::DOUBLE + ({row} + 0.5::DOUBLE) * {step}::DOUBLE))"
            f" / {step}::DOUBLE + 0.5::DOUBLE)) AS BIGINT)")


def cell(lat: str, lon: str, step: float = CELL_STEP_R7) -> str:
    r = _row(lat, step)
    n = _ncol(r, step)
    c = f"CAST(floor(({lon} + 180.0::DOUBLE) / 360.0::DOUBLE * {n}) AS BIGINT)"
    return (f"CASE WHEN ({lat}) IS NOT NULL AND ({lon}) IS NOT NULL THEN "
            f"({r} * {_ROW_FACTOR} + ((({c}) % {n}) + {n}) % {n}) END")


def cell_center(h: str, step: float = CELL_STEP_R7) -> tuple[str, str]:
    row = f"CAST(floor({h} / {_ROW_FACTOR}) AS BIGINT)"
    col = f"({h} - {row} * {_ROW_FACTOR})"
    n = _ncol(row, step)
    lat = f"(-90.0::DOUBLE + ({row} + 0.5::DOUBLE) * {step}::DOUBLE)"
    lon = f"(-180.0::DOUBLE + ({col} + 0.5::DOUBLE) * 360.0::DOUBLE / {n})"
    return lat, lon


# --------------------------------------------------------------------------- silver chain

RAW_COLS = ["MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading", "VesselName", "IMO", "CallSign",
            "VesselType", "Status", "Length", "Width", "Draft", "Cargo", "TransceiverClass", "_rescued_data"]
RAW_AS = ", ".join(f"{c} AS r_{c}" for c in RAW_COLS) + ", _source_file"
RAW_R = ", ".join(f"r_{c}" for c in RAW_COLS)
# raw columns under their own names, for outputs of the chk / silver CTEs
RAW_OUT = ", ".join(f"r_{c} AS {c}" for c in RAW_COLS)

def silver_ctes() -> str:
    """CTEs raw → land mask → chk (typed, flagged, causes) → silver (valid, deduplicated)."""
    return f"""
raw AS ({duckdb_raw_sql()}),
{land_ctes().strip()},
c0 AS (
  SELECT {RAW_AS}, trim(MMSI) AS mmsi_raw, TRY_CAST(BaseDateTime AS TIMESTAMP) AS ts_,
         TRY_CAST(LAT AS DOUBLE) AS lat_, TRY_CAST(LON AS DOUBLE) AS lon_,
         TRY_CAST(SOG AS DOUBLE) AS sog_, TRY_CAST(COG AS DOUBLE) AS cog_, TRY_CAST(Heading AS DOUBLE) AS hdg_
  FROM raw),
c1 AS (
  SELECT
    CASE WHEN regexp_matches(mmsi_raw, '^[0-9]{{7,9}}\\z') THEN lpad(mmsi_raw, 9, '0') END AS mmsi,
    ts_ AS ts, CAST(ts_ AS DATE) AS fecha, lat_ AS lat, lon_ AS lon,
    CASE WHEN NOT (abs(sog_ - 102.3) < 0.05) THEN sog_ END AS sog,
    CASE WHEN cog_ >= 0 AND cog_ < 360 THEN cog_ END AS cog,
    CASE WHEN hdg_ >= 0 AND hdg_ < 360 THEN hdg_ END AS heading,
    CASE WHEN trim(r_VesselName) <> '' THEN trim(r_VesselName) END AS vessel_name,
    CASE WHEN regexp_matches(r_IMO, '^IMO[0-9]{{7}}\\z') THEN r_IMO END AS imo,
    CASE WHEN trim(r_CallSign) <> '' THEN trim(r_CallSign) END AS call_sign,
    CASE WHEN TRY_CAST(r_VesselType AS INTEGER) <> 0 THEN TRY_CAST(r_VesselType AS INTEGER) END AS vessel_type,
    TRY_CAST(r_Status AS INTEGER) AS status,
    CASE WHEN TRY_CAST(r_Length AS DOUBLE) <> 0 THEN TRY_CAST(r_Length AS DOUBLE) END AS length,
    CASE WHEN TRY_CAST(r_Width AS DOUBLE) <> 0 THEN TRY_CAST(r_Width AS DOUBLE) END AS width,
    CASE WHEN TRY_CAST(r_Draft AS DOUBLE) <> 0 THEN TRY_CAST(r_Draft AS DOUBLE) END AS draft,
    CASE WHEN TRY_CAST(r_Cargo AS INTEGER) <> 0 THEN TRY_CAST(r_Cargo AS INTEGER) END AS cargo,
    r_TransceiverClass AS transceiver_class,
    CASE WHEN lat_ BETWEEN -90 AND 90 AND lon_ BETWEEN -180 AND 180 THEN {cell('lat_', 'lon_')} END AS h3_r7,
    coalesce(TRY_CAST(CASE WHEN regexp_matches(mmsi_raw, '^[0-9]{{7,9}}\\z') THEN lpad(mmsi_raw, 9, '0') END AS BIGINT)
             BETWEEN 200000000 AND 799999999, false) AS es_buque,
    coalesce(abs(sog_ - 102.3) < 0.05, false) AS sog_sin_dato,
    coalesce(abs(cog_ - 360.0) < 0.05, false) AS cog_sin_dato,
    coalesce(abs(hdg_ - 511) < 0.5, false) AS heading_sin_dato,
    coalesce(cog_ IS NOT NULL AND NOT (cog_ >= 0 AND cog_ < 360) AND NOT (abs(cog_ - 360.0) < 0.05), false) AS cog_invalido,
    coalesce(hdg_ IS NOT NULL AND NOT (hdg_ >= 0 AND hdg_ < 360) AND NOT (abs(hdg_ - 511) < 0.5), false) AS heading_invalido,
    coalesce(r_IMO IS NOT NULL AND NOT regexp_matches(r_IMO, '^IMO[0-9]{{7}}\\z'), false) AS imo_invalido,
    coalesce(lon_ < -168 OR lon_ > -60 OR lat_ < 15 OR lat_ > 50, false) AS fuera_extension,
    (lat_ BETWEEN -90 AND 90 AND lon_ BETWEEN -180 AND 180) AS coord_ok,
    _source_file, {RAW_R}
  FROM c0),
c2 AS (SELECT c1.*, lm.land_h3 IS NOT NULL AS en_tierra
       FROM c1 LEFT JOIN (SELECT h3 AS land_h3 FROM land_mask WHERE es_tierra) lm ON lm.land_h3 = c1.h3_r7),
chk AS (
  SELECT *, len(causas) = 0 AS valido FROM (
    SELECT *, list_filter([
        CASE WHEN mmsi IS NULL THEN 'mmsi_invalido' END,
        CASE WHEN ts IS NULL THEN 'ts_invalido' END,
        CASE WHEN NOT coalesce(coord_ok, false) THEN 'coord_fuera_rango' END,
        CASE WHEN en_tierra THEN 'posible_en_tierra' END,
        CASE WHEN sog > 50.0 THEN 'sog_implausible' END], lambda x: x IS NOT NULL) AS causas
    FROM c2)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi, ts ORDER BY _source_file NULLS FIRST, lat NULLS FIRST,
      lon NULLS FIRST, sog NULLS FIRST, cog NULLS FIRST, heading NULLS FIRST, vessel_name NULLS FIRST,
      imo NULLS FIRST, call_sign NULLS FIRST, vessel_type NULLS FIRST, status NULLS FIRST, length NULLS FIRST,
      width NULLS FIRST, draft NULLS FIRST, cargo NULLS FIRST, transceiver_class NULLS FIRST) AS rn,
      count(*) OVER (PARTITION BY mmsi, ts) AS n_reportes
  FROM chk WHERE valido),
silver AS (SELECT * FROM ranked WHERE rn = 1)"""


SEG_CTE = f"""
seg0 AS (
  SELECT *, lag(ts) OVER w AS ts_prev, lag(lat) OVER w AS lat_prev, lag(lon) OVER w AS lon_prev
  FROM silver WHERE es_buque WINDOW w AS (PARTITION BY mmsi, fecha ORDER BY ts)),
seg1 AS (
  SELECT *, {haversine('lat_prev', 'lon_prev', 'lat', 'lon')} AS d_km,
         (CAST(epoch(ts) AS BIGINT) - CAST(epoch(ts_prev) AS BIGINT)) / 3600.0::DOUBLE AS dt_h
  FROM seg0),
seg2 AS (SELECT *, CASE WHEN dt_h > 0 THEN d_km / 1.852::DOUBLE / dt_h END AS v_impl_kn FROM seg1),
seg AS (SELECT *, coalesce(v_impl_kn > 60.0 AND d_km > 1.0, false) AS es_salto FROM seg2)"""

TRAJ_CTE = f"""
traj AS (
  SELECT mmsi, fecha, count(*) AS posiciones, min(ts) AS ts_inicio, max(ts) AS ts_fin,
         arg_min(lat, ts) AS lat_inicio, arg_min(lon, ts) AS lon_inicio,
         arg_max(lat, ts) AS lat_fin, arg_max(lon, ts) AS lon_fin,
         {fixed('sum(CASE WHEN NOT es_salto THEN d_km END)', 2)} AS distancia_km,
         {fixed('avg(sog)', 2)} AS sog_promedio,
         max(sog) AS sog_max,
         CAST(count(*) FILTER (WHERE es_salto) AS BIGINT) AS saltos_anomalos,
         {fixed('max(v_impl_kn)', 1)} AS v_impl_max_kn,
         max(vessel_name) AS vessel_name, max(vessel_type) AS vessel_type, max(length) AS length,
         {fixed('(epoch(max(ts)) - epoch(min(ts))) / 3600.0::DOUBLE', 2)} AS horas_activo
  FROM seg GROUP BY mmsi, fecha)"""

_c_lat, _c_lon = cell_center("h3_r7")
TRAFFIC_CTE = f"""
traffic AS (
  SELECT fecha, hora, h3_r7, posiciones, buques, sog_promedio,
         {fixed(_c_lat, 6)} AS lat, {fixed(_c_lon, 6)} AS lon
  FROM (SELECT fecha, date_trunc('hour', ts) AS hora, h3_r7, count(*) AS posiciones,
               count(DISTINCT mmsi) AS buques, {fixed('avg(sog)', 2)} AS sog_promedio
        FROM silver GROUP BY fecha, date_trunc('hour', ts), h3_r7))"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select


# --------------------------------------------------------------------------- batch study

TYPED_CTES = f"""
raw AS ({duckdb_raw_sql()}),
typed AS (
  SELECT MMSI, TRY_CAST(BaseDateTime AS TIMESTAMP) AS BaseDateTime, TRY_CAST(LAT AS DOUBLE) AS LAT,
         TRY_CAST(LON AS DOUBLE) AS LON, TRY_CAST(SOG AS FLOAT) AS SOG, TRY_CAST(COG AS FLOAT) AS COG,
         TRY_CAST(Heading AS FLOAT) AS Heading, VesselName, IMO, CallSign,
         TRY_CAST(VesselType AS SMALLINT) AS VesselType, TRY_CAST(Status AS SMALLINT) AS Status,
         TRY_CAST(Length AS FLOAT) AS Length, TRY_CAST(Width AS FLOAT) AS Width, TRY_CAST(Draft AS FLOAT) AS Draft,
         Cargo, TransceiverClass, _source_file
  FROM raw),
clean AS (
  SELECT *, CAST(BaseDateTime AS DATE) AS fecha FROM typed
  WHERE LAT BETWEEN -90 AND 90 AND LON BETWEEN -180 AND 180 AND MMSI IS NOT NULL AND BaseDateTime IS NOT NULL),
opt AS (
  SELECT CAST(BaseDateTime AS DATE) AS date, CAST(date_trunc('month', BaseDateTime) AS DATE) AS year_month,
         CAST(hour(BaseDateTime) AS INTEGER) AS hour, CAST(round(LAT, 0) AS INTEGER) AS lat_bucket,
         CAST(round(LON, 0) AS INTEGER) AS lon_bucket, MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading, VesselName,
         IMO, CallSign, VesselType, Status, Length, Width, Draft, Cargo, TransceiverClass
  FROM typed)"""

RAW17 = ("MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading, VesselName, IMO, CallSign, VesselType, Status, "
         "Length, Width, Draft, Cargo, TransceiverClass")

# count_if measures of the profile, as DuckDB predicates over ``typed``
NULL_MEASURES = {f"nulos_{c}": f"{c} IS NULL" for c in ("MMSI", "BaseDateTime", "LAT", "LON")}
RANGE_MEASURES = {
    "LAT_fuera_rango": "LAT < -89.99999 OR LAT > 89.99999",
    "LON_fuera_rango": "LON < -179.99999 OR LON > 179.99999",
    "fuera_de_extension_NOAA": "LON < -168 OR LON > -60 OR LAT < 15 OR LAT > 50",
    "SOG_sin_dato": "abs(SOG - 102.3) < 0.05",
    "SOG_invalido_real": "SOG IS NOT NULL AND abs(SOG - 102.3) >= 0.05 AND (SOG < 0 OR SOG > 102.2)",
    "COG_sin_dato": "COG = 360.0",
    "COG_invalido_real": "COG IS NOT NULL AND COG <> 360.0 AND (COG < 0 OR COG > 359.9)",
    "Heading_sin_dato": "Heading = 511",
    "Heading_invalido_real": "Heading IS NOT NULL AND Heading <> 511 AND (Heading < 0 OR Heading > 359)",
}
ID_MEASURES = {
    "MMSI_longitud_invalida": "length(MMSI) <> 9",
    "MMSI_no_numerico": "NOT regexp_matches(MMSI, '^[0-9]+\\z')",
    "MMSI_fuera_rango_flota": ("regexp_matches(MMSI, '^[0-9]{9}\\z') AND (TRY_CAST(MMSI AS BIGINT) < 200000000 "
                               "OR TRY_CAST(MMSI AS BIGINT) > 799999999)"),
}
OPTIONAL_MEASURES = {}
for _c in ("VesselName", "CallSign"):
    OPTIONAL_MEASURES.update({f"{_c}_nulo": f"{_c} IS NULL", f"{_c}_vacio": f"{_c} = ''",
                              f"{_c}_placeholder_arroba": f"regexp_matches({_c}, '^@+\\z')"})
OPTIONAL_MEASURES.update({
    "IMO_nulo": "IMO IS NULL", "IMO_vacio": "IMO = ''",
    "IMO_formato_invalido": "IMO IS NOT NULL AND NOT regexp_matches(IMO, '^IMO[0-9]+\\z')",
    "Length_cero": "Length = 0", "Width_cero": "Width = 0", "Draft_cero": "Draft = 0",
    "Draft_techo_25_5": "Draft >= 25.5"})


def counts(measures: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {p}) AS {k}" for k, p in measures.items())


DUP_CTES = f"""
exact_g AS (SELECT {RAW17}, count(*) AS n FROM typed GROUP BY ALL),
key_g AS (SELECT MMSI, BaseDateTime, count(*) AS n FROM typed GROUP BY MMSI, BaseDateTime HAVING count(*) > 1),
exact_keys AS (SELECT DISTINCT MMSI, BaseDateTime FROM exact_g WHERE n > 1),
conflicts AS (SELECT * FROM key_g k WHERE NOT EXISTS (
  SELECT 1 FROM exact_keys e WHERE e.MMSI = k.MMSI AND e.BaseDateTime = k.BaseDateTime)),
dup AS (
  SELECT (SELECT CAST(sum(n - 1) AS BIGINT) FROM exact_g) AS duplicados_exactos,
         (SELECT count(*) FROM key_g) AS grupos_llave,
         (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM key_g) AS filas_involucradas,
         (SELECT count(*) FROM conflicts) AS grupos_conflicto)"""

BRONZE_CHECKS = {
    "total": "true",
    "mmsi_no_9_digitos": "NOT regexp_matches(MMSI, '^[0-9]{9}\\z') OR MMSI IS NULL",
    "ts_invalido": "TRY_CAST(BaseDateTime AS TIMESTAMP) IS NULL",
    "lat_nula_o_no_numerica": "TRY_CAST(LAT AS DOUBLE) IS NULL",
    "lat_fuera_rango": "TRY_CAST(LAT AS DOUBLE) < -90 OR TRY_CAST(LAT AS DOUBLE) > 90",
    "lon_nula_o_no_numerica": "TRY_CAST(LON AS DOUBLE) IS NULL",
    "lon_fuera_rango": "TRY_CAST(LON AS DOUBLE) < -180 OR TRY_CAST(LON AS DOUBLE) > 180",
    "sog_nula": "TRY_CAST(SOG AS DOUBLE) IS NULL",
    "sog_negativa": "TRY_CAST(SOG AS DOUBLE) < 0",
    "sog_sentinel_102_3": "abs(TRY_CAST(SOG AS DOUBLE) - 102.3) < 0.05",
    "sog_50_a_102": "TRY_CAST(SOG AS DOUBLE) > 50 AND TRY_CAST(SOG AS DOUBLE) < 102.25",
    "cog_sentinel_360": "abs(TRY_CAST(COG AS DOUBLE) - 360.0) < 0.05",
    "cog_fuera_rango": "TRY_CAST(COG AS DOUBLE) < 0 OR TRY_CAST(COG AS DOUBLE) > 360.05",
    "heading_sentinel_511": "abs(TRY_CAST(Heading AS DOUBLE) - 511) < 0.5",
    "imo_nulo": "IMO IS NULL",
    "imo_mal_formado": "IMO IS NOT NULL AND NOT regexp_matches(IMO, '^IMO[0-9]{7}\\z')",
}


# --------------------------------------------------------------------------- ports

def port_cells_ctes(ports_sql: str, step: float = CELL_STEP_R7, radius_km: float = 5.0) -> str:
    """Port cells by brute force: a generous block of rows/columns around each port, exact test."""
    lat_c, lon_c = cell_center("h3_r7", step)
    nc = _ncol("rw", step)
    return f"""
ports AS {ports_sql},
pc1 AS (SELECT *, unnest(generate_series({_row('lat_puerto', step)} - 6, {_row('lat_puerto', step)} + 6)) AS rw
        FROM ports),
pc2 AS (SELECT *, {nc} AS nc FROM pc1 WHERE rw BETWEEN 0 AND {_nrows(step) - 1}),
pc3 AS (SELECT *, unnest(generate_series(CAST(floor((lon_puerto + 180.0::DOUBLE) / 360.0::DOUBLE * nc) AS BIGINT) - 15,
                                         CAST(floor((lon_puerto + 180.0::DOUBLE) / 360.0::DOUBLE * nc) AS BIGINT) + 15))
               AS cl FROM pc2),
pc4 AS (SELECT DISTINCT puerto, pais, lat_puerto, lon_puerto, rw * {_ROW_FACTOR} + ((cl % nc) + nc) % nc AS h3_r7 FROM pc3),
pc5 AS (SELECT *, {haversine('lat_puerto', 'lon_puerto', lat_c, lon_c)} AS dist_km FROM pc4),
port_cells AS (
  SELECT h3_r7, arg_min(puerto, (dist_km, puerto, pais)) AS puerto, arg_min(pais, (dist_km, puerto, pais)) AS pais,
         arg_min(lat_puerto, (dist_km, puerto, pais)) AS lat_puerto, arg_min(lon_puerto, (dist_km, puerto, pais)) AS lon_puerto,
         {fixed('min(dist_km)', 2)} AS dist_km
  FROM pc5 WHERE dist_km <= {radius_km} GROUP BY h3_r7)"""


PRESENCE_CTE = f"""
pres0 AS (
  SELECT s.mmsi, s.ts, s.fecha, s.vessel_name, s.vessel_type, z.puerto, z.pais, z.lat_puerto, z.lon_puerto
  FROM silver s JOIN port_cells z ON s.h3_r7 = z.h3_r7
  WHERE s.es_buque AND s.sog IS NOT NULL AND s.sog <= 1.0),
pres1 AS (
  SELECT *, (CAST(epoch(ts) AS BIGINT)
             - CAST(epoch(lag(ts) OVER (PARTITION BY mmsi, fecha, puerto, pais ORDER BY ts)) AS BIGINT)) / 3600.0::DOUBLE
            AS dt_h
  FROM pres0),
presence AS (
  SELECT fecha, mmsi, puerto, pais, count(*) AS posiciones, min(ts) AS primera_posicion, max(ts) AS ultima_posicion,
         {fixed('sum(CASE WHEN dt_h <= 1 THEN dt_h ELSE 0.0::DOUBLE END)', 2)} AS horas_en_puerto,
         max(vessel_name) AS vessel_name, max(vessel_type) AS vessel_type,
         min(lat_puerto) AS lat_puerto, min(lon_puerto) AS lon_puerto
  FROM pres1 GROUP BY fecha, mmsi, puerto, pais)"""


def metrics_cte(day_metrics: list[str], causes: list[str], flags: list[str]) -> str:
    per_cause = ", ".join(f"count(*) FILTER (WHERE list_contains(causas, '{c}')) AS cuarentena_{c}" for c in causes)
    per_flag = ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in flags)
    return f"""
mday AS (
  SELECT fecha, count(*) AS filas_entrada, count(*) FILTER (WHERE valido) AS validas,
         count(*) FILTER (WHERE NOT valido) AS cuarentena, {per_cause}, {per_flag},
         count(*) FILTER (WHERE NOT es_buque) AS no_es_buque
  FROM chk GROUP BY fecha),
mdup AS (SELECT fecha, CAST(sum(n_reportes - 1) AS BIGINT) AS duplicados FROM silver GROUP BY fecha),
mwide AS (SELECT d.*, coalesce(u.duplicados, 0) AS duplicados FROM mday d LEFT JOIN mdup u
          ON d.fecha IS NOT DISTINCT FROM u.fecha),
metrics AS (
  SELECT fecha, metrica, CAST(valor AS BIGINT) AS valor FROM (
    SELECT fecha, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in day_metrics)} FROM mwide)
  UNPIVOT INCLUDE NULLS (valor FOR metrica IN ({", ".join(day_metrics)}))
  UNION ALL SELECT NULL::DATE, 'plata_insertadas', (SELECT count(*) FROM silver)
  UNION ALL SELECT NULL::DATE, 'duplicados_contra_historico', 0::BIGINT)"""


# --------------------------------------------------------------------------- land mask (brute force)

def _fixture_edges() -> list[tuple]:
    """Edges of the test layers, antimeridian-unwrapped, computed here independently of Spark."""
    from seawake.sources import geojson as gj
    out = []
    for layer, feats in (("land", gj.TEST_LAND), ("lakes", gj.TEST_LAKES), ("rivers", gj.TEST_RIVERS)):
        for fid, f in enumerate(feats):
            g = f["geometry"]
            parts = ([g["coordinates"]] if g["type"] == "Polygon" else
                     [[g["coordinates"]]] if g["type"] == "LineString" else [])
            for pid, rings in enumerate(parts):
                segs = [(a, b) for ring in rings for a, b in zip(ring[:-1], ring[1:])]
                wrap = any(abs(b[0] - a[0]) > 180 for a, b in segs)
                fix = (lambda x: x + 360 if wrap and x < 0 else x)
                out += [(layer, f"{fid}:{pid}", fix(a[0]), a[1], fix(b[0]), b[1]) for a, b in segs]
                if wrap:      # ... and once more for the cells west of 180°
                    out += [(layer, f"{fid}:{pid}:west", fix(a[0]) - 360, a[1], fix(b[0]) - 360, b[1]) for a, b in segs]
    return out


def land_ctes(step: float = CELL_STEP_R7) -> str:
    edges = ", ".join(f"('{l}', '{p}', {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)"
                      for l, p, x1, y1, x2, y2 in _fixture_edges())
    row = f"CAST(floor(h3 / {_ROW_FACTOR}) AS BIGINT)"
    nc = _ncol(row, step)

    def orient(cx, cy):
        return f"((e.x2 - e.x1) * ({cy} - e.y1) - (e.y2 - e.y1) * ({cx} - e.x1))"

    corners = [("b.bx0", "b.by0"), ("b.bx1", "b.by0"), ("b.bx1", "b.by1"), ("b.bx0", "b.by1")]
    sides = [orient(x, y) for x, y in corners]
    hit = (f"(least(e.x1, e.x2) <= b.bx1 AND greatest(e.x1, e.x2) >= b.bx0 AND least(e.y1, e.y2) <= b.by1 "
           f"AND greatest(e.y1, e.y2) >= b.by0 AND greatest({', '.join(sides)}) >= 0 AND least({', '.join(sides)}) <= 0)")

    def pseg(px, py):
        t = (f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, (({px} - e.x1) * (e.x2 - e.x1) + ({py} - e.y1) * (e.y2 - e.y1)) "
             f"/ ((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))))")
        return (f"sqrt(pow({px} - (e.x1 + {t} * (e.x2 - e.x1)), 2) + pow({py} - (e.y1 + {t} * (e.y2 - e.y1)), 2))")

    def pbox(px, py):
        return (f"sqrt(pow(greatest(b.bx0 - {px}, 0.0::DOUBLE, {px} - b.bx1), 2) "
                f"+ pow(greatest(b.by0 - {py}, 0.0::DOUBLE, {py} - b.by1), 2))")

    box_dist = (f"CASE WHEN {hit} THEN 0.0::DOUBLE ELSE least({pbox('e.x1', 'e.y1')}, {pbox('e.x2', 'e.y2')}, "
                + ", ".join(pseg(x, y) for x, y in corners) + ") END")
    lat_c, lon_c = cell_center("h3", step)
    return f"""
edges AS (SELECT * FROM (VALUES {edges}) t(layer, poly, x1, y1, x2, y2)),
cells AS (
  SELECT {cell('TRY_CAST(LAT AS DOUBLE)', 'TRY_CAST(LON AS DOUBLE)', step)} AS h3, count(*) AS posiciones,
         count(DISTINCT MMSI) AS buques
  FROM raw WHERE TRY_CAST(LAT AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(LON AS DOUBLE) BETWEEN -180 AND 180
  GROUP BY 1),
boxes AS (
  SELECT h3, by0, by0 + {step}::DOUBLE AS by1, bx0, bx0 + w AS bx1 FROM (
    SELECT h3, -90.0::DOUBLE + {row} * {step}::DOUBLE AS by0, 360.0::DOUBLE / {nc} AS w,
           -180.0::DOUBLE + (h3 - {row} * {_ROW_FACTOR}) * (360.0::DOUBLE / {nc}) AS bx0 FROM cells)),
corners AS (
  SELECT h3, 0 AS k, bx0 AS px, by0 AS py FROM boxes UNION ALL SELECT h3, 1, bx1, by0 FROM boxes
  UNION ALL SELECT h3, 2, bx1, by1 FROM boxes UNION ALL SELECT h3, 3, bx0, by1 FROM boxes),
inside AS (
  SELECT c.h3, c.k, e.layer, e.poly FROM corners c, edges e WHERE e.layer IN ('land', 'lakes')
  GROUP BY c.h3, c.k, e.layer, e.poly
  HAVING count(*) FILTER (WHERE (e.y1 > c.py) <> (e.y2 > c.py)
                           AND c.px < e.x1 + (c.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)) % 2 = 1),
hits AS (SELECT DISTINCT b.h3, e.layer, e.poly FROM boxes b, edges e WHERE {hit}),
within AS (
  SELECT DISTINCT i.h3 FROM (SELECT h3, poly FROM inside WHERE layer = 'land' GROUP BY h3, poly HAVING count(*) = 4) i
  WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.h3 = i.h3 AND h.layer = 'land' AND h.poly = i.poly)),
lake AS (SELECT h3 FROM hits WHERE layer = 'lakes' UNION SELECT h3 FROM inside WHERE layer = 'lakes'),
river AS (SELECT DISTINCT b.h3 FROM boxes b, edges e WHERE e.layer = 'rivers' AND ({box_dist}) <= 0.02),
base AS (SELECT h3 FROM within EXCEPT SELECT h3 FROM lake EXCEPT SELECT h3 FROM river),
wdist AS (
  SELECT h3, min({pseg('lon_c', 'lat_c')}) AS dist_deg FROM
    (SELECT h3, {lat_c} AS lat_c, {lon_c} AS lon_c FROM base) p,
    (SELECT x1 + t AS x1, y1, x2 + t AS x2, y2 FROM edges, (VALUES (0), (360), (-360)) turn(t)) e GROUP BY h3),
mask0 AS (
  SELECT c.h3, c.posiciones, c.buques, (base.h3 IS NOT NULL) AS es_tierra_base, w.dist_deg * 111.0 AS dist_agua_km,
         {lat_c.replace('h3', 'c.h3')} AS lat, {lon_c.replace('h3', 'c.h3')} AS lon
  FROM cells c LEFT JOIN base ON base.h3 = c.h3 LEFT JOIN wdist w ON w.h3 = c.h3),
land_mask AS (
  SELECT *, coalesce(es_tierra_base AND dist_agua_km >= 5.0 AND buques <= 3 AND posiciones <= 100, false) AS es_tierra
  FROM mask0)"""
