"""Native Column expressions for distances and spatial cells (no Python UDFs).

Cells are a latitude-band grid: rows of constant height ``step`` degrees, each row cut
into ``ncol`` columns so that cells keep roughly equal area. Everything is closed-form
arithmetic, so the same id comes out of Spark and of plain SQL engines, and a cell is an
axis-aligned lon/lat box (which keeps the land-mask geometry simple).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain.
EARTH_RADIUS_KM = 6371.0
KNOT_KMH = 1.852
CELL_STEP_R7 = 0.02     # ≈ 4.9 km² cells ("resolution 7" of the daily pipeline)
CELL_STEP_R8 = 0.0075   # ≈ 0.7 km² cells ("resolution 8" of the batch study)
_ROW_FACTOR = 100000    # cell = row * 100000 + col; ncol never exceeds 48000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (R = 6371); null when any input is null.

    ``a`` is clamped to 1 so rounding never yields NaN. The clamp is a CASE, not ``least``:
    ``least`` skips nulls and would turn a missing previous point into half the globe.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))


def _nrows(step: float) -> int:
    return int(round(180.0 / step))


def cell_row(lat, step: float = CELL_STEP_R7) -> Column:
    return F.least(F.floor((_c(lat) + 90.0) / step), F.lit(_nrows(step) - 1))


def _row_center(row: Column, step: float) -> Column:
    return F.lit(-90.0) + (row + 0.5) * step


def _ncol(row: Column, step: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) * F.cos(F.radians(_row_center(row, step))) / step + 0.5))


def cell_id(lat, lon, step: float = CELL_STEP_R7) -> Column:
    """Cell of a point as a bigint; null when lat or lon is null (``least`` would hide a null)."""
    row = cell_row(lat, step)
    ncol = _ncol(row, step)
    col = F.pmod(F.floor((_c(lon) + 180.0) / 360.0 * ncol), ncol)
    return F.when(_c(lat).isNotNull() & _c(lon).isNotNull(), (row * _ROW_FACTOR + col).cast("bigint"))


def cell_center(cell, step: float = CELL_STEP_R7) -> tuple[Column, Column]:
    """(lat, lon) of a cell centre."""
    cell = _c(cell)
    row = F.floor(cell / _ROW_FACTOR)
    col = cell - row * _ROW_FACTOR
    ncol = _ncol(row, step)
    return _row_center(row, step), F.lit(-180.0) + (col + 0.5) * 360.0 / ncol


def cell_bounds(cell, step: float = CELL_STEP_R7) -> tuple[Column, Column, Column, Column]:
    """(lat_min, lat_max, lon_min, lon_max) of a cell box."""
    cell = _c(cell)
    row = F.floor(cell / _ROW_FACTOR)
    col = cell - row * _ROW_FACTOR
    ncol = _ncol(row, step)
    width = F.lit(360.0) / ncol
    lat0 = F.lit(-90.0) + row * step
    lon0 = F.lit(-180.0) + col * width
    return lat0, lat0 + step, lon0, lon0 + width


def ring_cells(lat, lon, radius_km: float, step: float = CELL_STEP_R7) -> Column:
    """Array of cell ids whose boxes may lie within ``radius_km`` of (lat, lon).

    Candidate rows cover the radius in latitude; in each row the covered columns follow
    from the longitude span of the radius at that latitude. Callers filter the candidates
    with an exact distance test, so a generous cover is harmless.
    """
    lat, lon = _c(lat), _c(lon)
    row0 = cell_row(lat, step)
    k = int(radius_km / (111.195 * step)) + 1
    rows = F.sequence(F.greatest(row0 - k, F.lit(0)), F.least(row0 + k, F.lit(_nrows(step) - 1)))

    def per_row(r: Column) -> Column:
        ncol = _ncol(r, step)
        lat_c = _row_center(r, step)
        # degrees of longitude per km at the row edge closest to the pole (widest span)
        coslat = F.greatest(F.cos(F.radians(F.abs(lat_c) + step)), F.lit(1e-6))
        span = F.lit(radius_km) / (F.lit(111.195) * coslat) + 360.0 / ncol
        c0 = F.floor((lon + 180.0) / 360.0 * ncol)
        dc = F.least(F.ceil(span / (F.lit(360.0) / ncol)), F.floor(ncol / 2))
        return F.transform(F.sequence(c0 - dc, c0 + dc),
                           lambda c: (r * _ROW_FACTOR + F.pmod(c, ncol)).cast("bigint"))

    return F.array_distinct(F.flatten(F.transform(rows, per_row)))
