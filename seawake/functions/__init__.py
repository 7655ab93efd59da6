from seawake.functions.geo import (  # noqa: F401
    EARTH_RADIUS_KM, KNOT_KMH, haversine_km, cell_id, cell_center, cell_row, CELL_STEP_R7, CELL_STEP_R8,
)
from seawake.functions.numeric import fixed  # noqa: F401
from seawake.functions.dates import parse_days, day_filter  # noqa: F401
