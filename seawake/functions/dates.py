"""Day-set parameter shared by every daily step ("todas" = all days, or a comma list)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_DAYS = "todas"


def parse_days(spec: str | None) -> list[dt.date] | None:
    """``None``/"todas" → None (all days); "2024-01-03, 2024-01-04" → sorted unique dates."""
    if spec is None or spec.strip().lower() in (ALL_DAYS, "all", ""):
        return None
    return sorted({dt.date.fromisoformat(p.strip()) for p in spec.split(",") if p.strip()})


def day_filter(col, days: list[dt.date] | None) -> Column:
    """Predicate for a day set; an empty list selects nothing."""
    c = F.col(col) if isinstance(col, str) else col
    if days is None:
        return F.lit(True)
    if not days:
        return F.lit(False)
    return c.isin([F.lit(d) for d in days])
