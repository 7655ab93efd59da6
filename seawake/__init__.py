"""seawake: vessel-traffic (AIS) analytics as plain Spark DataFrame / SQL / Structured Streaming jobs.

Layers: raw CSV → bronze (all strings, lineage) → silver (typed, flagged, deduplicated,
quarantine with causes, per-day quality metrics) → quality gate → gold (traffic per cell
and hour, daily trajectories, port presence) → speed-anomaly forest.
"""

from seawake.session import get_session, prepare, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
