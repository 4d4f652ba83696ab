"""Column expressions shared by several operators (all JVM-side, codegen-friendly)."""

from zonepulse.functions.expressions import (
    cache_key,
    event_time_from_epoch,
    hilbert_key,
    hist_bin,
    pct,
    point_coordinate,
    zone_area_km2,
)

__all__ = ["cache_key", "event_time_from_epoch", "hilbert_key", "hist_bin", "pct",
           "point_coordinate", "zone_area_km2"]
