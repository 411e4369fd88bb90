"""Column-expression building blocks (all native Catalyst expressions)."""

from drivestats.functions.geo import EARTH_RADIUS_M, haversine_m
from drivestats.functions.motion import (
    DEFAULT_THRESHOLDS,
    EventThresholds,
    Measure,
    distance_measure,
    event_measures,
    speed_2dp,
)
from drivestats.functions.timeparts import (
    normalized_ts,
    partition_after,
    partition_start,
    year_month_padded,
    year_month_unpadded,
)

__all__ = [
    "DEFAULT_THRESHOLDS",
    "EARTH_RADIUS_M",
    "EventThresholds",
    "Measure",
    "distance_measure",
    "event_measures",
    "haversine_m",
    "normalized_ts",
    "partition_after",
    "partition_start",
    "speed_2dp",
    "year_month_padded",
    "year_month_unpadded",
]
