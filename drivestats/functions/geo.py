"""Great-circle distance as a native Catalyst expression (stays in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres and the degree-to-radian factor.
# The oracle SQL uses the same literals so both engines do the same float ops.
EARTH_RADIUS_M = 6371008.8
DEG_TO_RAD = 0.017453292519943295


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres between two points given in degrees.

    Null when any coordinate is null, so a pair with a missing side adds nothing
    to a ``sum``. ``least(1, sqrt(h))`` is guarded by that null check: both
    Spark and DuckDB return 1 for ``least(1, NULL)``.
    """
    half_dlat = (lat2 - lat1) * DEG_TO_RAD / 2.0
    half_dlon = (lon2 - lon1) * DEG_TO_RAD / 2.0
    sin_dlat = F.sin(half_dlat)
    sin_dlon = F.sin(half_dlon)
    h = sin_dlat * sin_dlat + F.cos(lat1 * DEG_TO_RAD) * F.cos(lat2 * DEG_TO_RAD) * sin_dlon * sin_dlon
    dist = F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    complete = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(complete, dist)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """``haversine_m`` as SQL text over column names: one call to build, however often it is used."""
    rad = f"{DEG_TO_RAD!r}D"
    half_dlat, half_dlon = f"(({lat2} - {lat1}) * {rad} / 2.0D)", f"(({lon2} - {lon1}) * {rad} / 2.0D)"
    h = f"sin({half_dlat}) * sin({half_dlat}) + cos({lat1} * {rad}) * cos({lat2} * {rad}) * sin({half_dlon}) * sin({half_dlon})"
    complete = " AND ".join(f"{c} IS NOT NULL" for c in (lat1, lon1, lat2, lon2))
    return f"CASE WHEN {complete} THEN {2.0 * EARTH_RADIUS_M!r}D * asin(least(1.0D, sqrt({h}))) END"
