"""Grains: what a trip bucket and a time bucket are for each output table.

One description per table replaces three near-copies of the same job.
"""

from __future__ import annotations

from dataclasses import dataclass

from drivestats.functions.timeparts import PARTITION_PARTS

# The column names of the published tables.
EVENT_TOTALS = (
    "total_sudden_start_count",
    "total_sudden_stop_count",
    "total_acceleration_count",
    "total_deceleration_count",
)
EVENT_AVGS = tuple(c.replace("total_", "avg_") for c in EVENT_TOTALS)
BASE_TOTALS = ("trip_count", "user_count", "vehicle_count", "total_driving_time", "total_distance")


@dataclass(frozen=True)
class Grain:
    name: str
    time_keys: tuple[str, ...]  # time part of the trip bucket and of the rollup
    source_parts: tuple[str, ...]  # source partition columns the incremental filter uses
    output_parts: tuple[str, ...]  # partitionBy of the published table
    with_events: bool  # speed events and the averages derived from them
    keep_null_trip: bool  # monthly keeps samples without trip id (no join drops them)
    year_month: str | None  # None, "unpadded" (concat) or "padded" (yyyy-MM)
    output_cols: tuple[str, ...]

    @property
    def trip_keys(self) -> tuple[str, ...]:
        return (*self.time_keys, "trip_id")

    @property
    def output_schema(self) -> str:
        """The published table's columns and types as DDL text."""

        def ddl(c: str) -> str:
            if c.startswith("avg_"):
                return "DOUBLE"
            return {"date": "DATE", "year_month": "STRING"}.get(c, "INT" if c in PARTITION_PARTS else "BIGINT")

        return ", ".join(f"`{c}` {ddl(c)}" for c in self.output_cols)

    @property
    def derived_keys(self) -> tuple[str, ...]:
        """Time keys that are functions of ``date`` (day, month next to date)."""
        if "date" not in self.time_keys:
            return ()
        return tuple(k for k in self.time_keys if k in ("year", "month", "day"))

    @property
    def bucket_keys(self) -> tuple[str, ...]:
        """The trip-bucket key as shuffled: derivable parts are added back after aggregation."""
        return tuple(k for k in self.trip_keys if k not in self.derived_keys)


HOURLY = Grain(
    name="hourly",
    time_keys=("date", "hour"),
    source_parts=("year", "month", "day", "hour"),
    output_parts=("year", "month", "day", "hour"),
    with_events=True,
    keep_null_trip=False,
    year_month=None,
    output_cols=(
        "date", "hour", *BASE_TOTALS, *EVENT_TOTALS, "year", "month", "day",
        "avg_distance", "avg_driving_time", *EVENT_AVGS,
    ),
)

DAILY = Grain(
    name="daily",
    time_keys=("date", "day"),
    source_parts=("year", "month", "day"),
    output_parts=("year", "month", "day"),
    with_events=True,
    keep_null_trip=False,
    year_month="unpadded",
    output_cols=(
        "date", "day", *BASE_TOTALS, *EVENT_TOTALS, "year", "month",
        "avg_distance", "avg_driving_time", *EVENT_AVGS, "year_month",
    ),
)

# The reference's monthly grain: trip bucket (date, month, trip), one output row
# per date, the date itself not kept.
MONTHLY = Grain(
    name="monthly",
    time_keys=("date", "month"),
    source_parts=("year", "month"),
    output_parts=("year", "month"),
    with_events=False,
    keep_null_trip=True,
    year_month="unpadded",
    output_cols=("year_month", "month", *BASE_TOTALS, "year", "avg_distance"),
)

# Calendar months: trip bucket (year, month, trip), one row per month, yyyy-MM key.
MONTHLY_CALENDAR = Grain(
    name="monthly_calendar",
    time_keys=("year", "month"),
    source_parts=("year", "month"),
    output_parts=("year", "month"),
    with_events=False,
    keep_null_trip=True,
    year_month="padded",
    output_cols=("year_month", "month", *BASE_TOTALS, "year", "avg_distance"),
)

GRAINS = {g.name: g for g in (HOURLY, DAILY, MONTHLY, MONTHLY_CALENDAR)}


def grain(name_or_grain: str | Grain) -> Grain:
    if isinstance(name_or_grain, Grain):
        return name_or_grain
    try:
        return GRAINS[name_or_grain]
    except KeyError:
        raise ValueError(f"unknown grain {name_or_grain!r}; expected one of {sorted(GRAINS)}") from None
