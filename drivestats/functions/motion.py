"""Per-pair measures over consecutive samples of one trip bucket.

A measure is a function ``(prev, cur) -> SQL text`` where ``prev`` and ``cur``
map a carried column name (``latitude``, ``longitude``, ``s``) to the name of
the column that holds it. The same function is evaluated per row (prev = lagged
values) and on the pairs stitched at the edges of blocks, slices and segments,
so a formula is written once.

The reference imports its distance and speed-event formulas from a module that
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from drivestats.functions.geo import haversine_sql

Names = Mapping[str, str]
MeasureFn = Callable[[Names, Names], str]


@dataclass(frozen=True)
class Measure:
    """A whole number (bigint) per pair: sums are then exact in any order of addition."""

    name: str
    fn: MeasureFn


@dataclass(frozen=True)
class EventThresholds:
    """Speed-change rules, in speed units per sample. Parameters, not constants."""

    acceleration: float = 10.0
    deceleration: float = -10.0
    start_from_below: float = 5.0
    sudden_start: float = 20.0
    stop_below: float = 5.0
    sudden_stop: float = -20.0


DEFAULT_THRESHOLDS = EventThresholds()

# Columns every pair measure may read, in the order they are carried.
CARRIED = ("latitude", "longitude", "s")


def speed_2dp(sp: Column) -> Column:
    """Speed rounded to two decimals (half-up, as Spark's ``round``)."""
    return F.round(sp, 2)


# Fixed value: distances are summed in whole micrometres, rounded half-up per
# pair. A bigint holds 9.2e12 m of them in one trip bucket (more is an overflow
# error under Spark's default ANSI mode).
UM_PER_M = 1_000_000


def _distance(prev: Names, cur: Names) -> str:
    metres = haversine_sql(prev["latitude"], prev["longitude"], cur["latitude"], cur["longitude"])
    return f"floor({metres} * {float(UM_PER_M)!r}D + 0.5D)"


def whole_metres(um: Column) -> Column:
    """Micrometres to metres, rounded half-up, in whole numbers only."""
    return F.floor((um + UM_PER_M // 2) / F.lit(UM_PER_M).cast("decimal(10,0)")).cast("long")


def distance_measure() -> Measure:
    return Measure("distance_um", _distance)


def event_measures(t: EventThresholds = DEFAULT_THRESHOLDS) -> list[Measure]:
    def number(x: float) -> str:
        return f"{float(x)!r}D"

    def rule(name: str, change: str, threshold: float, side: str | None = None, below: float = 0.0) -> Measure:
        def fn(prev: Names, cur: Names) -> str:
            jump = f"{cur['s']} - {prev['s']} {change} {number(threshold)}"
            slow = f"{(prev if side == 'before' else cur)['s']} <= {number(below)} AND " if side else ""
            return f"IF({slow}{jump}, 1, 0)"

        return Measure(name, fn)

    return [
        rule("sudden_start_count", ">=", t.sudden_start, "before", t.start_from_below),
        rule("sudden_stop_count", "<=", t.sudden_stop, "after", t.stop_below),
        rule("acceleration_count", ">=", t.acceleration),
        rule("deceleration_count", "<=", t.deceleration),
    ]
