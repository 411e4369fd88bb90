"""Trip-bucket operators: activity (A1), distance (U1, P8), speed events (U2), J1.

A trip bucket is one trip inside one time bucket (``Grain.trip_keys``). The
reference collects each bucket's samples into arrays and runs Python over them
(a UDF for distance, a driver-side loop for events). Here samples stay rows:
the pair measures run through ``ordered_pair_sums`` and the counts are plain
aggregates planned on the same shuffle, with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivestats.functions.motion import (
    CARRIED,
    DEFAULT_THRESHOLDS,
    UM_PER_M,
    EventThresholds,
    Measure,
    distance_measure,
    event_measures,
    speed_2dp,
    whole_metres,
)
from drivestats.operators.pairs import group_counts, ordered_pair_sums
from drivestats.plans.grains import Grain

# Order of samples inside a trip bucket. ``ct`` (the sample counter) leads, as
# in the reference; the rest settles ties so the order is total on values.
SAMPLE_ORDER = ("ct", "ts", "latitude", "longitude", "s")

EVENT_COLUMNS = {
    "sudden_start_count": "total_sudden_start_count",
    "sudden_stop_count": "total_sudden_stop_count",
    "acceleration_count": "total_acceleration_count",
    "deceleration_count": "total_deceleration_count",
}


def complete_key(grain: Grain) -> Column:
    """Whether a normalised sample has every key of a trip bucket.

    Hourly and daily need a date, hour and trip id (the reference's inner join
    drops the rest). Monthly keeps null trip ids, drops null dates.
    """
    cond = F.lit(True)
    for k in grain.time_keys:
        cond = cond & F.col(k).isNotNull()
    if not grain.keep_null_trip:
        cond = cond & F.col("trip_id").isNotNull()
    return cond


def bucket_samples(positions: DataFrame, grain: Grain) -> DataFrame:
    """Normalised positions restricted to rows with a complete bucket key."""
    return positions.where(complete_key(grain))


# Activity per trip bucket: output name -> counted column.
ACTIVITY_DISTINCT = {"user_count": "user_id", "vehicle_count": "vehicle_id"}
ACTIVITY_COUNTS = {"total_driving_time": "ct", "size_of_latitude": "latitude"}


_DATE_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def with_bucket_keys(df: DataFrame, grain: Grain, rest: list[Column] | None = None) -> DataFrame:
    """Add back the key parts derived from ``date``; trip keys first, then ``rest``."""
    derived = {k: _DATE_PARTS[k](F.col("date")).alias(k) for k in grain.derived_keys}
    if rest is None:
        rest = [F.col(c) for c in df.columns if c not in grain.trip_keys]
    return df.select(*[derived.get(k, F.col(k)) for k in grain.trip_keys], *rest)


def trip_activity(positions: DataFrame, grain: Grain) -> DataFrame:
    """A1 without arrays: distinct users and vehicles, sample and point counts.

    Samples are counted per (bucket, user, vehicle) first, map-side, so a hot
    bucket is split and the distinct counts read few rows (``group_counts``).
    """
    counted = group_counts(bucket_samples(positions, grain), grain.bucket_keys, ACTIVITY_COUNTS, ACTIVITY_DISTINCT)
    return with_bucket_keys(counted, grain)


def _measures(with_distance: bool, with_events: bool, thresholds: EventThresholds) -> list[Measure]:
    out: list[Measure] = []
    if with_distance:
        out.append(distance_measure())
    if with_events:
        out.extend(event_measures(thresholds))
    return out


def _renamed(columns: list[str]) -> list[Column]:
    """Measure columns under their table names; distance also rounded per bucket (P8)."""
    cols = []
    for c in columns:
        if c == "distance_um":
            cols.append((F.col(c) / float(UM_PER_M)).alias("distance_m"))
            cols.append(whole_metres(F.col(c)).alias("total_distance"))
        else:
            cols.append(F.col(c).alias(EVENT_COLUMNS.get(c, c)))
    return cols


def trip_metrics(
    positions: DataFrame,
    grain: Grain,
    with_activity: bool = True,
    with_distance: bool = True,
    with_events: bool | None = None,
    thresholds: EventThresholds = DEFAULT_THRESHOLDS,
    strategy: str = "blocks",
    samples: str | None = None,
) -> DataFrame:
    """Everything known about each trip bucket.

    Columns: trip keys, then (activity) ``user_count``, ``vehicle_count``,
    ``total_driving_time`` (sample count), ``size_of_latitude``, then
    ``distance_m`` and ``total_distance`` (metres rounded per bucket, P8), then
    the four ``total_*_count`` event columns. ``samples`` names a further
    column for the number of all samples, counters or not.

    Activity (distinct counts) and motion (ordered pairs) come from one scan
    and one shuffle of the samples (see ``ordered_pair_sums`` counts).
    """
    if with_events is None:
        with_events = grain.with_events
    measures = _measures(with_distance, with_events, thresholds)
    if not measures:
        if not with_activity:
            raise ValueError("nothing to compute")
        return trip_activity(positions, grain)
    # Only what the measures read travels through the sample shuffle. Without
    # events the speed is not needed: ties on the rest are at one place.
    order = [c for c in SAMPLE_ORDER if with_events or c != "s"]
    companions = list(ACTIVITY_DISTINCT.values()) if with_activity else []
    rows = bucket_samples(positions, grain).withColumn("s", speed_2dp(F.col("sp")))
    counts = dict(ACTIVITY_COUNTS) if with_activity else {}
    if samples:
        counts[samples] = grain.bucket_keys[0]  # a time key: never null here
    out = ordered_pair_sums(
        rows.select(*grain.bucket_keys, *companions, *order),
        keys=grain.bucket_keys,
        order=order,
        carry=[c for c in CARRIED if c in order],
        measures=measures,
        strategy=strategy,
        counts=counts,
        distinct_counts=ACTIVITY_DISTINCT if with_activity else None,
    )
    rest = _renamed([c for c in out.columns if c not in grain.bucket_keys])
    return with_bucket_keys(out, grain, rest)


def trip_distance(positions: DataFrame, grain: Grain, strategy: str = "blocks") -> DataFrame:
    """U1 + P8: trip keys and ``total_distance`` (long metres)."""
    out = trip_metrics(positions, grain, with_activity=False, with_events=False, strategy=strategy)
    return out.select(*grain.trip_keys, "total_distance")


def trip_driving_events(
    positions: DataFrame,
    grain: Grain,
    thresholds: EventThresholds = DEFAULT_THRESHOLDS,
    strategy: str = "blocks",
) -> DataFrame:
    """U2: trip keys and the four event counts."""
    out = trip_metrics(
        positions, grain, with_activity=False, with_distance=False, with_events=True,
        thresholds=thresholds, strategy=strategy,
    )
    return out.select(*grain.trip_keys, *EVENT_COLUMNS.values())


def join_trip_events(trips: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J1: inner equi-join of trip buckets with their event counts.

    Both sides are keyed by the bucket, so the join is 1:1 and a null key on
    either side drops the row (SQL equality). Both sides grow with the number
    of buckets, so the join is pinned to sort-merge (never a broadcast); both
    come out of aggregates hash-partitioned on the same keys, so no exchange
    is added for it.
    """
    return trips.join(events.hint("merge"), on=list(keys), how="inner")
