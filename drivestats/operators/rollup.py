"""Time-bucket rollup of trip buckets (A2) and the output shaping (P5-P10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivestats.functions.timeparts import year_month_padded, year_month_unpadded
from drivestats.plans.grains import EVENT_AVGS, EVENT_TOTALS, Grain


def driving_minutes(samples: Column, sample_seconds: float = 1.0) -> Column:
    """Sample count to whole minutes, rounded half-up once per time bucket (P7)."""
    return F.round(samples * F.lit(float(sample_seconds)) / 60.0).cast("long")


def rollup_stats(trips: DataFrame, grain: Grain, sample_seconds: float = 1.0, samples: str | None = None) -> DataFrame:
    """One row per time bucket with totals, partition parts, averages and keys.

    ``trip_count`` is ``count(trip_id)``: after the trip-bucket aggregate a trip
    occurs once per time bucket, so this equals ``count(distinct trip_id)``
    without a distinct aggregate. User and vehicle counts are sums of the
    per-bucket distinct counts (the reference's definition). Every aggregate
    here is partial-aggregated map-side, so a hot time bucket costs one row per
    task in the shuffle. ``samples`` names a column of ``trips`` that is summed
    and added at the end.
    """
    keys = list(grain.time_keys)
    aggs = [
        F.count("trip_id").alias("trip_count"),
        F.sum("user_count").alias("user_count"),
        F.sum("vehicle_count").alias("vehicle_count"),
        driving_minutes(F.sum("total_driving_time"), sample_seconds).alias("total_driving_time"),
        F.sum("total_distance").alias("total_distance"),
    ]
    if grain.with_events:
        aggs += [F.sum(c).alias(c) for c in EVENT_TOTALS]
    if samples:
        aggs.append(F.sum(samples).alias(samples))
    out = trips.groupBy(*keys).agg(*aggs)

    cols = {c: F.col(c) for c in out.columns}
    if "date" in keys:
        for p, e in {"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}.items():
            if p not in keys and p in grain.output_cols:
                cols[p] = e
    trip_count = F.col("trip_count")
    cols["avg_distance"] = F.try_divide(F.col("total_distance"), trip_count).cast("double")
    if grain.with_events:
        cols["avg_driving_time"] = F.try_divide(F.col("total_driving_time"), trip_count).cast("double")
        for total, avg in zip(EVENT_TOTALS, EVENT_AVGS):
            cols[avg] = F.try_divide(F.col(total), trip_count).cast("double")
    if grain.year_month:
        shape = year_month_unpadded if grain.year_month == "unpadded" else year_month_padded
        cols["year_month"] = shape(cols["year"], cols["month"])
    return out.select(*[cols[c].alias(c) for c in [*grain.output_cols, *([samples] if samples else [])]])
