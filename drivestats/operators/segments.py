"""Segments: trip buckets as mergeable rows (first and last sample, counts, sums, small id sets).

A segment is a run of consecutive samples of a trip, in sample order, that
``split_on`` does not part. Its row holds the pair sums inside it and its two
ends, so any set of buckets made of whole segments can be computed from such
rows: the sums add up, and the pairs lost between two segments are those of one
segment's last and the next one's first sample. Two uses:

* ``trip_segments`` over (month, trip), parted where the hour changes, feeds the
  tables of every grain from one pass over the samples.
* ``bucket_segments`` over one grain's buckets, parted at every gap of the sample
  counter, is the state that late samples merge into: a late sample carries a
  counter that was missing, so it falls between two segments, whatever became
  of the samples around it. Only a counter that came twice can fall inside one;
  ``overlapping`` finds those buckets.

A regular trace is one row a bucket and gap. Sets hold the ids of one segment,
which never has more rows than a block (``operators/blocks.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drivestats.functions.motion import CARRIED, DEFAULT_THRESHOLDS, EventThresholds, distance_measure, event_measures, speed_2dp
from drivestats.operators.blocks import in_blocks
from drivestats.operators.pairs import _row_measures, shuffle_width, stitched_in_blocks
from drivestats.operators.trips import ACTIVITY_COUNTS, ACTIVITY_DISTINCT, SAMPLE_ORDER, _renamed, bucket_samples, with_bucket_keys
from drivestats.plans.grains import Grain

MONTH_TRIP = ("year", "month", "trip_id")
HOURS = ("date", "hour")
SETS = {"users": "user_id", "vehicles": "vehicle_id"}


def _measures(thresholds: EventThresholds):
    return [distance_measure(), *event_measures(thresholds)]


def _ordered(alias: str) -> Column:
    return F.struct(*SAMPLE_ORDER).alias(alias)


def _segments(samples: DataFrame, keys: Sequence[str], split_on: Sequence[str], at_gaps: bool, thresholds: EventThresholds) -> DataFrame:
    keys, split_on = list(keys), list(split_on)
    samples = samples.withColumn("s", speed_2dp(F.col("sp"))).select(*keys, *split_on, *SETS.values(), *SAMPLE_ORDER)
    n = shuffle_width(samples)
    placed = in_blocks(samples, keys, SAMPLE_ORDER).repartition(*([n] if n else []), *keys, "_block")
    w = Window.partitionBy(*keys, "_block").orderBy(*[F.col(c).asc_nulls_first() for c in SAMPLE_ORDER])
    if at_gaps:
        # A block's first sample has no counter before it, its last one none behind.
        new = F.coalesce(F.col("ct") > F.lag("ct").over(w) + 1, F.lit(True))
        ends = F.coalesce(F.lead("ct").over(w) > F.col("ct") + 1, F.lit(True))
    else:
        new, ends = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
    for c in split_on:
        new = new | ~F.col(c).eqNullSafe(F.lag(c).over(w))
        ends = ends | ~F.col(c).eqNullSafe(F.lead(c).over(w))
    rows = placed.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in CARRIED], new.cast("int").alias("_new"), (new & ends).alias("_alone"))
    # The pair that leads into a segment is not of it.
    for c in CARRIED:
        rows = rows.withColumn(f"prev_{c}", F.when(F.col("_new") == 0, F.col(f"prev_{c}")))
    runs = (rows.where("NOT _alone") if at_gaps else rows).withColumn("_segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*keys, *split_on, "_block", "_segment").agg(
        F.min(_ordered("first")).alias("first"),
        F.max(_ordered("last")).alias("last"),
        *_row_measures(_measures(thresholds), CARRIED),
        *[F.count(c).alias(n) for n, c in ACTIVITY_COUNTS.items()],
        F.count(F.lit(1)).alias("samples"),
        *[F.collect_set(c).alias(n) for n, c in SETS.items()],
    ).drop("_block", "_segment")
    if not at_gaps:
        return runs
    # A sample that is a segment by itself, as most are between gaps, has nothing to add up, and needs no place in a hash table of sets.
    # No pair leads into it, so no predecessor's values are looked up for it.
    pair = dict.fromkeys(CARRIED, "CAST(NULL AS DOUBLE)"), {c: f"`{c}`" for c in CARRIED}
    alone = rows.where("_alone").select(
        *keys,
        *split_on,
        _ordered("first"),
        _ordered("last"),
        *[F.expr(f"CAST({m.fn(*pair)} AS BIGINT) AS `_rows_{m.name}`") for m in _measures(thresholds)],
        *[F.col(c).isNotNull().cast("long").alias(n) for n, c in ACTIVITY_COUNTS.items()],
        F.lit(1).cast("long").alias("samples"),
        *[F.array_compact(F.array(c)).alias(n) for n, c in SETS.items()],
    )
    return runs.unionByName(alone)


def trip_segments(positions: DataFrame, thresholds: EventThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Segments of normalised positions with a date, in the order of whole (month, trip)s, parted where the hour changes."""
    return _segments(positions.where(F.col("date").isNotNull()), MONTH_TRIP, HOURS, False, thresholds)


def bucket_segments(positions: DataFrame, grain: Grain, thresholds: EventThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Segments of the trip buckets of ``grain``, parted at gaps of the counter, with the output's partition columns."""
    out = _segments(bucket_samples(positions, grain), grain.bucket_keys, (), True, thresholds)
    parts = {p: {"year": F.year, "month": F.month, "day": F.dayofmonth}[p](F.col("date")) for p in grain.output_parts if p not in grain.bucket_keys}
    return out.withColumns(parts) if parts else out


def overlapping(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The buckets in which a segment begins before an earlier one ends: then one begins before its predecessor ends."""
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("first", "last"))
    ends = segments.select(*keys, "first", "last")
    if n := shuffle_width(segments):
        ends = ends.repartition(n, *keys)
    return ends.withColumn("_before", before).where(F.col("first") < F.col("_before")).select(*keys).distinct()


def merged(segments: DataFrame, grain: Grain, thresholds: EventThresholds = DEFAULT_THRESHOLDS, samples: str | None = None) -> DataFrame:
    """One row per trip bucket of ``grain``, as ``trips.trip_metrics`` has it, from segments that do not overlap.

    Segments are stitched in blocks, so a bucket of very many of them is not
    one task's; ids are counted as (bucket, id) pairs, never as one set of a
    whole bucket.
    """
    keys = list(grain.bucket_keys)
    if not grain.keep_null_trip:
        segments = segments.where(F.col("trip_id").isNotNull())
    measures = [m for m in _measures(thresholds) if grain.with_events or m.name == "distance_um"]
    carry = [c for c in CARRIED if grain.with_events or c != "s"]
    ends = [F.col(f"first.{c}").alias(f"_head_{c}") for c in carry] + [F.col(f"last.{c}").alias(f"_tail_{c}") for c in carry]
    counts = [*ACTIVITY_COUNTS, *([samples] if samples else [])]
    if samples:
        segments = segments.withColumnRenamed("samples", samples)
    parts = segments.select(*keys, "first", "last", *ends, *[f"_rows_{m.name}" for m in measures], *counts)
    sums = stitched_in_blocks(parts, keys, ["first", "last"], carry, measures, counts)
    out = sums
    for (name, _), ids in zip(ACTIVITY_DISTINCT.items(), SETS):
        counted = segments.select(*keys, F.explode(ids).alias("_id")).groupBy(*keys).agg(F.count_distinct("_id").alias(name))
        out = out.unionByName(counted, allowMissingColumns=True)
    order = [*ACTIVITY_DISTINCT, *counts, *[m.name for m in measures]]
    out = out.groupBy(*keys).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in order])
    return with_bucket_keys(out, grain, _renamed(order))
