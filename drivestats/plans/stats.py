"""The statistics plan: positions to one row per time bucket (E1-E3 data path)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from drivestats.functions.motion import DEFAULT_THRESHOLDS, EventThresholds
from drivestats.operators.rollup import rollup_stats
from drivestats.operators.segments import merged
from drivestats.operators.trips import trip_metrics
from drivestats.plans.grains import Grain, grain as as_grain
from drivestats.sources.positions import normalize


def build_stats(
    positions: DataFrame,
    grain: str | Grain,
    sample_seconds: float = 1.0,
    thresholds: EventThresholds = DEFAULT_THRESHOLDS,
    strategy: str = "blocks",
    normalized: bool = False,
    samples: str | None = None,
) -> DataFrame:
    """Hourly / daily / monthly statistics from raw (or normalised) positions.

    One lazy plan, the same at every size: normalise, trip-bucket pass (one
    shuffle of the samples, partial aggregation), rollup (shuffle of trip-bucket
    rows only), shaping. Building it starts no job.
    Each table is built from positions, never from a finer table: trip buckets
    are not additive across time buckets.
    """
    g = as_grain(grain)
    pos = positions if normalized else normalize(positions)
    trips = trip_metrics(pos, g, thresholds=thresholds, strategy=strategy, samples=samples)
    return rollup_stats(trips, g, sample_seconds=sample_seconds, samples=samples)


def build_many(segments: DataFrame, grains: Sequence[str | Grain], sample_seconds: float = 1.0, samples: str | None = None) -> dict[str, DataFrame]:
    """The tables of several grains from one set of ``segments.trip_segments``, each equal to ``build_stats`` of its samples.

    Every grain's buckets are made of whole segments, so no table reads a
    sample again; written once, the segments cost one scan and one shuffle.
    """
    out = {}
    for g in map(as_grain, grains):
        out[g.name] = rollup_stats(merged(segments, g, samples=samples), g, sample_seconds=sample_seconds, samples=samples)
    return out
