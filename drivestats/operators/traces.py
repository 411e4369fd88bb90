"""Trip traces in row form (O1, P12): every sample with its position in sample order.

The reference collects each trip bucket's samples into sorted arrays. An array
is a whole bucket in one row, so here the trace is kept as rows: element i of
the array is the row with ``seq = i`` (1-based), and the array size is the
bucket's largest ``seq``. Nothing holds a bucket whole:

* ``blocks`` (default): rows are numbered inside their block (``operators/blocks.py``). Only buckets that were cut
  have rows before a block; their block sizes, added up in order, complete the positions. That is one row per
  ``blockRows`` samples of large buckets, which bounds the broadcast; the samples move once, in the JVM.
* ``sorted``: the range exchange cuts a hot bucket into slices. Rows
  are numbered inside the sorted slice where they are. Only the first bucket of
  a slice can have begun in an earlier one, so one number per slice, the rows
  of that bucket before the slice, completes the positions. These numbers are
  at most one row per shuffle partition, which bounds the broadcast; the
  samples move once.
* ``window``: ``row_number()`` over the bucket, for callers who know that every
  bucket is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from drivestats.operators import _slice_scan
from drivestats.operators.blocks import in_blocks, renamed_keys, same_key
from drivestats.operators.pairs import over, shuffle_for_pairs, shuffle_width
from drivestats.operators.trips import bucket_samples, with_bucket_keys
from drivestats.plans.grains import Grain

TRACE_ORDER = ("ct", "ts", "latitude", "longitude", "sp")
TRACE_COLUMNS = ("ct", "ts", "latitude", "longitude", "sp")


def trace_points(positions: DataFrame, grain: Grain, strategy: str = "blocks") -> DataFrame:
    """Trip keys, ``seq`` and the sample columns, one row per sample of a complete bucket."""
    keys = list(grain.bucket_keys)
    samples = bucket_samples(positions, grain).select(*keys, *TRACE_COLUMNS)
    if strategy == "blocks":
        out = _by_blocks(samples, keys)
    else:
        shuffled = shuffle_for_pairs(samples, keys, TRACE_ORDER, strategy)
        out = _by_window(shuffled, keys) if strategy == "window" else _by_sorted_slices(shuffled, keys)
    return with_bucket_keys(out, grain).select(*grain.trip_keys, "seq", *TRACE_COLUMNS)


def _by_blocks(samples: DataFrame, keys: list[str]) -> DataFrame:
    width = [n] if (n := shuffle_width(samples)) else []
    shuffled = in_blocks(samples, keys, TRACE_ORDER, cut="_cut").repartition(*width, *keys, "_block")
    blocks = [*keys, "_block"]
    rows = shuffled.selectExpr("*", f"row_number() {over(blocks, TRACE_ORDER)} AS _pos")
    # From the same shuffle: a row's block is not worked out twice.
    sizes = shuffled.where("_cut").groupBy(*blocks).count()
    earlier = over(keys, ["_block"]).removesuffix(")") + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = sizes.selectExpr(*renamed_keys(blocks), f"sum(count) {earlier} AS _offset")
    return rows.join(F.broadcast(offsets), same_key(blocks), "left").selectExpr(*[f"`{c}`" for c in [*keys, *TRACE_COLUMNS]], "coalesce(_offset, 0L) + _pos AS seq")


def _by_window(shuffled: DataFrame, keys: list[str]) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in TRACE_ORDER]
    return shuffled.withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def _by_sorted_slices(shuffled: DataFrame, keys: list[str]) -> DataFrame:
    sort_key = [F.col(c).asc_nulls_first() for c in [*keys, *TRACE_ORDER]]
    ranged = shuffled.sortWithinPartitions(*sort_key).withColumn("_slice", F.spark_partition_id())
    added = [StructField("_pos", LongType()), StructField("_head", BooleanType()), StructField("_edge", BooleanType())]
    rows = ranged.mapInArrow(_slice_scan.slice_positions(keys), StructType([*ranged.schema.fields, *added]))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.where("_edge")
        .select("_slice", "_head", F.sum("_pos").over(earlier).alias("_offset"))
        .where("_head AND _offset IS NOT NULL")
        .select("_slice", "_offset")
    )
    start = F.when(F.col("_head"), F.coalesce(F.col("_offset"), F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    return rows.join(F.broadcast(offsets), "_slice", "left").select(
        *keys, *TRACE_COLUMNS, (start + F.col("_pos")).alias("seq")
    )
