"""Sums of per-pair measures over consecutive rows of each group, in a given order.

This is the operator behind trip distance and speed events: every sample is
paired with its predecessor in ``order`` inside its group (trip bucket), a
measure is evaluated per pair, and the measures are summed per group.

``blocks`` (default, one plan at every size)
    Rows are hashed by (group, block); a block is a whole group, or a
    consecutive part of one with very many rows (``operators/blocks.py``). The
    predecessor is a ``lag`` inside the block, and sums, counts and the block's
    first and last values come from the same partitioning with no further
    exchange. A group cut into blocks loses only the pair across each edge; a
    window over the per-block rows restores it. All of it runs in the JVM: one
    shuffle of the rows, no Python worker, no range sampling.

``sorted`` (by name)
    ``repartitionByRange(keys + order)`` samples the full sort key, so a hot
    group (one trip bucket holding a third of all rows, a default trip id, a
    repeated counter) is cut into many contiguous slices on many tasks. Each
    sorted slice is scanned once by a vectorised Arrow helper that adds the
    predecessor's values and marks the first/last row of every group in the
    slice; only the keys and the carried columns cross to it. Pair measures run
    as Catalyst expressions and are summed per (group, slice) together with the
    group's first and last values in that slice (plain declarative aggregates,
    hash-aggregated map-side). A group spanning slices loses only the pair
    across each slice edge; a window over the per-slice rows, ordered by slice,
    restores it. That window holds one row per slice of a group, so its size is
    bounded by the shuffle partition count whatever the data. One shuffle of
    the sample rows (the range exchange); everything after it moves per-slice
    rows only.

``window`` (only where the caller asks for it)
    ``lag`` over ``Window.partitionBy(keys).orderBy(order)`` on rows
    hash-partitioned by the keys: one shuffle and no Python, but a whole group
    is sorted in one task, so it needs a caller who knows that every group is
    small.

All give the same results to the last digit: measures are whole numbers, so
their sums do not depend on the order of addition, on slice edges or on retries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from drivestats.functions.motion import Measure
from drivestats.operators import _slice_scan
from drivestats.operators.blocks import in_blocks

# Executors get the helper by value: no need to ship the package to run it.
cloudpickle.register_pickle_by_value(_slice_scan)

STRATEGIES = ("blocks", "sorted", "window")

# Session settings: the width of the shuffle itself, or the input bytes one of its tasks gets.
# A sample of some 20 bytes in a file is about 1,000 in the sorts and the hash table of a task.
CONF_PARTITIONS = "spark.drivestats.pairPartitions"
CONF_BYTES_PER_TASK = "spark.drivestats.bytesPerTask"
DEFAULT_BYTES_PER_TASK = 2 * 1024 * 1024


def shuffle_width(df: DataFrame) -> int | None:
    """Partitions of the sample shuffle; None leaves it to the session and adaptive coalescing.

    ``spark.drivestats.pairPartitions`` if set. Else the input size that the
    planner knows (file sizes, no job) over ``spark.drivestats.bytesPerTask``,
    where that is more than the tasks that run at once. A given width is not
    coalesced: the shuffled bytes that adaptive coalescing goes by are a small
    part of what a task holds of them.
    """
    conf = df.sparkSession.conf
    fixed = conf.get(CONF_PARTITIONS, None)
    if fixed:
        return int(fixed)
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    known = sum(size for size in sizes if size < unknown)
    needed = -(-known // int(conf.get(CONF_BYTES_PER_TASK, None) or DEFAULT_BYTES_PER_TASK))
    return needed if needed > df.sparkSession.sparkContext.defaultParallelism else None


def _row_measures(measures: Sequence[Measure], carry: Sequence[str]) -> list[Column]:
    prev, cur = {c: f"`prev_{c}`" for c in carry}, {c: f"`{c}`" for c in carry}
    return [F.expr(f"sum({m.fn(prev, cur)}) AS `_rows_{m.name}`") for m in measures]


def over(keys: Sequence[str], order: Sequence[str]) -> str:
    """Window text: rows of one group in ascending order, nulls first."""
    by = ", ".join(f"`{c}`" for c in order)
    return f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY {by})"


def shuffle_for_pairs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    strategy: str = "sorted",
    companions: Sequence[str] = (),
) -> DataFrame:
    """The one shuffle of the rows that ``ordered_pair_sums`` performs by slices or windows.

    Exposed so that other aggregates over the same rows can be planned on the
    same exchange: identical exchange subtrees are computed once (exchange
    reuse), so the source is scanned and shuffled once for all of them. For
    that every branch must need the same columns of it: ``companions``, which
    only some branches read, end the range key.
    """
    n = shuffle_width(df)
    width = [n] if n else []
    if strategy == "sorted":
        last = [c for c in companions if c not in keys and c not in order]
        return df.repartitionByRange(*width, *[F.col(c).asc_nulls_first() for c in [*keys, *order, *last]])
    if strategy == "window":
        return df.repartition(*width, *keys)
    raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")


def ordered_pair_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    measures: Sequence[Measure],
    strategy: str = "blocks",
    counts: Mapping[str, str] | None = None,
    distinct_counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per group: ``keys``, one column per measure, and the companions.

    ``counts`` / ``distinct_counts`` map an output name to a column whose
    non-null values (distinct values) are counted per group, from the same
    single shuffle of the rows:

    * blocks strategy: as the window strategy, per (group, block); counts add up
      over the blocks. Distinct counts of a group that was cut come from a
      distinct aggregate over the rows of such groups only.
    * sorted strategy: one companion aggregate over the reused range exchange
      (``group_counts``), merged with the pair sums by a union, which keeps
      null keys as groups.
    * window strategy: the rows are already hash-partitioned by the keys, and
      everything is computed on that partitioning with no further exchange of
      the rows. The first distinct count is a plain ``count(DISTINCT)``: a
      single distinct aggregate is planned as hash aggregation keyed by (keys,
      value), which the partitioning satisfies. Each further one is a sum of
      first-occurrence flags from a window partitioned by (keys, value).

    ``order`` is ascending with nulls first; ties on the whole order key carry
    identical values (``carry`` is part of it), so tie order cannot change any
    measure. A pair with a null input yields a null measure and adds nothing.
    Groups with no pair get 0.
    """
    keys, order, carry = list(keys), list(order), list(carry)
    counts, distinct_counts = dict(counts or {}), dict(distinct_counts or {})
    missing = [c for c in carry if c not in order]
    if missing:
        raise ValueError(f"carried columns must be part of the order key: {missing}")
    companions = [*distinct_counts.values(), *counts.values()]
    if strategy == "blocks":
        width = [n] if (n := shuffle_width(df)) else []
        placed = in_blocks(df, keys, order, distinct_counts).repartition(*width, *keys, "_block")
        return _by_blocks(placed, keys, order, carry, measures, counts, distinct_counts)
    shuffled = shuffle_for_pairs(df, keys, order, strategy, companions)
    if strategy == "window":
        return _by_window(shuffled, keys, order, carry, measures, counts, distinct_counts)
    out = _by_sorted_slices(shuffled, keys, order, carry, measures)
    if not counts and not distinct_counts:
        return out
    merged = out.unionByName(group_counts(shuffled, keys, counts, distinct_counts), allowMissingColumns=True)
    cols = [m.name for m in measures] + list(distinct_counts) + list(counts)
    return merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def group_counts(
    df: DataFrame, keys: Sequence[str], counts: Mapping[str, str], distinct_counts: Mapping[str, str]
) -> DataFrame:
    """Non-null and distinct counts per group, one row per group.

    One aggregate per distinct column, so no row is multiplied (a single
    distinct count is hash aggregation keyed by (keys, value), partial before
    the shuffle, which splits a hot group by its values); their results, a row
    per group each, are merged by a union, which keeps null keys as groups.
    """
    keys = list(keys)
    plain = [F.count(c).alias(n) for n, c in counts.items()]
    distinct = [F.count_distinct(c).alias(n) for n, c in distinct_counts.items()]
    parts = [df.groupBy(*keys).agg(*plain, *distinct[:1])] + [df.groupBy(*keys).agg(d) for d in distinct[1:]]
    if len(parts) == 1:
        return parts[0].select(*keys, *distinct_counts, *counts)
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    return merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in [*distinct_counts, *counts]])


def _measure_totals(measures: Sequence[Measure], parts: Sequence[str]) -> list[Column]:
    """Final measure columns: the sums of all ``parts`` (in-group or in-slice pairs, edge pairs)."""
    return [F.expr(" + ".join(f"coalesce(`{p}{m.name}`, 0L)" for p in parts) + f" AS `{m.name}`") for m in measures]


def _with_neighbours(shuffled, keys, order, carry, distinct_counts) -> tuple[DataFrame, list[Column]]:
    """Each row with its predecessor's values, and the distinct counts as aggregates over such rows.

    The rows are hash-partitioned by the keys (or some of them): the windows
    add local sorts only, no exchange. The first distinct count is a plain one,
    hash aggregation keyed by (keys, value); the others are sums of flags.
    """
    w = over(keys, order)
    columns = ["*", *[f"lag(`{c}`) {w} AS `prev_{c}`" for c in carry], f"row_number() {w} = 1 AS _first", f"lead(1) {w} IS NULL AS _last"]
    for name, c in list(distinct_counts.items())[1:]:
        columns.append(f"IF(row_number() {over([*keys, c], [c])} = 1 AND `{c}` IS NOT NULL, 1, 0) AS `_first_{name}`")
    distinct = [F.expr(f"count(DISTINCT `{c}`) AS `{n}`") for n, c in list(distinct_counts.items())[:1]]
    return shuffled.selectExpr(*columns), distinct + [F.expr(f"sum(`_first_{n}`) AS `{n}`") for n in list(distinct_counts)[1:]]


def _plain(counts: Mapping[str, str]) -> list[Column]:
    return [F.expr(f"count(`{c}`) AS `{n}`") for n, c in counts.items()]


def _by_window(shuffled, keys, order, carry, measures, counts, distinct_counts) -> DataFrame:
    rows, distinct = _with_neighbours(shuffled, keys, order, carry, distinct_counts)
    agg = rows.groupBy(*keys).agg(*_row_measures(measures, carry), *distinct, *_plain(counts))
    return agg.select(*keys, *_measure_totals(measures, ["_rows_"]), *distinct_counts, *counts)


def _by_blocks(shuffled, keys, order, carry, measures, counts, distinct_counts) -> DataFrame:
    rows, distinct = _with_neighbours(shuffled, [*keys, "_block"], order, carry, distinct_counts)
    whole = [F.expr(f"max(`_whole_{n}`) AS `_whole_{n}`") for n in distinct_counts]
    per_block = rows.groupBy(*keys, "_block").agg(*_row_measures(measures, carry), *_end_values(carry), *distinct, *whole, *_plain(counts))
    return _stitched(per_block, over(keys, ["_block"]), keys, carry, measures, counts, distinct_counts)


def stitched_in_blocks(parts: DataFrame, keys, order, carry, measures, counts) -> DataFrame:
    """``_stitched`` for groups that may have very many parts: those of a block first, then the blocks of a group."""
    width = [n] if (n := shuffle_width(parts)) else []
    placed = in_blocks(parts, keys, order).repartition(*width, *keys, "_block")
    w = over([*keys, "_block"], order)
    rows = placed.selectExpr("*", *[f"lag(`_tail_{c}`) {w} AS `_ptail_{c}`" for c in carry], f"row_number() {w} = 1 AS _first", f"lead(1) {w} IS NULL AS _last")
    prev, head = {c: f"`_ptail_{c}`" for c in carry}, {c: f"`_head_{c}`" for c in carry}
    per_block = rows.groupBy(*keys, "_block").agg(
        *[F.expr(f"coalesce(sum(`_rows_{m.name}`), 0L) + coalesce(sum({m.fn(prev, head)}), 0L) AS `_rows_{m.name}`") for m in measures],
        *[F.expr(f"max(IF(_first, `_head_{c}`, NULL)) AS `_head_{c}`") for c in carry],
        *[F.expr(f"max(IF(_last, `_tail_{c}`, NULL)) AS `_tail_{c}`") for c in carry],
        *[F.expr(f"sum(`{n}`) AS `{n}`") for n in counts],
    )
    return _stitched(per_block, over(keys, ["_block"]), keys, carry, measures, counts, {})


def _end_values(carry: Sequence[str]) -> list[Column]:
    """The carried values of the first and of the last row (one row each is flagged)."""
    ends = [F.expr(f"max(IF(_first, `{c}`, NULL)) AS `_head_{c}`") for c in carry]
    return ends + [F.expr(f"max(IF(_last, `{c}`, NULL)) AS `_tail_{c}`") for c in carry]


def _stitched(parts, w: str, keys, carry, measures, counts, distinct_counts) -> DataFrame:
    """Sums of the consecutive parts of each group, and of the pairs between one part's last row and the next one's first.

    The window holds one row per part of a group.
    """
    rows = parts.selectExpr("*", *[f"lag(`_tail_{c}`) {w} AS `_ptail_{c}`" for c in carry])
    prev, head = {c: f"`_ptail_{c}`" for c in carry}, {c: f"`_head_{c}`" for c in carry}
    out = rows.groupBy(*keys).agg(
        *[F.expr(f"sum(`_rows_{m.name}`) AS `_rows_{m.name}`") for m in measures],
        *[F.expr(f"sum({m.fn(prev, head)}) AS `_edge_{m.name}`") for m in measures],
        *[F.expr(f"coalesce(max(`_whole_{n}`), sum(`{n}`)) AS `{n}`") for n in distinct_counts],
        *[F.expr(f"sum(`{n}`) AS `{n}`") for n in counts],
    )
    return out.select(*keys, *_measure_totals(measures, ["_rows_", "_edge_"]), *distinct_counts, *counts)


def _by_sorted_slices(shuffled, keys, order, carry, measures) -> DataFrame:
    sort_key = [F.col(c).asc_nulls_first() for c in keys + order]
    ranged = shuffled.sortWithinPartitions(*sort_key).select(*keys, *carry, F.spark_partition_id().alias("_slice"))
    fields = list(ranged.schema.fields)
    by_name = {f.name: f for f in fields}
    out_schema = StructType(
        fields
        + [StructField(f"prev_{c}", by_name[c].dataType, True) for c in carry]
        + [StructField("_first", BooleanType(), False), StructField("_last", BooleanType(), False)]
    )
    rows = ranged.mapInArrow(_slice_scan.slice_neighbours(keys, carry), out_schema)

    # One row per (group, slice): in-slice pair sums plus the values of the
    # group's first and last row in that slice. Slices are consecutive in the
    # range order, at most the partition count of them.
    per_slice = rows.groupBy(*keys, "_slice").agg(*_row_measures(measures, carry), *_end_values(carry))
    return _stitched(per_slice, over(keys, ["_slice"]), keys, carry, measures, {}, {})
