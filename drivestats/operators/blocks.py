"""Ordered blocks: groups of very many rows cut into consecutive parts, in the JVM.

``in_blocks`` numbers the rows' blocks so that hashing by (group, block) never
puts a large group into one task. A group of at most ``blockRows`` rows is one
block. Larger ones are found by a count per group (partial aggregation, the key
columns only) and cut at every eighth of a thin sample of their own order
tuples, one cut per ``blockRows`` rows or so. The cuts only balance: whichever
they are, block numbers follow the order, so a row's predecessor is in its own
block or ends an earlier one. Rows equal to several cuts may be in any block
between them, in which their values are the same; they are dealt by input
split, so that a repeated row does not make a block of its own.

What is broadcast is one row a large group, with one cut per ``blockRows`` rows,
and nothing where there are none: the adaptive plan then drops the join and its inputs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONF_BLOCK_ROWS = "spark.drivestats.blockRows"
DEFAULT_BLOCK_ROWS = 1_000_000
#: Sampled rows per cut.
PER_CUT = 8


def block_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CONF_BLOCK_ROWS, None) or DEFAULT_BLOCK_ROWS)


def same_key(keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with their renamed copies (``_k_...``)."""
    return F.expr(" AND ".join(f"`{k}` <=> `_k_{k}`" for k in keys))


def renamed_keys(keys: Sequence[str]) -> list[str]:
    return [f"`{k}` AS `_k_{k}`" for k in keys]


def rows_of_large_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose group has more than ``blockRows`` of them."""
    keys = list(keys)
    large = df.groupBy(*keys).count().where(f"count > {block_rows(df)}").selectExpr(*renamed_keys(keys))
    return df.join(F.broadcast(large), same_key(keys), "left_semi")  # at most rows / blockRows groups


def _cuts(large: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, distinct: Mapping[str, str]) -> DataFrame:
    """Per large group, its cuts in chunks of about the square root of their number, and its distinct counts."""
    marked = large.withColumn("_pick", F.rand(17) < PER_CUT / n)
    tuples = f"sort_array(collect_list(IF(_pick, {_tuple(order)}, NULL)))"
    whole = [f"_whole_{name}" for name in distinct]
    counted = [F.expr(f"count(DISTINCT `{c}`) AS `_whole_{name}`") for name, c in distinct.items()]
    cuts = marked.groupBy(*keys).agg(F.expr(f"filter({tuples}, (x, i) -> i % {PER_CUT} = {PER_CUT - 1}) AS _s"), *counted)
    cuts = cuts.selectExpr(*renamed_keys(keys), *whole, "_s", "CAST(greatest(ceil(sqrt(size(_s))), 1) AS INT) AS _wide")
    chunks = "IF(size(_s) = 0, array(), transform(sequence(0, greatest(size(_s) - 1, 0) div _wide), i -> slice(_s, CAST(i AS INT) * _wide + 1, _wide)))"
    cuts = cuts.selectExpr(*[f"`_k_{k}`" for k in keys], *whole, "_wide", f"{chunks} AS _chunks")
    return cuts.selectExpr("*", "transform(_chunks, c -> c[0]) AS _heads")


def _tuple(order: Sequence[str]) -> str:
    return f"struct({', '.join(f'`{c}`' for c in order)})"


def in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], distinct: Mapping[str, str] | None = None, cut: str | None = None) -> DataFrame:
    """``df`` with ``_block``: 0 in groups that stay whole, else ascending with ``order``.

    ``distinct`` maps names to columns whose distinct values are counted in the
    large groups, where blocks can't add them up: ``_whole_<name>``, null in
    the other groups. ``cut`` names a flag for rows of large groups.
    """
    keys, order, n, distinct = list(keys), list(order), block_rows(df), dict(distinct or {})
    large = rows_of_large_groups(df.select(*dict.fromkeys([*keys, *order, *distinct.values()])), keys)
    joined = df.join(F.broadcast(_cuts(large, keys, order, n, distinct)), same_key(keys), "left")
    row = _tuple(order)

    def cuts_before(op: str) -> str:
        heads = f"size(filter(_heads, h -> h {op} {row}))"
        return f"IF({heads} = 0, 0, ({heads} - 1) * _wide + size(filter(element_at(_chunks, greatest({heads}, 1)), x -> x {op} {row})))"

    low, high = cuts_before("<"), cuts_before("<=")
    block = f"CAST(IF(_wide IS NULL OR size(_heads) = 0, 0, {low} + pmod(xxhash64(spark_partition_id()), {high} - {low} + 1)) AS INT)"
    return joined.selectExpr(*[f"`{c}`" for c in df.columns], *[f"`_whole_{name}`" for name in distinct], *([f"_wide IS NOT NULL AS `{cut}`"] if cut else []), f"{block} AS _block")
