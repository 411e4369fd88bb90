"""Arrow helpers run inside ``mapInArrow`` on one range-partitioned, sorted slice.

``slice_neighbours`` adds the previous row's carried values when the previous
row in the slice belongs to the same group, plus two flags: ``_first`` (first
row of its group in this slice) and ``_last`` (last row of its group in this
slice). ``slice_positions`` adds each row's position in its group inside the
slice. Both are vectorised over Arrow batches and keep one row of state between
batches; nothing here aggregates or holds a group in memory.

This module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Null-safe element-wise equality as a numpy bool array."""
    eq = pc.fill_null(pc.equal(a, b), False)
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    return pc.or_(eq, both_null).to_numpy(zero_copy_only=False)


def _continues(tail: pa.RecordBatch | None, batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Per row, whether the row before it (``tail`` for the first) is of the same group."""
    n = batch.num_rows
    same = np.ones(n, dtype=bool)
    same[0] = tail is not None and all(bool(_same(tail.column(k), batch.column(k).slice(0, 1))[0]) for k in keys)
    for k in keys if n > 1 else ():
        col = batch.column(k)
        same[1:] &= _same(col.slice(1), col.slice(0, n - 1))
    return same


def slice_positions(keys: Sequence[str]):
    """Build the ``mapInArrow`` function that numbers the rows of each group inside a slice.

    Adds ``_pos`` (1-based), ``_head`` (the row is of the slice's first group,
    the only one that an earlier slice may have begun) and ``_edge`` (the last
    row in this slice of its first or its last group).
    """
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.RecordBatch | None = None
        held: tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray] | None = None

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            same = _continues(tail, batch, keys)
            rows = np.arange(n, dtype=np.int64)
            # Index of the row at which each row's group begins; -1: before this batch.
            begin = np.maximum.accumulate(np.where(same, -1, rows))
            before = int(held[1][-1]) if held is not None else 0
            pos = np.where(begin < 0, rows + 1 + before, rows - begin + 1)
            head = (begin < 0) & held[2][-1] if held is not None else begin == 0
            edge = np.zeros(n, dtype=bool)
            edge[:-1] = head[:-1] & ~same[1:]
            if held is not None:
                held[3][-1] = held[2][-1] and not same[0]
                yield _numbered(*held)
            held = (batch, pos, head, edge)
            tail = batch.slice(n - 1, 1)

        if held is not None:
            held[3][-1] = True
            yield _numbered(*held)

    return run


def _numbered(batch: pa.RecordBatch, pos: np.ndarray, head: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
    arrays = list(batch.columns) + [pa.array(pos), pa.array(head), pa.array(edge)]
    return pa.RecordBatch.from_arrays(arrays, names=list(batch.schema.names) + ["_pos", "_head", "_edge"])


def slice_neighbours(keys: Sequence[str], carry: Sequence[str]):
    """Build the ``mapInArrow`` function for the given group keys and carried columns."""
    keys = list(keys)
    carry = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.RecordBatch | None = None  # last row seen, 1-row batch
        held: tuple[pa.RecordBatch, list[pa.Array], np.ndarray, np.ndarray] | None = None

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            same = _continues(tail, batch, keys)

            if held is not None:
                # The held batch's final row is last in its group unless this
                # batch continues the group.
                held[3][-1] = not same[0]
                yield _emit(*held, carry)

            mask = pa.array(same)
            prevs = []
            for c in carry:
                col = batch.column(c)
                before = tail.column(c) if tail is not None else pa.nulls(1, col.type)
                shifted = pa.concat_arrays([before, col.slice(0, n - 1)])
                prevs.append(pc.if_else(mask, shifted, pa.scalar(None, col.type)))
            first = ~same
            last = np.empty(n, dtype=bool)
            last[:-1] = ~same[1:]
            last[-1] = True
            held = (batch, prevs, first, last)
            tail = batch.slice(n - 1, 1)

        if held is not None:
            yield _emit(*held, carry)

    return run


def _emit(
    batch: pa.RecordBatch, prevs: list[pa.Array], first: np.ndarray, last: np.ndarray, carry: Sequence[str]
) -> pa.RecordBatch:
    arrays = list(batch.columns) + prevs + [pa.array(first), pa.array(last)]
    names = list(batch.schema.names) + [f"prev_{c}" for c in carry] + ["_first", "_last"]
    return pa.RecordBatch.from_arrays(arrays, names=names)
