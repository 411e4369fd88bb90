"""Best-fit packing by a configuration linear program over the length histogram (operator 10).

Documents become token ids and an end id; only those longer than a sequence
are cut, into full pieces after a first piece that may be shorter. Full pieces
fill a sequence each. For the others the histogram of lengths is all that
matters: a configuration is a multiset of lengths that fits a sequence, and
the linear program asks for the fewest configurations that cover the
histogram. Multiplicative weights solve it: each step prices lengths by how
little they are covered so far, finds the best configuration by a knapsack
dynamic program, and uses it. The fractional solution is rounded down, once
all of it and once only its full configurations; what is left is packed by
filling one sequence after another, from the longest length left, as exactly
as a subset-sum program over all copies can, and the shorter plan is taken.

The histogram has at most ``capacity`` entries at any size of the input; it
and the plan (configurations and how often each is used) are all that the
driver sees. Pieces get their place from their rank among the pieces of their
length.

Defined cases: null texts are empty and give one piece with the end id; every
row is packed, repeated rows and null ids too; an empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drivestats.llm.common import BATCH_ROWS, map_arrow, written
from drivestats.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
Plan = list[tuple[dict[int, int], int]]


def _best_configuration(value: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths of the highest value that fits (unbounded knapsack); value[l] is that of length l."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    back = value[1:]
    for c in range(1, capacity + 1):
        total = best[c - 1 :: -1][:c] + back[:c]
        i = int(total.argmax())
        if total[i] > best[c - 1]:
            best[c], took[c] = total[i], i + 1
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if took[c]:
            out[int(took[c])] = out.get(int(took[c]), 0) + 1
            c -= int(took[c])
        else:
            c -= 1
    return out


def solve_configurations(demand: np.ndarray, capacity: int, epsilon: float = 0.3, steps: int = 1200) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often to use each: a fractional cover of ``demand`` (by length) by multiplicative weights.

    Prices start in proportion to length, the optimal dual where sequences can
    be filled to the last token. A step uses the best configuration until one
    of its lengths gains a full demand's worth; a length's price falls by
    (1 - epsilon) to the share gained. ``steps`` bounds the work on the
    driver; rounding repairs whatever the solution still lacks.
    """
    lengths = np.flatnonzero(demand)
    if not len(lengths):
        return []
    covered = np.zeros(capacity + 1)
    times: dict[tuple, float] = {}
    log_price = np.zeros(capacity + 1)
    for _ in range(steps):
        price = np.full(capacity + 1, -1.0)
        price[lengths] = np.exp(log_price[lengths] - log_price[lengths].max()) * lengths / capacity
        config = _best_configuration(np.maximum(price, 0.0) + np.where(demand > 0, 0.0, -1.0), capacity)
        step = min(demand[l] / a for l, a in config.items()) * 0.25
        key = tuple(sorted(config.items(), reverse=True))
        times[key] = times.get(key, 0.0) + step
        for l, a in config.items():
            gain = a * step / demand[l]
            covered[l] += gain
            log_price[l] += gain * np.log1p(-epsilon)
    # A scale at which the cover meets demand on average; lengths above or below it are left to rounding.
    scale = float((covered[lengths] * demand[lengths] * lengths).sum() / (demand[lengths] * lengths).sum())
    return [(dict(k), x / scale) for k, x in times.items()]


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest length left and, with it, others that fill the sequence as far as they can."""
    lengths = np.flatnonzero(left)[::-1].tolist()
    first = lengths[0]
    room = capacity - first
    # As many copies as fit, by binary splitting: 1, 2, 4, ... and what remains.
    items: list[tuple[int, int]] = []
    for l in lengths:
        copies, part = min(int(left[l]) - (l == first), room // l), 1
        while copies > 0:
            items.append((l, min(part, copies)))
            copies -= part
            part *= 2
    mask = (1 << (room + 1)) - 1
    reach = [1]
    for l, n in items:
        reach.append((reach[-1] | reach[-1] << l * n) & mask)
        if reach[-1] >> room:
            break
    at = reach[-1].bit_length() - 1
    out = {first: 1}
    for i in range(len(reach) - 1, 0, -1):
        if not reach[i - 1] >> at & 1:
            l, n = items[i - 1]
            out[l] = out.get(l, 0) + n
            at -= l * n
    return out


def pack_histogram(demand: dict[int, int], capacity: int, **solver) -> Plan:
    """Configurations and whole numbers of times that pack exactly ``demand`` (length to count)."""
    # The fullest configurations first: those in excess of demand are the least useful.
    counts = np.zeros(capacity + 1, np.int64)
    for l, n in demand.items():
        counts[l] = n
    solution = sorted(solve_configurations(counts.astype(float), capacity, **solver), key=lambda c: -sum(l * a for l, a in c[0].items()))
    exact = [c for c in solution if sum(l * a for l, a in c[0].items()) == capacity]
    # Configurations with room to spare are all that some lengths allow, and a loss where filling finds better ones.
    return min((_rounded(chosen, counts, capacity) for chosen in (exact, solution)), key=lambda plan: sum(times for _, times in plan))


def _rounded(solution: list[tuple[dict[int, int], float]], counts: np.ndarray, capacity: int) -> Plan:
    """The whole times of each configuration of ``solution``, as far as ``counts`` go, and fillings of what is left."""
    left = counts.copy()
    plan: Plan = []

    def use(config: dict[int, int], times: int) -> None:
        times = min([times, *(int(left[l]) // a for l, a in config.items())])
        if times > 0:
            plan.append((config, times))
            for l, a in config.items():
                left[l] -= a * times

    for config, times in solution:
        use(config, int(times))
    while left.any():
        config = _fill(left, capacity)
        # Alike sequences at once while much is left; one by one towards the end.
        use(config, max(1, int(min(left[l] // a for l, a in config.items()) * 0.5)))
    return plan


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def cut(batches):
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            out: list[list] = [[] for _ in range(6)]
            for doc_id, ids in zip(doc_ids, enc.encode(texts)):
                raw = np.append(ids, enc.dtype(end_id)).astype("<u4")
                n = len(raw)
                start, end, piece = 0, (n % capacity or capacity) if n > capacity else n, 0
                while start < n:
                    length = end - start
                    for column, v in zip(out, (doc_id, piece, start, length, zlib.crc32(raw[start:end].tobytes()), int(seen[length]))):
                        column.append(v)
                    seen[length] += 1
                    start, end, piece = end, end + capacity, piece + 1
            doc, piece_, start_, length_, crc, rank = out
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece_, pa.int32()), pa.array(start_, pa.int64()), pa.array(length_, pa.int64()),
                 pa.array(crc, pa.int64()), pa.array([part] * len(doc), pa.int32()), pa.array(rank, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    return cut


def _placer(plan: Plan, capacity: int, full: int):
    """Maps (length, rank among that length) to (sequence, offset)."""
    first_rank: dict[int, list[int]] = {}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = full
    for config, times in plan:
        offset = 0
        for l in sorted(config, reverse=True):
            first_rank.setdefault(l, []).append(used.get(l, 0))
            slots.setdefault(l, []).append((sequence, offset, config[l]))
            used[l] = used.get(l, 0) + config[l] * times
            offset += l * config[l]
        sequence += times
    ranks = {l: np.array(r, np.int64) for l, r in first_rank.items()}
    table = {l: np.array(s, np.int64) for l, s in slots.items()}

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = rank.copy(), np.zeros(len(rank), np.int64)
            for l in np.unique(length[length < capacity]).tolist():
                at = np.flatnonzero(length == l)
                i = np.searchsorted(ranks[l], rank[at], side="right") - 1
                first, offset, a = table[l][i].T
                within = rank[at] - ranks[l][i]
                seq[at] = first + within // a
                off[at] = offset + within % a * l
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, **solver) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text) with its sequence and its offset there."""
    cut = map_arrow(docs.select("doc_id", "text"), _pieces(tokenizer, end_id, capacity), PIECES)
    pieces = written(cut, "pieces", batch_rows=BATCH_ROWS)
    counts = pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first")).drop("first", "part")
    return map_arrow(ranked, _placer(pack_histogram(histogram, capacity, **solver), capacity, full), PACKED)
