"""Benchmark decontamination by winnowing (operator 5).

Fingerprints are the smallest hash among each window of ``window - k + 1``
consecutive k-grams, so any run of ``window`` shared words holds a fingerprint
that both sides select. Fingerprints of documents are joined with those of
the benchmark and each match is extended both ways over the words around it;
what counts is a whole window of ``window`` equal words. An item of fewer
words is one window; it is looked for by the hash of all its words.

Before the join, document fingerprints pass a bitmap of the benchmark's, of a
fixed number of bits whatever the benchmark's size. It only spares rows that
cannot match.

Defined cases: null texts have no words and are never hit; items without a
word occur nowhere; null item ids mark words as hit but are not counted as
items; repeated rows are each reported; an empty benchmark hits nothing.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import map_arrow, text_chunks
from drivestats.llm.textvec import kgrams, mix64, word_hashes

WINDOW, K = 10, 5
#: Words kept on each side of a fingerprint for extending a match.
SIDE = WINDOW - K
BITS = 22
CHUNK_CHARS = 1_000_000
FOUND = "row long, doc_id long, n_words long, kind int, fp long, pos long, around array<bigint>"
ITEMS = "kind int, fp long, item_id long, item_around array<bigint>"


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest (rightmost of equals) of every ``width`` consecutive hashes."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(np.arange(len(windows)) + width - 1 - windows[:, ::-1].argmin(axis=1))


def _slot(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - BITS)).astype(np.int64)


def _short(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, apart from those of fingerprints."""
    return mix64(kgrams(h, n) + np.uint64(n))


def _around(h: np.ndarray, at: int, kind: int, first: int, end: int) -> list:
    """The words by which a match is extended; null outside the text."""
    if kind < WINDOW:
        return h[at : at + kind].view(np.int64).tolist()
    lo, hi = at - SIDE, at + WINDOW
    own = h[max(lo, first) : min(hi, end)].view(np.int64).tolist()
    return [None] * max(0, first - lo) + own + [None] * max(0, hi - end)


def _item_rows(batches):
    for b in batches:
        ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
        h, bounds = word_hashes(texts)
        rows = []
        for item, a, z in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist()):
            own = h[a:z]
            if 0 < z - a < WINDOW:
                rows.append((z - a, int(_short(own, z - a).view(np.int64)[0]), item, own.view(np.int64).tolist()))
            elif z > a:
                grams = kgrams(own, K)
                for at in winnow(grams, WINDOW - K + 1).tolist():
                    rows.append((WINDOW, int(grams[at : at + 1].view(np.int64)[0]), item, _around(own, at, WINDOW, 0, z - a)))
        kind, fp, item, around = map(list, zip(*rows)) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(fp, pa.int64()), pa.array(item, pa.int64()), pa.array(around, pa.list_(pa.int64()))],
            ["kind", "fp", "item_id", "item_around"],
        )


def _document_rows(bitmap, short_lengths: list[int]):
    def find(batches):
        seen = np.unpackbits(np.frombuffer(bitmap.value, np.uint8)).view(bool)
        for b in batches:
            row_ids, doc_ids, texts = (b.column(i).to_pylist() for i in range(3))
            texts = [t or "" for t in texts]
            for first, chunk in text_chunks(texts, CHUNK_CHARS):
                h, bounds = word_hashes(chunk)
                found = []  # (text, kind, fp, place in h)
                for kind in [WINDOW, *short_lengths]:
                    grams = kgrams(h, K) if kind == WINDOW else _short(h, kind)
                    at = winnow(grams, WINDOW - K + 1) if kind == WINDOW else np.arange(len(grams))
                    at = at[seen[_slot(grams[at])]]
                    text = np.searchsorted(bounds, at, side="right") - 1
                    whole = at + (K if kind == WINDOW else kind) <= bounds[text + 1]
                    found += zip(text[whole].tolist(), [kind] * int(whole.sum()), grams[at[whole]].view(np.int64).tolist(), at[whole].tolist())
                none = np.setdiff1d(np.arange(len(chunk)), [f[0] for f in found]).tolist()
                out: list[list] = [[] for _ in range(7)]
                for i, kind, fp, at in [*found, *((i, 0, row_ids[first + i], 0) for i in none)]:
                    a, z = int(bounds[i]), int(bounds[i + 1])
                    values = (row_ids[first + i], doc_ids[first + i], z - a, kind, fp, at - a, _around(h, at, kind, a, z) if kind else None)
                    for column, v in zip(out, values):
                        column.append(v)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["row", "doc_id", "n_words", "kind", "fp", "pos", "around"])

    return find


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, hits (struct of start and length, in words) and items (ids) of the windows found in it."""
    spark = docs.sparkSession
    items = map_arrow(benchmark.select(F.col("item_id").cast("long"), "text"), _item_rows, ITEMS).distinct()
    # Bounded by the bitmap, not by the benchmark.
    slots = items.select(F.shiftrightunsigned("fp", 64 - BITS).alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)
    marks = np.zeros(1 << BITS, bool)
    marks[slots] = True
    short_lengths = sorted(r[0] for r in items.where(F.col("kind") < WINDOW).select("kind").distinct().collect())
    bitmap = spark.sparkContext.broadcast(np.packbits(marks).tobytes())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    found = map_arrow(rows, _document_rows(bitmap, short_lengths), FOUND)
    joined = found.join(items, ["kind", "fp"], "left")
    equal = F.zip_with("around", "item_around", lambda a, b: F.coalesce(a == b, F.lit(False)))
    joined = joined.select("row", "doc_id", "n_words", "kind", "pos", "item_id", equal.alias("equal"))
    # A window of equal words around the match that starts `before` words ahead of it.
    starts = F.expr(
        f"""CASE WHEN equal IS NULL THEN array()
                 WHEN kind < {WINDOW} THEN IF(forall(equal, e -> e), array(pos), array())
                 ELSE filter(transform(sequence(0, {SIDE}), before -> IF(forall(slice(equal, {SIDE} + 1 - before, {WINDOW}), e -> e), pos - before, -1L)), s -> s >= 0) END"""
    )
    windows = joined.withColumn("starts", starts).withColumn("item_id", F.expr("IF(size(starts) > 0, item_id, NULL)"))
    hits = F.expr(f"transform(starts, s -> struct(s AS start, CAST(least(kind, {WINDOW}) AS bigint) AS length))")
    return windows.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(hits)))).alias("hits"), F.collect_set("item_id").alias("items")
    ).drop("row")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest per document: how many words are hit, by how many items, and which."""
    covered = F.expr(
        """aggregate(hits, struct(0L AS n, 0L AS upto),
             (acc, h) -> struct(acc.n + greatest(0L, h.start + h.length - greatest(acc.upto, h.start)) AS n, greatest(acc.upto, h.start + h.length) AS upto)).n"""
    )
    return overlaps(docs, benchmark).select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.expr("transform(items, i -> CAST(i AS string))"))), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, unnest([array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') FOR i IN range(1, greatest(len(w) - {WINDOW}, 0) + 2)]) AS key FROM b WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_windows),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
hit AS (SELECT r, i, p.n, item_id FROM places p JOIN item_windows x ON p.n = x.n AND x.key = array_to_string(w[i:i + p.n - 1], ' ')),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY r),
word_hits AS (SELECT r, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT r, i, n FROM hit)),
words AS (SELECT r, count(DISTINCT word) AS n_hit FROM word_hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (r) LEFT JOIN words USING (r)
"""


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window was found; id and text name a row."""
    row = F.xxhash64(docs["doc_id"], docs["text"])
    hit = overlaps(docs.select(row.alias("doc_id"), "text"), benchmark).where(F.size("hits") > 0).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, row == F.col("__hit"), "left_anti")
