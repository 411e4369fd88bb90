"""Deletion of repeated runs of lines by digests of windows of whole lines (operator 8).

Lines are compared with white space collapsed; lines without a word are passed
over. A run of lines counts when it has at least ``min_words`` words. Windows
are the shortest spans of whole lines with that many words that start, or end,
at a line. All of them are joined by the digest of the whole window, and by
the smallest line hash in it, which adds nothing to the digest; none is
selected or extended. The first place (by doc_id, then place) stays and the
lines of later ones go, also where a later window overlaps the first one in a
run that repeats itself. Windows from both directions together cover every
line of a repeated run, so runs of any length go whole.

Joins are on fingerprint and window: each place is compared with the first
one of its window only, so a run in very many documents costs one row each.

Defined cases: null texts stay null; a text that loses all lines becomes empty;
rows repeated with the same doc_id and text are one document and lose the same
lines; null ids come before all others; an empty table stays empty. Columns
other than doc_id and text are handed through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import map_arrow

MIN_WORDS = 50
WINDOWS = "doc_id long, text_hash long, first_line int, last_line int, fingerprint long, window binary"


def line_windows(words: np.ndarray, min_words: int) -> np.ndarray:
    """(first, last) of the shortest spans with ``min_words`` words that start or end at each place."""
    n, upto = len(words), np.concatenate(([0], np.cumsum(words)))
    last = np.searchsorted(upto, upto[:-1] + min_words) - 1  # forward: first..last
    first = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1  # backward
    place = np.arange(n)
    spans = np.concatenate([np.stack([place, last], 1)[last < n], np.stack([first, place], 1)[first >= 0]])
    return np.unique(spans, axis=0)


def _window_rows(min_words: int):
    def make(batches):
        import xxhash

        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text_hash, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                at, digests, words = [], [], []
                for i, line in enumerate((text or "").split("\n")):
                    if own := line.split():
                        at.append(i)
                        digests.append(xxhash.xxh3_128_digest(" ".join(own).encode("utf-8", "surrogatepass")))
                        words.append(len(own))
                if sum(words) < min_words:
                    continue
                fingerprint = np.frombuffer(b"".join(digests), "<i8")[::2]
                for first, last in line_windows(np.array(words, np.int64), min_words).tolist():
                    values = (
                        doc_id, text_hash, at[first], at[last], int(fingerprint[first : last + 1].min()),
                        digests[first] if first == last else xxhash.xxh3_128_digest(b"".join(digests[first : last + 1])),
                    )
                    for column, v in zip(out, values):
                        column.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "text_hash", "first_line", "last_line", "fingerprint", "window"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return make


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, first_line, last_line) of spans of lines that occur earlier; spans of one run overlap."""
    windows = map_arrow(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text"), _window_rows(min_words), WINDOWS)
    place = F.struct("doc_id", "text_hash", "first_line")
    firsts = windows.groupBy("fingerprint", "window").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    later = windows.join(firsts, ["fingerprint", "window"]).where(place > F.col("first"))
    return later.select("doc_id", "text_hash", "first_line", "last_line")


def _without_lines(names: list[str], text_at: int):
    def rewrite(batches):
        for b in batches:
            texts, runs = b.column(text_at).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            deleted = np.zeros(len(texts), np.int64)
            for i, own in enumerate(runs):
                if own:
                    lines = texts[i].split("\n")
                    gone = np.zeros(len(lines) + 1, np.int64)
                    for r in own:
                        gone[r["first_line"]] += 1
                        gone[r["last_line"] + 1] -= 1
                    gone = np.cumsum(gone)[:-1] > 0
                    texts[i] = "\n".join(line for line, g in zip(lines, gone.tolist()) if not g)
                    deleted[i] = gone.sum()
            columns = [b.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, b.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(deleted)], [*names, "__lines_deleted"])

    return rewrite


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, deleted: str | None = None) -> DataFrame:
    """``docs`` with the lines of later repeated runs gone from text; ``deleted`` names a column for their number."""
    runs = repeated_runs(docs, min_words).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first_line", "last_line")).alias("__runs"))
    runs = runs.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__runs")
    joined = docs.join(runs, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")), "left").drop("__id", "__hash")
    schema = docs.select(*docs.columns, F.lit(0).cast("long").alias("__lines_deleted")).schema
    out = map_arrow(joined, _without_lines(docs.columns, docs.columns.index("text")), schema)
    return out.withColumnRenamed("__lines_deleted", deleted) if deleted else out.drop("__lines_deleted")


ORACLE = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM documents),
w AS (SELECT *, regexp_extract_all(line, '[^\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+') AS ws FROM l),
s AS (SELECT doc_id, p, array_to_string(ws, ' ') AS norm, len(ws) AS n, row_number() OVER d AS k, sum(len(ws)) OVER d AS upto
      FROM w WHERE len(ws) > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
pair AS (SELECT a.doc_id, a.k AS i, b.k AS j FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n >= {MIN_WORDS}),
win AS (SELECT doc_id, i, min(j) AS j FROM pair GROUP BY doc_id, i UNION SELECT doc_id, max(i) AS i, j FROM pair GROUP BY doc_id, j),
keyed AS (SELECT win.doc_id, i, j, string_agg(norm, chr(10) ORDER BY k) AS key, min(p) AS p0, max(p) AS p1
          FROM win JOIN s ON win.doc_id = s.doc_id AND s.k BETWEEN i AND j GROUP BY ALL),
later AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, p0) > 1),
gone AS (SELECT DISTINCT l.doc_id, l.p FROM l JOIN later ON l.doc_id = later.doc_id AND l.p BETWEEN p0 AND p1),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.p) FILTER (gone.p IS NULL) AS text, count(gone.p) AS n FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.p = gone.p GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, coalesce(kept.n, 0) AS n_deleted_lines
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
