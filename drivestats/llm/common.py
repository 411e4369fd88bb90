"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivestats.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that the JVM hands to a Python worker at once; both hold them outside the heap.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written_at(df: DataFrame, name: str, batch_rows: int | None = None) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared checkpoint folder and read back, and where that is.

    Cuts the lineage: what follows reads files that every executor can reach,
    so a lost executor costs no recomputation of what came before. Nothing
    reads the shuffles of the write again, so their files go with it.
    ``batch_rows`` is the number of rows that Python workers get at once.
    """
    spark = df.sparkSession
    settings = {SHUFFLE_CLEANUP: "true"} | ({ARROW_ROWS: str(batch_rows)} if batch_rows else {})
    path, before = work_path(spark, name), {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.select("*").write.parquet(path)  # a new frame: the settings hold for frames made under them
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``written_at`` without the path, for tables that stay until the folder is cleared."""
    return written_at(df, name, batch_rows)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written_at`` that nothing reads any more (a round's table, once the next one is written)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, by: list[Column], most: int, group: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """At most ``most`` rows of ``df`` (per value of ``group``), those with the smallest 64-bit hashes of ``by``, as a written table.

    Rows equal in ``by`` count once, so neither null ids nor a row that holds
    a third of the table can swell the sample. It is ``most`` rows at any size
    of ``df``, or all distinct ones where there are fewer: a bound on the hash
    that lets too few through is widened. ``counted`` may stand for ``df``
    where rows are counted, if that reads fewer columns; it may have more rows.
    The driver sees hashes of the sample only, and one row per group.
    """
    rows = df.withColumn("__hash", F.xxhash64(*by))
    of = F.col(group) if group else F.lit(0)
    counted = df if counted is None else counted
    sizes = {r[0]: r[1] for r in counted.groupBy(of.alias("of")).count().collect()}

    def below(bounds: dict) -> Column:
        # One pass for all groups; the bound of a group is the largest hash it takes.
        chosen = [(of.eqNullSafe(F.lit(g))) & (F.col("__hash") <= F.lit(b)) for g, b in bounds.items()]
        return F.reduce(F.array(*chosen), F.lit(False), lambda a, b: a | b) if chosen else F.lit(False)

    taken, widened, found = None, False, {g: set() for g in sizes}
    todo = {g: min(1.0, 2 * most / n) for g, n in sizes.items() if n}
    while todo or taken is None:
        bounds = {g: min(2**63 - 1, -(2**63) + int(2**64 * s)) for g, s in todo.items()}
        some = written(rows.where(below(bounds)).dropDuplicates([*([group] if group else []), "__hash"]), "sample")
        for g, h in some.select(of.alias("of"), "__hash").collect():
            found[g].add(h)
        taken, widened = (some, False) if taken is None else (taken.union(some), True)
        todo = {g: min(1.0, s * 64) for g, s in todo.items() if len(found[g]) < most and s < 1}
    last = {g: sorted(hashes)[:most][-1] for g, hashes in found.items() if hashes}
    out = taken.where(below(last))
    if widened:  # a wider table holds the rows of a narrower one again
        out = written(out.dropDuplicates([*([group] if group else []), "__hash"]), "sample")
    return out.drop("__hash")


#: Rows that a task turns into Python objects at a time.
BATCH_ROWS = 1000


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(first, BATCH_ROWS)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_ROWS`` rows, which bounds what a worker holds as Python objects."""
    return df.mapInArrow(lambda batches: fn(small_batches(batches)), schema)


def text_chunks(texts: list[str], max_chars: int) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of consecutive runs of about ``max_chars`` characters; a longer text stands alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > max_chars:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions arrive pickled by value, so module globals are new in every
    task; what is costly to build is kept here instead.
    """
    return sys.__dict__.setdefault("_drivestats_worker_cache", {})


def flat(lists: Iterable[list]) -> list:
    return list(itertools.chain.from_iterable(lists))
