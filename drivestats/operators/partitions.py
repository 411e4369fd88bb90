"""Partition-level operators: latest partition (A4, L3), partition paths (A3), new-data test (P4)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drivestats.functions.timeparts import partition_after, partition_start


def latest_partition(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One row: the greatest partition tuple and its start time.

    ``max(struct(parts))`` is the lexicographic maximum (the reference's
    ``ORDER BY parts`` + last row) computed as a single partial aggregate: no
    sort, and only partition columns are read. Empty input gives no row.
    """
    parts = list(parts)
    top = df.select(*parts).agg(F.max(F.struct(*parts)).alias("p")).where(F.col("p").isNotNull())
    return top.select(*[F.col(f"p.{c}").alias(c) for c in parts]).withColumn("watermark", partition_start(parts))


def latest_partition_sql(df: DataFrame, parts: Sequence[str], view: str | None = None) -> DataFrame:
    """A4 through the SQL API (S4): the same query over a temporary view.

    For callers that keep watermark logic in SQL text. ``view`` defaults to a
    fresh name so concurrent jobs in one session do not collide.
    """
    parts = list(parts)
    view = view or f"gold_partitions_{uuid.uuid4().hex[:12]}"
    df.select(*parts).createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in parts)
    top = df.sparkSession.sql(
        f"SELECT p.* FROM (SELECT max(struct({cols})) AS p FROM `{view}`) WHERE p IS NOT NULL"
    )
    return top.withColumn("watermark", partition_start(parts))


def latest_partition_time(df: DataFrame, parts: Sequence[str]) -> dt.datetime | None:
    """The watermark as a Python datetime, or None for an empty table (Q22).

    Only the single aggregated row reaches the driver.
    """
    row = latest_partition(df, parts).select("watermark").first()
    return None if row is None else row["watermark"]


def partition_paths(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Distinct ``year=…/month=…/…/`` paths of the partitions present in ``df``."""
    pieces = []
    for c in parts:
        pieces += [F.lit(f"{c}="), F.col(c).cast("string"), F.lit("/")]
    return df.select(*parts).distinct().select(F.concat(*pieces).alias("path"))


def has_new_data(df: DataFrame, watermark: dt.datetime | None, parts: Sequence[str]) -> bool:
    """P4/L4: does the source hold any partition after the watermark?"""
    if watermark is not None:
        df = df.where(partition_after(parts, watermark))
    return not df.select(*parts).isEmpty()


def new_data_by_month(df: DataFrame) -> DataFrame:
    """For every source month taken as a watermark, whether later partitions exist.

    The months are first reduced to one row each by a partial aggregate; the
    final comparison is a window over those few rows (one per calendar month,
    independent of data volume), so nothing row-sized is moved to one task.
    """
    months = df.groupBy("year", "month").agg(F.lit(1).alias("_n")).drop("_n")
    later = F.max(F.struct("year", "month")).over(Window.orderBy("year", "month").rowsBetween(1, Window.unboundedFollowing))
    return months.select(
        "year",
        "month",
        partition_start(["year", "month"]).alias("watermark"),
        later.isNotNull().alias("has_new_data"),
    )
