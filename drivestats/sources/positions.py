"""Silver position samples: scan (S1), projection (P1), time derivation (P2), incremental filter (P3)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

from drivestats.functions.timeparts import normalized_ts, partition_after

POSITION_COLUMNS = ("trip_id", "user_id", "vehicle_id", "ts", "latitude", "longitude", "ct", "sp")

# Declared schema of the silver table. ``ts`` may also be a string or a zoned
# timestamp, and the ids of any type that can be grouped: they are only grouped
# and counted.
ID_COLUMNS = ("trip_id", "user_id", "vehicle_id")
POSITIONS_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("user_id", LongType()),
        StructField("vehicle_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("ct", LongType()),
        StructField("sp", DoubleType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("day", IntegerType()),
        StructField("hour", IntegerType()),
    ]
)

NORMALIZED_COLUMNS = (*POSITION_COLUMNS, "date", "year", "month", "day", "hour")


def check_positions(df: DataFrame) -> DataFrame:
    """Fail fast on a source that lacks a used column or has an incompatible type."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in POSITION_COLUMNS if c not in fields]
    if missing:
        raise ValueError(f"positions lack columns {missing}")
    for f in POSITIONS_SCHEMA.fields:
        if f.name == "ts" or f.name not in fields:
            continue
        got = fields[f.name]
        if f.name in ID_COLUMNS and not isinstance(got, (MapType, VariantType)):
            continue
        numeric_ok = isinstance(f.dataType, (LongType, IntegerType, DoubleType)) and got.typeName() in (
            "integer", "long", "short", "byte", "double", "float", "decimal",
        )
        if got != f.dataType and not numeric_ok:
            raise TypeError(f"positions.{f.name} is {got.simpleString()}, expected {f.dataType.simpleString()}")
    return df


def _read_declared(spark: SparkSession, path: str) -> DataFrame:
    """One folder, by the declared schema and not by what one file happens to hold.

    Files may have narrower numbers (int, float), more columns, or lack an
    id, coordinate or speed column that others have (null there). The ids and
    ``ts`` take the type they have in the file that Spark looks at. A column
    that this file lacks has to have a value in some other one.
    """
    found = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    lacking = [c for c in POSITION_COLUMNS if c not in found]
    declared = [
        StructField(f.name, _declared_type(f, found[f.name]) if f.name in found else f.dataType)
        for f in POSITIONS_SCHEMA.fields
        if f.name in found or f.name in lacking
    ]
    df = spark.read.schema(StructType(declared)).parquet(path)
    absent = [c for c in lacking if df.where(F.col(c).isNotNull()).select(c).isEmpty()]
    return check_positions(df.drop(*absent))


def _declared_type(field: StructField, found: DataType) -> DataType:
    """The type to read: the widest of the found one's kind; text, times, decimals and other ids as they are."""
    if field.name in ID_COLUMNS:
        return LongType() if found.typeName() in ("byte", "short", "integer", "long") else found
    narrower = {"long": ("byte", "short", "integer"), "integer": ("byte", "short"), "double": ("float",)}
    return field.dataType if found.typeName() in narrower.get(field.dataType.typeName(), ()) else found


def read_positions(
    spark: SparkSession,
    path: str | Sequence[str],
    watermark: dt.datetime | None = None,
    source_parts: Sequence[str] = ("year", "month", "day", "hour"),
) -> DataFrame:
    """Scan the silver table; with a watermark keep only partitions after it (P3).

    The predicate only references partition columns, so on a Hive-partitioned
    layout it prunes directories before any file is opened. Several folders
    are read as one table: ids whose type differs between them become text, a
    ``ts`` that differs becomes ``timestamp_ntz``.
    """
    tables = [_read_declared(spark, p) for p in ([path] if isinstance(path, str) else path)]
    for c in ID_COLUMNS:
        if len({t.schema[c].dataType.simpleString() for t in tables}) > 1:
            tables = [t.withColumn(c, F.col(c).cast("string")) for t in tables]
    if len({t.schema["ts"].dataType.simpleString() for t in tables}) > 1:
        tables = [t.withColumn("ts", normalized_ts("ts", t.schema["ts"].dataType)) for t in tables]
    df = tables[0]
    for t in tables[1:]:
        df = df.unionByName(t, allowMissingColumns=True)
    if watermark is not None:
        df = df.where(partition_after(source_parts, watermark))
    return df


def normalize(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Project the eight sample columns and derive ``date`` and the time parts.

    ``ts`` becomes ``timestamp_ntz`` (no session time zone involved; zoned
    timestamps take the wall clock of ``zone``); unparseable strings give a null ``ts`` and so a null ``date``. The source
    partition columns are replaced by parts computed from ``ts``.
    """
    ts_type = df.schema["ts"].dataType
    base = df.select(*[c for c in POSITION_COLUMNS if c != "ts"], normalized_ts("ts", ts_type, zone).alias("ts"))
    ts = F.col("ts")
    return base.select(
        *POSITION_COLUMNS,
        F.to_date(ts).alias("date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
    )
