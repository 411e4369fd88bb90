"""Adaptors that present the shared test tables as position samples (FIXTURES.md).

The reference ships no inputs, so the queries run on the driver's tables:
``events`` (E, 30 days with time of day) and ``lineitem`` (L, 83 months).
The oracle SQL in ``drivestats.plans.oracle`` builds the same rows in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_source_parts(ts: Column) -> list[Column]:
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
    ]


def _trip(prefix: Column, ts: Column) -> Column:
    return F.concat(prefix.cast("string"), F.lit("-"), F.to_date(ts).cast("string"))


def events_positions(events: DataFrame, null_trip_for_errors: bool = False) -> DataFrame:
    """Fixture E. With ``null_trip_for_errors`` samples of ``error`` events carry no trip id."""
    ts = F.col("ts")
    trip = _trip(F.col("user_id") % 4, ts)
    if null_trip_for_errors:
        trip = F.when(F.col("event_type") != "error", trip)
    return events.select(
        trip.alias("trip_id"),
        F.col("user_id"),
        (F.col("user_id") % 7).alias("vehicle_id"),
        ts,
        (F.lit(35.0) + F.col("value") / 1000.0).alias("latitude"),
        (F.lit(139.0) + (F.col("event_id") % 97) / 1000.0).alias("longitude"),
        F.col("event_id").alias("ct"),
        F.least(F.col("value"), F.lit(180.0)).alias("sp"),
        *_with_source_parts(ts),
    )


def lineitem_positions(lineitem: DataFrame) -> DataFrame:
    """Fixture L: one sample per line item, trips are (supplier mod 4, ship date)."""
    ts = F.col("l_shipdate")
    return lineitem.select(
        _trip(F.col("l_suppkey") % 4, ts).alias("trip_id"),
        F.col("l_suppkey").alias("user_id"),
        (F.col("l_partkey") % 50).alias("vehicle_id"),
        ts.alias("ts"),
        (F.lit(35.0) + F.col("l_discount")).alias("latitude"),
        (F.lit(139.0) + F.col("l_tax")).alias("longitude"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ct"),
        F.col("l_quantity").alias("sp"),
        *_with_source_parts(ts),
    )


def positions_e(spark: SparkSession, sf_dir: str, null_trip_for_errors: bool = False) -> DataFrame:
    return events_positions(_table(spark, sf_dir, "events"), null_trip_for_errors)


def positions_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_positions(_table(spark, sf_dir, "lineitem"))


def positions_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E as a careless producer would send it: ``ts`` as text in several shapes,
    some of it no timestamp, ids of other types, missing latitudes and counters."""
    ct = F.col("ct")
    second = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(ct % 7 == 0, F.concat(second, F.lit(".123")))
        .when(ct % 7 == 1, F.concat(second, F.lit("Z")))
        .when(ct % 7 == 2, F.concat(second, F.lit(" +09:00")))
        .when(ct % 7 == 3, F.date_format("ts", "yyyy-M-d H:m:s"))
        .when(ct % 7 == 4, F.concat(F.lit("at "), second))
        .otherwise(second)
    )
    e = positions_e(spark, sf_dir)
    return e.withColumns(
        {
            "ts": text,
            "user_id": F.col("user_id").cast("string"),
            "vehicle_id": F.col("vehicle_id").cast("decimal(20,0)"),
            "latitude": F.when(ct % 11 != 0, F.col("latitude")),
            "ct": F.when(ct % 13 != 0, ct),
        }
    )


def positions_late(spark: SparkSession, sf_dir: str, days: int = 400) -> DataFrame:
    """Fixture L in which every fifth order arrives ``days`` after its samples' own time."""
    arrival = F.when(F.col("ct") % 50 < 10, F.col("ts") + F.make_dt_interval(F.lit(days))).otherwise(F.col("ts"))
    late = positions_l(spark, sf_dir)
    parts = ["year", "month", "day", "hour"]
    return late.select(*[c for c in late.columns if c not in parts], *_with_source_parts(arrival))
