"""

Every query reads the shared test tables through the fixture adaptors and runs
over the whole tables. The publish/catalog queries write under the session's
shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivestats.functions.timeparts import partition_after
from drivestats.operators.traces import trace_points
from drivestats.operators.partitions import latest_partition, latest_partition_sql, new_data_by_month, partition_paths
from drivestats.operators.trips import join_trip_events, trip_activity, trip_distance, trip_driving_events
from drivestats.plans import oracle
from drivestats.plans.grains import DAILY, GRAINS, HOURLY, MONTHLY, MONTHLY_CALENDAR
from drivestats.plans.job import MERGE, REBUILD, run, run_full_many
from drivestats.plans.stats import build_stats
from drivestats.session import work_path
from drivestats.sources import gold
from drivestats.sources.commits import CommitLog
from drivestats.sources.fixtures import positions_e, positions_l, positions_late, positions_odd
from drivestats.sources.positions import normalize, read_positions

Query = Callable[[SparkSession, str], DataFrame]


def _ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def hourly_stats(spark: SparkSession, d: str) -> DataFrame:
    return build_stats(positions_e(spark, d), HOURLY)


def daily_stats(spark: SparkSession, d: str) -> DataFrame:
    return build_stats(positions_l(spark, d), DAILY)


def monthly_stats(spark: SparkSession, d: str) -> DataFrame:
    return build_stats(positions_l(spark, d), MONTHLY)


def monthly_stats_calendar(spark: SparkSession, d: str) -> DataFrame:
    return build_stats(positions_l(spark, d), MONTHLY_CALENDAR)


def daily_stats_minutes(spark: SparkSession, d: str) -> DataFrame:
    return build_stats(positions_l(spark, d), DAILY, sample_seconds=60.0)


def trip_events_joined(spark: SparkSession, d: str) -> DataFrame:
    pos = normalize(positions_e(spark, d, null_trip_for_errors=True))
    g = dataclasses.replace(HOURLY, keep_null_trip=True)
    return join_trip_events(trip_activity(pos, g), trip_driving_events(pos, g), g.trip_keys)


def publish_full_daily(spark: SparkSession, d: str) -> DataFrame:
    path = work_path(spark, "publish_full_daily")
    run(spark, DAILY, gold.FULL_LOAD, positions_l(spark, d), path)
    return gold.read_gold(spark, path)


def publish_incremental_daily(spark: SparkSession, d: str) -> DataFrame:
    """History up to a cut-off as a full load, then an incremental run on everything."""
    path = work_path(spark, "publish_incremental_daily")
    pos = positions_l(spark, d)
    history = pos.where(~partition_after(DAILY.source_parts, _ts(oracle.HISTORY_CUTOFF_DAILY)))
    run(spark, DAILY, gold.FULL_LOAD, history, path)
    run(spark, DAILY, gold.INCREMENTAL, pos, path)
    return gold.read_gold(spark, path)


def _target(spark: SparkSession, name: str) -> tuple[str, dict[str, str]]:
    """A fresh path and the catalog entry of the same number."""
    path = work_path(spark, name)
    return path, {"database": "drivestats_gold", "table": f"{name}_{path.rsplit('-', 1)[-1]}"}


def _until(pos: DataFrame, cutoff: str) -> DataFrame:
    return pos.where(~partition_after(DAILY.source_parts, _ts(cutoff)))


def catalog_daily(spark: SparkSession, d: str) -> DataFrame:
    path, entry = _target(spark, "catalog_daily")
    run(spark, DAILY, gold.FULL_LOAD, positions_l(spark, d), path, **entry)
    return gold.read_table(spark, **entry)


def _publish_late(spark: SparkSession, d: str, name: str) -> tuple[str, dict[str, str]]:
    path, entry = _target(spark, name)
    pos = positions_late(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, **entry)
    run(spark, DAILY, gold.INCREMENTAL, pos, path, late_rows=REBUILD, **entry)
    return path, entry


def publish_late_daily(spark: SparkSession, d: str) -> DataFrame:
    """New partitions with samples of days long published: the touched days are built again."""
    return gold.read_gold(spark, _publish_late(spark, d, "publish_late_daily")[0], DAILY.output_schema)


def catalog_late_daily(spark: SparkSession, d: str) -> DataFrame:
    return gold.read_table(spark, **_publish_late(spark, d, "catalog_late_daily")[1])


def catalog_incremental_daily(spark: SparkSession, d: str) -> DataFrame:
    path, entry = _target(spark, "catalog_incremental_daily")
    pos = positions_l(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, **entry)
    run(spark, DAILY, gold.INCREMENTAL, pos, path, **entry)
    return gold.read_table(spark, **entry)


def catalog_after_crash_daily(spark: SparkSession, d: str) -> DataFrame:
    """The second run writes and dies before it registers (here: knows no table); the third has new data."""
    path, entry = _target(spark, "catalog_after_crash_daily")
    pos = positions_l(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, **entry)
    run(spark, DAILY, gold.INCREMENTAL, _until(pos, oracle.CRASH_CUTOFF_DAILY), path)
    run(spark, DAILY, gold.INCREMENTAL, pos, path, **entry)
    return gold.read_table(spark, **entry)


def catalog_reload_daily(spark: SparkSession, d: str) -> DataFrame:
    """The partitions listed after a second full load that holds fewer days."""
    path, entry = _target(spark, "catalog_reload_daily")
    pos = positions_l(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, pos, path, **entry)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, **entry)
    return spark.sql(f"SHOW PARTITIONS {gold.table_name(**entry)}")


def load_control_daily(spark: SparkSession, d: str) -> DataFrame:
    """L2 (no history: full load), an incremental run, L4 (nothing new: stop)."""
    path = work_path(spark, "load_control_daily")
    pos = positions_l(spark, d)
    results = [
        run(spark, DAILY, gold.INCREMENTAL, p, path) for p in (_until(pos, oracle.HISTORY_CUTOFF_DAILY), pos, pos)
    ]
    rows = [(i, r.load_type, r.wrote, r.watermark, r.rows_read, len(r.partitions)) for i, r in enumerate(results, 1)]
    return spark.createDataFrame(
        rows, "step int, load_type string, wrote boolean, watermark timestamp_ntz, rows_read long, n_partitions long"
    )


def _arrives(pos: DataFrame, parts: Sequence[str], at: Column) -> DataFrame:
    """``pos`` with the source partition of another time."""
    values = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at)}
    return pos.withColumns({p: values[p] for p in parts})


def watermark_ahead_daily(spark: SparkSession, d: str) -> DataFrame:
    """Samples dated ahead of their arrival (a clock a year fast, here: early arrivals) do not hide what arrives later.

    Every seventh order arrives 300 days before its samples' own time, so the history publishes days far
    beyond the partitions read; the incremental run reads on from the partitions.
    """
    path = work_path(spark, "watermark_ahead_daily")
    pos = positions_l(spark, d)
    early = F.when(F.col("ct") % 70 < 10, F.col("ts") - F.make_dt_interval(F.lit(300))).otherwise(F.col("ts"))
    pos = _arrives(pos, oracle.DAILY.parts, early)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, late_rows=MERGE)
    run(spark, DAILY, gold.INCREMENTAL, pos, path, late_rows=MERGE)
    return gold.read_gold(spark, path, DAILY.output_schema)


def late_only_twice_daily(spark: SparkSession, d: str) -> DataFrame:
    """A source partition of late samples only, refreshed twice: taken in once, the mark moves past it."""
    path = work_path(spark, "late_only_twice_daily")
    pos = positions_l(spark, d)
    last = pos.agg(F.max("ts")).first()[0] + dt.timedelta(days=10)
    late = F.when(F.col("ct") % 50 < 10, F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")).otherwise(F.col("ts"))
    pos = _arrives(pos, oracle.DAILY.parts, late)
    run(spark, DAILY, gold.FULL_LOAD, pos.where("ct % 50 >= 10"), path, late_rows=MERGE)
    for _ in range(2):
        run(spark, DAILY, gold.INCREMENTAL, pos, path, late_rows=MERGE)
    return gold.read_gold(spark, path, DAILY.output_schema)


def rebuild_expired_daily(spark: SparkSession, d: str) -> DataFrame:
    """Late samples of days whose source partitions are gone: merged into the state, nothing published is lost."""
    path = work_path(spark, "rebuild_expired_daily")
    pos = positions_late(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path, late_rows=MERGE)
    kept = pos.where(partition_after(DAILY.source_parts, _ts(oracle.HISTORY_CUTOFF_DAILY)))
    run(spark, DAILY, gold.INCREMENTAL, kept, path, late_rows=MERGE)
    return gold.read_gold(spark, path, DAILY.output_schema)


def repeated_run_daily(spark: SparkSession, d: str) -> DataFrame:
    """A run that dies after its record and before publishing is finished by the next; runs that repeat add nothing."""
    path = work_path(spark, "repeated_run_daily")
    pos = positions_l(spark, d)
    run(spark, DAILY, gold.FULL_LOAD, _until(pos, oracle.HISTORY_CUTOFF_DAILY), path)
    run(spark, DAILY, gold.INCREMENTAL, _until(pos, oracle.CRASH_CUTOFF_DAILY), path)
    commits = CommitLog(spark, path)
    # As if it had died: the marker is gone, so is half of what it published.
    commits.delete(commits.run_path(2, "published"))
    commits.delete(f"{path}/year=1999/month=1")
    for _ in range(2):
        run(spark, DAILY, gold.INCREMENTAL, pos, path)
    return gold.read_gold(spark, path, DAILY.output_schema)


def positions_mixed_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Silver data of several producers: narrower numbers, text ids and times, further and missing columns, read as one table."""
    root, pos, ct = work_path(spark, "positions_mixed"), positions_e(spark, d), F.col("ct")
    narrow = pos.where(ct % 3 == 0).withColumns({"user_id": F.col("user_id").cast("int"), "ct": ct.cast("int"), "sp": F.col("sp").cast("double")})
    narrow.drop("vehicle_id").where(ct % 2 == 0).write.parquet(f"{root}/a/part=1")
    pos.where((ct % 3 == 0) & (ct % 2 == 1)).withColumn("driver", F.lit("x")).write.parquet(f"{root}/a/part=2")
    text = {"user_id": F.col("user_id").cast("string"), "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")}
    pos.where(ct % 3 > 0).withColumns(text).write.parquet(f"{root}/b")
    out = normalize(read_positions(spark, [f"{root}/a", f"{root}/b"]))
    return out.withColumn("user_id", F.col("user_id").cast("long"))


def several_grains(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The table of one grain out of a full load of all of them from one pass over the samples."""
    root = work_path(spark, "several_grains")
    run_full_many(spark, positions_e(spark, d), {g.name: f"{root}/{g.name}" for g in (HOURLY, DAILY, MONTHLY, MONTHLY_CALENDAR)})
    return gold.read_gold(spark, f"{root}/{name}", GRAINS[name].output_schema)


def registry() -> dict[str, Query]:
    e, l = positions_e, positions_l
    return {
        "positions_normalized": lambda s, d: normalize(e(s, d)),
        "incremental_rows_hourly": lambda s, d: e(s, d).where(
            partition_after(HOURLY.source_parts, _ts(oracle.WATERMARK_HOURLY))
        ),
        "incremental_rows_daily": lambda s, d: e(s, d).where(
            partition_after(DAILY.source_parts, _ts(oracle.WATERMARK_DAILY))
        ),
        "incremental_rows_monthly": lambda s, d: l(s, d).where(
            partition_after(MONTHLY.source_parts, _ts(oracle.WATERMARK_MONTHLY))
        ),
        "has_new_data": lambda s, d: new_data_by_month(l(s, d)),
        "latest_partition_hourly": lambda s, d: latest_partition(hourly_stats(s, d), HOURLY.output_parts),
        "latest_partition_daily": lambda s, d: latest_partition(build_stats(e(s, d), DAILY), DAILY.output_parts),
        "latest_partition_monthly": lambda s, d: latest_partition(monthly_stats(s, d), MONTHLY.output_parts),
        "trip_activity_hourly": lambda s, d: trip_activity(normalize(e(s, d)), HOURLY),
        "trip_activity_daily": lambda s, d: trip_activity(normalize(e(s, d)), DAILY),
        "trip_activity_monthly": lambda s, d: trip_activity(normalize(l(s, d)), MONTHLY),
        "trip_distance_hourly": lambda s, d: trip_distance(normalize(e(s, d)), HOURLY),
        "trip_distance_daily": lambda s, d: trip_distance(normalize(l(s, d)), DAILY),
        "trip_driving_events_hourly": lambda s, d: trip_driving_events(normalize(e(s, d)), HOURLY),
        "trip_driving_events_daily": lambda s, d: trip_driving_events(normalize(l(s, d)), DAILY),
        "trip_events_joined": trip_events_joined,
        "trip_traces_daily": lambda s, d: trace_points(normalize(l(s, d)), DAILY),
        "hourly_stats": hourly_stats,
        "daily_stats": daily_stats,
        "monthly_stats": monthly_stats,
        "monthly_stats_calendar": monthly_stats_calendar,
        # The other strategies by name; the default is blocks.
        "hourly_stats_sliced": lambda s, d: build_stats(e(s, d), HOURLY, strategy="sorted"),
        "daily_stats_sliced": lambda s, d: build_stats(l(s, d), DAILY, strategy="sorted"),
        "hourly_stats_window": lambda s, d: build_stats(e(s, d), HOURLY, strategy="window"),
        "daily_stats_window": lambda s, d: build_stats(l(s, d), DAILY, strategy="window"),
        "daily_stats_minutes": daily_stats_minutes,
        "partition_paths_hourly": lambda s, d: partition_paths(hourly_stats(s, d), HOURLY.output_parts),
        "partition_paths_daily": lambda s, d: partition_paths(build_stats(e(s, d), DAILY), DAILY.output_parts),
        "partition_paths_monthly": lambda s, d: partition_paths(monthly_stats(s, d), MONTHLY.output_parts),
        "publish_full_daily": publish_full_daily,
        "publish_incremental_daily": publish_incremental_daily,
        "catalog_daily": catalog_daily,
        "publish_late_daily": publish_late_daily,
        "catalog_late_daily": catalog_late_daily,
        "catalog_incremental_daily": catalog_incremental_daily,
        "catalog_after_crash_daily": catalog_after_crash_daily,
        "catalog_reload_daily": catalog_reload_daily,
        "load_control_daily": load_control_daily,
        "positions_mixed_normalized": positions_mixed_normalized,
        "watermark_ahead_daily": watermark_ahead_daily,
        "late_only_twice_daily": late_only_twice_daily,
        "rebuild_expired_daily": rebuild_expired_daily,
        "repeated_run_daily": repeated_run_daily,
        "several_grains_hourly": lambda s, d: several_grains(s, d, "hourly"),
        "several_grains_monthly_calendar": lambda s, d: several_grains(s, d, "monthly_calendar"),
        "latest_partition_sql_daily": lambda s, d: latest_partition_sql(daily_stats(s, d), DAILY.output_parts),
        "positions_odd_normalized": lambda s, d: normalize(positions_odd(s, d)).withColumns(
            {"user_id": F.col("user_id").cast("long"), "vehicle_id": F.col("vehicle_id").cast("long")}
        ),
        "hourly_stats_odd": lambda s, d: build_stats(positions_odd(s, d), HOURLY),
        "trip_traces_hourly": lambda s, d: trace_points(normalize(e(s, d)), HOURLY),
    }
