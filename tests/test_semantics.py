
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from drivestats.plans.grains import DAILY, HOURLY, MONTHLY, MONTHLY_CALENDAR
from drivestats.plans.stats import build_stats
from drivestats.sources.positions import normalize

STR_SCHEMA = (
    "trip_id string, user_id long, vehicle_id long, ts string, latitude double, longitude double, "
    "ct long, sp double, year int, month int, day int, hour int"
)


def pos(spark, rows):
    """rows: (trip, user, vehicle, ts text, lat, lon, ct, sp); partition parts from the text."""
    out = []
    for trip, user, veh, ts, lat, lon, ct, sp in rows:
        try:
            t = dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S")
            parts = (t.year, t.month, t.day, t.hour)
        except (TypeError, ValueError):
            parts = (2024, 1, 1, 0)
        out.append((trip, user, veh, ts, lat, lon, ct, sp, *parts))
    return spark.createDataFrame(out, STR_SCHEMA)


def samples(trip, user, start, n, step_s=1, ct0=0, sp=10.0, veh=1):
    t0 = dt.datetime.fromisoformat(start)
    return [
        (trip, user, veh, (t0 + dt.timedelta(seconds=i * step_s)).strftime("%Y-%m-%d %H:%M:%S"),
         35.0 + i * 1e-4, 139.0, ct0 + i, sp)
        for i in range(n)
    ]


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("strategy", ["blocks", "sorted", "window"])
def test_trip_across_hour_edge_counts_in_both_hours(spark, strategy):
    p = pos(spark, samples("t", 1, "2024-03-01 10:59:58", 4))
    hourly = rows_by(build_stats(p, HOURLY, strategy=strategy), "hour")
    daily = rows_by(build_stats(p, DAILY, strategy=strategy), "day")
    assert set(hourly) == {(10,), (11,)}
    assert hourly[(10,)]["trip_count"] == 1 and hourly[(11,)]["trip_count"] == 1
    assert daily[(1,)]["trip_count"] == 1
    # The pair across the hour edge is in the daily bucket only (Q1).
    assert hourly[(10,)]["total_distance"] + hourly[(11,)]["total_distance"] < daily[(1,)]["total_distance"]


def test_user_and_vehicle_counts_are_sums_over_trips(spark):
    p = pos(spark, samples("a", 1, "2024-03-01 10:00:00", 3) + samples("b", 1, "2024-03-01 10:10:00", 3, veh=2))
    r = build_stats(p, HOURLY).collect()[0]
    assert (r["trip_count"], r["user_count"], r["vehicle_count"]) == (2, 2, 2)


@pytest.mark.parametrize("n,minutes", [(29, 0), (30, 1), (31, 1), (89, 1), (90, 2)])
def test_driving_minutes_round_half_up_once(spark, n, minutes):
    p = pos(spark, samples("a", 1, "2024-03-01 10:00:00", n))
    r = build_stats(p, HOURLY).collect()[0]
    assert r["total_driving_time"] == minutes
    assert r["avg_driving_time"] == pytest.approx(minutes / 1)


def test_minutes_rounded_after_summing_trips(spark):
    # Two trips of 20 samples: 40/60 rounds to 1; per-trip rounding would give 0.
    p = pos(spark, samples("a", 1, "2024-03-01 10:00:00", 20) + samples("b", 2, "2024-03-01 10:20:00", 20))
    assert build_stats(p, HOURLY).collect()[0]["total_driving_time"] == 1


def test_sample_seconds_parameter(spark):
    p = pos(spark, samples("a", 1, "2024-03-01 10:00:00", 3, step_s=60))
    assert build_stats(p, HOURLY, sample_seconds=60).collect()[0]["total_driving_time"] == 3


def test_null_trip_dropped_hourly_daily_kept_monthly(spark):
    rows = samples(None, 5, "2024-03-02 10:00:00", 3) + samples("a", 1, "2024-03-01 10:00:00", 3)
    p = pos(spark, rows)
    assert build_stats(p, HOURLY).count() == 1
    assert build_stats(p, DAILY).count() == 1
    monthly = build_stats(p, MONTHLY).collect()
    assert len(monthly) == 2  # one row per date (reference grain)
    null_only = [r for r in monthly if r["trip_count"] == 0][0]
    assert null_only["user_count"] == 1 and null_only["avg_distance"] is None  # 0 trips: no ratio, no error


def test_unparseable_ts_is_dropped_not_an_error(spark):
    rows = samples("a", 1, "2024-03-01 10:00:00", 3) + [("a", 1, 1, "not a time", 35.0, 139.0, 99, 10.0)]
    r = build_stats(pos(spark, rows), HOURLY).collect()
    assert len(r) == 1 and r[0]["trip_count"] == 1
    assert normalize(pos(spark, rows)).where(F.col("date").isNull()).count() == 1


def test_null_latitude_breaks_distance_chain(spark):
    rows = samples("a", 1, "2024-03-01 10:00:00", 3)
    rows[1] = rows[1][:4] + (None,) + rows[1][5:]
    r = build_stats(pos(spark, rows), HOURLY).collect()[0]
    assert r["total_distance"] == 0  # both pairs touch the null point


def test_speed_events(spark):
    speeds = [0.0, 21.0, 31.5, 40.0, 2.0, 2.0]
    rows = [("a", 1, 1, f"2024-03-01 10:00:0{i}", 35.0, 139.0, i, s) for i, s in enumerate(speeds)]
    r = build_stats(pos(spark, rows), HOURLY).collect()[0]
    # deltas: +21 (start from 0), +10.5, +8.5, -38 (stop at 2), 0
    assert r["total_sudden_start_count"] == 1
    assert r["total_sudden_stop_count"] == 1
    assert r["total_acceleration_count"] == 2
    assert r["total_deceleration_count"] == 1


def test_single_point_trip_has_zero_distance(spark):
    r = build_stats(pos(spark, samples("a", 1, "2024-03-01 10:00:00", 1)), HOURLY).collect()[0]
    assert r["total_distance"] == 0 and r["total_acceleration_count"] == 0


def test_empty_input(spark):
    empty = pos(spark, samples("a", 1, "2024-03-01 10:00:00", 2)).where(F.lit(False))
    for g in (HOURLY, DAILY, MONTHLY, MONTHLY_CALENDAR):
        assert build_stats(empty, g).count() == 0


def test_year_month_keys(spark):
    p = pos(spark, samples("a", 1, "2024-01-05 10:00:00", 2))
    assert build_stats(p, DAILY).collect()[0]["year_month"] == "20241"
    assert build_stats(p, MONTHLY).collect()[0]["year_month"] == "20241"
    assert build_stats(p, MONTHLY_CALENDAR).collect()[0]["year_month"] == "2024-01"


def test_output_schemas(spark):
    p = pos(spark, samples("a", 1, "2024-01-05 10:00:00", 2))
    for g in (HOURLY, DAILY, MONTHLY, MONTHLY_CALENDAR):
        df = build_stats(p, g)
        assert tuple(df.columns) == g.output_cols
        types = dict(df.dtypes)
        for c in g.output_cols:
            if c.startswith("avg_"):
                assert types[c] == "double"
            elif c in ("year", "month", "day", "hour"):
                assert types[c] == "int"
            elif c == "date":
                assert types[c] == "date"
            elif c == "year_month":
                assert types[c] == "string"
            else:
                assert types[c] == "bigint", (g.name, c)


def test_timestamp_input_accepted(spark):
    p = pos(spark, samples("a", 1, "2024-01-05 10:00:00", 3)).withColumn("ts", F.to_timestamp("ts"))
    assert build_stats(p, HOURLY).collect()[0]["trip_count"] == 1


def test_latest_partition_dataframe_and_sql_agree(spark):
    from drivestats.operators.partitions import latest_partition, latest_partition_sql, latest_partition_time

    rows = samples("a", 1, "2024-01-31 23:59:58", 3) + samples("b", 2, "2023-12-31 10:00:00", 2)
    stats = build_stats(pos(spark, rows), HOURLY)
    a = latest_partition(stats, HOURLY.output_parts).collect()
    b = latest_partition_sql(stats, HOURLY.output_parts).collect()
    assert a == b and (a[0]["year"], a[0]["month"], a[0]["day"], a[0]["hour"]) == (2024, 2, 1, 0)
    assert latest_partition_time(stats, HOURLY.output_parts) == dt.datetime(2024, 2, 1, 0)
    assert latest_partition_time(stats.where(F.lit(False)), HOURLY.output_parts) is None


def test_hot_trip_bucket_matches(spark, sf_dir):
    """Every user's samples under one trip id per day."""
    from drivestats.sources.fixtures import positions_e

    hot = positions_e(spark, sf_dir).withColumn("trip_id", F.concat(F.lit("fleet-"), F.to_date("ts").cast("string")))
    got = build_stats(hot, DAILY)
    want = build_stats(hot, DAILY, strategy="window")
    cols = sorted(got.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


@pytest.mark.parametrize("strategy", ["window", "sorted", "blocks"])
def test_input_order_and_partitioning_do_not_matter(spark, sf_dir, strategy):
    from drivestats.sources.fixtures import positions_e

    base = positions_e(spark, sf_dir)
    shuffled = base.repartition(7, F.rand(3)).orderBy(F.desc("ct"))
    a = build_stats(base, DAILY, strategy=strategy)
    b = build_stats(shuffled, DAILY, strategy=strategy)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_bucket_grain_properties(spark, sf_dir):
    from drivestats.sources.fixtures import positions_e

    p = positions_e(spark, sf_dir)
    hourly = build_stats(p, HOURLY).agg(F.sum("trip_count"), F.sum("total_distance"), F.min("trip_count")).first()
    daily = build_stats(p, DAILY).agg(F.sum("trip_count"), F.sum("total_distance"), F.min("trip_count")).first()
    # A trip-day splits into one bucket per hour it touches; distance across hour edges is lost.
    assert hourly[0] >= daily[0] and hourly[1] <= daily[1]
    assert hourly[2] >= 1 and daily[2] >= 1


@pytest.mark.parametrize("block_rows", [None, "40"])
def test_trace_points_by_blocks(spark, sf_dir, block_rows):
    """Whole buckets, and one bucket of most rows with repeated samples, cut into many blocks: numbered as by the window, without Python."""
    from drivestats.operators.blocks import CONF_BLOCK_ROWS
    from drivestats.operators.traces import trace_points
    from drivestats.sources.fixtures import positions_e

    p = normalize(positions_e(spark, sf_dir)).withColumns({"trip_id": F.when(F.col("ct") % 5 != 0, F.lit("hot")), "ct": F.col("ct") % 50})
    p = p.union(p.where("ct = 7"))
    want = sorted(map(str, trace_points(p, MONTHLY, strategy="window").collect()))
    if block_rows:
        spark.conf.set(CONF_BLOCK_ROWS, block_rows)
    try:
        got = trace_points(p, MONTHLY)
        assert sorted(map(str, got.collect())) == want
        assert "Python" not in got._jdf.queryExecution().toString() and "InArrow" not in got._jdf.queryExecution().toString()
    finally:
        spark.conf.unset(CONF_BLOCK_ROWS)


@pytest.mark.parametrize("grain", [DAILY, MONTHLY])
def test_trace_points_sliced_equals_window(spark, sf_dir, grain):
    """Row-form traces: the hot-bucket plan (forced into many slices) numbers samples exactly as the window."""
    from drivestats.operators.traces import trace_points
    from drivestats.sources.fixtures import positions_l

    p = normalize(positions_l(spark, sf_dir)).withColumn(
        "trip_id", F.when(F.col("ct") % 5 != 0, F.col("trip_id"))  # some null trips for the monthly grain
    )
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = trace_points(p, grain, strategy="window")
        b = trace_points(p, grain)
        key = lambda r: tuple((x is None, str(x)) for x in r)
        ra, rb = sorted(map(tuple, a.collect()), key=key), sorted(map(tuple, b.collect()), key=key)
        assert ra == rb and len(ra) > 0
        sizes = b.groupBy(*grain.trip_keys).agg(F.max("seq").alias("m"), F.count("*").alias("n"))
        assert sizes.where("m != n").count() == 0  # seq runs 1..size without gaps
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_string_timestamps_padded_or_not(spark):
    rows = [
        ("a", 1, 1, "2024-01-05 03:07:09", 35.0, 139.0, 1, 10.0),
        ("a", 1, 1, "2024-1-5 3:7:10", 35.1, 139.0, 2, 10.0),
        ("a", 1, 1, "2024-13-01 00:00:00", 35.2, 139.0, 3, 10.0),  # impossible: null, not rolled over
    ]
    n = normalize(pos(spark, rows)).orderBy("ct").select("date", "hour").collect()
    assert [tuple(r) for r in n] == [(dt.date(2024, 1, 5), 3), (dt.date(2024, 1, 5), 3), (None, None)]


def test_has_new_data_and_partition_paths(spark):
    from drivestats.operators.partitions import has_new_data, new_data_by_month, partition_paths

    rows = samples("a", 1, "2024-01-31 23:00:00", 2) + samples("b", 2, "2024-02-01 05:00:00", 2)
    p = pos(spark, rows)
    assert has_new_data(p, None, HOURLY.source_parts)
    assert has_new_data(p, dt.datetime(2024, 2, 1, 4), HOURLY.source_parts)
    assert not has_new_data(p, dt.datetime(2024, 2, 1, 5), HOURLY.source_parts)  # strictly after
    months = {(r["year"], r["month"]): r["has_new_data"] for r in new_data_by_month(p).collect()}
    assert months == {(2024, 1): True, (2024, 2): False}
    paths = {r["path"] for r in partition_paths(build_stats(p, HOURLY), HOURLY.output_parts).collect()}
    assert paths == {"year=2024/month=1/day=31/hour=23/", "year=2024/month=2/day=1/hour=5/"}


def test_text_after_the_seconds_is_ignored(spark):
    texts = ["2024-01-01 10:00:00.123", "2024-01-01 10:00:00Z", "2024-01-01 10:00:00 +09:00", "2024-3-10 02:30:00"]
    bad = ["at 2024-01-01 10:00:00", "2024-02-30 10:00:00", "2024-01-01 10:60:00", "2024-01-01 10:00:000", "", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there on 10 March
    try:
        rows = [("a", 1, 1, t, 35.0, 139.0, i, 10.0) for i, t in enumerate(texts + bad)]
        got = [r["ts"] for r in normalize(pos(spark, rows)).orderBy("ct").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    ten = dt.datetime(2024, 1, 1, 10)
    assert got == [ten, ten, ten, dt.datetime(2024, 3, 10, 2, 30)] + [None] * len(bad)


def test_zoned_timestamps_take_the_named_zone(spark):
    base = pos(spark, samples("a", 1, "2024-01-05 20:00:00", 1))
    instant = F.timestamp_micros(F.lit(1704484800_000_000))  # 2024-01-05 20:00:00 UTC
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        zoned = base.withColumn("ts", instant)
        assert normalize(zoned).first()["hour"] == 20
        tokyo = normalize(zoned, zone="Asia/Tokyo").first()
        assert (tokyo["day"], tokyo["hour"]) == (6, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ids_of_any_type(spark):
    from drivestats.sources.positions import check_positions

    p = pos(spark, samples("1", 1, "2024-01-05 10:00:00", 3))
    other = p.withColumns({"trip_id": F.lit(7).cast("bigint"), "user_id": F.lit("u"), "vehicle_id": F.lit("v")})
    r = build_stats(check_positions(other), HOURLY).first()
    assert (r["trip_count"], r["user_count"], r["vehicle_count"]) == (1, 1, 1)
    with pytest.raises(TypeError):
        check_positions(p.withColumn("sp", F.lit("fast")))


def test_declared_schema_over_mixed_files(spark, tmp_path):
    """Files of one folder with narrower numbers, more and missing columns; a misnamed column is an error, not nulls."""
    from drivestats.sources.positions import read_positions

    root = str(tmp_path / "mixed")
    full = "'t' AS trip_id, 1L AS user_id, 2L AS vehicle_id, timestamp_ntz'2024-01-01 10:00:00' AS ts, 35.0D AS latitude, 139.0D AS longitude, {} AS ct, {} AS sp"
    spark.range(1).selectExpr(*full.format("1", "CAST(1.5 AS float)").split(", ")).drop("vehicle_id").coalesce(1).write.parquet(f"{root}/year=2024/month=1/day=1/hour=9")
    spark.range(1).selectExpr(*full.format("2L", "2.5D").split(", "), "'x' AS driver").write.parquet(f"{root}/year=2024/month=1/day=1/hour=10")
    spark.range(1).selectExpr(*full.format("3L", "3.5D").split(", ")).withColumn("user_id", F.lit(7)).write.parquet(f"{root}/year=2024/month=1/day=1/hour=11")
    df = read_positions(spark, root)
    assert {f.name: f.dataType.simpleString() for f in df.schema}["ct"] == "bigint" and "driver" not in df.columns
    assert sorted(tuple(r) for r in df.select("ct", "sp", "user_id", "vehicle_id", "hour").collect()) == [(1, 1.5, 1, None, 9), (2, 2.5, 1, 2, 10), (3, 3.5, 7, 2, 11)]
    bad = str(tmp_path / "bad")
    spark.range(1).selectExpr(*full.format("1L", "1.5D").split(", ")).withColumnRenamed("sp", "speed").write.parquet(bad)
    with pytest.raises(ValueError):
        read_positions(spark, bad)
