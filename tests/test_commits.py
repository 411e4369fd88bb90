"""Commit log: arrival watermark, repeatable runs, late rows with and without their source, catalog changes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from drivestats.operators.blocks import CONF_BLOCK_ROWS
from drivestats.operators.segments import bucket_segments, merged, overlapping, trip_segments
from drivestats.operators.trips import trip_metrics
from drivestats.plans import job
from drivestats.plans.grains import DAILY, GRAINS, HOURLY, MONTHLY
from drivestats.plans.job import run, run_full_many
from drivestats.plans.stats import build_many, build_stats
from drivestats.session import work_path
from drivestats.sources import gold
from drivestats.sources.commits import CommitLog, newest_partition
from drivestats.sources.fixtures import positions_e
from drivestats.sources.positions import POSITIONS_SCHEMA, normalize
from tests.test_job import same_rows


def sample(day, ct, arrived=None, trip="t", user=1):
    """One sample of January ``day`` in the source partition of day ``arrived``."""
    return (trip, user, 1, dt.datetime(2024, 1, day, 12, ct // 60 % 60, ct % 60), 35.0 + ct * 0.001, 139.0, ct, float(ct * 7 % 60), 2024, 1, arrived or day, 12)


def source(spark, rows):
    return spark.createDataFrame(rows, POSITIONS_SCHEMA)


def full(spark, rows, grain=DAILY):
    return build_stats(source(spark, rows), grain)


HISTORY = [sample(d, ct) for d in (1, 2, 3) for ct in (0, 1, 2)]


@pytest.mark.parametrize("late_rows", ["append", "rebuild", "merge"])
def test_sample_dated_ahead_hides_nothing(spark, late_rows):
    target = work_path(spark, "ahead")
    first = [*HISTORY, sample(20, 0, arrived=3)]
    run(spark, DAILY, "FULL_LOAD", source(spark, first), target, late_rows=late_rows)
    more = [sample(4, 0), sample(4, 1)]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, first + more), target, late_rows=late_rows)
    assert res.watermark == dt.datetime(2024, 1, 3) and res.rows_read == 2
    same_rows(gold.read_gold(spark, target), full(spark, first + more))


@pytest.mark.parametrize("late_rows", ["append", "rebuild", "merge"])
def test_late_only_partition_is_taken_once(spark, late_rows):
    target = work_path(spark, "late_only")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, late_rows=late_rows)
    rows = [*HISTORY, sample(2, 3, arrived=4)]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, late_rows=late_rows)
    # Also what was only appended to is listed.
    assert res.wrote and res.partitions == ["year=2024/month=1/day=2/"]
    again = run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, late_rows=late_rows)
    assert not again.wrote and again.watermark == dt.datetime(2024, 1, 4) and again.rows_read == 0
    if late_rows == "append":
        assert sorted(r["day"] for r in gold.read_gold(spark, target).collect()) == [1, 2, 2, 3]
    else:
        same_rows(gold.read_gold(spark, target), full(spark, rows))


def test_rejected_rows_move_the_mark(spark):
    target = work_path(spark, "rejected")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target)
    bad = [(None, *sample(4, 0)[1:])]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, HISTORY + bad), target)
    assert (res.wrote, res.rows_read, res.rows_rejected, res.partitions) == (False, 1, 1, [])
    assert run(spark, DAILY, "INCREMENTAL", source(spark, HISTORY + bad), target).rows_read == 0


def test_rebuild_holds_what_its_source_lacks(spark):
    """With old source partitions gone, a published day is left as it is, and the late row is counted."""
    target = work_path(spark, "expired")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target)
    late = [sample(1, 3, arrived=4), sample(4, 0)]
    left = [r for r in HISTORY if r[10] > 1]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, left + late), target, late_rows="rebuild")
    assert res.rows_held == 1 and res.partitions == ["year=2024/month=1/day=4/"]
    same_rows(gold.read_gold(spark, target), full(spark, [*HISTORY, sample(4, 0)]))


@pytest.mark.parametrize("ct", [3, -1])
def test_merge_needs_no_old_source(spark, ct):
    target = work_path(spark, "merge")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, late_rows="merge")
    late = [sample(1, ct, arrived=4, user=2), sample(1, 9, arrived=4), sample(4, 0)]
    late = [r if r[6] >= 0 else (*r[:3], dt.datetime(2024, 1, 1, 11), *r[4:]) for r in late]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, late), target, late_rows="merge")
    assert res.rows_held == 0
    same_rows(gold.read_gold(spark, target), full(spark, HISTORY + late))
    # What falls between merged samples later on.
    last = [sample(1, 5, arrived=5), sample(1, 7, arrived=5)]
    run(spark, DAILY, "INCREMENTAL", source(spark, last), target, late_rows="merge")
    same_rows(gold.read_gold(spark, target), full(spark, HISTORY + late + last))


def test_merge_holds_a_counter_that_came_twice(spark):
    target = work_path(spark, "twice")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, late_rows="merge")
    twice = [(*sample(1, 1, arrived=4)[:4], 36.0, *sample(1, 1, arrived=4)[5:]), sample(2, 3, arrived=4)]
    res = run(spark, DAILY, "INCREMENTAL", source(spark, twice), target, late_rows="merge")
    assert res.rows_held == 1
    same_rows(gold.read_gold(spark, target), full(spark, [*HISTORY, twice[1]]))
    assert spark.read.parquet(CommitLog(spark, target).run_path(2, "held")).count() == 1


def test_merge_picks_days_by_a_join(spark, monkeypatch):
    """No condition that grows with the number of touched days is put to the segments, and a lone one gets no predecessor."""
    read = []
    monkeypatch.setattr(job, "merged", lambda segments, *a, **b: read.append(segments) or merged(segments, *a, **b))
    target = work_path(spark, "days")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, late_rows="merge")
    late = [sample(d, 3, arrived=4) for d in (1, 3)]
    run(spark, DAILY, "INCREMENTAL", source(spark, late), target, late_rows="merge")
    same_rows(gold.read_gold(spark, target), full(spark, HISTORY + late))
    whole, some = [df._jdf.queryExecution().optimizedPlan().toString() for df in read]
    assert "Filter" not in whole and "Join" not in whole
    assert "Join LeftSemi" in some and "day#" in some and " = 1)" not in some and " IN (" not in some
    assert sorted({r["day"] for r in read[1].select("day").collect()}) == [1, 3]
    segments = bucket_segments(normalize(source(spark, HISTORY)), DAILY)._jdf.queryExecution().optimizedPlan().toString()
    assert segments.count("lag(latitude") == 1 and "row_number" not in segments


def test_merge_needs_its_state(spark):
    target = work_path(spark, "no_state")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target)
    with pytest.raises(ValueError):
        run(spark, DAILY, "INCREMENTAL", source(spark, HISTORY), target, late_rows="merge")
    with pytest.raises(ValueError):
        run(spark, DAILY, "INCREMENTAL", source(spark, HISTORY), target, late_rows="merge", reprocess_latest=True)


@pytest.mark.parametrize("died", ["before the record", "before publishing", "while publishing"])
def test_a_run_that_died(spark, monkeypatch, died):
    target = work_path(spark, "died")
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target)
    rows = [*HISTORY, sample(1, 3, arrived=4), sample(4, 0), sample(5, 0)]

    def stop(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if died == "before the record":
            m.setattr(CommitLog, "record", stop)
        elif died == "before publishing":
            m.setattr(job, "_publish", stop)
        else:
            m.setattr(CommitLog, "mark_published", stop)
        with pytest.raises(RuntimeError):
            run(spark, DAILY, "INCREMENTAL", source(spark, rows), target)
    for _ in range(2):
        run(spark, DAILY, "INCREMENTAL", source(spark, rows), target)
    want = full(spark, HISTORY).union(full(spark, rows[len(HISTORY) :]))
    same_rows(gold.read_gold(spark, target), want)
    assert len(CommitLog(spark, target).runs()) == 2


def test_catalog_by_the_change(spark, monkeypatch):
    """An incremental run registers its own partitions; the storage is listed only where the entry may lack others."""
    target, entry = work_path(spark, "delta"), {"database": "ds_test", "table": "delta_daily"}
    repairs = []
    whole = gold.register_table
    monkeypatch.setattr(gold, "register_table", lambda *a: repairs.append(1) or whole(*a))
    rows = [*HISTORY, sample(1, 3, arrived=4), sample(4, 0)]
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, **entry)
    assert len(repairs) == 1
    run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, **entry)
    run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, **entry)
    assert len(repairs) == 1 and spark.table("ds_test.delta_daily").count() == 5
    # A run that knew no table: all is repaired by the next.
    rows.append(sample(5, 0))
    run(spark, DAILY, "INCREMENTAL", source(spark, rows), target)
    run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, **entry)
    assert len(repairs) == 2 and spark.table("ds_test.delta_daily").count() == 6


def test_partitions_of_a_finished_run_reach_the_catalog(spark, monkeypatch):
    """The run that finishes another one's publishing, and has nothing new itself, registers what that one wrote."""
    target, entry = work_path(spark, "finished"), {"database": "ds_test", "table": "finished_daily"}
    run(spark, DAILY, "FULL_LOAD", source(spark, HISTORY), target, **entry)
    rows = [*HISTORY, sample(4, 0), sample(5, 0)]
    with monkeypatch.context() as m:
        m.setattr(job, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, **entry)
    assert not run(spark, DAILY, "INCREMENTAL", source(spark, rows), target, **entry).wrote
    assert spark.table("ds_test.finished_daily").count() == 5


def test_newest_partition_lists_one_directory_a_level(spark):
    target = work_path(spark, "newest")
    spark.createDataFrame([(y, m, d, "x") for y in (2022, 2023, 2024) for m in (1, 11, 2) for d in (3, 10)], "year int, month int, day int, t string").write.partitionBy(
        "year", "month", "day"
    ).text(target)
    listed: list[str] = []
    assert newest_partition(spark, target, DAILY.output_parts, listed) == dt.datetime(2024, 11, 10)
    assert len(listed) == 4
    # Without a log, an incremental run goes on from there.
    assert newest_partition(spark, target + "-none", DAILY.output_parts) is None


def test_rebuild_reads_the_partitions_of_the_runs_that_wrote(spark):
    """Day 5 was written by the second and the third run: the source of the first is pruned."""
    target, silver = work_path(spark, "pruned"), work_path(spark, "pruned_silver")
    rows = [*HISTORY, sample(4, 0), sample(5, 0), sample(6, 0), sample(5, 1, arrived=7)]
    source(spark, rows).write.partitionBy("year", "month", "day", "hour").parquet(silver)
    src = spark.read.parquet(silver)
    for day in (3, 5, 6):
        run(spark, DAILY, "INCREMENTAL", src.where(F.col("day") <= day), target, late_rows="rebuild")
    commits = CommitLog(spark, target)
    work = job._Work(spark, DAILY, commits, 4, target, 1.0, job.DEFAULT_THRESHOLDS, "blocks", "UTC")
    wanted = src.where(work._source_of([{"year": 2024, "month": 1, "day": 5}], commits.commit(3)))
    assert "PartitionFilters: [" in wanted._jdf.queryExecution().executedPlan().toString()
    assert sorted({r["day"] for r in wanted.collect()}) == [4, 5, 6, 7]
    res = run(spark, DAILY, "INCREMENTAL", src, target, late_rows="rebuild")
    assert res.partitions == ["year=2024/month=1/day=5/"] and res.rows_held == 0
    same_rows(gold.read_gold(spark, target), build_stats(src, DAILY))


def random_rows(seed, n, trips=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        d, ct = rnd.randint(1, 3), rnd.choice([None, rnd.randint(0, 40), rnd.randint(0, 4000)])
        row = list(sample(d, ct or 0, trip=rnd.choice([None, *map(str, range(trips))]), user=rnd.randint(1, 5)))
        row[3] = dt.datetime(2024, 1, d, rnd.choice([0, 5, 23]), rnd.randint(0, 59), 0)
        row[4], row[6] = rnd.choice([None, 35.0 + rnd.random()]), ct
        rows.append(tuple(row))
    return rows


@pytest.mark.parametrize("block_rows", [None, "20"])
def test_segments_hold_all_grains(spark, block_rows):
    """Any mix of hours, repeated counters, null ids and places: every table from the segments equals its own build."""
    if block_rows:
        spark.conf.set(CONF_BLOCK_ROWS, block_rows)
    try:
        pos = source(spark, random_rows(3, 400))
        segments = trip_segments(normalize(pos))
        for name, stats in build_many(segments, list(GRAINS)).items():
            same_rows(stats, build_stats(pos, name, strategy="window"))
    finally:
        spark.conf.unset(CONF_BLOCK_ROWS)


def test_state_merges_in_any_order(spark):
    """Samples with distinct counters dealt at random into three loads: merged segments equal one build."""
    rows = [sample(d, ct, trip=t, user=ct % 3) for t in "ab" for d in (1, 2) for ct in range(60) if ct % 11]
    rnd = random.Random(1)
    parts = [[], [], []]
    for r in rows:
        rnd.choice(parts).append(r)
    segments = None
    for p in parts:
        s = bucket_segments(normalize(source(spark, p)), DAILY)
        segments = s if segments is None else segments.unionByName(s)
    assert overlapping(segments, DAILY.bucket_keys).isEmpty()
    want = trip_metrics(normalize(source(spark, rows)), DAILY)
    same_rows(merged(segments, DAILY).select(*want.columns), want)
    # A regular trace is one row a gap.
    whole = bucket_segments(normalize(source(spark, rows)), DAILY)
    assert whole.count() == 2 * 2 * 6


def test_several_grains_from_one_scan(spark, sf_dir):
    pos = positions_e(spark, sf_dir)
    plan = trip_segments(normalize(pos))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1 and "Python" not in text
    root = work_path(spark, "several")
    results = run_full_many(spark, pos, {n: f"{root}/{n}" for n in ("hourly", "monthly")})
    assert results["hourly"].wrote and results["hourly"].rows_read == pos.count()
    same_rows(gold.read_gold(spark, f"{root}/hourly"), build_stats(pos, HOURLY))
    same_rows(gold.read_gold(spark, f"{root}/monthly"), build_stats(pos, MONTHLY))
    # Later runs go on from its mark.
    assert not run(spark, HOURLY, "INCREMENTAL", pos, f"{root}/hourly").wrote


def test_lone_samples_are_not_aggregated(spark):
    """A sample between two gaps is a segment as it is; only longer ones reach the aggregation of sets."""
    rows = [("t", 1, 2, "2024-01-01 00:00:01", 35.0, 139.0, ct, 5.0, 2024, 1, 1, 0) for ct in (1, 3, 4, 9)]
    rows += [("t", None, 2, "2024-01-01 00:00:01", None, 139.0, None, None, 2024, 1, 1, 0)] * 2
    columns = "trip_id string, user_id long, vehicle_id long, ts string, latitude double, longitude double, ct long, sp double, year int, month int, day int, hour int"
    out = bucket_segments(normalize(spark.createDataFrame(rows, columns)), DAILY)
    got = sorted(
        (r["first"]["ct"] or 0, r["last"]["ct"] or 0, r["samples"], r["total_driving_time"], r["size_of_latitude"], r["users"], r["vehicles"], r["_rows_distance_um"], r["_rows_acceleration_count"])
        for r in out.collect()
    )
    none = (0, 0, 1, 0, 0, [], [2], None, 0)
    assert got == [none, none, (1, 1, 1, 1, 1, [1], [2], None, 0), (3, 4, 2, 2, 2, [1], [2], 0, 0), (9, 9, 1, 1, 1, [1], [2], None, 0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_state_shuffles_follow_the_width(spark, tmp_path):
    """The state of one month is written by several tasks, and its segments are sorted in as many as the input asks for."""
    from drivestats.operators.pairs import CONF_PARTITIONS
    from drivestats.sources.gold import write_partitioned

    path = str(tmp_path / "state")
    df = spark.range(1000).selectExpr("2024 AS year", "1 AS month", "id")
    write_partitioned(df, path, ["year", "month"], False, ["id"], 4)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) == 4
    assert back.select("id").distinct().count() == 1000
    columns = "trip_id string, user_id long, vehicle_id long, ts string, latitude double, longitude double, ct long, sp double, year int, month int, day int, hour int"
    rows = [("t", 1, 2, "2024-01-01 00:00:01", 35.0, 139.0, ct, 5.0, 2024, 1, 1, 0) for ct in (1, 3, 4, 9)]
    segments = str(tmp_path / "segments")
    bucket_segments(normalize(spark.createDataFrame(rows, columns)), DAILY).write.parquet(segments)
    segments = spark.read.parquet(segments)
    keys = list(dict.fromkeys([*DAILY.output_parts, *DAILY.bucket_keys]))
    try:
        spark.conf.set(CONF_PARTITIONS, "7")
        for out in (overlapping(segments, keys), merged(segments, DAILY)):
            assert "7), REPARTITION_BY_NUM" in out._jdf.queryExecution().toString()
    finally:
        spark.conf.unset(CONF_PARTITIONS)
