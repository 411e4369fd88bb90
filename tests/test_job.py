"""End-to-end refresh: full and incremental loads, fallbacks, sink and catalog."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from drivestats.functions.timeparts import partition_after
from drivestats.operators.partitions import latest_partition_time
from drivestats.plans.grains import DAILY, HOURLY, MONTHLY
from drivestats.plans.job import run, validate_load_type
from drivestats.plans.stats import build_stats
from drivestats.session import work_path
from drivestats.sources import gold
from drivestats.sources.fixtures import positions_e
from drivestats.sources.positions import POSITIONS_SCHEMA
from tests.oracle_compare import _rows


def same_rows(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert _rows(cols, [tuple(r) for r in a.select(*cols).collect()]) == _rows(cols, [tuple(r) for r in b.select(*cols).collect()])


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    """Fixture E written as a Hive-partitioned silver table (year/month/day/hour)."""
    path = work_path(spark, "silver_e")
    positions_e(spark, sf_dir).write.partitionBy("year", "month", "day", "hour").parquet(path)
    return path


def test_load_type_validation():
    assert validate_load_type("FULL_LOAD") == "FULL_LOAD"
    with pytest.raises(ValueError):
        validate_load_type("DELTA")


def test_full_load_roundtrip(spark, silver):
    target = work_path(spark, "t_full")
    res = run(spark, HOURLY, "FULL_LOAD", silver, target)
    assert res.wrote and res.load_type == "FULL_LOAD"
    same_rows(gold.read_gold(spark, target), build_stats(spark.read.parquet(silver), HOURLY))


def test_incremental_without_history_falls_back(spark, silver):
    target = work_path(spark, "t_fallback")
    res = run(spark, DAILY, "INCREMENTAL", silver, target)
    assert res.load_type == "FULL_LOAD" and res.watermark is None


def test_empty_history_folder_means_full_load(spark, silver):
    target = tempfile.mkdtemp(prefix="drivestats-empty-")
    open(os.path.join(target, "_SUCCESS"), "w").close()
    res = run(spark, DAILY, "INCREMENTAL", silver, target)
    assert res.load_type == "FULL_LOAD" and res.wrote


@pytest.mark.parametrize("grain,cutoff", [(HOURLY, "2024-01-12 07:00:00"), (DAILY, "2024-01-12 00:00:00")])
def test_history_plus_incremental_equals_full(spark, silver, grain, cutoff):
    target = work_path(spark, f"t_inc_{grain.name}")
    src = spark.read.parquet(silver)
    history = src.where(~partition_after(grain.source_parts, dt.datetime.fromisoformat(cutoff)))
    run(spark, grain, "FULL_LOAD", history, target)
    res = run(spark, grain, "INCREMENTAL", silver, target)
    assert res.load_type == "INCREMENTAL" and res.wrote
    assert res.watermark == dt.datetime.fromisoformat(cutoff)
    assert len(res.partitions) > 0
    same_rows(gold.read_gold(spark, target), build_stats(src, grain))
    # Nothing new on a second run: short circuit, nothing written.
    again = run(spark, grain, "INCREMENTAL", silver, target)
    assert not again.wrote


def test_reprocess_latest_is_idempotent(spark, silver):
    target = work_path(spark, "t_reprocess")
    run(spark, DAILY, "FULL_LOAD", silver, target)
    res = run(spark, DAILY, "INCREMENTAL", silver, target, reprocess_latest=True)
    assert res.wrote
    same_rows(gold.read_gold(spark, target), build_stats(spark.read.parquet(silver), DAILY))


def test_catalog_registration_full_then_incremental(spark, silver):
    target = work_path(spark, "t_catalog")
    src = spark.read.parquet(silver)
    history = src.where(~partition_after(DAILY.source_parts, dt.datetime(2024, 1, 20)))
    run(spark, DAILY, "FULL_LOAD", history, target, database="ds_test", table="daily_stat")
    assert spark.catalog.tableExists("ds_test.daily_stat")
    n_hist = spark.table("ds_test.daily_stat").count()
    res = run(spark, DAILY, "INCREMENTAL", silver, target, database="ds_test", table="daily_stat")
    assert res.load_type == "INCREMENTAL"
    parts = spark.sql("SHOW PARTITIONS ds_test.daily_stat").count()
    assert parts == 30 and spark.table("ds_test.daily_stat").count() == 30 > n_hist


def test_catalog_missing_means_no_history(spark, silver):
    target = work_path(spark, "t_nocat")
    run(spark, MONTHLY, "FULL_LOAD", silver, target)
    assert not gold.target_exists(spark, target, "ds_test", "no_such_table")
    assert gold.target_exists(spark, target)


def test_incremental_filter_prunes_partitions(spark, silver):
    df = spark.read.parquet(silver).where(partition_after(HOURLY.source_parts, dt.datetime(2024, 1, 15, 11)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    src = spark.read.parquet(silver)
    want = src.where(F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0)) > F.lit(dt.datetime(2024, 1, 15, 11)).cast("timestamp_ntz"))
    assert df.count() == want.count()


def test_catalog_repaired_after_unregistered_write(spark, silver):
    """A run that wrote but died before registering is repaired by the next (no-op) run."""
    target = work_path(spark, "t_repair")
    src = spark.read.parquet(silver)
    history = src.where(~partition_after(DAILY.source_parts, dt.datetime(2024, 1, 20)))
    run(spark, DAILY, "FULL_LOAD", history, target, database="ds_test", table="daily_repair")
    # Simulate the crash: publish the rest without touching the catalog.
    run(spark, DAILY, "INCREMENTAL", silver, target)
    assert spark.table("ds_test.daily_repair").count() < 30
    res = run(spark, DAILY, "INCREMENTAL", silver, target, database="ds_test", table="daily_repair")
    assert not res.wrote
    assert spark.table("ds_test.daily_repair").count() == 30


@pytest.mark.parametrize("strategy", ["blocks", "sorted"])
def test_history_plus_incremental_equals_full_sliced(spark, silver, strategy):
    target = work_path(spark, f"t_inc_sliced_{strategy}")
    src = spark.read.parquet(silver)
    history = src.where(~partition_after(HOURLY.source_parts, dt.datetime(2024, 1, 9, 13)))
    kw = {"strategy": strategy}
    run(spark, HOURLY, "FULL_LOAD", history, target, **kw)
    run(spark, HOURLY, "INCREMENTAL", silver, target, **kw)
    same_rows(gold.read_gold(spark, target), build_stats(src, HOURLY, strategy="window"))


def test_command_line_entry(spark, silver):
    from drivestats.__main__ import main

    target = work_path(spark, "t_cli")
    out = main(["monthly", "INCREMENTAL", "--source", silver, "--target", target], spark=spark)
    assert out["load_type"] == "FULL_LOAD" and out["wrote"]
    again = main(["monthly", "INCREMENTAL", "--source", silver, "--target", target], spark=spark)
    assert again["load_type"] == "INCREMENTAL" and not again["wrote"]
    with pytest.raises(ValueError):
        main(["monthly", "NIGHTLY", "--source", silver, "--target", target], spark=spark)


def test_incremental_filter_pushed_to_flat_parquet(spark, sf_dir):
    """Without Hive partitions, the partition-tuple predicate still reaches the scan as pushed filters."""
    flat = work_path(spark, "silver_flat")
    positions_e(spark, sf_dir).write.parquet(flat)
    df = spark.read.parquet(flat).where(partition_after(HOURLY.source_parts, dt.datetime(2024, 1, 15, 11)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]  # the plan string truncates long filter lists
    assert "Or(GreaterThan(year,2024),And(EqualTo(year,2024),Or(GreaterThan(month,1)" in pushed


def _day(d, ct, arrived=None):
    """One sample at noon of January ``d``, in the source partition of day ``arrived``."""
    return ("t", 1, 1, dt.datetime(2024, 1, d, 12, 0, ct), 35.0 + ct * 0.001, 139.0, ct, 10.0, 2024, 1, arrived or d, 12)


def _source(spark, rows):
    return spark.createDataFrame(rows, POSITIONS_SCHEMA)


@pytest.mark.parametrize("mode", [{"reprocess_latest": True}, {"late_rows": "rebuild"}])
def test_late_samples_rebuild_their_bucket(spark, mode):
    """A sample of 1 January that arrives on the 4th: the published day is built again, not replaced by it."""
    target = work_path(spark, "t_late")
    history = [_day(d, ct) for d in (1, 2, 3) for ct in (0, 1)]
    late = [_day(1, 2, arrived=4), _day(4, 0)]
    run(spark, DAILY, "FULL_LOAD", _source(spark, history), target)
    res = run(spark, DAILY, "INCREMENTAL", _source(spark, history + late), target, **mode)
    assert res.wrote and "year=2024/month=1/day=1/" in res.partitions
    same_rows(gold.read_gold(spark, target), build_stats(_source(spark, history + late), DAILY))


def test_late_samples_of_an_unpublished_day_reach_the_catalog(spark):
    target = work_path(spark, "t_late_day")
    entry = {"database": "ds_test", "table": "late_day"}
    history = [_day(d, 0) for d in (1, 3)]
    run(spark, DAILY, "FULL_LOAD", _source(spark, history), target, **entry)
    run(spark, DAILY, "INCREMENTAL", _source(spark, [*history, _day(2, 0, arrived=4), _day(4, 0)]), target, **entry)
    assert sorted(r["day"] for r in spark.table("ds_test.late_day").collect()) == [1, 2, 3, 4]


def test_unusable_rows_are_counted_and_empty_nothing(spark):
    """A full load without one usable row leaves the published table as it is."""
    target = work_path(spark, "t_unusable")
    entry = {"database": "ds_test", "table": "unusable"}
    bad = [(None, *_day(1, 0)[1:])]
    res = run(spark, DAILY, "FULL_LOAD", _source(spark, bad), target, **entry)
    assert (res.wrote, res.rows_read, res.rows_rejected, res.table) == (False, 1, 1, None)
    res = run(spark, DAILY, "FULL_LOAD", _source(spark, [_day(1, 0), *bad]), target, **entry)
    assert (res.wrote, res.rows_read, res.rows_rejected) == (True, 2, 1)
    assert not run(spark, DAILY, "FULL_LOAD", _source(spark, bad), target, **entry).wrote
    assert spark.table("ds_test.unusable").count() == 1


def test_watermark_opens_no_parquet_file(spark):
    """The published partitions come from the directory tree: files that are no Parquet do not matter."""
    target = work_path(spark, "t_tree")
    spark.createDataFrame([(2024, 1, 5, "x"), (2024, 2, 1, "y")], "year int, month int, day int, t string").write.partitionBy(
        "year", "month", "day"
    ).text(target)
    found = gold.published_partitions(spark, target, DAILY.output_parts)
    assert [tuple(r) for r in found.collect()] == [(2024, 1, 5), (2024, 2, 1)]
    assert latest_partition_time(found, DAILY.output_parts) == dt.datetime(2024, 2, 1)


def test_unknown_late_rows(spark):
    with pytest.raises(ValueError):
        run(spark, DAILY, "FULL_LOAD", _source(spark, []), "unused", late_rows="drop")
