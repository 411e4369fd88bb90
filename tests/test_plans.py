
from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from drivestats.operators.blocks import CONF_BLOCK_ROWS
from drivestats.operators.trips import trip_metrics
from drivestats.plans.grains import DAILY, HOURLY, MONTHLY
from drivestats.plans.stats import build_stats
from drivestats.sources.fixtures import positions_e, positions_l
from drivestats.sources.positions import normalize


def plan(df) -> str:
    """The final adaptive plan (after running), without the initial-plan section."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("grain", [HOURLY, DAILY, MONTHLY])
def test_sorted_stats_plan(spark, sf_dir, grain):
    src = positions_e if grain is HOURLY else positions_l
    p = plan(build_stats(src(spark, sf_dir), grain, strategy="sorted"))
    # One scan and one range exchange of the sample rows, shared (reused) by
    # the motion aggregate and the two distinct counts; one Arrow pass; no row-at-a-time
    # Python, no global sort, no join.
    lines = p.splitlines()
    assert sum("Exchange rangepartitioning" in x and "ReusedExchange" not in x for x in lines) == 1
    assert sum("ReusedExchange" in x for x in lines) == 2
    assert sum("FileScan" in x for x in lines) == 1
    assert p.count("MapInArrow") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p and "CartesianProduct" not in p
    # Each distinct count is an aggregate of its own, split by value before shuffling.
    assert "Expand" not in p


def test_window_strategy_has_no_python(spark, sf_dir):
    p = plan(build_stats(positions_e(spark, sf_dir), HOURLY, strategy="window"))
    assert "MapInArrow" not in p and "BatchEvalPython" not in p
    assert "rangepartitioning" not in p
    lines = p.splitlines()
    assert sum("FileScan" in x for x in lines) == 1
    # One shuffle of the samples (by trip bucket) and one of trip-bucket rows
    # (rollup); the distinct counts use local windows, not Expand.
    exchanges = [x for x in lines if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2, exchanges
    assert "Expand" not in p


def test_scan_is_pruned(spark, sf_dir):
    for strategy in ("blocks", "window", "sorted"):
        df = build_stats(positions_l(spark, sf_dir), DAILY, strategy=strategy)
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(df))
        assert scans
        if strategy == "blocks":  # the count per bucket reads keys only; the adaptive plan has dropped it
            assert len(scans) == 1
        for s in scans:
            cols = {c.split("#")[0] for c in s.split(",")}
            assert cols == {
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate",
            }


def test_construction_starts_no_job(spark, sf_dir):
    spark.sparkContext.setJobGroup("construction", "plans only")
    try:
        pos = positions_l(spark, sf_dir)
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("construction"))
        build_stats(pos, DAILY)
        assert set(spark.sparkContext.statusTracker().getJobIdsForGroup("construction")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unrounded_distances_do_not_depend_on_the_plan(spark):
    """Sums of whole numbers: both strategies give the same distances on sf0.1."""
    pos = normalize(positions_l(spark, "/root/testdata/sf0.1"))
    a, b = (
        trip_metrics(pos, DAILY, with_activity=False, with_events=False, strategy=s).select("date", "trip_id", "distance_m")
        for s in ("blocks", "window")
    )
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("grain", [HOURLY, DAILY, MONTHLY])
def test_default_plan_stays_in_the_jvm(spark, sf_dir, grain):
    """One scan and one shuffle of the samples, no Python, no range sampling, no Expand; no large bucket leaves no join."""
    src = positions_e if grain is HOURLY else positions_l
    p = plan(build_stats(src(spark, sf_dir), grain))
    lines = p.splitlines()
    assert not re.search("Python|Arrow|Pandas|rangepartitioning|Expand|Join", p), p
    assert sum("FileScan" in x for x in lines) == 1
    # Samples by (bucket, block), per-block rows by bucket, bucket rows by time bucket.
    exchanges = [x for x in lines if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 3 and sum("_block" in x for x in exchanges) == 1, exchanges


def test_large_buckets_are_cut(spark, sf_dir):
    """With few rows a block every bucket is cut: still no Python, the samples move by (bucket, block), the same results."""
    df = build_stats(positions_l(spark, sf_dir), DAILY)
    want = sorted(map(tuple, df.collect()))
    spark.conf.set(CONF_BLOCK_ROWS, "2")
    try:
        cut = build_stats(positions_l(spark, sf_dir), DAILY)
        p = plan(cut)
        assert sorted(map(tuple, cut.collect())) == want
    finally:
        spark.conf.unset(CONF_BLOCK_ROWS)
    assert "BroadcastHashJoin" in p and "_block" in p and not re.search("Python|Arrow|SortMergeJoin|Cartesian|NestedLoop", p)


def test_joins_never_broadcast_growing_sides(spark, sf_dir):
    from drivestats.operators.traces import trace_points
    from drivestats.plans.queries import registry

    p = plan(registry()["trip_events_joined"](spark, sf_dir))
    assert "SortMergeJoin" in p and "Broadcast" not in p
    # One bucket over many slices. The samples move once, by range; what is broadcast is one row per slice.
    one = normalize(positions_l(spark, sf_dir)).withColumns({"trip_id": F.lit("t"), "date": F.lit("2024-01-01").cast("date")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = plan(trace_points(one, DAILY, strategy="sorted"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = t.splitlines()
    assert sum("Exchange rangepartitioning" in x and "ReusedExchange" not in x for x in lines) == 1, t
    assert sum("ReusedExchange" in x for x in lines) == 1, t  # one range exchange feeds both sides
    assert "SortMergeJoin" not in t and "BroadcastHashJoin [_slice" in t
