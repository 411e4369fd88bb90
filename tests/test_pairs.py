"""The ordered-pair operator: both strategies against a plain-Python model, skew and nulls."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drivestats.functions.motion import CARRIED, distance_measure, event_measures
from drivestats.operators.blocks import CONF_BLOCK_ROWS, in_blocks
from drivestats.operators.pairs import ordered_pair_sums
from tests.brute import pair_sums

SCHEMA = "g string, ct long, latitude double, longitude double, s double"
KEYS = ["g"]
ORDER = ["ct", "latitude", "longitude", "s"]
MEASURES = [distance_measure(), *event_measures()]


def _run(spark, rows, strategy):
    df = spark.createDataFrame(rows, SCHEMA)
    out = ordered_pair_sums(df, KEYS, ORDER, CARRIED, MEASURES, strategy=strategy)
    return {(r["g"],): r.asDict() for r in out.collect()}


def _check(spark, rows):
    dicts = [dict(zip(["g", "ct", "latitude", "longitude", "s"], r)) for r in rows]
    want = pair_sums(dicts, KEYS, ORDER)
    assert _run(spark, rows, "sorted") == _run(spark, rows, "window") == _run(spark, rows, "blocks")
    for strategy in ("blocks", "sorted", "window"):
        got = _run(spark, rows, strategy)
        assert set(got) == set(want), strategy
        for g, w in want.items():
            for k, v in w.items():
                # Python and the JVM may differ in the last digit of a sine: a few micrometres.
                assert got[g][k] == pytest.approx(v, rel=1e-9, abs=3), (strategy, g, k)


def test_simple_trip(spark):
    rows = [("a", i, 35.0 + i * 0.001, 139.0, float(s)) for i, s in enumerate([0, 25, 40, 20, 3, 3.5])]
    rows += [("b", 1, 35.0, 139.0, 10.0)]  # single point: zero everything
    _check(spark, rows)


def test_nulls_break_pairs(spark):
    rows = [
        ("a", 1, 35.0, 139.0, 0.0),
        ("a", 2, None, 139.1, 30.0),  # null latitude: both adjacent distance pairs skipped
        ("a", 3, 35.2, 139.2, None),  # null speed: both adjacent speed pairs skipped
        ("a", None, 35.3, 139.3, 50.0),  # null counter sorts first
        ("a", 4, 35.4, 139.4, 4.0),
        (None, 1, 35.0, 139.0, 1.0),  # null group is a group
        (None, 2, 35.1, 139.0, 30.0),
    ]
    _check(spark, rows)


def test_ties_on_counter(spark):
    rows = [("a", 1, 35.0, 139.0, 0.0), ("a", 1, 35.5, 139.0, 30.0), ("a", 1, 35.5, 139.0, 30.0), ("a", 2, 35.1, 139.0, 5.0)]
    _check(spark, rows)


def test_hot_group_spans_many_slices(spark):
    """One group holds most rows; it must be cut into several slices and stitched exactly."""
    rnd = random.Random(7)
    rows = [("hot", i, 35.0 + rnd.random(), 139.0 + rnd.random(), round(rnd.uniform(0, 60), 2)) for i in range(6000)]
    rows += [(f"c{j}", i, 35.0 + rnd.random(), 139.0, round(rnd.uniform(0, 60), 2)) for j in range(20) for i in range(5)]
    # Duplicated counters inside the hot group (a collapsed default trip id).
    rows += [("hot", 100, 35.0 + rnd.random(), 139.5, round(rnd.uniform(0, 60), 2)) for _ in range(500)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        sk = [F.col(c).asc_nulls_first() for c in KEYS + ORDER]
        slices = (
            df.repartitionByRange(*sk).select("g", F.spark_partition_id().alias("p"))
            .where("g = 'hot'").select("p").distinct().count()
        )
        assert slices >= 8
        _check(spark, rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c", None]),
            st.one_of(st.none(), st.integers(0, 30)),
            st.one_of(st.none(), st.floats(34.0, 36.0, allow_nan=False)),
            st.floats(138.0, 140.0, allow_nan=False),
            st.one_of(st.none(), st.sampled_from([0.0, 2.5, 4.0, 5.0, 12.0, 25.0, 30.5, 60.0])),
        ),
        min_size=0,
        max_size=60,
    )
)
def test_random_inputs_match_model(spark, rows):
    _check(spark, rows)


def test_hot_group_is_cut_into_blocks(spark):
    """A group with most rows, a counter and one whole sample repeated in it: many blocks, none of them large, the same sums."""
    rnd = random.Random(11)
    rows = [("hot", rnd.choice([None, i, i, 7]), 35.0 + rnd.random(), 139.0, round(rnd.uniform(0, 60), 2)) for i in range(3000)]
    rows += [("hot", 7, 35.5, 139.5, 20.0)] * 900 + [(None, 7, 35.5, 139.5, float(i % 40)) for i in range(700)]
    rows += [(f"c{j}", i, 35.0 + rnd.random(), 139.0, round(rnd.uniform(0, 60), 2)) for j in range(20) for i in range(5)]
    spark.conf.set(CONF_BLOCK_ROWS, "100")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(6, "ct", "s", "latitude")
        blocks = in_blocks(df, KEYS, ORDER).groupBy("g", "_block").count().collect()
        assert {r["g"] for r in blocks if r["_block"] > 0} == {"hot", None}
        assert sum(r["g"] == "hot" for r in blocks) > 20 and sum(r["g"] is None for r in blocks) > 3
        _check(spark, rows)
        users = df.withColumns({"u": F.pmod(F.xxhash64("latitude"), F.lit(97)), "v": F.pmod(F.col("ct"), F.lit(5))})
        counted = [
            sorted(map(tuple, ordered_pair_sums(users, KEYS, ORDER, CARRIED, MEASURES, strategy=s, counts={"n": "ct"}, distinct_counts={"us": "u", "vs": "v"}).collect()), key=str)
            for s in ("blocks", "window")
        ]
        assert counted[0] == counted[1]
    finally:
        spark.conf.unset(CONF_BLOCK_ROWS)


def test_shuffle_width_above_running_tasks(spark, tmp_path):
    """A task gets about ``bytesPerTask`` of the input as soon as not all tasks run at once, and its share is not coalesced."""
    from drivestats.operators.pairs import CONF_BYTES_PER_TASK, DEFAULT_BYTES_PER_TASK, shuffle_width

    assert DEFAULT_BYTES_PER_TASK <= 8 * 1024 * 1024
    path = str(tmp_path / "samples")
    rows = [("a", i, 35.0, 139.0 + i * 1e-4, float(i % 50)) for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    at_once, session = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = at_once + 2
    assert wanted <= session
    try:
        spark.conf.set(CONF_BYTES_PER_TASK, str(-(-size // wanted)))
        assert shuffle_width(stored) == wanted
        assert stored.repartition(shuffle_width(stored), *KEYS).rdd.getNumPartitions() == wanted
        spark.conf.set(CONF_BYTES_PER_TASK, str(-(-size // at_once)))
        assert shuffle_width(stored) is None
    finally:
        spark.conf.unset(CONF_BYTES_PER_TASK)


def test_small_tasks_on_both_sides_of_the_sample_shuffle(spark, tmp_path, sf_dir):
    """9 MB of samples are more than four tasks' worth, and the registered statistics read small splits; the training-data operators don't."""
    import __spark_entry__ as entry
    from drivestats.operators.pairs import shuffle_width
    from drivestats.session import CONF_SPLIT_BYTES

    path = str(tmp_path / "samples")
    spark.range(0, 1_200_000, 1, 1).select(F.rand(3).alias("s")).write.parquet(path)
    assert 4 < shuffle_width(spark.read.parquet(path)) < 10
    before = spark.conf.get(CONF_SPLIT_BYTES)
    try:
        spark.conf.unset(CONF_SPLIT_BYTES)
        own = spark.conf.get(CONF_SPLIT_BYTES)
        queries = entry.queries()
        queries["daily_stats"](spark, sf_dir)
        assert int(spark.conf.get(CONF_SPLIT_BYTES)) <= 16 * 1024 * 1024
        queries["op3_quality"](spark, sf_dir)
        assert spark.conf.get(CONF_SPLIT_BYTES) == own
    finally:
        spark.conf.set(CONF_SPLIT_BYTES, before)


def test_shuffle_width(spark, tmp_path):
    """Width from the settings or from file sizes the planner knows, never from a job or a cap."""
    from drivestats.operators.pairs import CONF_BYTES_PER_TASK, CONF_PARTITIONS, shuffle_width

    rows = [("a", i, 35.0, 139.0 + i * 1e-4, float(i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert shuffle_width(df) is None  # unknown size: the session's partitions
    path = str(tmp_path / "samples")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    assert shuffle_width(stored) is None  # small: the session's partitions
    try:
        spark.conf.set(CONF_BYTES_PER_TASK, "100")
        wide = shuffle_width(stored)
        assert wide > 100
        out = ordered_pair_sums(stored, KEYS, ORDER, CARRIED, MEASURES)
        narrow = ordered_pair_sums(df, KEYS, ORDER, CARRIED, MEASURES)
        assert [tuple(r) for r in out.collect()] == [tuple(r) for r in narrow.collect()]
        spark.conf.set(CONF_PARTITIONS, "7")
        assert shuffle_width(stored) == 7
    finally:
        spark.conf.unset(CONF_BYTES_PER_TASK)
        spark.conf.unset(CONF_PARTITIONS)


def test_group_counts(spark):
    from drivestats.operators.pairs import group_counts

    df = spark.createDataFrame([("a", 1, 1, 5), ("a", 1, 2, None), ("a", None, 2, 7), (None, 3, None, 1)], "g string, u int, v int, x int")
    got = group_counts(df, ["g"], {"n": "x"}, {"users": "u", "vehicles": "v"})
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, 2, 2), (None, 1, 0, 1)]
    assert sorted(map(tuple, group_counts(df, ["g"], {"n": "x"}, {"users": "u"}).collect()), key=str) == [("a", 1, 2), (None, 1, 1)]


def test_unknown_strategy(spark):
    df = spark.createDataFrame([("a", 1, 35.0, 139.0, 1.0)], SCHEMA)
    with pytest.raises(ValueError):
        ordered_pair_sums(df, KEYS, ORDER, CARRIED, MEASURES, strategy="nope")


def test_arrow_helper_runs_without_the_package(tmp_path):
    """Executors need no copy of drivestats: the helper is pickled by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from drivestats.operators import _slice_scan

    blob = tmp_path / "helper.pkl"
    blob.write_bytes(cloudpickle.dumps(_slice_scan.slice_neighbours(["g"], ["x"])))
    code = (
        "import sys, pickle, pyarrow as pa\n"
        "sys.path = [p for p in sys.path if p not in ('', '.') and 'repo' not in p]\n"
        "try:\n    import drivestats\n    raise SystemExit('package visible')\nexcept ImportError:\n    pass\n"
        f"f = pickle.load(open({str(blob)!r}, 'rb'))\n"
        "b = pa.RecordBatch.from_arrays([pa.array(['a', 'a', 'b']), pa.array([1.0, 2.0, 3.0])], names=['g', 'x'])\n"
        "out = list(f(iter([b])))[0].to_pydict()\n"
        "assert out['prev_x'] == [None, 1.0, None] and out['_last'] == [False, True, True], out\n"
    )
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=120)
    assert res.returncode == 0, res.stderr + res.stdout
