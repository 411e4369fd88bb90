
from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drivestats.plans.grains import DAILY, HOURLY, MONTHLY
from drivestats.plans.stats import build_stats
from drivestats.sources.fixtures import positions_e, positions_l

SF001 = "/root/testdata/sf0.01"
TOTALS = [
    "trip_count", "user_count", "vehicle_count", "total_driving_time", "total_distance",
    "total_sudden_start_count", "total_sudden_stop_count", "total_acceleration_count", "total_deceleration_count",
]

# The table "Expected totals at sf0.01" of FIXTURES.md, in its column order.
EXPECTED = {
    ("hourly", "E"): (720, 2788, 9567, 7856, 1, 41240919, 453, 444, 2962, 2959),
    ("daily", "E"): (30, 120, 4006, 840, 167, 57003958, 615, 617, 4010, 4063),
    ("daily", "L"): (2499, 9971, 53307, 56591, 349, 244715081, 2753, 2871, 16417, 16426),
}


@pytest.mark.parametrize("strategy", ["window", "sorted", "blocks"])
@pytest.mark.parametrize("build", sorted(EXPECTED))
def test_expected_totals(spark, build, strategy):
    grain, fixture = build
    src = positions_e if fixture == "E" else positions_l
    df = build_stats(src(spark, SF001), {"hourly": HOURLY, "daily": DAILY}[grain], strategy=strategy)
    row = df.agg(F.count(F.lit(1)), *[F.sum(c) for c in TOTALS]).first()
    assert tuple(row) == EXPECTED[build]


SCHEMA = (
    "trip_id string, user_id long, vehicle_id long, ts timestamp_ntz, latitude double, longitude double, "
    "ct long, sp double, year int, month int, day int, hour int"
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.integers(1, 3),
            st.integers(0, 47),  # hour offset over two days
            st.one_of(st.none(), st.floats(35.0, 35.5, allow_nan=False)),
            st.one_of(st.none(), st.integers(0, 20)),
            st.sampled_from([0.0, 3.0, 12.5, 30.0, 55.0]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_random_positions_both_plans_agree(spark, rows):
    import datetime as dt

    t0 = dt.datetime(2024, 2, 28, 0, 0, 0)
    data = []
    for trip, user, h, lat, ct, sp in rows:
        ts = t0 + dt.timedelta(hours=h, minutes=(ct or 0))
        data.append((trip, user, user % 2, ts, lat, 139.0, ct, sp, ts.year, ts.month, ts.day, ts.hour))
    pos = spark.createDataFrame(data, SCHEMA)
    for grain in (HOURLY, MONTHLY):
        a = build_stats(pos, grain, strategy="window")
        b = build_stats(pos, grain, strategy="sorted")
        cols = sorted(a.columns)
        key = lambda r: tuple((x is None, str(x)) for x in r)
        ra = sorted(map(tuple, a.select(*cols).collect()), key=key)
        rb = sorted(map(tuple, b.select(*cols).collect()), key=key)
        assert ra == rb, grain.name
