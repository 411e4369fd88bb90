"""Oracle SQL for DuckDB, one statement per registered query.

Written independently of the Spark plans: a plain window over each whole trip
bucket (no slicing), partition-start timestamps instead of tuple predicates,
``ORDER BY ... LIMIT 1`` instead of ``max(struct)``. Arithmetic is spelled in
the same operation order as the Spark expressions so both engines do the same
floating-point steps; every output column is cast to the Spark type. Key sets,
column lists, thresholds and constants are spelled out here and not taken from
the package, so a wrong one there shows.
"""

from __future__ import annotations

from typing import NamedTuple


class Table(NamedTuple):
    """One published table, in literals."""

    time_keys: tuple[str, ...]
    parts: tuple[str, ...]
    output_cols: tuple[str, ...]
    with_events: bool = True
    keep_null_trip: bool = False
    year_month: str | None = None

    @property
    def trip_keys(self) -> tuple[str, ...]:
        return (*self.time_keys, "trip_id")


_EVENT_OUTPUT = (
    "total_sudden_start_count, total_sudden_stop_count, total_acceleration_count, total_deceleration_count, "
    "avg_distance, avg_driving_time, avg_sudden_start_count, avg_sudden_stop_count, avg_acceleration_count, "
    "avg_deceleration_count"
)
_TOTALS = "trip_count, user_count, vehicle_count, total_driving_time, total_distance"


def _columns(text: str) -> tuple[str, ...]:
    return tuple(text.split(", "))


HOURLY = Table(
    ("date", "hour"), ("year", "month", "day", "hour"), _columns(f"date, year, month, day, hour, {_TOTALS}, {_EVENT_OUTPUT}")
)
DAILY = Table(
    ("date", "day"), ("year", "month", "day"),
    _columns(f"date, year, month, day, year_month, {_TOTALS}, {_EVENT_OUTPUT}"), year_month="unpadded",
)
MONTHLY = Table(
    ("date", "month"), ("year", "month"), _columns(f"year_month, year, month, {_TOTALS}, avg_distance"),
    with_events=False, keep_null_trip=True, year_month="unpadded",
)
MONTHLY_CALENDAR = MONTHLY._replace(time_keys=("year", "month"), year_month="padded")

_PARTS = """CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour"""


def positions_e(null_trip_for_errors: bool = False) -> str:
    trip = "concat(CAST(user_id % 4 AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR))"
    if null_trip_for_errors:
        trip = f"CASE WHEN event_type <> 'error' THEN {trip} END"
    return f"""SELECT CAST({trip} AS VARCHAR) AS trip_id,
       CAST(user_id AS BIGINT) AS user_id,
       CAST(user_id % 7 AS BIGINT) AS vehicle_id,
       CAST(ts AS TIMESTAMP) AS ts,
       35.0e0 + value / 1000.0e0 AS latitude,
       139.0e0 + (event_id % 97) / 1000.0e0 AS longitude,
       CAST(event_id AS BIGINT) AS ct,
       least(value, 180.0e0) AS sp,
       {_PARTS}
FROM events"""


def positions_l() -> str:
    return f"""SELECT CAST(concat(CAST(l_suppkey % 4 AS VARCHAR), '-', CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS VARCHAR) AS trip_id,
       CAST(l_suppkey AS BIGINT) AS user_id,
       CAST(l_partkey % 50 AS BIGINT) AS vehicle_id,
       CAST(l_shipdate AS TIMESTAMP) AS ts,
       35.0e0 + l_discount AS latitude,
       139.0e0 + l_tax AS longitude,
       CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS ct,
       l_quantity AS sp,
       {_PARTS.replace('ts)', 'l_shipdate)')}
FROM lineitem"""


def _norm(pos_cte: str) -> str:
    return f"""SELECT trip_id, user_id, vehicle_id, ts, latitude, longitude, ct, sp,
       CAST(ts AS DATE) AS date,
       {_PARTS}
FROM {pos_cte}"""


def _key_filter(g: Table) -> str:
    conds = [f"{k} IS NOT NULL" for k in g.time_keys]
    if not g.keep_null_trip:
        conds.append("trip_id IS NOT NULL")
    return " AND ".join(conds)


_K = "0.017453292519943295e0"  # degrees to radians
_D = "12742017.6e0"  # diameter of the Earth in metres


def _f(x: float) -> str:
    return f"{x!r}e0"


_DIST = f"""CASE WHEN p_lat IS NOT NULL AND p_lon IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
            THEN {_D} * asin(least(1.0e0, sqrt(
                 sin((latitude - p_lat) * {_K} / 2.0e0) * sin((latitude - p_lat) * {_K} / 2.0e0)
                 + cos(p_lat * {_K}) * cos(latitude * {_K})
                   * sin((longitude - p_lon) * {_K} / 2.0e0) * sin((longitude - p_lon) * {_K} / 2.0e0))))
       END"""

_EVENTS = {
    "total_sudden_start_count": "p_s <= 5.0e0 AND s - p_s >= 20.0e0",
    "total_sudden_stop_count": "s <= 5.0e0 AND s - p_s <= -20.0e0",
    "total_acceleration_count": "s - p_s >= 10.0e0",
    "total_deceleration_count": "s - p_s <= -10.0e0",
}


def trip_sql(norm: str, g: Table, activity=True, distance=True, events=None) -> str:
    """Trip-bucket rows for grain ``g`` over the normalised positions query ``norm``."""
    events = g.with_events if events is None else events
    keys = ", ".join(g.trip_keys)
    cols = []
    if activity:
        cols += [
            "CAST(count(DISTINCT user_id) AS BIGINT) AS user_count",
            "CAST(count(DISTINCT vehicle_id) AS BIGINT) AS vehicle_count",
            "CAST(count(ct) AS BIGINT) AS total_driving_time",
            "CAST(count(latitude) AS BIGINT) AS size_of_latitude",
        ]
    if distance:
        # Whole micrometres per pair, whole metres per bucket, both half-up.
        um = f"coalesce(sum(CAST(floor({_DIST} * 1000000.0e0 + 0.5e0) AS BIGINT)), 0)"
        cols.append(f"CAST(({um} + 500000) // 1000000 AS BIGINT) AS total_distance")
    if events:
        cols += [f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}" for name, cond in _EVENTS.items()]
    return f"""SELECT {keys}, {', '.join(cols)}
FROM (
  SELECT *, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon, lag(s) OVER w AS p_s
  FROM (SELECT *, round(sp, 2) AS s FROM ({norm}) WHERE {_key_filter(g)})
  WINDOW w AS (PARTITION BY {keys}
               ORDER BY ct ASC NULLS FIRST, ts ASC NULLS FIRST, latitude ASC NULLS FIRST,
                        longitude ASC NULLS FIRST, s ASC NULLS FIRST)
)
GROUP BY {keys}"""


def traces_sql(norm: str, g: Table) -> str:
    keys = ", ".join(g.trip_keys)
    return f"""SELECT {keys},
       CAST(row_number() OVER (PARTITION BY {keys}
            ORDER BY ct ASC NULLS FIRST, ts ASC NULLS FIRST, latitude ASC NULLS FIRST,
                     longitude ASC NULLS FIRST, sp ASC NULLS FIRST) AS BIGINT) AS seq,
       ct, ts, latitude, longitude, sp
FROM ({norm}) WHERE {_key_filter(g)}"""


def _avg(total: str) -> str:
    return f"CASE WHEN trip_count = 0 THEN NULL ELSE CAST({total} AS DOUBLE) / CAST(trip_count AS DOUBLE) END"


def stats_sql(pos: str, g: Table, sample_seconds: float = 1.0) -> str:
    norm = _norm(f"({pos})")
    trips = trip_sql(norm, g)
    keys = ", ".join(g.time_keys)
    totals = [
        "CAST(count(trip_id) AS BIGINT) AS trip_count",
        "CAST(sum(user_count) AS BIGINT) AS user_count",
        "CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count",
        f"CAST(round(sum(total_driving_time) * {_f(float(sample_seconds))} / 60.0e0) AS BIGINT) AS total_driving_time",
        "CAST(sum(total_distance) AS BIGINT) AS total_distance",
    ]
    if g.with_events:
        totals += [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _EVENTS]
    derived = {
        "year": "CAST(year(date) AS INTEGER)",
        "month": "CAST(month(date) AS INTEGER)",
        "day": "CAST(day(date) AS INTEGER)",
    }
    extra = [f"{e} AS {p}" for p, e in derived.items() if p not in g.time_keys and p in g.output_cols]
    avgs = {"avg_distance": _avg("total_distance")}
    if g.with_events:
        avgs["avg_driving_time"] = _avg("total_driving_time")
        for c in _EVENTS:
            avgs[c.replace("total_", "avg_")] = _avg(c)
    if g.year_month == "unpadded":
        avgs["year_month"] = "concat(CAST(year AS VARCHAR), CAST(month AS VARCHAR))"
    elif g.year_month == "padded":
        avgs["year_month"] = "concat(lpad(CAST(year AS VARCHAR), 4, '0'), '-', lpad(CAST(month AS VARCHAR), 2, '0'))"
    inner = f"""SELECT {keys}, {', '.join(totals)}
  FROM ({trips}) GROUP BY {keys}"""
    shaped = f"SELECT *{', ' if extra else ''}{', '.join(extra)} FROM ({inner})"
    final = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in avgs.items())} FROM ({shaped})"
    return f"SELECT {', '.join(g.output_cols)} FROM ({final})"


def _partition_time(parts: tuple[str, ...], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    month = f"{p}month" if "month" in parts else "1"
    day = f"{p}day" if "day" in parts else "1"
    hour = f"{p}hour" if "hour" in parts else "0"
    return f"make_timestamp({p}year, {month}, {day}, {hour}, 0, 0.0)"


def incremental_rows_sql(pos: str, parts: tuple[str, ...], watermark: str) -> str:
    return f"SELECT * FROM ({pos}) WHERE {_partition_time(parts)} > TIMESTAMP '{watermark}'"


def has_new_data_sql(pos: str) -> str:
    return f"""WITH p AS ({pos}),
m AS (SELECT DISTINCT year, month FROM p)
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       CAST(make_timestamp(year, month, 1, 0, 0, 0.0) AS TIMESTAMP) AS watermark,
       EXISTS (SELECT 1 FROM p WHERE {_partition_time(('year', 'month'), 'p')} > {_partition_time(('year', 'month'), 'm')})
         AS has_new_data
FROM m"""


def latest_partition_sql(stats: str, parts: tuple[str, ...]) -> str:
    cols = ", ".join(parts)
    order = ", ".join(f"{c} DESC" for c in parts)
    return f"""SELECT {cols}, CAST({_partition_time(parts)} AS TIMESTAMP) AS watermark
FROM (SELECT DISTINCT {cols} FROM ({stats}))
ORDER BY {order} LIMIT 1"""


def partition_paths_sql(stats: str, parts: tuple[str, ...]) -> str:
    pieces = " || ".join(f"'{c}=' || CAST({c} AS VARCHAR) || '/'" for c in parts)
    return f"SELECT DISTINCT {pieces} AS path FROM ({stats})"


def odd_positions() -> str:
    """Fixture E with gaps: what ``drivestats.sources.fixtures.positions_odd`` builds, read back.

    Texts of the fourth kind are not timestamps; all others keep the wall clock in seconds.
    """
    return f"""SELECT trip_id, user_id, vehicle_id,
       CASE WHEN ct % 7 <> 4 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS ts,
       CASE WHEN ct % 11 <> 0 THEN latitude END AS latitude, longitude,
       CASE WHEN ct % 13 <> 0 THEN ct END AS ct, sp
FROM ({positions_e()})"""


def mixed_positions() -> str:
    """Fixture E as ``positions_mixed_normalized`` spoils it: no vehicle in one folder's older files, whole seconds in the other."""
    return f"""SELECT trip_id, user_id, CASE WHEN ct % 6 <> 0 THEN vehicle_id END AS vehicle_id,
       CASE WHEN ct % 3 > 0 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) ELSE ts END AS ts, latitude, longitude, ct, sp
FROM ({positions_e()})"""


def load_control_sql(pos: str) -> str:
    """The steps of ``load_control_daily``: what each run reads, writes and finds."""
    day = "make_timestamp(year, month, day, 0, 0, 0.0)"
    old = f"{day} <= TIMESTAMP '{HISTORY_CUTOFF_DAILY}'"
    return f"""WITH p AS (SELECT *, {day} AS part, {old} AS old FROM ({pos}))
SELECT 1 AS step, 'FULL_LOAD' AS load_type, true AS wrote, CAST(NULL AS TIMESTAMP) AS watermark,
       count(*) AS rows_read, count(DISTINCT part) AS n_partitions FROM p WHERE old
UNION ALL
SELECT 2, 'INCREMENTAL', count(*) FILTER (NOT old) > 0, max(part) FILTER (old),
       count(*) FILTER (NOT old), count(DISTINCT part) FILTER (NOT old) FROM p
UNION ALL
SELECT 3, 'INCREMENTAL', false, max(part), 0, 0 FROM p"""


# Fixed watermarks used by the incremental queries (partition-aligned).
WATERMARK_HOURLY = "2024-01-15 11:00:00"
WATERMARK_DAILY = "2024-01-20 00:00:00"
WATERMARK_MONTHLY = "1998-06-01 00:00:00"
HISTORY_CUTOFF_DAILY = "1998-06-30 00:00:00"
CRASH_CUTOFF_DAILY = "1999-03-31 00:00:00"


def oracle_sql() -> dict[str, str]:
    e, l, e_null = positions_e(), positions_l(), positions_e(null_trip_for_errors=True)
    hourly_e = stats_sql(e, HOURLY)
    daily_l = stats_sql(l, DAILY)
    monthly_l = stats_sql(l, MONTHLY)
    norm_e, norm_l = _norm(f"({e})"), _norm(f"({l})")
    hourly_keep_null = HOURLY._replace(keep_null_trip=True)
    norm_e_null = _norm(f"({e_null})")
    keys = ", ".join(HOURLY.trip_keys)
    joined = f"""SELECT a.*, v.total_sudden_start_count, v.total_sudden_stop_count,
       v.total_acceleration_count, v.total_deceleration_count
FROM ({trip_sql(norm_e_null, hourly_keep_null, activity=True, distance=False, events=False)}) a
JOIN ({trip_sql(norm_e_null, hourly_keep_null, activity=False, distance=False, events=True)}) v
  USING ({keys})"""
    daily_e = stats_sql(e, DAILY)
    return {
        "positions_normalized": _norm(f"({e})"),
        "incremental_rows_hourly": incremental_rows_sql(e, HOURLY.parts, WATERMARK_HOURLY),
        "incremental_rows_daily": incremental_rows_sql(e, DAILY.parts, WATERMARK_DAILY),
        "incremental_rows_monthly": incremental_rows_sql(l, MONTHLY.parts, WATERMARK_MONTHLY),
        "has_new_data": has_new_data_sql(l),
        "latest_partition_hourly": latest_partition_sql(hourly_e, HOURLY.parts),
        "latest_partition_daily": latest_partition_sql(daily_e, DAILY.parts),
        "latest_partition_monthly": latest_partition_sql(monthly_l, MONTHLY.parts),
        "trip_activity_hourly": trip_sql(norm_e, HOURLY, distance=False, events=False),
        "trip_activity_daily": trip_sql(norm_e, DAILY, distance=False, events=False),
        "trip_activity_monthly": trip_sql(norm_l, MONTHLY, distance=False, events=False),
        "trip_distance_hourly": trip_sql(norm_e, HOURLY, activity=False, distance=True, events=False),
        "trip_distance_daily": trip_sql(norm_l, DAILY, activity=False, distance=True, events=False),
        "trip_driving_events_hourly": trip_sql(norm_e, HOURLY, activity=False, distance=False, events=True),
        "trip_driving_events_daily": trip_sql(norm_l, DAILY, activity=False, distance=False, events=True),
        "trip_events_joined": joined,
        "trip_traces_daily": traces_sql(norm_l, DAILY),
        "hourly_stats": hourly_e,
        "daily_stats": daily_l,
        "monthly_stats": monthly_l,
        "monthly_stats_calendar": stats_sql(l, MONTHLY_CALENDAR),
        "hourly_stats_sliced": hourly_e,
        "daily_stats_sliced": daily_l,
        "hourly_stats_window": hourly_e,
        "daily_stats_window": daily_l,
        "daily_stats_minutes": stats_sql(l, DAILY, sample_seconds=60.0),
        "partition_paths_hourly": partition_paths_sql(hourly_e, HOURLY.parts),
        "partition_paths_daily": partition_paths_sql(daily_e, DAILY.parts),
        "partition_paths_monthly": partition_paths_sql(monthly_l, MONTHLY.parts),
        "publish_full_daily": daily_l,
        "publish_incremental_daily": daily_l,
        "catalog_daily": daily_l,
        "publish_late_daily": daily_l,
        "catalog_late_daily": daily_l,
        "catalog_incremental_daily": daily_l,
        "catalog_after_crash_daily": daily_l,
        "catalog_reload_daily": f"""SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day AS partition
FROM ({daily_l}) WHERE date <= DATE '{HISTORY_CUTOFF_DAILY[:10]}'""",
        "load_control_daily": load_control_sql(l),
        "positions_mixed_normalized": _norm(f"({mixed_positions()})"),
        "watermark_ahead_daily": daily_l,
        "late_only_twice_daily": daily_l,
        "rebuild_expired_daily": daily_l,
        "repeated_run_daily": daily_l,
        "several_grains_hourly": hourly_e,
        "several_grains_monthly_calendar": stats_sql(e, MONTHLY_CALENDAR),
        "latest_partition_sql_daily": latest_partition_sql(daily_l, DAILY.parts),
        "positions_odd_normalized": _norm(f"({odd_positions()})"),
        "hourly_stats_odd": stats_sql(odd_positions(), HOURLY),
        "trip_traces_hourly": traces_sql(norm_e, HOURLY),
    }
