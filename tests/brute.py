"""Plain-Python model of the trip statistics, for small hand-built inputs only."""

from __future__ import annotations

import math
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

R2 = 2 * 6371008.8
K = 0.017453292519943295


def half_up(x: float, nd: int = 0) -> float:
    q = Decimal(1).scaleb(-nd)
    return float(Decimal(repr(x)).quantize(q, rounding=ROUND_HALF_UP))


def hav(a, b):
    lat1, lon1 = a
    lat2, lon2 = b
    if None in (lat1, lon1, lat2, lon2):
        return None
    sdl = math.sin((lat2 - lat1) * K / 2.0)
    sdn = math.sin((lon2 - lon1) * K / 2.0)
    h = sdl * sdl + math.cos(lat1 * K) * math.cos(lat2 * K) * sdn * sdn
    return R2 * math.asin(min(1.0, math.sqrt(h)))


def _key(v):
    return (v is not None, v if v is not None else 0)


def pair_sums(rows, keys, order):
    """rows: dicts with keys, order columns, latitude, longitude, s. Returns {group: dict}."""
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    out = {}
    for g, rs in groups.items():
        rs.sort(key=lambda r: tuple(_key(r[c]) for c in order))
        dist, ss, sp, ac, dc = 0, 0, 0, 0, 0
        for p, c in zip(rs, rs[1:]):
            d = hav((p["latitude"], p["longitude"]), (c["latitude"], c["longitude"]))
            if d is not None:
                dist += math.floor(d * 1_000_000.0 + 0.5)  # whole micrometres per pair
            if p["s"] is not None and c["s"] is not None:
                delta = c["s"] - p["s"]
                ss += p["s"] <= 5.0 and delta >= 20.0
                sp += c["s"] <= 5.0 and delta <= -20.0
                ac += delta >= 10.0
                dc += delta <= -10.0
        out[g] = {
            "distance_um": dist,
            "sudden_start_count": ss,
            "sudden_stop_count": sp,
            "acceleration_count": ac,
            "deceleration_count": dc,
        }
    return out
