"""Operator 13 against plain rounds over all vectors, and its bounds."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from drivestats.llm import drift_kmeans

SCHEMA = "vec_id long, embedding array<double>, cluster string, x int"


def brute(rows, k, rounds, dims, scale=1024, seed=3):
    kept = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in start]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        placed = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (p, _) in zip(kept, placed) if p == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    placed = assign()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = [sum(d for p, d in placed if p == c) for c in range(len(centroids))]
    return sorted(((i if i is not None else -1), p, d, each[p], sum(each), names[p]) for (i, _), (p, d) in zip(kept, placed))


def run(spark, rows, **kw):
    got = drift_kmeans.cluster(spark.createDataFrame([(i, v, "a", 1) for i, v in rows], SCHEMA), **kw).collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got)


@pytest.mark.parametrize("shape", ["blobs", "even", "grid"])
def test_equals_plain_rounds(spark, shape):
    rng = np.random.default_rng(7)
    dims, n = 6, 400
    x = {
        "blobs": rng.normal(size=(5, dims))[rng.integers(0, 5, n)] * 3 + rng.normal(size=(n, dims)) * 0.3,
        "even": rng.uniform(-1, 1, (n, dims)),
        "grid": rng.integers(-1, 2, (n, dims)).astype(float),  # many ties
    }[shape]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    trace: list = []
    assert run(spark, rows, clusters=7, rounds=6, dims=dims, trace=trace) == brute(rows, 7, 6, dims)
    assert trace
    for drift, loosen in trace:
        assert (loosen <= drift[None, :] + 1e-12).all() and (loosen >= 0).all()
    # Less than the full drift somewhere off the diagonal.
    assert any((loosen < 0.9 * drift[None, :])[~np.eye(7, dtype=bool)].any() for drift, loosen in trace)


def test_loosening_holds_for_points_of_the_sphere():
    """No point of the sphere comes nearer to a moved centroid than the bound allows; it is tight for far spheres."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        old, new = rng.normal(size=(2, 4, 3)) * 10
        new = old + (new - old) * rng.choice([0.01, 0.3, 1])
        radius = rng.uniform(0, 8, 4)
        bound = drift_kmeans.loosening(old, new, radius)
        way = rng.normal(size=(200, 3))
        way /= np.linalg.norm(way, axis=1)[:, None]
        for i in range(4):
            x = old[i] + way * radius[i] * rng.uniform(0.9, 1, (200, 1))
            for j in range(4):
                nearer = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert nearer.max() <= bound[i, j] + 1e-9


def test_odd_rows(spark):
    v = [0.5, -0.25]
    rows = [(1, v), (1, v), (2, None), (3, [0.5]), (4, [0.5, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [-0.001, 3.0])]
    for clusters in (1, 2, 20):
        assert run(spark, rows, clusters=clusters, rounds=4, dims=2) == brute(rows, clusters, 4, 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0])]])
def test_no_usable_row(spark, rows):
    df = drift_kmeans.cluster(spark.createDataFrame([(i, v, "a", 1) for i, v in rows], SCHEMA), dims=2)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and df.count() == 0


def test_round_skips_what_the_bounds_decide():
    """Only ambiguous vectors are looked at: a wrong upper bound of the others stays as it was, moved by the drift."""
    import pyarrow as pa

    old = np.array([[0, 0], [1000, 0]], np.int64)
    new = np.array([[1, 0], [1001, 0]], np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([[3, 0], [500, 0]], pa.list_(pa.int32())), pa.array([0, 0], pa.int32()), pa.array([-1, -1], pa.int32()), pa.array([4.0, 500.0]), pa.array([990.0, 500.0])],
        ["vec_id", "x", "cluster", "was", "upper", "lower"],
    )
    loosen = drift_kmeans.loosening(old, new, np.array([500.0, 0.0]))
    out = next(drift_kmeans._next_round(old, new, np.array([loosen[0, 1], loosen[1, 0]]))(iter([batch])))
    assert out.column("upper").to_pylist() == [5.0, 499.0] and out.column("cluster").to_pylist() == [0, 0]
