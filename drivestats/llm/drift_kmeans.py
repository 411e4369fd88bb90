"""Centroid clustering with geometric drift tightening (operator 13).

Lloyd's rounds on integer vectors, exact to the last digit. Every vector
carries an upper bound of the distance to its own centroid and a lower bound
of the distance to all others. When centroids move, the upper bound grows by
the drift of the own centroid. The lower bound shrinks by less than the drift
of the others: all vectors of a cluster lie in a sphere around its old
centroid, and seen from the middle of another centroid's move, that sphere
fills a cone. A point at an angle t to the move comes closer by at most
drift * cos(t), so what counts is the ray of the cone nearest to the move, in
the plane of the move and the sphere's centre (``loosening``). Vectors whose
bounds still part their own centroid from the others are not looked at again;
the ambiguous ones are scanned exactly, in whole numbers.

The vectors with their bounds are a table that each round writes anew in the
shared folder; the driver holds the centroids (clusters x components), one row
of figures a cluster, and nothing that grows with the data. Centroid sums
change by the vectors that changed their cluster.

Defined cases: a vector is used if it has exactly ``dims`` components, none
null or not finite, none beyond +-131072 (such squares would not fit a long);
other rows are not in the result. Fewer usable vectors than clusters make
fewer clusters; none, an empty result. Among equal hashes (repeated ids) the
smaller components come first; null ids count as empty text. Ties in distance
go to the smaller cluster number, empty clusters keep their centroid. Repeated
rows are each counted and reported. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import map_arrow, removed, written_at

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Components are below 2**27 then, and a squared distance of 64 of them below 2**62.
LIMIT = 131072.0
STATE = "vec_id long, x array<int>, cluster int, was int, upper double, lower double"


def usable(vector: str, dims: int):
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False))), F.lit(False))


def integer_vectors(df: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, x) of the usable rows."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("int"))
    return df.where(usable(vector, dims)).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: how much nearer centroid j can have come to any point within ``radius[i]`` of old centroid i.

    With m the middle of the move from c to c', |x - c| - |x - c'| is
    2 <x - m, c' - c> / (|x - c| + |x - c'|), at most drift * cos(angle of
    x - m and c' - c) where that is positive, by the triangle inequality.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    move, middle = new - old, (new + old) / 2
    drift = np.sqrt((move**2).sum(1))
    away = old[:, None, :] - middle[None, :, :]
    distance = np.sqrt((away**2).sum(2))
    along = (away * move[None, :, :]).sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip(along / (distance * drift), -1, 1))
        cone = np.arcsin(np.clip(radius[:, None] / distance, 0, 1))
    share = np.clip(np.cos(np.maximum(0, angle - cone)), 0, 1)
    out = np.where((radius[:, None] >= distance) | ~np.isfinite(share), 1, share) * drift
    return np.minimum(out * (1 + 1e-9), drift)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, [vector, centroid]."""
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), distance to it and to the next."""
    d = squared(x, centroids)
    best = d.argmin(1)
    rows = np.arange(len(x))
    near = np.sqrt(d[rows, best].astype(np.float64))
    d[rows, best] = np.iinfo(np.int64).max
    return best, near, np.sqrt(d.min(1).astype(np.float64))


def _emit(batch: pa.RecordBatch, cluster, was, upper, lower) -> pa.RecordBatch:
    columns = [batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(upper), pa.array(lower)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "cluster", "was", "upper", "lower"])


def _first_round(centroids: np.ndarray):
    def assign(batches):
        for b in batches:
            best, near, next_ = _scan(_matrix(b.column(1), centroids.shape[1]), centroids)
            yield _emit(b, best, np.full(len(best), -1), near, next_)

    return assign


def _next_round(old: np.ndarray, new: np.ndarray, loosen: np.ndarray):
    """Bounds moved along with the centroids; what they no longer decide is scanned."""
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(1))

    def assign(batches):
        for b in batches:
            was, upper, lower = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("cluster", "upper", "lower"))
            cluster, upper, lower = was.copy(), upper + drift[was], lower - loosen[was]
            # Rounding of the bounds is far below this part of them.
            open_ = np.flatnonzero(upper * (1 + 1e-9) + 1e-6 >= lower)
            if len(open_):
                x = _matrix(b.column(1).take(pa.array(open_)), new.shape[1])
                own = np.sqrt(((x - new[was[open_]]) ** 2).sum(1).astype(np.float64))
                upper[open_] = own
                still = own * (1 + 1e-9) + 1e-6 >= lower[open_]
                if still.any():
                    at = open_[still]
                    cluster[at], upper[at], lower[at] = _scan(x[still], new)
            yield _emit(b, cluster, was, upper, lower)

    return assign


def _moved_sums(dims: int, clusters: int):
    """Per task: what the vectors that changed their cluster add to and take from each one's count and sum."""

    def add(batches):
        total = np.zeros((clusters, dims + 1), np.int64)
        for b in batches:
            x = _matrix(b.column(0), dims)
            x = np.concatenate([np.ones((len(x), 1), np.int64), x], 1)
            cluster, was = b.column(1).to_numpy(), b.column(2).to_numpy()
            np.add.at(total, cluster, x)
            left = was >= 0
            np.subtract.at(total, was[left], x[left])
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel()[places])], ["place", "n"])

    return add


def _first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(named, 256), "x").limit(clusters).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster(
    df: DataFrame, *, vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
    trace: list | None = None,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every usable row of ``df``.

    ``trace`` receives, for each round, (drift, loosening) as they were used.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, vector, dims, scale)
    centroids = _first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256").where("false")
    k = len(centroids)
    totals = np.zeros((k, dims + 1), object)
    state, path = written_at(map_arrow(vectors, _first_round(centroids), STATE), "clusters")
    for _ in range(rounds):
        moved = map_arrow(state.where("cluster != was").select("x", "cluster", "was"), _moved_sums(dims, k), "place long, n long")
        for place, n in moved.groupBy("place").agg(F.sum("n")).collect():  # at most clusters x (components + 1) rows
            totals[place // (dims + 1), place % (dims + 1)] += n
        new = np.array([[s // t[0] for s in t[1:]] if t[0] else c.tolist() for t, c in zip(totals, centroids)], np.int64)
        if (new == centroids).all():
            break
        radius = np.zeros(k)
        for c, r in state.groupBy("cluster").agg(F.max("upper")).collect():
            radius[c] = r * (1 + 1e-9)
        loosen = loosening(centroids, new, radius)
        np.fill_diagonal(loosen, 0)
        if trace is not None:
            trace.append((np.sqrt(((new - centroids).astype(np.float64) ** 2).sum(1)), loosen))
        state, old = map_arrow(state, _next_round(centroids, new, loosen.max(1)), STATE), path
        state, path = written_at(state, "clusters")
        removed(spark, old)
        centroids = new
    return _described(state, centroids)


def _described(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    spark = state.sparkSession
    names = [(i, [int(v) for v in c], hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    final = F.broadcast(spark.createDataFrame(names, "cluster int, centre array<long>, centroid_sha256 string"))  # a row a cluster
    apart = F.zip_with("x", "centre", lambda a, b: (a - b) * (a - b))
    placed = state.join(final, "cluster").select("vec_id", "cluster", F.aggregate(apart, F.lit(0).cast("long"), lambda s, d: s + d).alias("distance"), "centroid_sha256")
    each = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = each.agg(F.sum("cluster_inertia").alias("inertia"))
    return (
        placed.join(F.broadcast(each), "cluster").join(F.broadcast(whole))
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rounds in DuckDB, every vector against every centroid in each."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
     FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('{seed}:', vec_id)), x) - 1 AS c, x FROM v
     QUALIFY row_number() OVER (ORDER BY sha256(concat('{seed}:', vec_id)), x) <= {clusters})"""]  # fmt: skip
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, d * {clusters} + c) AS c, min(d) AS d FROM (
     SELECT v.r, k.c, list_sum(list_transform(range(1, {dims} + 1), lambda i: (v.x[i] - k.x[i]) * (v.x[i] - k.x[i]))) AS d FROM v, c{i} k) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT k.c, coalesce(m.x, k.x) AS x FROM c{i} k LEFT JOIN (
     SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
       SELECT c, i, sum(x[i]) AS s, count(*) AS n FROM v JOIN a{i} USING (r), range(1, {dims} + 1) t(i) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} k ON k.c = a.c"""
