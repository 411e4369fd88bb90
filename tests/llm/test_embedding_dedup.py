"""Operator 11 against all pairs: links, components, recall, and its defined cases."""

from __future__ import annotations

import numpy as np
import pytest

from drivestats.llm import embedding_dedup, queries
from drivestats.llm.hnsw import Graph

SCHEMA = "vec_id long, embedding array<double>, node long, n string"


def brute(rows, threshold=0.9):
    """(vec_id, n_links, component_id) by all pairs."""
    def unit(v):
        if not v or any(c is None or not np.isfinite(c) for c in v) or not np.any(v):
            return None
        x = np.array(v, float) / np.max(np.abs(v))
        return x / np.sqrt((x**2).sum())

    xs = [unit(v) for _, v in rows]
    n, up, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(n):
        for b in range(a):
            if xs[a] is not None and xs[b] is not None and len(xs[a]) == len(xs[b]) and xs[a] @ xs[b] >= threshold:
                links[a] += 1
                links[b] += 1
                up[top(a)] = top(b)
    ids: dict[int, list] = {}
    for a in range(n):
        ids.setdefault(top(a), []).append(rows[a][0])
    least = {r: min((i for i in members if i is not None), default=None) for r, members in ids.items()}
    return [(rows[a][0], links[a], least[top(a)]) for a in range(n)]


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = embedding_dedup.near_duplicates(df, **kw).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return key([tuple(r)[:3] for r in got])


def groups(rng, sizes, dim, spread):
    out = []
    for size in sizes:
        centre = rng.normal(size=dim)
        out += list(centre / np.linalg.norm(centre) + rng.normal(size=(size, dim)) * spread / np.sqrt(dim))
    return out


@pytest.mark.parametrize("spread", [0.05, 0.25, 0.33])
def test_equals_all_pairs(spark, spread):
    """Tight groups (balls counted at once), and groups whose pairs lie around the threshold."""
    rng = np.random.default_rng(int(spread * 100))
    x = groups(rng, [1] * 150 + [3] * 20 + [60, 25], 24, spread)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(10_000), x)]
    rows += [(20_000, rows[0][1]), (20_001, rows[0][1]), (rows[5][0], rows[5][1]), (20_002, [7 * c for c in rows[9][1]])]
    got, want = run(spark, rows, shards=3), key(brute(rows))
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.99 * true and sum(a != b for a, b in zip(got, want)) <= 0.01 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (None, [1.0, 0.0]), (None, None),
        (8, [1e300, 1e299]), (9, [1e-300, 1e-301]), (10, [1.0, 0.0, 0.0]), (11, [2.0, 0.0, 0.0]), (12, [-1.0, 0.0]), (13, [5.0]), (14, [1.0]), (14, [1.0]), (3, [0.0, 0.0]),
    ]
    assert run(spark, rows) == key(brute(rows))
    assert run(spark, []) == []


def test_one_group_in_all_shards(spark):
    """A third of all rows are near copies, another third one vector: counts without all pairs."""
    rng = np.random.default_rng(5)
    x = groups(rng, [300], 16, 0.1) + list(rng.normal(size=(300, 16))) + [np.ones(16)] * 300
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows, shards=2) == key(brute(rows))


def test_audit_widens_beams():
    """From a beam of one, the audit widens until the links of all queries are found."""
    rng = np.random.default_rng(9)
    x = embedding_dedup.units(np.array(groups(rng, [4] * 500, 32, 0.15)))
    graph = Graph.build(x.astype(np.float32), rng.integers(0, 2**63, len(x)).astype(np.uint64))
    rows, found, _, _, beam = embedding_dedup.find_links(x, graph, x, 0.9, 0.99, True, beam=1)
    true = x @ x.T >= 0.9
    owner = np.where(graph.member_of >= 0, graph.member_of, np.arange(len(x)))
    seen = np.zeros_like(true)
    for r in range(len(x)):
        seen[r] = np.isin(owner, found[rows == r])
    assert (seen & true).sum() >= 0.98 * true.sum()
    again = Graph.from_bytes(graph.x, graph.to_bytes())
    assert (again.search(graph.x[:50], 8)[0] == graph.search(graph.x[:50], 8)[0]).all()


def test_registered_query(spark):
    """The whole table of the smallest size against all pairs."""
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.registry()["op11_embedding_duplicates"](spark, sf).collect()
    assert key([tuple(r)[:3] for r in got]) == key(brute(rows))
