"""Near-duplicate vectors by HNSW graphs per shard (operator 11).

Distinct vectors are dealt into shards by hash and each shard gets a
hierarchical navigable small-world graph (``hnsw``). Every vector is searched
in every shard: a pair of shards is one task that searches the vectors of the
one in the graph of the other, and a shard's own vectors in its own graph. A
query's beam widens while its worst entry may still lead to a link, and a
task's beams all widen until its recall audit passes: some of its queries are
compared with the whole shard, and ``recall`` of their links must be found.

A link is a cosine of at least ``threshold`` in double precision. The members
of a graph node lie in a ball around it; where even the far side of the ball
is near enough, all its members are links by the triangle inequality and are
counted at once, else each is verified. So a group of copies costs its size,
not its square, and a task returns counts and a spanning forest of its links,
never all pairs. Components are united by ``near_dup.components``.

Shards hold at most about ``SHARD_ROWS`` vectors, which bounds a task's memory;
there are at least ``SHARDS``, so that small tables are built in parallel.
Searching every shard costs vectors x shards, so beyond SHARDS * SHARD_ROWS
distinct vectors the work grows faster than the table; that is the method.

Defined cases: vectors that are null, empty, zero, or hold null or not finite
components link with nothing; vectors of different lengths never link; equal
vectors are links of one another, also under one id; null ids are handled like
others, a component of only null ids has a null component_id; an empty table
gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import removed, written_at
from drivestats.llm.hnsw import BALL, Graph
from drivestats.llm.near_dup import components

THRESHOLD, RECALL = 0.9, 0.99
SHARD_ROWS, SHARDS = 50_000, 8
#: Beam of the first search; queries of a task that are compared with the whole shard.
BEAM, AUDITED = 16, 64
QUERY_BLOCK = 256
#: A vector with more than one in so many of all rows is joined by broadcast.
HOT = 10_000
#: Radians, and cosines, by which single-precision and rounding errors are given room.
ROOM = 1e-5
GRAPHS = "dim int, shard int, nodes binary, weights binary, vectors binary, graph binary"
FOUND = "kind int, node long, value long"


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, whatever their scale."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v**2).sum(1, keepdims=True))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _build(threshold: float):
    def build(group: pa.Table) -> pa.Table:
        dim, shard = group.column("dim")[0].as_py(), group.column("shard")[0].as_py()
        nodes, keys, weights = (group.column(c).to_numpy() for c in ("node", "h1", "n"))
        vectors = _matrix(group.column("v"), dim)
        order = np.argsort(nodes)
        nodes, keys, weights, vectors = nodes[order], keys[order], weights[order], vectors[order]
        # Members must be links of their node, with room.
        graph = Graph.build(units(vectors).astype(np.float32), keys.view(np.uint64), max(BALL, threshold + ROOM))
        row = [dim, shard, *(a.tobytes() for a in (nodes, weights.astype(np.int64), vectors)), graph.to_bytes()]
        return pa.table([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), *[pa.binary()] * 4))], names=["dim", "shard", "nodes", "weights", "vectors", "graph"])

    return build


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy().reshape(-1, dim) for c in column.chunks if len(c)] or [np.zeros((0, dim), np.float32)])


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.up[x] = y
            self.edges.append((a, b))


def find_links(queries: np.ndarray, graph: Graph, exact: np.ndarray, threshold: float, recall: float, own: bool, beam: int = BEAM):
    """For each query the (node, cosine) that may hold links, by beams wide enough for the audit to pass.

    Returns rows, node numbers and cosines of the pairs, and the beam used.
    ``exact`` holds the graph's unit vectors in double precision.
    """
    nodes, first, order = graph.members()
    radius = np.zeros(len(graph.x))
    inner = np.einsum("ij,ij->i", exact[order], exact[np.repeat(nodes, np.diff(first))])
    radius[nodes] = np.maximum.reduceat(_angles(inner), first[:-1]) + ROOM
    reach = np.arccos(threshold) + radius[nodes].max()
    least = float(np.cos(min(np.pi, reach))) - ROOM
    single = queries.astype(np.float32)
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    wanted = queries[audited] @ exact.T >= threshold
    while True:
        rows, found, cosines = [], [], []
        for begin in range(0, len(single), QUERY_BLOCK):
            todo, width = np.arange(begin, min(len(single), begin + QUERY_BLOCK)), beam
            while len(todo):
                at, sims = graph.search(single[todo], min(width, len(nodes)))
                wide = (sims[:, -1] >= least) & (at[:, -1] >= 0) & (width < len(nodes))
                r, c = np.nonzero((at >= 0) & (sims >= least) & ~wide[:, None])
                rows.append(todo[r])
                found.append(at[r, c])
                cosines.append(np.einsum("ij,ij->i", queries[todo[r]], exact[at[r, c]]))
                todo, width = todo[wide], width * 4
        rows, found, cosines = (np.concatenate(p) if p else np.zeros(0, t) for p, t in ((rows, int), (found, int), (cosines, float)))
        seen = np.zeros(wanted.shape, bool)
        owner = np.where(graph.member_of >= 0, graph.member_of, np.arange(len(graph.x)))
        for k, a in enumerate(audited):
            seen[k] = np.isin(owner, found[rows == a])
        if (seen & wanted).sum() >= recall * wanted.sum() or beam >= len(nodes):
            return rows, found, cosines, radius, beam
        beam *= 2


def _search(threshold: float, recall: float):
    theta = float(np.arccos(threshold))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], pa.int64())], names=["kind", "node", "value"])
        dim, i, j = (k.as_py() for k in key)
        if not right.num_rows or (i != j and not left.num_rows):
            return empty
        g_nodes, g_weights = (np.frombuffer(right.column(c)[0].as_py(), np.int64) for c in ("nodes", "weights"))
        raw = right.column("vectors")[0].as_py()
        exact = units(np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(g_nodes) else np.float64).reshape(-1, dim))
        graph = Graph.from_bytes(exact.astype(np.float32), right.column("graph")[0].as_py())
        own = i == j
        if own:
            q_nodes, q_weights, queries = g_nodes, g_weights, exact
        else:
            q_nodes, q_weights, queries = left.column("node").to_numpy(), left.column("n").to_numpy(), units(_matrix(left.column("v"), dim))
        rows, found, cosines, radius, _ = find_links(queries, graph, exact, threshold, recall, own)
        nodes, first, order = graph.members()
        q_count, g_count = np.zeros(len(q_nodes), np.int64), np.zeros(len(g_nodes), np.int64)
        ball_weight = np.add.reduceat(g_weights[order], first[:-1])
        ball_count = np.zeros(len(nodes), np.int64)
        forest, merged = _Forest(), np.zeros(len(nodes), bool)
        place = np.searchsorted(nodes, found)
        certain = _angles(cosines) + radius[found] + ROOM <= theta
        for r, p, sure in zip(rows.tolist(), place.tolist(), certain.tolist()):
            inside = order[first[p] : first[p + 1]]
            if sure:
                q_count[r] += ball_weight[p]
                ball_count[p] += q_weights[r]
                linked = inside[:1] if merged[p] else inside
                merged[p] = True
            else:
                linked = inside[exact[inside] @ queries[r] >= threshold]
                q_count[r] += g_weights[linked].sum()
                g_count[linked] += q_weights[r]
            a = int(q_nodes[r])
            for b in g_nodes[linked].tolist():
                forest.join(a, b)
        if own:
            # Each vector has found itself too; what others found of it is what it finds of them.
            q_count -= q_weights * _found_self(len(q_nodes), rows, found, graph, certain, exact, threshold)
            counts = [(q_nodes, q_count)]
        else:
            g_count[order] += np.repeat(ball_count, np.diff(first))
            counts = [(q_nodes, q_count), (g_nodes, g_count)]
        nodes_out = np.concatenate([n[c > 0] for n, c in counts])
        values = np.concatenate([c[c > 0] for _, c in counts])
        a, b = (np.array([e[k] for e in forest.edges], np.int64) for k in (0, 1))
        return pa.table(
            [pa.array(np.repeat([0, 1], [len(nodes_out), len(a)]), pa.int32()), pa.array(np.concatenate([nodes_out, a])), pa.array(np.concatenate([values, b]))],
            names=["kind", "node", "value"],
        )

    return search


def _found_self(n: int, rows, found, graph: Graph, certain, exact, threshold: float) -> np.ndarray:
    """1 for each query of its own shard that counted itself."""
    owner = np.where(graph.member_of >= 0, graph.member_of, np.arange(n))
    mine = found == owner[rows]
    counted = certain | (np.einsum("ij,ij->i", exact[rows], exact[rows]) >= threshold)
    out = np.zeros(n, np.int64)
    out[rows[mine & counted]] = 1
    return out


def near_duplicates(
    df: DataFrame, *, vector: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, shard_rows: int = SHARD_ROWS, shards: int = SHARDS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``."""
    spark = df.sparkSession
    v = F.col(vector)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(vector), v).alias("v"))
    rows = rows.withColumns({"h1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))})
    distinct = (
        rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "vec_id", "n", F.size("v").alias("dim"), "v")
    )
    distinct, distinct_path = written_at(distinct, "vectors")
    total, most = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    s = max(shards, -(-most // shard_rows))
    dealt = distinct.select("node", "h1", "n", "v", "dim", F.pmod("h2", F.lit(s)).cast("int").alias("shard"))
    graphs, graphs_path = written_at(dealt.groupBy("dim", "shard").applyInArrow(_build(threshold), GRAPHS), "graphs")
    asked = dealt.withColumn("i", F.col("shard")).withColumn("j", F.explode(F.when(F.col("shard") < s - 1, F.sequence(F.col("shard") + 1, F.lit(s - 1)))))
    held = graphs.withColumn("j", F.col("shard")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("shard"))))
    found = asked.groupBy("dim", "i", "j").cogroup(held.groupBy("dim", "i", "j")).applyInArrow(_search(threshold, recall), FOUND)
    found, found_path = written_at(found, "links")
    counts = found.where("kind = 0").groupBy("node").agg(F.sum("value").alias("others"))
    links = found.where("kind = 1").select("node", F.col("value").alias("leader"))
    named = distinct.select("node", "h1", "h2", "vec_id", "n").join(counts, "node", "left")
    if links.isEmpty():
        named = named.withColumn("component", F.col("vec_id"))
    else:
        named = named.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("vec_id").alias("component"))
        named = named.join(least, "root")
    named = named.select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component", "n")
    named, _ = written_at(named, "components")
    for p in (distinct_path, graphs_path, found_path):
        removed(spark, p)
    return _back_to_rows(rows.select("vec_id", "h1", "h2"), named, total)


def _back_to_rows(rows: DataFrame, named: DataFrame, total: int) -> DataFrame:
    """Each row with what is known of its vector. A vector of very many rows is joined by broadcast; at most ``HOT`` are."""
    common = F.broadcast(named.where(F.col("n") * HOT >= total).select("h1", "h2", F.col("n_links").alias("hot_links"), F.col("component").alias("hot_component")))
    rows = rows.join(common, ["h1", "h2"], "left")
    # Rows that are done, or have no vector, match nothing and are spread by their id.
    done = F.col("hot_links").isNotNull() | F.col("h1").isNull()
    rows = rows.select("vec_id", "hot_links", "hot_component", F.when(done, F.xxhash64("vec_id")).otherwise(F.col("h1")).alias("h1"), F.when(~done, F.col("h2")).alias("h2"), F.col("h1").isNull().alias("alone"))
    out = rows.join(named.drop("n"), ["h1", "h2"], "left")
    component = F.when(F.col("alone"), F.col("vec_id")).otherwise(F.coalesce("hot_component", "component"))
    out = out.select("vec_id", F.coalesce("hot_links", "n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
