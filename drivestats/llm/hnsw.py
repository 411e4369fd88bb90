"""A hierarchical navigable small-world graph over unit vectors, built and searched in NumPy batches.

Vectors within ``ball`` of a graph node (cosine at least ``ball``) hang on it
as members instead of becoming nodes, so groups of copies, however large, do
not crowd the graph out of its long edges. Every vector is a node or a member.
"""

from __future__ import annotations

import io

import numpy as np

#: Edges of a node (twice that on the lowest level), beam while building, batch size, cosine of members to their node.
EDGES, BUILD_BEAM, BATCH, BALL = 12, 48, 256, 0.98
#: Levels below this size are searched whole.
WHOLE = 48


def _gather_sims(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.einsum("qd,qcd->qc", q, x[at], optimize=False)


def diverse(x: np.ndarray, sims: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (-1: none), best first: those nearer to the row than to any chosen one, then the nearest others."""
    order = np.argsort(-np.where(candidates >= 0, sims, -np.inf), axis=1, kind="stable")
    sims, candidates = np.take_along_axis(sims, order, 1), np.take_along_axis(candidates, order, 1)
    rows, width = candidates.shape
    vectors = x[np.maximum(candidates, 0)]
    among = np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -np.inf, np.float32)  # to any chosen one
    count = np.zeros(rows, int)
    for c in range(width):
        take = (candidates[:, c] >= 0) & (sims[:, c] > closest[:, c]) & (count < most)
        chosen[:, c] = take
        count += take
        closest = np.where(take[:, None], np.maximum(closest, among[:, :, c]), closest)
    rank = np.where(chosen, 0, np.where(candidates >= 0, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(candidates, first, 1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((rows, most - out.shape[1]), -1, out.dtype)], 1)
    return out


class Level:
    """One level: node numbers and their edges (-1: none)."""

    def __init__(self, edges: int):
        self.edges = edges
        self.nodes = np.zeros(0, np.int32)
        self.links = np.zeros((0, edges), np.int32)  # by place in ``nodes``

    def beam(self, x: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, step: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``width`` best nodes found for each query, from ``entry`` places (-1: none)."""
        rows, n = len(q), len(self.nodes)
        if n <= max(WHOLE, width):
            sims = q @ x[self.nodes].T
            order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
            return order.astype(np.int32), np.take_along_axis(sims, order, 1)
        seen = np.zeros((rows, n + 1), bool)
        seen[:, n] = True  # stands for -1
        r = np.arange(rows)[:, None]
        found = entry
        seen[r, found] = True
        sims = np.where(found >= 0, _gather_sims(x, q, self.nodes[found]), -np.inf)
        pad = max(0, width - found.shape[1])
        at = np.concatenate([found, np.full((rows, pad), -1, np.int32)], 1)
        best = np.concatenate([sims, np.full((rows, pad), -np.inf, sims.dtype)], 1)
        done = at < 0
        while True:
            todo = np.where(done, -np.inf, best)
            live = np.flatnonzero(todo.max(1) > -np.inf)
            if not len(live):
                return at[:, :width], best[:, :width]
            pick = np.argpartition(-todo[live], min(step, todo.shape[1]) - 1, axis=1)[:, :step]
            lr = live[:, None]
            fresh = np.isfinite(todo[lr, pick])
            done[lr, pick] = True
            new = np.where(fresh[:, :, None], self.links[np.maximum(at[lr, pick], 0)], -1).reshape(len(live), -1)
            new = np.where(seen[lr, new], -1, new)
            # The same neighbour by two ways counts once.
            new.sort(axis=1)
            new[:, 1:] = np.where(new[:, 1:] == new[:, :-1], -1, new[:, 1:])
            seen[lr, new] = True
            near = np.where(new >= 0, _gather_sims(x, q[live], self.nodes[np.maximum(new, 0)]), -np.inf)
            both, where = np.concatenate([best[live], near], 1), np.concatenate([at[live], new], 1)
            was = np.concatenate([done[live], new < 0], 1)
            keep = np.argpartition(-both, width - 1, axis=1)[:, :width]
            order = np.take_along_axis(keep, np.argsort(-np.take_along_axis(both, keep, 1), axis=1, kind="stable"), 1)
            best[live, :width], at[live, :width], done[live, :width] = (np.take_along_axis(m, order, 1) for m in (both, where, was))
            if best.shape[1] > width:
                best, at, done = best[:, :width], at[:, :width], done[:, :width]

    def insert(self, x: np.ndarray, new: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        """Adds nodes with the candidates (places, -1: none) found for each; batch mates are candidates too."""
        first = len(self.nodes)
        mates = x[new] @ x[new].T
        np.fill_diagonal(mates, -np.inf)
        k = min(self.edges, len(new) - 1)
        if k > 0:
            near = np.argpartition(-mates, k - 1, axis=1)[:, :k]
            found = np.concatenate([found, near + first], 1)
            sims = np.concatenate([sims, np.take_along_axis(mates, near, 1)], 1)
        self.nodes = np.concatenate([self.nodes, new.astype(np.int32)])
        self.links = np.concatenate([self.links, np.full((len(new), self.edges), -1, np.int32)])
        if not found.shape[1]:
            return
        at_x = x[self.nodes]
        self.links[first:] = diverse(at_x, sims, found, self.edges)
        source = np.repeat(np.arange(first, len(self.nodes)), self.edges)
        target = self.links[first:].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        to, begin, count = np.unique(target, return_index=True, return_counts=True)
        # Every new edge is offered to its other end, a few at a time, and kept there if it is among the best.
        for offset in range(0, int(count.max(initial=0)), self.edges):
            some = count > offset
            nodes, start, n = to[some], begin[some] + offset, np.minimum(count[some] - offset, self.edges)
            offered = np.full((len(nodes), self.edges), -1, np.int32)
            columns = np.arange(self.edges)[None, :]
            inside = columns < n[:, None]
            offered[inside] = source[(start[:, None] + columns)[inside]]
            held = self.links[nodes]
            offered[(offered[:, :, None] == held[:, None, :]).any(2)] = -1
            candidates = np.concatenate([held, offered], 1)
            near = np.where(candidates >= 0, _gather_sims(at_x, at_x[nodes], np.maximum(candidates, 0)), -np.inf)
            self.links[nodes] = diverse(at_x, near, candidates, self.edges)


class Graph:
    def __init__(self, x: np.ndarray, levels: list[Level], member_of: np.ndarray):
        self.x, self.levels, self.member_of = x, levels, member_of

    @classmethod
    def build(cls, x: np.ndarray, keys: np.ndarray, ball: float = BALL) -> Graph:
        """The graph of unit vectors ``x``; ``keys`` (64-bit hashes) deal the levels."""
        n = len(x)
        # Each level holds one in EDGES of the one below.
        share = (keys.astype(np.uint64) >> np.uint64(11)).astype(np.float64) / 2**53
        height = np.minimum((-np.log(np.maximum(share, 1e-300)) / np.log(EDGES)).astype(int), 8)
        levels = [Level(2 * EDGES if h == 0 else EDGES) for h in range(int(height.max(initial=0)) + 1)]
        member_of = np.full(n, -1, np.int64)
        graph, done = cls(x, levels, member_of), 0
        while done < n:
            batch = np.arange(done, min(n, done + (BATCH if done else WHOLE)))
            done += len(batch)
            entry = graph._descend(x[batch], BUILD_BEAM // 4)
            near = [lv.beam(x, x[batch], e, BUILD_BEAM) if len(lv.nodes) else None for lv, e in zip(levels, entry)]
            node = np.ones(len(batch), bool)
            if near[0] is not None:
                best = near[0][0][:, 0]
                member = near[0][1][:, 0] >= ball
                member_of[batch[member]] = levels[0].nodes[best[member]]
                node &= ~member
            mates = x[batch] @ x[batch].T >= ball
            for i in np.flatnonzero(node):
                earlier = np.flatnonzero(mates[i, :i] & node[:i])
                if len(earlier):
                    member_of[batch[i]], node[i] = batch[earlier[0]], False
            for h, lv in enumerate(levels):
                mine = node & (height[batch] >= h)
                if mine.any():
                    found, sims = (m[mine] for m in near[h]) if near[h] is not None else (np.zeros((mine.sum(), 0), np.int32), np.zeros((mine.sum(), 0), np.float32))
                    lv.insert(x, batch[mine], found, sims)
        return graph

    def _descend(self, q: np.ndarray, width: int) -> list[np.ndarray]:
        """Entry places of each level, from the top: the best of the level above."""
        out: list[np.ndarray] = []
        above = None
        for lv in reversed(self.levels):
            if above is None or not len(above[0].nodes):
                entry = np.zeros((len(q), 1), np.int32)
            else:
                up, found = above
                entry = np.where(found >= 0, _places(lv, up.nodes[np.maximum(found, 0)]), -1).astype(np.int32)
            out.append(entry)
            if lv is not self.levels[0]:
                above = (lv, lv.beam(q=q, x=self.x, entry=entry, width=width)[0]) if len(lv.nodes) else None
        return out[::-1]

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Node numbers (-1: none) and cosines of the ``width`` best nodes found for each query."""
        base = self.levels[0]
        at, sims = base.beam(self.x, q, self._descend(q, max(4, width // 4))[0], width)
        return np.where(at >= 0, base.nodes[np.maximum(at, 0)], -1), sims

    def members(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes, where each one's vectors (itself included) start in the last array, and the vectors by node."""
        owner = np.where(self.member_of >= 0, self.member_of, np.arange(len(self.x)))
        order = np.argsort(owner, kind="stable")
        nodes, first = np.unique(owner[order], return_index=True)
        return nodes, np.append(first, len(order)), order

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        parts = {"member_of": self.member_of, "levels": np.array([lv.edges for lv in self.levels])}
        for h, lv in enumerate(self.levels):
            parts |= {f"nodes{h}": lv.nodes, f"links{h}": lv.links}
        np.savez(out, **parts)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, x: np.ndarray, data: bytes) -> Graph:
        with np.load(io.BytesIO(data)) as parts:
            levels = []
            for h, edges in enumerate(parts["levels"].tolist()):
                lv = Level(edges)
                lv.nodes, lv.links = parts[f"nodes{h}"], parts[f"links{h}"]
                levels.append(lv)
            member_of = parts["member_of"]
        return cls(x, levels, member_of)


def _places(lv: Level, nodes: np.ndarray) -> np.ndarray:
    """Places of nodes in a level; they are added in ascending order, so by bisection."""
    return np.searchsorted(lv.nodes, nodes)
