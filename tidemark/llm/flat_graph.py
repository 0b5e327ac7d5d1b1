"""A robust-pruned flat graph over the unit vectors of one shard, and range-expanding greedy search in it."""

from __future__ import annotations

import numpy as np

#: Rows whose similarities are computed, or queries that are searched, at a time.
BLOCK = 256
#: Nodes that a step of the search expands for each query, and expansions at a time.
WIDTH, EXPANSIONS = 4, 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, whatever their size."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def pruned_neighbours(vectors: np.ndarray, degree: int, candidates: int, alpha: float, far: int, seed: int) -> list[np.ndarray]:
    """Neighbours of each row: of its nearest `candidates` those that robust pruning leaves, `degree` at most, and `far`
    random ones, edges both ways.

    The nearest candidate stays; any candidate that is `alpha` times closer to it than to the row goes; and so on. The
    random edges keep dense groups, whose members have each other as nearest, in reach of the rest.
    """
    n = len(vectors)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    rng, many = np.random.default_rng(seed), min(candidates, n - 1)
    heads, tails = [], []
    for at in range(0, n, BLOCK):
        rows = np.arange(at, min(n, at + BLOCK))
        close = vectors[rows] @ vectors.T
        close[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-close, many - 1, axis=1)[:, :many]
        value = np.take_along_axis(close, near, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near, value = np.take_along_axis(near, order, axis=1), np.take_along_axis(value, order, axis=1)
        points, alive = vectors[near], np.ones(near.shape, bool)
        for _ in range(min(degree, many)):
            some = np.flatnonzero(alive.any(axis=1))
            if not len(some):
                break
            best = alive[some].argmax(axis=1)
            heads.append(rows[some])
            tails.append(near[some, best])
            between = np.einsum("rcd,rd->rc", points[some], points[some, best])
            alive[some] &= alpha * alpha * (1 - between) > 1 - value[some]
            alive[some, best] = False
    heads.append(np.repeat(np.arange(n), far))
    tails.append(rng.integers(0, n, n * far))
    a, b = np.concatenate(heads), np.concatenate(tails)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    pairs = pairs[pairs // n != pairs % n]
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def medoids(vectors: np.ndarray, most: int) -> np.ndarray:
    """The row closest to the mean, and then always the one farthest from those chosen."""
    chosen = [int((vectors @ vectors.mean(axis=0)).argmax())]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(most, len(vectors)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    return np.unique(chosen)


class Graph:
    """Rows and their neighbours as one flat list."""

    def __init__(self, vectors: np.ndarray, neighbours: list[np.ndarray], entries: np.ndarray):
        self.vectors, self.entries = vectors, entries
        self.sizes = np.fromiter(map(len, neighbours), np.int64, len(neighbours))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([*neighbours, np.zeros(0, np.int64)]).astype(np.int64)

    def _expand(self, seen: np.ndarray, who: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of nodes that their query has not seen, each once, now seen: (query, node)."""
        sizes = self.sizes[nodes]
        until = np.cumsum(sizes)
        at = np.repeat(self.starts[nodes] - until + sizes, sizes) + np.arange(until[-1] if len(until) else 0)
        codes = np.repeat(who, sizes) * seen.shape[1] + self.flat[at]
        codes = np.unique(codes[~seen.ravel()[codes]])
        seen.ravel()[codes] = True
        return codes // seen.shape[1], codes % seen.shape[1]

    def in_range(self, queries: np.ndarray, least: float, beam: int) -> np.ndarray:
        """For each query, a row of the graph, the rows found with at least this cosine, as a matrix of booleans.

        A greedy search from the entries keeps a beam of the closest rows until all in it are expanded. Then all rows in
        range, the query's own among them, are expanded until no further one is met. Every cosine is exact.
        """
        n, q = len(self.vectors), len(queries)
        seen, hits = np.zeros((q, n), bool), np.zeros((q, n), bool)
        everyone = np.arange(q)

        def met(who: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            value = np.einsum("pd,pd->p", self.vectors[queries[who]], self.vectors[nodes])
            near = value >= least
            hits[who[near], nodes[near]] = True
            return value

        seen[:, self.entries] = True
        who, nodes = np.repeat(everyone, len(self.entries)), np.tile(self.entries, q)
        value, done, expanded = met(who, nodes), np.zeros(len(who), bool), np.zeros((q, n), bool)
        while True:
            order = np.lexsort((-value, who))
            who, nodes, value, done = who[order], nodes[order], value[order], done[order]
            first = np.searchsorted(who, everyone)
            keep = np.arange(len(who)) - first[who] < beam
            who, nodes, value, done = who[keep], nodes[keep], value[keep], done[keep]
            # Of each query the closest few of its beam that were not expanded.
            waiting = np.flatnonzero(~done)
            if not len(waiting):
                break
            rank = np.arange(len(waiting)) - np.searchsorted(who[waiting], everyone)[who[waiting]]
            now = waiting[rank < WIDTH]
            done[now] = True
            expanded[who[now], nodes[now]] = True
            new_who, new_nodes = self._expand(seen, who[now], nodes[now])
            who, nodes = np.concatenate([who, new_who]), np.concatenate([nodes, new_nodes])
            value = np.concatenate([value, met(new_who, new_nodes)])
            done = np.concatenate([done, np.zeros(len(new_who), bool)])
        seen[everyone, queries] = hits[everyone, queries] = True
        while True:
            who, nodes = np.nonzero(hits & ~expanded)
            if not len(who):
                return hits
            expanded[who, nodes] = True
            for at in range(0, len(who), EXPANSIONS):
                met(*self._expand(seen, who[at : at + EXPANSIONS], nodes[at : at + EXPANSIONS]))


def smallest_reachable(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row that chains of them reach."""
    n = len(links)
    root = np.arange(n)
    while True:
        parts = [np.where(links[a : a + BLOCK], root, n).min(axis=1, initial=n) for a in range(0, n, BLOCK)]
        after = np.minimum(root, np.concatenate([root[:0], *parts]))
        after = after[after]
        if (after == root).all():
            return root
        root = after
