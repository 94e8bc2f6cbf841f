"""A hierarchical navigable small-world graph in numpy, for one bounded shard of vectors.

Layers are built from the top down and filled in batches: a batch searches the layer as it stands, adds the closest of its
own members, keeps diverse neighbours, and links back. Searches run for many queries at once.
"""

from __future__ import annotations

import numpy as np


class Graph:
    """Unit vectors (float32, one per row) with their layers of neighbours."""

    def __init__(self, vectors: np.ndarray, links: int = 12, beam: int = 48, batch: int = 256, seed: int = 3):
        self.vectors, self.links, self.beam = vectors, links, beam
        n = len(vectors)
        random = np.random.default_rng(seed)
        level = self.level = np.floor(-np.log(1 - random.random(n)) / np.log(links)).astype(np.int64)
        #: Per layer from the bottom: neighbours of each vector, -1 where there are fewer.
        self.layers: list[np.ndarray] = []
        self.tops = np.flatnonzero(level == level.max()) if n else np.zeros(0, np.int64)
        known = np.zeros(0, np.int64)
        layers: list[np.ndarray] = []
        for at in range(int(level.max()) if n else -1, -1, -1):
            self.layers = layers[::-1]  # those above this one
            width = 2 * links if at == 0 else links
            table = np.full((n, width), -1, np.int32)
            fresh = np.flatnonzero(level >= at)
            rest = np.setdiff1d(fresh, known, assume_unique=True)
            inserted = 0
            for chunk in self._chunks(np.concatenate([known, rest]), batch):
                self._insert(table, chunk, inserted)
                inserted += len(chunk)
            known = np.concatenate([known, rest])
            layers.append(table)
        self.layers = layers[::-1]

    @classmethod
    def of_rows(cls, vectors: np.ndarray, near: list[bytes], links: int = 12) -> Graph:
        """The graph that ``rows`` gave."""
        graph = cls.__new__(cls)
        graph.vectors, graph.links = vectors, links
        levels = np.array([(len(b) // 4 - 2 * links) // links for b in near], np.int64)
        graph.tops = np.flatnonzero(levels == levels.max()) if len(near) else np.zeros(0, np.int64)
        graph.layers = []
        for at in range(int(levels.max()) + 1 if len(near) else 0):
            first, width = (0, 2 * links) if at == 0 else (2 * links + (at - 1) * links, links)
            table = np.full((len(near), width), -1, np.int32)
            own = np.flatnonzero(levels >= at)
            table[own] = np.frombuffer(b"".join(near[k][4 * first : 4 * (first + width)] for k in own), "<i4").reshape(-1, width)
            graph.layers.append(table)
        return graph

    def rows(self) -> list[bytes]:
        """The neighbours of each vector in the layers that it is in, the lowest first, as 32-bit numbers."""
        return [
            b"".join(table[k].astype("<i4").tobytes() for table in self.layers[: level + 1])
            for k, level in enumerate(self.level.tolist())
        ]

    @staticmethod
    def _chunks(nodes: np.ndarray, batch: int):
        """The first chunk is linked by itself; later ones are never larger than half of what is there."""
        at = 0
        while at < len(nodes):
            size = min(batch, max(32, at // 2))
            yield nodes[at : at + size]
            at += size

    def _insert(self, table: np.ndarray, nodes: np.ndarray, inserted: int) -> None:
        own = self.vectors[nodes]
        sims = own @ own.T
        np.fill_diagonal(sims, -2)
        k = min(len(nodes) - 1, self.links) if inserted else len(nodes) - 1
        near = np.argsort(-sims, axis=1)[:, :k]
        ids = nodes[near].reshape(len(nodes), -1)
        close = np.take_along_axis(sims, near, axis=1)
        if inserted:
            found, score = self._beam(table, own, self._entries(own, len(self.layers)), self.beam)
            ids, close = np.concatenate([ids, found], axis=1), np.concatenate([close, score], axis=1)
        picked = self._diverse(own, ids, close, min(self.links, table.shape[1]))
        table[nodes, : picked.shape[1]] = picked
        # Links back; a node with too many keeps a diverse choice of them.
        source = np.repeat(nodes, picked.shape[1])
        target = picked.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        starts = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else []
        for a, b in zip(starts, np.append(starts[1:], len(target)) if len(target) else []):
            node = target[a]
            held = table[node]
            held = held[held >= 0]
            both = np.concatenate([held, np.setdiff1d(source[a:b], held)])
            if len(both) > table.shape[1]:
                score = self.vectors[both] @ self.vectors[node]
                both = self._diverse(self.vectors[node][None], both[None], score[None], table.shape[1])[0]
                both = both[both >= 0]
            table[node] = -1
            table[node, : len(both)] = both

    def _diverse(self, queries: np.ndarray, ids: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        """At most ``most`` of each row's ids: first those that are closer to the query than to any chosen one."""
        order = np.argsort(-close, axis=1, kind="stable")[:, : 3 * most + 8]
        ids, close = np.take_along_axis(ids, order, axis=1), np.take_along_axis(close, order, axis=1)
        valid = close > -2
        vectors = self.vectors[np.where(valid, ids, 0)]
        between = np.einsum("bid,bjd->bij", vectors, vectors)
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            shadowed = (chosen & (between[:, j] >= close[:, j : j + 1])).any(axis=1)
            chosen[:, j] = valid[:, j] & ~shadowed & (chosen.sum(axis=1) < most)
        # Chosen ones first, then the closest of the others.
        rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(valid, rank, axis=1), np.take_along_axis(ids, rank, axis=1), -1).astype(np.int32)

    def _entries(self, queries: np.ndarray, above: int) -> np.ndarray:
        """Where to enter the layer below the ``above`` upper ones of those built: a few vectors per query."""
        if not above:
            return np.tile(self.tops[:8], (len(queries), 1))
        sims = queries @ self.vectors[self.tops].T
        at = self.tops[np.argsort(-sims, axis=1)[:, :4]]
        for table in self.layers[len(self.layers) - above :][::-1]:
            found, score = self._beam(table, queries, at, 8)
            at = found[:, :4]
            at = np.where(score[:, :4] > -2, at, at[:, :1])
        return at

    def _beam(self, table, queries, entries, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best vectors found for each query, best first, and their similarities (-2 where fewer)."""
        b, n = len(queries), len(self.vectors)
        width = max(4, beam // 16)  # how many of a query's best are opened at a time
        seen = np.zeros((b, n), bool)
        ids = np.full((b, beam), 0, np.int64)
        score = np.full((b, beam), -2, np.float32)
        opened = np.ones((b, beam), bool)
        fresh = entries
        active = np.arange(b)
        while len(active):
            own = active[:, None]
            fresh = np.sort(fresh, axis=1)
            good = (fresh >= 0) & ~seen[own, np.maximum(fresh, 0)]
            good[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            safe = np.where(good, fresh, 0)
            sims = np.einsum("bkd,bd->bk", self.vectors[safe], queries[active])
            sims = np.where(good, sims, np.float32(-2))
            at = np.nonzero(good)
            seen[active[at[0]], fresh[at]] = True
            all_ids = np.concatenate([ids[active], safe], axis=1)
            all_score = np.concatenate([score[active], sims], axis=1)
            all_open = np.concatenate([opened[active], ~good], axis=1)
            order = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(all_ids, order, axis=1)
            score[active] = np.take_along_axis(all_score, order, axis=1)
            opened[active] = np.take_along_axis(all_open, order, axis=1)
            waiting = ~opened[active]
            more = waiting.any(axis=1)
            active = active[more]
            if not len(active):
                break
            # The best that were not opened yet; argsort is stable, so True ones come first in order of rank.
            next_ = np.argsort(~waiting[more], axis=1, kind="stable")[:, :width]
            usable = np.take_along_axis(waiting[more], next_, axis=1)
            own = active[:, None]
            opened[own, next_] = True
            neighbours = table[ids[own, next_]]
            fresh = np.where(usable[:, :, None], neighbours, -1).reshape(len(active), -1).astype(np.int64)
        return ids, score

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best vectors found for each query, best first, and their similarities."""
        beam = min(beam, len(self.vectors))
        parts = []
        step = max(8, min(256, (1 << 17) // beam, (1 << 23) // max(1, len(self.vectors))))
        for at in range(0, len(queries), step):
            some = queries[at : at + step]
            parts.append(self._beam(self.layers[0], some, self._entries(some, len(self.layers) - 1), beam))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
