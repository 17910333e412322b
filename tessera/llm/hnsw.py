"""A hierarchical navigable small-world graph in numpy, searched for many queries in step."""

from __future__ import annotations

import numpy as np

LINKS = 28                 # neighbours of a node on the ground layer
UPPER_LINKS = 16
LAYER = 16                 # a layer holds one in so many nodes of the layer below
BUILD_BEAM = 64
BATCH = 256                # queries, or new nodes, that move in step
PRODUCTS = 1 << 21         # similarities that exact products hold at a time
HELD = 4                   # lists that should hold a node at least
WIDTH = 4                  # nodes a beam opens at a time


def layers(n: int) -> list[int]:
    """Nodes on the layers of a graph of n, from the ground up."""
    sizes = [n]
    while sizes[-1] > 4 * LAYER:
        sizes.append(-(-sizes[-1] // LAYER))
    return sizes


def rows_held(n: int) -> int:
    """Rows of n products each that are held at a time."""
    return max(1, min(BATCH, PRODUCTS // max(1, n)))


def select(sim: np.ndarray, node: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (-1: none): nearest first, a candidate being
    kept if it is nearer to the row than to any kept before; the nearest others then fill
    half of the places, so that some stay free for links out of a dense group."""
    out = np.full((len(node), most), -1, np.int32)
    for lo in range(0, len(node), BATCH):
        out[lo: lo + BATCH] = _select(sim[lo: lo + BATCH], node[lo: lo + BATCH], vectors, most)
    return out


def _select(sim: np.ndarray, node: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    order = np.argsort(-sim, axis=1, kind="stable")
    sim, node = np.take_along_axis(sim, order, 1), np.take_along_axis(node, order, 1)
    some = vectors[np.maximum(node, 0)]
    among = some @ some.transpose(0, 2, 1)
    rows, wide = node.shape
    kept, free, row = np.zeros((rows, wide), bool), node >= 0, np.arange(rows)
    for _ in range(min(most, wide)):
        # the nearest candidate left is kept, those nearer to it than to the row are not
        pick = free.argmax(axis=1)
        any_left = free[row, pick]
        if not any_left.any():
            break
        kept[row, pick] |= any_left
        free &= among[row, pick] <= sim
        free[row, pick] = False
    room = np.maximum(0, most // 2 - kept.sum(axis=1, keepdims=True))
    spare = (node >= 0) & ~kept
    kept |= spare & (np.cumsum(spare, axis=1) <= room)
    place = np.argsort(~kept, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(kept, place, 1), np.take_along_axis(node, place, 1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


class Graph:
    """Layers over unit ``vectors`` (float32); node k is on layer l if k < sizes[l]."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Rows must come in random order: the first ones make the upper layers."""
        n = len(vectors)
        sizes = layers(n)
        graph = cls(vectors, [np.full((s, LINKS if l == 0 else UPPER_LINKS), -1, np.int32) for l, s in enumerate(sizes)])
        for layer in reversed(range(len(sizes))):
            known = sizes[layer + 1] if layer + 1 < len(sizes) else min(n, sizes[layer])
            graph._exact(layer, known)
            while known < sizes[layer]:
                upto = min(sizes[layer], known + min(BATCH, max(16, known)))
                graph._insert(layer, known, upto)
                known = upto
            graph._reach(layer, sizes[layer + 1] if layer + 1 < len(sizes) else 1)
        return graph

    def _reach(self, layer: int, entries: int) -> None:
        """Make every node easy to reach: a node that few lists hold, or that no path from the
        first ``entries`` nodes reaches, goes into the lists of its nearest nodes (of the
        nearest node reached), in free places or that of a link whose node many lists hold."""
        links = self.links[layer]
        for _ in range(4):
            held = np.bincount(links[links >= 0], minlength=len(links))
            rare = np.flatnonzero(held < HELD)
            for u in rare.tolist():
                for v in links[u, :HELD][links[u, :HELD] >= 0].tolist():
                    if u not in links[v]:
                        self._put(links, held, u, v)
            reached, front = np.zeros(len(links), bool), np.arange(min(entries, len(links)))
            while len(front):
                reached[front] = True
                near = np.unique(links[front])
                near = near[near >= 0]
                front = near[~reached[near]]
            lost = np.flatnonzero(~reached)
            step = rows_held(len(links))
            for lo in range(0, len(lost), step):
                some = lost[lo: lo + step]
                sim = self.vectors[some] @ self.vectors[: len(links)].T
                sim[:, lost] = -2
                best = sim.argmax(axis=1)
                for u, v in zip(some.tolist(), best.tolist()):
                    self._put(links, held, u, v)
            if not len(rare) and not len(lost):
                break

    @staticmethod
    def _put(links: np.ndarray, held: np.ndarray, node: int, into: int) -> None:
        row = links[into]
        place = int(np.where(row < 0, 1 << 30, held[np.maximum(row, 0)]).argmax())
        if row[place] >= 0:
            held[row[place]] -= 1
        row[place] = node
        held[node] += 1

    def _exact(self, layer: int, n: int) -> None:
        """Links of the layer's first n nodes among themselves, by blocks of exact products."""
        wide = min(BUILD_BEAM, n - 1)
        if wide < 1:
            return
        for lo in range(0, n, BATCH):
            sim = self.vectors[lo: min(n, lo + BATCH)] @ self.vectors[:n].T
            sim[np.arange(len(sim)), lo + np.arange(len(sim))] = -2
            near = np.argpartition(-sim, wide - 1, axis=1)[:, :wide]
            self.links[layer][lo: lo + len(sim)] = select(np.take_along_axis(sim, near, 1), near, self.vectors,
                                                          self.links[layer].shape[1])
        self._back(layer, np.arange(n))

    def _insert(self, layer: int, lo: int, hi: int) -> None:
        new = self.vectors[lo:hi]
        entry = self.descend(new, layer)
        node, sim = self.beam(new, entry, layer, BUILD_BEAM, lo)
        beside = new @ new.T
        np.fill_diagonal(beside, -2)
        some = np.argpartition(-beside, min(LINKS, len(new) - 1) - 1, axis=1)[:, :LINKS] if len(new) > 1 else np.zeros((1, 0), int)
        node = np.concatenate([node, np.where(np.take_along_axis(beside, some, 1) > -2, some + lo, -1)], axis=1)
        sim = np.concatenate([sim, np.take_along_axis(beside, some, 1)], axis=1)
        self.links[layer][lo:hi] = select(sim, node, self.vectors, self.links[layer].shape[1])
        self._back(layer, np.arange(lo, hi))

    def _back(self, layer: int, sources: np.ndarray) -> None:
        """Links back from the nodes that ``sources`` point to; full lists are selected anew."""
        links = self.links[layer]
        most = links.shape[1]
        source = np.repeat(sources, most)
        target = links[sources].ravel()
        source, target = source[target >= 0], target[target >= 0]
        sim = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sim, target))
        source, target = source[order], target[order]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        turn = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
        few = turn < most                                    # a hub takes its nearest
        source, target, turn = source[few], target[few], turn[few]
        nodes, row = np.unique(target, return_inverse=True)
        fresh = np.full((len(nodes), most), -1, np.int32)
        fresh[row, turn] = source
        order = np.argsort(np.bincount(row), kind="stable")  # lists of like lengths together
        nodes, fresh = nodes[order], fresh[order]
        for lo in range(0, len(nodes), BATCH):
            at = nodes[lo: lo + BATCH]
            every = np.sort(np.concatenate([links[at], fresh[lo: lo + BATCH]], axis=1), axis=1)
            every[:, 1:][every[:, 1:] == every[:, :-1]] = -1  # links that are there already
            every.sort(axis=1)
            every = every[:, min((every < 0).sum(axis=1).min(), every.shape[1] - 1):]
            sim = (self.vectors[np.maximum(every, 0)] @ self.vectors[at][:, :, None])[:, :, 0]
            links[at] = select(np.where(every >= 0, sim, -2), every, self.vectors, most)

    def descend(self, queries: np.ndarray, layer: int = 0) -> np.ndarray:
        """Entry nodes on ``layer``: beams from the top layer down."""
        entry = np.zeros((len(queries), 1), np.int64)
        for l in range(len(self.links) - 1, layer, -1):
            entry = self.beam(queries, entry, l, 8)[0]
        return entry

    def beam(self, queries: np.ndarray, entry: np.ndarray, layer: int, wide: int, limit: int | None = None
             ) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of each query's beam on the layer's first ``limit`` nodes; -1: none."""
        links, vectors = self.links[layer], self.vectors
        n = limit or len(links)
        out_node = np.full((len(queries), wide), -1, np.int64)
        out_sim = np.full((len(queries), wide), -2, np.float32)
        for lo in range(0, len(queries), BATCH):
            some = queries[lo: lo + BATCH]
            live = np.arange(len(some))
            seen = np.zeros((len(some), n + 1), bool)        # the last column takes the -1
            node = np.full((len(some), wide), -1, np.int64)
            sim = np.full((len(some), wide), -2, np.float32)
            start = entry[lo: lo + BATCH]
            start = np.where((start >= 0) & (start < n), start, -1)[:, :wide]
            node[:, : start.shape[1]] = start
            sim[:, : start.shape[1]] = np.where(start >= 0, np.einsum(
                "ijk,ik->ij", vectors[np.maximum(start, 0)], some), -2)
            np.put_along_axis(seen, start, True, 1)
            done = node < 0
            while len(live):
                score = np.where(done, -2, sim)
                pick = np.argpartition(-score, min(WIDTH, wide) - 1, axis=1)[:, :WIDTH]
                chosen = np.where(np.take_along_axis(score, pick, 1) > -2, np.take_along_axis(node, pick, 1), -1)
                np.put_along_axis(done, pick, True, 1)
                near = np.where(chosen[:, :, None] >= 0, links[np.maximum(chosen, 0)], -1).reshape(len(live), -1)
                near = np.sort(np.where(near < n, near, -1), axis=1)
                near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
                near = np.where(np.take_along_axis(seen, near, 1), -1, near)
                r, c = np.nonzero(near >= 0)
                got = np.full(near.shape, -2, np.float32)
                got[r, c] = np.einsum("ij,ij->i", vectors[near[r, c]], some[r])
                seen[r, near[r, c]] = True
                node = np.concatenate([node, near], axis=1)
                sim = np.concatenate([sim, got], axis=1)
                done = np.concatenate([done, near < 0], axis=1)
                best = np.argpartition(-sim, wide - 1, axis=1)[:, :wide]
                node, sim, done = (np.take_along_axis(x, best, 1) for x in (node, sim, done))
                over = done.all(axis=1)
                if over.any():
                    out_node[lo + live[over]], out_sim[lo + live[over]] = node[over], sim[over]
                    keep = ~over
                    live, node, sim, done, seen, some = (x[keep] for x in (live, node, sim, done, seen, some))
        return out_node, out_sim

    def near(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of similarity ``least`` or more.  A beam that is half full of them is
        doubled; one that would hold a quarter of the graph gives way to exact products."""
        n, todo = len(self.vectors), np.arange(len(queries))
        entry = self.descend(queries)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(todo):
            if beam * 4 >= n:
                found.append(self.exact(queries, todo, least))
                break
            node, sim = self.beam(queries[todo], entry[todo], 0, beam)
            hit = (sim >= least) & (node >= 0)
            full = hit.sum(axis=1) * 2 >= beam
            r, c = np.nonzero(hit & ~full[:, None])
            found.append((todo[r], node[r, c]))
            todo, beam = todo[full], 2 * beam
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))

    def exact(self, queries: np.ndarray, which: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = [np.zeros(0, int)], [np.zeros(0, int)]
        step = rows_held(len(self.vectors))
        for lo in range(0, len(which), step):
            r, c = np.nonzero(queries[which[lo: lo + step]] @ self.vectors.T >= least)
            rows.append(which[lo + r])
            cols.append(c)
        return np.concatenate(rows), np.concatenate(cols)
