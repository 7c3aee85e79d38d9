"""Hierarchical navigable small-world graphs over unit vectors, built and searched for many vectors at once in numpy."""

from __future__ import annotations

import numpy as np

NONE = -1


def _select(x: np.ndarray, candidates: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` neighbours of each row among its candidates (sorted by similarity, NONE last).

    A candidate closer to the row than to all chosen before it comes first, which keeps far groups connected; the
    nearest of the others fill what is left.
    """
    rows, width = candidates.shape
    valid = candidates != NONE
    near = x[np.where(valid, candidates, 0)]
    between = near @ near.transpose(0, 2, 1)
    chosen, closest = np.zeros((rows, width), bool), np.full((rows, width), -2, np.float32)
    for c in range(width):
        take = valid[:, c] & (closest[:, c] < sims[:, c])
        chosen[:, c] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, :, c]), closest)
    order = np.argsort(np.where(valid, np.where(chosen, 0, 1), 2), axis=1, kind="stable")[:, :most]
    out = np.full((rows, most), NONE, np.int32)
    out[:, : order.shape[1]] = np.take_along_axis(np.where(valid, candidates, NONE), order, 1)
    return out


def _sorted(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    if ids.shape[1] > width:
        part = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        ids, sims = np.take_along_axis(ids, part, 1), np.take_along_axis(sims, part, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` best nodes met from the entries (rows of node ids) and their similarities, best first."""
    rows = len(queries)
    ids, sims, open_ = np.full((rows, beam), NONE, np.int32), np.full((rows, beam), -2, np.float32), np.zeros((rows, beam), bool)
    seen = np.zeros((rows, len(x) + 1), bool)
    seen[:, NONE] = True
    live, fresh = np.arange(rows), entries
    while len(live):
        fresh = np.sort(fresh, axis=1)
        new = ~seen[live[:, None], fresh]
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        seen[live[:, None], fresh] = True
        # Most nodes of a later step have been met before; only the others are compared.
        found = np.full(fresh.shape, -2, np.float32)
        found[new] = np.einsum("kd,kd->k", x[fresh[new]], np.repeat(queries[live], new.sum(1), axis=0))
        both = np.concatenate([ids[live], np.where(new, fresh, NONE)], 1), np.concatenate([sims[live], found], 1)
        marks = np.concatenate([open_[live], new], 1)
        order = np.argsort(-both[1], axis=1, kind="stable")[:, :beam]
        ids[live], sims[live] = np.take_along_axis(both[0], order, 1), np.take_along_axis(both[1], order, 1)
        marks = np.take_along_axis(marks, order, 1)
        live, marks = live[marks.any(1)], marks[marks.any(1)]
        if not len(live):
            break
        # The best nodes not yet expanded; rows are sorted, so they come first.
        first = np.argsort(~marks, axis=1, kind="stable")[:, :step]
        usable = np.take_along_axis(marks, first, 1)
        nodes = np.where(usable, np.take_along_axis(ids[live], first, 1), NONE)
        np.put_along_axis(marks, first, False, 1)
        open_[live] = marks
        fresh = np.where((nodes != NONE)[:, :, None], links[np.where(nodes == NONE, 0, nodes)], NONE).reshape(len(live), -1)
    return ids, sims


class Graph:
    """Layers from the top down: the node numbers of each layer and their links, as positions in that layer."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers

    def entries(self, queries: np.ndarray, layers: list, width: int = 4) -> np.ndarray:
        """Node numbers near the queries, found by descending through `layers`."""
        near = None
        for nodes, links in layers:
            place = np.full(len(self.x), NONE, np.int32)
            place[nodes] = np.arange(len(nodes))
            start = np.zeros((len(queries), 1), np.int32) if near is None else place[near]
            ids, _ = beam_search(self.x[nodes], links, queries, start, min(2 * width, max(1, len(nodes))))
            near = np.where(ids[:, :width] == NONE, nodes[0], nodes[ids[:, :width]])
        return near

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        nodes, links = self.layers[-1]
        place = np.full(len(self.x), NONE, np.int32)
        place[nodes] = np.arange(len(nodes))
        above = self.entries(queries, self.layers[:-1])
        start = np.zeros((len(queries), 1), np.int32) if above is None else place[above]
        ids, sims = beam_search(self.x[nodes], links, queries, start, min(beam, len(nodes)))
        return np.where(ids == NONE, NONE, nodes[ids]), sims


def build(x: np.ndarray, degree: int = 16, beam: int = 48, shrink: int = 24, seed: int = 1, batch: int = 1024) -> Graph:
    """A graph over unit vectors (float32). Each layer holds about one in `shrink` nodes of the one below it.

    Nodes join a layer in batches, those of the layer above first: each is linked with the best of a search among the
    nodes there already and of its own batch, and their lists are pruned in turn.
    """
    draw = np.random.default_rng(seed)
    order, sizes = draw.permutation(len(x)).astype(np.int32), [len(x)]
    while sizes[-1] > 512:
        sizes.append(max(1, sizes[-1] // shrink))
    graph = Graph(x, [])
    for size in reversed(sizes):
        nodes = order[:size]
        own = x[nodes]
        most = 2 * degree if size == len(x) else degree
        links = np.full((size, most), NONE, np.int32)
        done = min(size, 512)
        sims = own[:done] @ own[:done].T
        np.fill_diagonal(sims, -2)
        ids, s = _sorted(np.broadcast_to(np.arange(done, dtype=np.int32), sims.shape), sims, min(beam, done))
        links[:done] = _select(own, np.where(s > -2, ids, NONE), s, most)
        place = np.full(len(x), NONE, np.int32)
        place[nodes] = np.arange(size)
        while done < size:
            stop = min(size, done + min(done, batch))
            fresh = own[done:stop]
            above = graph.entries(fresh, graph.layers)
            start = np.zeros((len(fresh), 1), np.int32) if above is None else place[above]
            ids, s = beam_search(own[:done], links[:done], fresh, np.where(start < done, start, 0), min(beam, done))
            peers = fresh @ fresh.T
            np.fill_diagonal(peers, -2)
            inner, t = _sorted(np.broadcast_to(np.arange(done, stop, dtype=np.int32), peers.shape), peers, min(16, len(fresh)))
            ids, s = _sorted(np.concatenate([ids, np.where(t > -2, inner, NONE)], 1), np.concatenate([s, t], 1), beam)
            links[done:stop, :degree] = _select(own, np.where(s > -2, ids, NONE), s, degree)
            _link_back(own, links, done, stop)
            done = stop
        graph.layers.append((nodes, links))
    return graph


def _link_back(x: np.ndarray, links: np.ndarray, start: int, stop: int, block: int = 1024) -> None:
    """Adds the reverse of the links of nodes start..stop, pruning the lists that grow too long."""
    most = links.shape[1]
    targets = links[start:stop]
    sources = np.broadcast_to(np.arange(start, stop, dtype=np.int32)[:, None], targets.shape)[targets != NONE]
    targets = targets[targets != NONE]
    sims = np.einsum("kd,kd->k", x[sources], x[targets])
    order = np.lexsort((-sims, targets))
    sources, targets = sources[order], targets[order]
    nodes, begin = np.unique(targets, return_index=True)
    rank = np.arange(len(targets)) - np.repeat(begin, np.diff(np.append(begin, len(targets))))
    incoming = np.full((len(nodes), most), NONE, np.int32)
    few = rank < most
    incoming[np.searchsorted(nodes, targets[few]), rank[few]] = sources[few]
    for at in range(0, len(nodes), block):
        part = nodes[at : at + block]
        ids = np.sort(np.concatenate([links[part], incoming[at : at + block]], 1), axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = NONE
        # A list that has room keeps all its nodes; only the others are weighed against each other.
        count = (ids != NONE).sum(1)
        room, ids = count <= most, np.sort(ids, axis=1)[:, ::-1]
        links[part[room]] = ids[room, :most]
        part, ids = part[~room], ids[~room, : count.max()]
        s = np.einsum("akd,ad->ak", x[ids], x[part])
        s[ids == NONE] = -2
        ids, s = _sorted(ids, s, ids.shape[1])
        links[part] = _select(x, np.where(s > -2, ids, NONE), s, most)
