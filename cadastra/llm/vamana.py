"""A robust-pruned proximity graph over one shard of vectors, in NumPy.

Similarity is the inner product of rows that all have the same norm, so larger means nearer in the Euclidean sense too.
Graphs are built in double precision, as distances are twice the squared norm less a product that is near it.
Points are inserted in batches: beam searches of the graph so far propose neighbours, pruning keeps a neighbour unless one
already kept is nearer to it, by the factor ``ALPHA``, than the point itself is; then links back are added and
lists that overflow are pruned in the same way.
"""

from __future__ import annotations

import numpy as np

DEGREE = 32
SLACK = 16
BUILD_BEAM = 64
ALPHA = 1.2
BATCH = 256
EXPAND = 4


def beam_search(
    queries: np.ndarray, points: np.ndarray, graph: np.ndarray, entry: int, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities of the ``beam`` nearest points found for each query, nearest first; -1 where fewer."""
    rows = len(queries)
    ids = np.full((rows, beam), -1, np.int64)
    sims = np.full((rows, beam), -np.inf, points.dtype)
    done = np.zeros((rows, beam), bool)
    seen = np.zeros((rows, len(points)), bool)
    ids[:, 0], sims[:, 0], seen[:, entry] = entry, queries @ points[entry], True
    active = np.arange(rows)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        step = min(EXPAND, beam)
        at = np.argpartition(-open_sims, step - 1, axis=1)[:, :step]
        usable = np.take_along_axis(open_sims, at, 1) > -np.inf
        alive = usable.any(1)
        active, at, usable = active[alive], at[alive], usable[alive]
        if not len(active):
            break
        done[active[:, None], at] |= usable
        current = np.where(usable, ids[active[:, None], at], entry)
        near = graph[current].reshape(len(active), -1)
        fresh = (near >= 0) & ~seen[active[:, None], near] & np.repeat(usable, graph.shape[1], 1)
        # one list may name a point twice through two of the points expanded; the first stands
        order = np.argsort(near, axis=1, kind="stable")
        ordered = np.take_along_axis(near, order, 1)
        twice = np.zeros_like(fresh)
        np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
        fresh &= ~twice
        seen[active[:, None], np.where(fresh, near, entry)] = True
        new = np.einsum("brd,bd->br", points[near], queries[active], optimize=True)
        new[~fresh] = -np.inf
        all_sims = np.concatenate([sims[active], new], 1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[active], np.zeros_like(fresh)], 1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        sims[active] = np.take_along_axis(all_sims, best, 1)
        ids[active] = np.take_along_axis(all_ids, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def pruned(ids: np.ndarray, sims: np.ndarray, points: np.ndarray, norm2: float, degree: int) -> np.ndarray:
    """Neighbour lists (padded with -1) from candidate lists ordered nearest first."""
    rows, width = ids.shape
    alive = ids >= 0
    among = np.matmul(points[ids], points[ids].transpose(0, 2, 1))
    apart = np.maximum(2 * (norm2 - among), 0)
    away = np.maximum(2 * (norm2 - sims), 0)
    out = np.full((rows, degree), -1, np.int64)
    each = np.arange(rows)
    for place in range(degree):
        first = alive.argmax(1)
        live = alive[each, first]
        if not live.any():
            break
        out[live, place] = ids[each, first][live]
        covered = ALPHA * ALPHA * apart[each, first] <= away
        alive &= ~(covered & live[:, None])
        alive[each, first] = False
    return out


def build(points: np.ndarray, seed: int = 42) -> tuple[np.ndarray, int]:
    """Neighbour lists (rows padded with -1) and the entry point of a graph over ``points``."""
    count = len(points)
    graph = np.full((count, DEGREE + SLACK), -1, np.int64)
    entry = int(np.argmax(points @ points.mean(0)))
    norm2 = float((points[0] * points[0]).sum())
    order = np.random.default_rng(seed).permutation(count)
    order = order[order != entry]
    start, size = 0, 1
    while start < len(order):
        batch = order[start : start + size]
        ids, sims = beam_search(points[batch], points, graph, entry, BUILD_BEAM)
        # points of one batch do not see each other in the graph yet; they are candidates as well
        mates = points[batch] @ points[batch].T
        np.fill_diagonal(mates, -np.inf)
        nearest = np.argsort(-mates, axis=1)[:, :DEGREE]
        own = np.where(np.take_along_axis(mates, nearest, 1) > -np.inf, batch[nearest], -1)
        ids = np.concatenate([ids, own], 1)
        sims = np.concatenate([sims, np.take_along_axis(mates, nearest, 1)], 1)
        by = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)
        lists = pruned(ids, sims, points, norm2, DEGREE)
        graph[batch, :DEGREE] = lists
        link_back(graph, points, batch, lists, norm2)
        start += size
        size = min(size * 2, BATCH)
    return graph, entry


def link_back(graph: np.ndarray, points: np.ndarray, batch: np.ndarray, lists: np.ndarray, norm2: float) -> None:
    """Add the reverse of each new link; prune the lists that do not take all of them."""
    source = np.repeat(batch, lists.shape[1])
    target = lists.ravel()
    source, target = source[target >= 0], target[target >= 0]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    owners, first, incoming = np.unique(target, return_index=True, return_counts=True)
    held = (graph[owners] >= 0).sum(1)
    width = graph.shape[1] + int(incoming.max(initial=0))
    lists_of = np.full((len(owners), width), -1, np.int64)
    lists_of[:, : graph.shape[1]] = graph[owners]
    spot = np.arange(len(target)) - np.repeat(first, incoming)
    lists_of[np.repeat(np.arange(len(owners)), incoming), np.repeat(held, incoming) + spot] = source
    # new points of one batch may have chosen each other
    ordered = np.sort(lists_of, axis=1)
    repeats = ((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] >= 0)).any(1)
    fits = (held + incoming <= graph.shape[1]) & ~repeats
    graph[owners[fits]] = lists_of[fits][:, : graph.shape[1]]
    for part in np.array_split(np.flatnonzero(~fits), max(1, (~fits).sum() // BATCH)):
        if not len(part):
            continue
        ids = np.sort(lists_of[part], axis=1)[:, ::-1]
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.einsum("brd,bd->br", points[ids], points[owners[part]], optimize=True)
        sims[ids < 0] = -np.inf
        nearest = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * DEGREE]
        lists = pruned(
            np.take_along_axis(ids, nearest, 1), np.take_along_axis(sims, nearest, 1), points, norm2, DEGREE
        )
        graph[owners[part]] = -1
        graph[owners[part], :DEGREE] = lists
