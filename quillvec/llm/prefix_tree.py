"""A prefix tree over sets, traversed by all queries at once."""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets of items in one order, most frequent first, laid out so that a subtree is a range of sorted sets.

    ``sets`` are arrays of distinct numbers. An item found in one set only can't be shared: it counts in the size of
    its set, and isn't stored.
    """

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        items, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.lexsort((items, -counts))
        rank = np.empty(len(items), np.int64)
        rank[order] = np.arange(len(items))
        self.n_ranks = int((counts > 1).sum())
        owner = np.repeat(np.arange(len(sets)), sizes)
        path = rank[inverse]
        keep = path < self.n_ranks
        owner, path = owner[keep], path[keep]
        at = np.lexsort((path, owner))
        owner, path = owner[at], path[at]
        lengths = np.bincount(owner, minlength=len(sets))
        starts = np.r_[0, np.cumsum(lengths)]
        paths = [path[starts[i]:starts[i + 1]] for i in range(len(sets))]
        # Bytes of big-endian numbers sort like the paths.
        by = sorted(range(len(sets)), key=lambda i: paths[i].astype(">u4").tobytes())
        self.order = np.array(by, np.int64)
        self.paths = [paths[i] for i in by]
        self.lengths = lengths[self.order]
        self.sizes = sizes[self.order]
        place = np.empty(len(sets), np.int64)
        place[self.order] = np.arange(len(sets))
        #: (set, rank) of each stored item as one sorted number, and the sets that hold each rank.
        self.flat = np.sort(place[owner] * self.n_ranks + path)
        self.flat_starts = np.r_[0, np.cumsum(self.lengths)]
        by_rank = np.lexsort((place[owner], path))
        self.holders = place[owner][by_rank]
        self.holder_starts = np.r_[0, np.cumsum(np.bincount(path, minlength=self.n_ranks))]

    def _hits(self, alive: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Items of ``segment`` in each set of ``alive``."""
        total = int((self.holder_starts[segment + 1] - self.holder_starts[segment]).sum())
        if len(alive) * len(segment) * 4 < total + len(self.paths):
            wanted = (alive[:, None] * self.n_ranks + segment).ravel()
            at = np.minimum(np.searchsorted(self.flat, wanted), len(self.flat) - 1)
            return (self.flat[at] == wanted).reshape(len(alive), len(segment)).sum(axis=1)
        held = np.concatenate([self.holders[self.holder_starts[t]:self.holder_starts[t + 1]] for t in segment])
        return np.bincount(held, minlength=len(self.paths))[alive]

    def _left(self, alive: np.ndarray, rank: int) -> np.ndarray:
        """Items beyond ``rank`` in each set of ``alive``."""
        return self.flat_starts[alive + 1] - np.searchsorted(self.flat, alive * self.n_ranks + rank, "right")

    def similar(self, percent: int, queries: np.ndarray | None = None):
        """Yields ``(set, its similar queries)``, by position in the sorted order.

        Two sets are similar if ``100 * intersection >= percent * union``. ``queries`` restricts one side to some
        positions. All queries descend the tree together; the overlap with a shared part of the path is counted once
        for all sets below, and a query leaves a subtree when even all items left would not do.
        """
        alive = np.arange(len(self.paths)) if queries is None else np.sort(queries)
        stack = [(0, len(self.paths), 0, alive, np.zeros(len(alive), np.int64))]
        while stack:
            lo, hi, depth, alive, hits = stack.pop()
            shared = _common(self.paths[lo], self.paths[hi - 1], depth)
            if shared > depth:
                segment = self.paths[lo][depth:shared]
                hits = hits + self._hits(alive, segment)
                left = np.minimum(self._left(alive, int(segment[-1])), int(self.lengths[lo:hi].max()) - shared)
            else:
                left = np.full(len(alive), int(self.lengths[lo:hi].max()) - shared)
            small = int(self.sizes[lo:hi].min())
            stay = (100 + percent) * (hits + left) >= percent * (small + self.sizes[alive])
            if not stay.all():
                alive, hits = alive[stay], hits[stay]
            if not len(alive):
                continue
            while lo < hi and self.lengths[lo] == shared:  # sets that end here come first
                same = (100 + percent) * hits >= percent * (self.sizes[lo] + self.sizes[alive])
                yield lo, alive[same]
                lo += 1
            while lo < hi:
                after = _next_child(self.paths, lo, hi, shared)
                stack.append((lo, after, shared, alive, hits))
                lo = after


def _common(a: np.ndarray, b: np.ndarray, depth: int) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[depth:n] != b[depth:n])
    return depth + int(differ[0]) if len(differ) else n


def _next_child(paths: list[np.ndarray], lo: int, hi: int, depth: int) -> int:
    """End of the range of paths that have the same item at ``depth`` as the first."""
    item, a, b = paths[lo][depth], lo, hi
    while b - a > 1:
        middle = (a + b) // 2
        if paths[middle][depth] == item:
            a = middle
        else:
            b = middle
    return b


def forest(tree: PrefixTree, percent: int, queries: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets, by position in the input, that connect what all similar pairs connect: the first set of each
    component with every other one."""
    label = np.arange(len(tree.paths))
    for one, others in tree.similar(percent, queries):
        for other in others[label[others] != label[one]].tolist():
            if label[other] != label[one]:
                label[label == label[other]] = label[one]
    out = []
    for group in np.split(np.argsort(label, kind="stable"), np.cumsum(np.unique(label, return_counts=True)[1])[:-1]):
        first, *rest = sorted(tree.order[group].tolist())
        out += [(first, other) for other in rest]
    return out
