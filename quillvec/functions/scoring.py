"""Block scoring of vectors against queries inside a task, with numpy.

A matrix product finds candidates; the score of each is then summed by itself, in a fixed order, so that it does
not depend on how rows were grouped into blocks, files or tasks. The product may differ from that sum by rounding,
so it only prunes, with a margin above its error bound. It is taken in single precision first, and
again in double precision where single leaves too many candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

METRICS = ("dot", "cosine", "euclidean")
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
BLOCK_PAIRS = 8_000_000
PAIR_BLOCK = 128
FLUSH_ENTRIES = 1_000_000
SINGLE, DOUBLE = np.float32, np.float64


def as_matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a matrix, and the positions of the rows that are complete finite vectors."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = arr.flatten()  # leaves out NULL lists and respects slices
    sizes = arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    right = sizes == dimension
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if right.all():
        matrix = values.reshape(-1, dimension)
    else:
        starts = np.cumsum(sizes) - sizes
        matrix = values[starts[right][:, None] + np.arange(dimension)]
    rows = np.flatnonzero(right)
    good = np.isfinite(matrix).all(axis=1)  # a NULL element arrives as NaN
    return (matrix, rows) if good.all() else (matrix[good], rows[good])


def row_sums(make_terms, n: int) -> np.ndarray:
    """Sums of n rows of terms, a few rows at a time so that they stay in cache; ``make_terms`` gives a slice.

    Each row is added up by itself, pairwise, in an order that follows from its length alone.
    """
    out = np.empty(n)
    for start in range(0, n, PAIR_BLOCK):
        part = slice(start, min(start + PAIR_BLOCK, n))
        np.add.reduce(make_terms(part), axis=1, out=out[part])
    return out


def within_single(norms: np.ndarray) -> bool:
    """Whether products of such vectors stay clear of the limits of single precision."""
    return len(norms) == 0 or bool(norms.max() < 1e15 and norms.min() > 1e-15)


class Rows:
    """Rows of one namespace with their lengths, converted once."""

    def __init__(self, v: np.ndarray, norm: np.ndarray):
        self.v, self.norm, self.safe = v, norm, within_single(norm)
        self._single = None

    def of(self, kind: type) -> np.ndarray:
        if kind is DOUBLE:
            return self.v
        if self._single is None:
            self._single = self.v.astype(SINGLE)
        return self._single


class LocalTopK:
    """Running top k per (namespace, query) over the rows one task sees; order is score descending, id ascending."""

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        self.q, self.k, self.metric = queries, k, metric
        # Every pair of a block can survive where namespaces are tiny.
        self.row_block = max(1, min(ROW_BLOCK, BLOCK_PAIRS // max(1, len(queries))))
        self.q_norm = np.sqrt((queries * queries).sum(axis=1))
        self.usable = self.q_norm > 0 if metric == "cosine" else np.ones(len(queries), bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = queries / self.q_norm[:, None] if metric == "cosine" else queries
        self.single_safe = within_single(self.q_norm[self.usable])
        self.q_squares = row_sums(lambda p: np.square(queries[p]), len(queries))
        self.pruning = {DOUBLE: scaled, SINGLE: scaled.astype(SINGLE) if self.single_safe else None}
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.kth = np.empty((0, len(self.q)))
        self.ns = np.empty(0, np.int64)
        self.qi = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.ids = np.empty(0, object)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n_waiting = 0

    def add(self, matrix: np.ndarray, ids: np.ndarray, names: list[str], which: np.ndarray):
        """Take in rows, with the namespace of row i in ``names[which[i]]``; yields results early when many small
        namespaces have filled the state."""
        for start in range(0, len(matrix), self.row_block):
            part = slice(start, start + self.row_block)
            self._add_block(matrix[part], ids[part], names, which[part])
            # Put in place only when there are as many as before, so that the sort of the state is paid by new entries.
            if self.n_waiting >= min(len(self.score), FLUSH_ENTRIES):
                self._settle()
            if len(self.score) > FLUSH_ENTRIES:
                yield self.drain()

    def _add_block(self, x: np.ndarray, ids: np.ndarray, names: list[str], which: np.ndarray) -> None:
        found = []
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        code = np.empty(len(x), np.int64)
        for local in np.unique(which):
            rows = np.flatnonzero(which == local)
            code[rows] = c = self._code(names[local])
            found.extend(self._candidates(x, norm, ids, rows, c))
        if not found:
            return
        row = np.concatenate([f[0] for f in found])
        qi = np.concatenate([f[1] for f in found])
        score = self._exact(x, row, qi)
        keep = ~np.isnan(score)
        self.waiting.append((code[row[keep]], qi[keep], score[keep], ids[row[keep]]))
        self.n_waiting += len(self.waiting[-1][0])

    def _settle(self) -> None:
        if self.n_waiting:
            self._merge(*map(np.concatenate, zip(*self.waiting)))
        self.waiting, self.n_waiting = [], 0

    def _exact(self, x: np.ndarray, row: np.ndarray, qi: np.ndarray) -> np.ndarray:
        """Score of each pair, from sums of its own."""
        if self.metric == "euclidean":
            return -np.sqrt(row_sums(lambda p: np.square(x[row[p]] - self.q[qi[p]]), len(row)))
        dot = row_sums(lambda p: x[row[p]] * self.q[qi[p]], len(row))
        if self.metric == "dot":
            return dot
        used, at = np.unique(row, return_inverse=True)
        squares = row_sums(lambda p: np.square(x[used[p]]), len(used))
        with np.errstate(divide="ignore", invalid="ignore"):
            return dot / np.sqrt(squares[at] * self.q_squares[qi])

    def _code(self, name: str) -> int:
        if name not in self.codes:
            self.codes[name] = len(self.codes)
            if len(self.codes) > len(self.kth):
                more = np.full((max(8, len(self.kth)), len(self.q)), -np.inf)
                self.kth = np.concatenate([self.kth, more])
        return self.codes[name]

    def _candidates(self, x: np.ndarray, norm: np.ndarray, ids: np.ndarray, rows: np.ndarray, code: int):
        """Pairs of rows of one namespace and queries that can still enter the top k, by block of queries."""
        if self.metric == "cosine":
            rows = rows[norm[rows] > 0]
        if len(rows) == 0:
            return
        norm = norm[rows]
        v = x if len(rows) == len(x) else x[rows]
        if self.metric == "cosine":
            v = v / norm[:, None]
        blocks = Rows(v, norm)
        few = None
        for start in range(0, len(self.q), QUERY_BLOCK):
            part = slice(start, start + QUERY_BLOCK)
            enough = 4 * self.k * (min(start + QUERY_BLOCK, len(self.q)) - start)
            hit = None
            if blocks.safe and self.single_safe:
                hit = self._hits(blocks, code, part, SINGLE)
            if hit is None or np.count_nonzero(hit) > enough:
                hit = self._hits(blocks, code, part, DOUBLE)
                if np.count_nonzero(hit) > enough and len(rows) > self.k:
                    few = self._few_copies(v, ids[rows]) if few is None else few
                    hit &= few[:, None]
            r, j = np.nonzero(hit)
            yield rows[r], j + start

    def _hits(self, rows: Rows, code: int, part: slice, kind: type) -> np.ndarray:
        q, q_norm = self.pruning[kind][part], self.q_norm[part]
        approx = rows.of(kind) @ q.T
        unit = 2 * (q.shape[1] + 8) * np.finfo(kind).eps / 2
        bar = self.kth[code, part]
        if self.metric == "cosine":
            margin = np.full(len(q), unit)
        else:
            margin = unit * rows.norm.max() * q_norm
            if self.metric == "euclidean":
                approx = 2 * approx.astype(DOUBLE, copy=False) - (rows.norm ** 2)[:, None] - (q_norm ** 2)[None, :]
                slack = 4 * (q.shape[1] + 8) * np.finfo(DOUBLE).eps
                margin = 2 * margin + slack * (rows.norm.max() + q_norm) ** 2
                bar = np.where(np.isfinite(bar), -bar * bar, bar)
        if len(approx) > self.k and np.isneginf(bar).any():
            place = len(approx) - self.k
            bar = np.maximum(bar, np.partition(approx, place, axis=0)[place])
        return (approx >= (bar - 2 * margin).astype(approx.dtype)) & self.usable[part]

    def _few_copies(self, v: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of equal vectors only the k smallest ids can be in any result; true for these and for all others."""
        raw = np.ascontiguousarray(v).view(np.dtype((np.void, v.shape[1] * 8))).ravel()
        group = np.unique(raw, return_inverse=True)[1]
        order = np.lexsort((rank_of(ids), group))
        keep = np.empty(len(ids), bool)
        keep[order] = run_position(group[order]) < self.k
        return keep

    def _merge(self, ns, qi, score, ids) -> None:
        """Put new entries in place; only the namespaces that have any are sorted again."""
        codes = np.zeros(len(self.kth), bool)
        codes[ns] = True
        old = codes[self.ns]
        rest = (self.ns[~old], self.qi[~old], self.score[~old], self.ids[~old])
        ns, qi = np.concatenate([self.ns[old], ns]), np.concatenate([self.qi[old], qi])
        score, ids = np.concatenate([self.score[old], score]), np.concatenate([self.ids[old], ids])
        group = ns * len(self.q) + qi
        order = np.lexsort((-score, group))
        tied = (group[order][1:] == group[order][:-1]) & (score[order][1:] == score[order][:-1])
        if tied.any():
            at = order[np.r_[tied, False] | np.r_[False, tied]]
            rank = np.zeros(len(ids), np.int64)
            rank[at] = rank_of(ids[at])
            order = np.lexsort((rank, -score, group))
        place = run_position(group[order])
        order, place = order[place < self.k], place[place < self.k]
        ns, qi, score, ids = ns[order], qi[order], score[order], ids[order]
        last = place == self.k - 1
        self.kth[ns[last], qi[last]] = score[last]
        self.ns, self.qi, self.score, self.ids = (
            np.concatenate(pair) for pair in zip(rest, (ns, qi, score, ids)))

    def drain(self) -> dict[str, np.ndarray]:
        self._settle()
        names = np.array(list(self.codes), object)
        out = {"query": self.qi, "namespace": names[self.ns] if len(names) else self.ids,
               "id": self.ids, "score": self.score}
        self._clear()
        return out


def rank_of(ids: np.ndarray) -> np.ndarray:
    """Order of ids; Python compares by code point, which is the byte order Spark uses."""
    return np.unique(ids, return_inverse=True)[1]


def run_position(sorted_groups: np.ndarray) -> np.ndarray:
    """Position of each element in its run of equal values."""
    n = len(sorted_groups)
    at = np.arange(n)
    starts = np.r_[True, sorted_groups[1:] != sorted_groups[:-1]] if n else np.empty(0, bool)
    return at - np.maximum.accumulate(np.where(starts, at, 0))
