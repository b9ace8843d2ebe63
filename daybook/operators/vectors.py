"""Vectors in numpy and the exact scoring of one side against another (survey: F16, F17).

A matrix product makes a shortlist with an error margin, and the shortlist is scored and
ranked by the defining formula, so equal vectors score exactly alike wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scores held at a time.
SCORES = 1 << 22
_EPS = 1e-13


class Vectors:
    """Vectors of one side: cells (null and missing ones 0.0), lengths, ids, labels."""

    def __init__(self, ids: pa.Array, vecs: pa.Array, labels: np.ndarray):
        vecs = vecs.combine_chunks() if isinstance(vecs, pa.ChunkedArray) else vecs
        self.ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        self.labels = labels
        self.length = pc.fill_null(pc.list_value_length(vecs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.fill_null(vecs.flatten(), 0.0).to_numpy(zero_copy_only=False).astype(np.float64)
        n, width = len(self.length), int(self.length.max(initial=0))
        self.cells = np.zeros((n, width))
        row = np.repeat(np.arange(n), self.length)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.cells[row, col] = np.nan_to_num(flat, nan=0.0)
        self.square = (self.cells * self.cells).sum(axis=1)

    def __len__(self) -> int:
        return len(self.length)


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _similarity(metric: str, q: np.ndarray, c: np.ndarray, both: np.ndarray) -> np.ndarray:
    """F16 or F17 of row pairs by definition; ``both``: cells that both vectors of a pair
    have (the Euclidean form compares as far as both go, like a zip)."""
    if metric == "euclidean":
        d = np.where(np.arange(q.shape[1]) < both[:, None], q - c, 0.0)
        return 1.0 / (1.0 + np.sqrt((d * d).sum(axis=1)))
    norm = np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norm > 0, (q * c).sum(axis=1) / norm, np.nan)


def best(q: Vectors, c: Vectors, k: int, metric: str, other: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every query the ``k`` best candidates by ``similarity desc (NaN last), label,
    id``: arrays ``query, candidate, similarity``. ``other[i, j]``: whether candidate j is
    another row than query i."""
    width = max(q.cells.shape[1], c.cells.shape[1])
    x, y = _widen(q.cells, width), _widen(c.cells, width)
    id_rank = np.empty(len(c), dtype=np.int64)
    id_rank[pc.sort_indices(c.ids).to_numpy()] = np.arange(len(c))
    out = []
    step = max(1, SCORES // max(1, len(c)))
    for a in range(0, len(q), step):
        b = min(a + step, len(q))
        dot = x[a:b] @ y.T
        if metric == "euclidean":
            if (q.length[a:b, None] == c.length[None, :]).all():
                rough = -(q.square[a:b, None] + c.square[None, :] - 2.0 * dot)
                margin = _EPS * width * (q.square[a:b, None] + c.square.max(initial=0.0))
            else:  # unequal lengths: no product says it, so all are scored
                rough, margin = np.zeros_like(dot), np.zeros((b - a, 1))
        else:
            norm = np.sqrt(q.square[a:b])[:, None] * np.sqrt(c.square)[None, :]
            with np.errstate(divide="ignore", invalid="ignore"):
                rough = np.where(norm > 0, dot / norm, -2.0)
            margin = np.full((b - a, 1), _EPS * max(1, width))
        rough = np.where(other[a:b], rough, -np.inf)
        if k < len(c):
            least = np.partition(rough, len(c) - k, axis=1)[:, len(c) - k][:, None]
            near = (rough >= least - 2 * margin) & other[a:b]
        else:
            near = other[a:b]
        i, j = np.nonzero(near)
        s, strip = np.empty(len(i)), max(1, SCORES // max(1, width))
        for p in range(0, len(i), strip):
            ip, jp = a + i[p:p + strip], j[p:p + strip]
            s[p:p + strip] = _similarity(metric, x[ip], y[jp], np.minimum(q.length[ip], c.length[jp]))
        i, j, s = _first(i, j, s, k, c, id_rank)
        out.append((a + i, j, s))
    return _joined(out)


def _first(i: np.ndarray, j: np.ndarray, s: np.ndarray, k: int, c: Vectors, id_rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first ``k`` scored pairs of each query."""
    order = np.lexsort((id_rank[j], c.labels[j], np.where(np.isnan(s), np.inf, -s), i))
    i, j, s = i[order], j[order], s[order]
    top = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[top], j[top], s[top]


def _joined(out: list) -> tuple[np.ndarray, ...]:
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(p) for p in zip(*out))


def nearest(q: Vectors, c: Vectors, k: int, same: Alike | None, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """``best`` by Euclidean similarity, for vectors of one length whose squares are finite,
    without the pairs ``same``. Where a query's ``floor`` is not NaN, only
    those of similarity ``floor`` and above are sure to be among the result.

    One product tells the distances but for a constant of the query; with a floor, one
    comparison makes the shortlist, and nothing is partitioned unless it is long."""
    width = max(q.cells.shape[1], c.cells.shape[1])
    x, y = _widen(q.cells, width), _widen(c.cells, width)
    left, right = np.column_stack((x, np.ones(len(x)))), np.column_stack((y, -0.5 * c.square)).T
    id_rank = np.empty(len(c), dtype=np.int64)
    id_rank[pc.sort_indices(c.ids).to_numpy()] = np.arange(len(c))
    margin = _EPS * (width + 1) * (q.square + c.square.max(initial=0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        far = (1.0 + _EPS) / floor - 1.0  # no row of similarity ``floor`` is farther
        need = np.where(floor > 0, 0.5 * (q.square - far * far) - margin, -np.inf)
    out = []
    step = max(1, SCORES // 2 // max(1, len(c)))
    for a in range(0, len(q), step):
        b = min(a + step, len(q))
        rough = left[a:b] @ right  # half of: square of the query less square of the distance
        if same:
            rough[same.pairs(a, b)] = -np.inf
        near = rough >= need[a:b, None]
        if k < len(c):
            long = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * k)
            if len(long):
                least = np.partition(rough[long], len(c) - k, axis=1)[:, len(c) - k] - 2 * margin[a:b][long]
                near[long] &= rough[long] >= least[:, None]
        i, j = np.nonzero(near)
        other = rough[i, j] > -np.inf
        i, j = i[other], j[other]
        s, strip = np.empty(len(i)), max(1, SCORES // max(1, width))
        for p in range(0, len(i), strip):
            ip, jp = a + i[p:p + strip], j[p:p + strip]
            s[p:p + strip] = _similarity("euclidean", x[ip], y[jp], np.minimum(q.length[ip], c.length[jp]))
        i, j, s = _first(i, j, s, k, c, id_rank)
        out.append((a + i, j, s))
    return _joined(out)


def _other(metric: str) -> str:
    return "cosine" if metric == "euclidean" else "euclidean"


NAMES = ["qid", "cid", "sim", "label", "sim2"]


def rows(q: Vectors, c: Vectors, i: np.ndarray, j: np.ndarray, s: np.ndarray, metric: str) -> pa.RecordBatch:
    width = max(q.cells.shape[1], c.cells.shape[1])
    s2 = _similarity(_other(metric), _widen(q.cells, width)[i], _widen(c.cells, width)[j], np.minimum(q.length[i], c.length[j]))
    return pa.RecordBatch.from_arrays(
        [q.ids.take(pa.array(i)), c.ids.take(pa.array(j)), pa.array(s, from_pandas=True), pa.array(c.labels[j]),
         pa.array(s2, from_pandas=True)], names=NAMES)


def differ(q: pa.Array, c: pa.Array, exclude_self: bool) -> np.ndarray:
    if not exclude_self:
        return np.ones((len(q), len(c)), dtype=bool)
    known = pc.unique(c)
    qi = pc.fill_null(pc.index_in(q, value_set=known), -1).to_numpy(zero_copy_only=False)
    ci = pc.index_in(c, value_set=known).to_numpy(zero_copy_only=False)
    return qi[:, None] != ci[None, :]


class Alike:
    """The pairs that ``differ`` with ``exclude_self`` leaves out, told for some queries at a time
    (an id may repeat on both sides)."""

    def __init__(self, q: pa.Array, c: pa.Array):
        known = pc.unique(c)
        qi = pc.fill_null(pc.index_in(q, value_set=known), -1).to_numpy(zero_copy_only=False)
        ci = pc.index_in(c, value_set=known).to_numpy(zero_copy_only=False)
        self.order = np.argsort(ci, kind="stable")
        self.first, self.end = (np.searchsorted(ci[self.order], qi, side) for side in ("left", "right"))

    def pairs(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries ``a`` to ``b`` (counted from ``a``) and of their candidates."""
        first, n = self.first[a:b], self.end[a:b] - self.first[a:b]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(n)), n), self.order[np.repeat(first, n) + within]


def result_schema(query_kind: str, cand_kind: str) -> str:
    return f"qid {query_kind}, cid {cand_kind}, sim double, label double, sim2 double"
