"""Embedding near-dedup by spherical-cap filters from structured random product codes.

A filter is a random direction, and a vector belongs to every filter whose direction it
exceeds a threshold with: a cap of the sphere. Directions are the combinations of one code
word out of each block of (rotated) coordinates, so their number is a product while finding
all those a vector exceeds is list decoding: code words are tried block by block, and a
partial sum is dropped as soon as the best of the remaining blocks could not lift it over
the threshold. ``CODES`` independent codes even out how many caps a vector lies in. Two
vectors of cosine 0.98 share about forty of some sixty caps; unrelated vectors share hardly
any. Vectors that meet in a filter are compared in double precision.

The number of directions grows with the largest label, so caps hold about as many unrelated
vectors at any size, and thresholds are set so that a random vector lies in ``HITS`` caps of
each code.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.blocks import pieces, spread
from daybook.llm.common import save
from daybook.operators.graph import connected_components

CODES, HITS, BLOCK_ROWS = 8, 8, 512
# Directions of a code for each vector of the largest label, times HITS; most code words of
# a block (more directions take more blocks).
SPARSE, MAX_WORDS = 10, 4096


@dataclasses.dataclass
class Codes:
    """``rotation`` (d, d), per block its slice of coordinates and code words, threshold."""

    rotation: np.ndarray
    slices: list[slice]
    words: list[np.ndarray]
    threshold: float


def product_code(d: int, n: int, hits: int = HITS, seed: tuple[int, ...] = (0,)) -> Codes:
    """A code for ``n`` vectors of ``d`` dimensions; its threshold is the one at which 64
    random vectors lie in ``hits`` caps on average."""
    rng = np.random.default_rng([*seed, d])
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    directions = hits * max(64, SPARSE * n)
    blocks = 2
    while directions ** (1 / blocks) > MAX_WORDS:
        blocks += 1
    if d < 8 * blocks:  # too few coordinates for a product: plain directions
        blocks, directions = 1, min(directions, MAX_WORDS)
    size = int(np.ceil(directions ** (1 / blocks)))
    edges = np.linspace(0, d, blocks + 1).astype(int)
    slices = [slice(a, b) for a, b in zip(edges, edges[1:])]
    words = []
    for s in slices:
        w = rng.normal(size=(size, s.stop - s.start))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True))
    x = rng.normal(size=(64, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    high = low = float(np.sqrt(blocks))
    while low > -1 and len(decode(Codes(rotation, slices, words, low), x)[0]) < hits * len(x):
        high, low = low, low - 0.05
    for _ in range(20):
        mid = (low + high) / 2
        if len(decode(Codes(rotation, slices, words, mid), x)[0]) < hits * len(x):
            high = mid
        else:
            low = mid
    return Codes(rotation, slices, words, low)


def decode(codes: Codes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``(row, filter)`` pairs whose score reaches the threshold, for unit rows ``x``."""
    y = x @ codes.rotation
    scores = [y[:, s] @ w.T for s, w in zip(codes.slices, codes.words)]
    best_after = np.zeros((len(scores) + 1, len(x)))
    for b in range(len(scores) - 1, -1, -1):
        best_after[b] = best_after[b + 1] + scores[b].max(axis=1)
    rows, total, names = np.arange(len(x)), np.zeros(len(x)), np.zeros(len(x), dtype=np.int64)
    for b, s in enumerate(scores):
        order = np.argsort(-s, axis=1)
        # code words best first, each row's shifted past the row before: one sorted list
        ranked = (8.0 * np.arange(len(x))[:, None] - np.take_along_axis(s, order, axis=1)).ravel()
        # so many of the row's best code words keep a partial sum alive
        need = np.clip(codes.threshold - total - best_after[b + 1][rows], -3, 3)
        many = np.searchsorted(ranked, 8.0 * rows - need, side="right") - rows * s.shape[1]
        at = np.repeat(np.arange(len(rows)), many)
        k = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        rows, word = rows[at], order[rows[at], k]
        total = total[at] + s[rows, word]
        names = names[at] * s.shape[1] + word
    return rows, names


def _filters(codes: dict[int, list[Codes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, out = batch.column("vector"), [[]] * batch.num_rows
            lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            flat = vectors.flatten().to_numpy()
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                for i in range(0, len(at), 1024):
                    part = at[i:i + 1024]
                    x = flat[offsets[part][:, None] + np.arange(d)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    each = [decode(c, x) for c in codes[d]]
                    rows = np.concatenate([r for r, _ in each])
                    names = np.concatenate([f + (c << 56) for c, (_, f) in enumerate(each)])
                    order = np.lexsort((names, rows))
                    cut = np.searchsorted(rows[order], np.arange(1, len(part)))
                    for k, f in zip(part.tolist(), np.split(names[order], cut)):
                        out[k] = f
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "filters"])
    return run


def _shared_before(lists: list[np.ndarray], limit: int) -> np.ndarray:
    """(n, n): whether two sorted lists have an element below ``limit`` in common."""
    n = len(lists)
    cut = [f[:np.searchsorted(f, limit)] for f in lists]
    values, local = np.unique(np.concatenate(cut), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(c) for c in cut])
    shared = np.zeros((n, n), dtype=bool)
    for a in range(0, len(values), 4096):
        here = (local >= a) & (local < a + 4096)
        m = np.zeros((n, min(4096, len(values) - a)), dtype=np.float32)
        m[owner[here], local[here] - a] = 1
        shared |= (m @ m.T) > 0
    return shared


def _links(threshold: float):
    """For each vector of a piece its number of links that appear in no earlier filter, and
    one member of its group by these links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in pieces(batches, ["label", "dim", "filter"]):
            if t.num_rows < 2:
                continue
            vectors = t.column("vector").combine_chunks()
            x = vectors.flatten().to_numpy().reshape(t.num_rows, -1)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            norm = np.sqrt((x * x).sum(axis=1))
            link = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
            np.fill_diagonal(link, False)
            i, j = t.column("_i")[0].as_py(), t.column("_j")[0].as_py()
            if i != j:
                b = t.column("_b").to_numpy()
                link &= b[:, None] != b[None, :]
            some = np.flatnonzero(link.any(axis=1))
            if not len(some):
                continue
            link = link[np.ix_(some, some)]
            lists = [np.asarray(f, dtype=np.int64) for f in t.column("filters").take(pa.array(some)).to_pylist()]
            link &= ~_shared_before(lists, t.column("filter")[0].as_py())
            count = link.sum(axis=1)
            if not count.any():
                continue
            group = np.arange(len(some))
            while True:
                near = np.where(link, group[None, :], len(some)).min(axis=1)
                new = np.minimum(group, near)
                new = np.minimum(new, new[new])
                if (new == group).all():
                    break
                group = new
            rows = t.column("row").to_numpy()[some]
            yield pa.RecordBatch.from_arrays([pa.array(rows[count > 0]), pa.array(count[count > 0].astype(np.int64)),
                                              pa.array(rows[group][count > 0])], names=["row", "links", "other"])
    return run


def near_dedup(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label", hits: int = HITS, block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Vectors of equal label and dimension whose cosine (double precision) is at least
    ``threshold`` are linked if they share a filter. ``n_links`` counts the other vectors a
    vector is linked with, ``component_id`` is the smallest id reachable, ``kept`` whether
    it is the row's own.

    * a null label, a null or empty vector, one with null, NaN or infinite components or
      of zeros only: no links;
    * repeated ids and rows are vectors of their own; a null id is never the smallest;
    * an empty table gives no rows; other columns are neither read nor returned.
    """
    v = F.col("vector")
    whole = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    all_rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    all_rows = save(all_rows.withColumn("row", F.monotonically_increasing_id()))
    rows = all_rows.where(F.col("label").isNotNull() & whole).where(F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("vector"))
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()
    codes = {r["dim"]: [product_code(r["dim"], r["n"], hits, (seed, c)) for c in range(CODES)] for r in sizes}
    rows = rows.select("row", "label", "dim", "vector")
    kind = rows.schema["label"].dataType.simpleString()
    known = save(rows.mapInArrow(_filters(codes), f"row bigint, label {kind}, dim int, vector array<double>, filters array<bigint>"))

    key = ["label", "dim", "filter"]
    entry = known.select("row", "label", "dim", F.explode("filters").alias("filter"))
    crowded = entry.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    entry = entry.join(crowded, key).join(known.select("row", "vector", "filters"), "row")
    found = save(spread(entry, key, "size", "row", block_rows)
                 .mapInArrow(_links(threshold), "row bigint, links bigint, other bigint"))

    links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    edges = found.where("row <> other").select(F.col("row").alias("src"), F.col("other").alias("dst")).distinct()
    comp = save(connected_components(edges.select(F.col("src").alias("id")), edges).select(F.col("id").alias("row"), "component"))
    ids = all_rows.select("row", "id").join(links, "row", "left").join(comp, "row", "left")
    ids = ids.withColumn("component", F.coalesce("component", "row"))
    least = ids.where("n_links > 0").groupBy("component").agg(F.min("id").alias("least"))
    out = ids.join(least, "component", "left").withColumn("least", F.coalesce("least", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.col("least").alias("component_id"), F.col("id").eqNullSafe(F.col("least")).alias("kept"))
