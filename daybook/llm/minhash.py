"""Near-dedup by min-max hashing.

Under each hash function both the smallest and the largest value over a document's shingles
are kept: two signature values, each equal for two documents with probability J (their
Jaccard similarity), for one evaluation. ``BANDS`` bands of ``ROWS`` values (half of them
minima, half maxima, never both of one function in a band) make the candidates: at J = 0.8
a pair shares no band with probability (1 - 0.8^5)^40, about 1e-7. Candidates are confirmed
on the full shingle sets.

Documents with the same set are one class, whatever their number. Among classes that share
a band, first every class is compared with one centre of its bucket, then those that are
still in different components with each other, a bucket in bounded pieces. No pair within a
component is compared again, so a large group of copies costs a line, not a square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.blocks import pieces, spread
from daybook.llm.common import save
from daybook.llm.shingles import common, mix, shingle_sets
from daybook.operators.graph import connected_components

BANDS, ROWS = 40, 5
WIDTH = 4
# Characters of text hashed together, shingles multiplied at a time, rows of a piece.
BATCH_CHARS, STRIP, BLOCK_ROWS = 1_000_000, 1 << 15, 1024
# Functions of the finer signature that candidates get. Pairs whose fine signatures agree on
# less than the threshold minus SLACK (five standard deviations of 800 values) are not
# confirmed in the exhaustive round.
FINE, SLACK = 400, 0.07

_RNG = np.random.default_rng(7)
_FUNCTIONS = (_RNG.integers(0, 2**31, BANDS * ROWS // 2, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_FINE = (_RNG.integers(0, 2**31, FINE, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_BAND = _RNG.integers(1, 2**63, BANDS, dtype=np.uint64)
_ROW = _RNG.integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of a non-empty set under all functions (uint32)."""
    s = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = None, None
    for i in range(0, len(s), STRIP):
        h = functions[:, None] * s[None, i:i + STRIP]
        lo, hi = h.min(axis=1), h.max(axis=1)
        low = lo if low is None else np.minimum(low, lo)
        high = hi if high is None else np.maximum(high, hi)
    return np.concatenate((low, high))


def _texts(batches: Iterator[pa.RecordBatch]):
    """``(ids, raw texts)`` in portions of about BATCH_CHARS bytes."""
    for batch in batches:
        ids, texts, start, raws, size = batch.column(0), batch.column(1), 0, [], 0
        for i in range(batch.num_rows):
            raws.append((texts[i].as_py() or "").encode())
            size += len(raws[-1])
            if size >= BATCH_CHARS or i + 1 == batch.num_rows:
                yield ids.slice(start, i + 1 - start), raws
                start, raws, size = i + 1, [], 0


def _profiles(width: int):
    def run(batches):
        for ids, raws in _texts(batches):
            sets = shingle_sets(raws, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands = [None] * len(sets)
            if full:
                sig = np.stack([signature(sets[i], _FUNCTIONS) for i in full])
                with np.errstate(over="ignore"):
                    b = (sig.reshape(len(full), BANDS, ROWS).astype(np.uint64) * _ROW).sum(axis=2, dtype=np.uint64)
                    b = mix(b + _BAND).view(np.int64)
                for k, i in enumerate(full):
                    bands[i] = b[k]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "bands"])
    return run


def _sets(width: int):
    def run(batches):
        for ids, raws in _texts(batches):
            sets = shingle_sets(raws, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            ids, sets = ids.take(pa.array(full, pa.int64())), [sets[i] for i in full]
            fine = [(signature(s, _FINE) & np.uint32(255)).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(fine, pa.binary())],
                names=["id", "shingles", "sketch"])
    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((len(a), len(b)))
                if 100 * small < percent * large:
                    ok.append(False)
                    continue
                c = common(a, b)
                ok.append(100 * c >= percent * (len(a) + len(b) - c))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _candidates(percent: int):
    """Pairs of one piece that lie in different components, meet here first (no earlier
    band of theirs agrees), fit in size and look alike by their signatures."""
    def run(batches):
        for t in pieces(batches, ["key"]):
            ids, comp, n = (t.column(c).to_numpy() for c in ("id", "comp", "n_shingles"))
            block, i, j = t.column("_b").to_numpy(), t.column("_i")[0].as_py(), t.column("_j")[0].as_py()
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
            bands = t.column("bands").combine_chunks().values.to_numpy().reshape(len(ids), -1)
            band = int(np.flatnonzero(bands[0] == t.column("key")[0].as_py())[0])
            one, two = [], []
            for p in np.flatnonzero(block == i):
                q = np.flatnonzero((block == j) & (comp != comp[p]) & (100 * np.minimum(n, n[p]) >= percent * np.maximum(n, n[p])))
                if i == j:
                    q = q[q > p]
                if len(q) and band:
                    q = q[~(bands[q, :band] == bands[p, :band]).any(axis=1)]
                if len(q):
                    q = q[(sketch[q] == sketch[p]).mean(axis=1) >= percent / 100 - SLACK]
                    one.append(np.full(len(q), ids[p]))
                    two.append(ids[q])
            if one:
                a, b = np.concatenate(one), np.concatenate(two)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


def _components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` of every id that has an edge."""
    e = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return save(connected_components(e.select(F.col("src").alias("id")), e).select("id", F.col("component").alias("comp")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               percent: int = 80, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id, kept``.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` over their sets of
    distinct ``width``-word shingles (words: runs without ``[\\x20\\x09-\\x0D]``, A-Z in
    lower case; with fewer words, the whole sequence is the one shingle).
    ``component_id`` is the smallest id reachable by links, ``kept`` whether it is the
    row's own. Ids are integers.

    * null text and text without words: an empty set, linked with nothing;
    * a null id: linked with nothing, ``component_id`` null, kept;
    * rows that repeat an id are one vertex of the link graph, each with its own row;
    * an empty table gives no rows; other columns are neither read nor returned.

    Sets are compared as sets of 64-bit hashes, equal sets are recognised by a 128-bit digest.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = save(d.mapInArrow(_profiles(width), "id bigint, n_shingles bigint, digest binary, bands array<bigint>"))

    # classes: documents with the same set
    full = rows.where("n_shingles > 0 and id is not null")
    classes = save(full.groupBy("digest", "n_shingles", "bands").agg(F.min("id").alias("rep")))
    members = full.join(classes.select("digest", "rep"), "digest").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))

    # classes that share a band with another
    entry = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
    crowded = entry.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("centre")).where("size > 1")
    entry = save(entry.join(crowded, "key"))
    wanted = d.where("text is not null").join(entry.select("id").distinct(), "id", "left_semi")
    sets = save(wanted.mapInArrow(_sets(width), "id bigint, shingles binary, sketch binary"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        p = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        p = p.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        return save(p.select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a bigint, b bigint"))

    # against one centre of each bucket
    links = confirmed(entry.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    comp = _components(links)

    # what is still apart, in every bucket, exhaustively
    rest = entry.select("key", "id").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    apart = rest.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    rest = rest.join(apart.where("lo <> hi").select("key", "size"), "key")
    rest = rest.join(classes.select(F.col("rep").alias("id"), "n_shingles", "bands"), "id").join(sets.select("id", "sketch"), "id")
    pairs = spread(rest, ["key"], "size", "id", block_rows).mapInArrow(_candidates(percent), "a bigint, b bigint")
    more = confirmed(pairs)

    comp = _components(links.unionByName(more).unionByName(members))
    return (rows.select("id", "n_shingles").join(comp, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("comp", "id").alias("component_id"),
                    (F.col("id").isNull() | (F.coalesce("comp", "id") == F.col("id"))).alias("kept")))
