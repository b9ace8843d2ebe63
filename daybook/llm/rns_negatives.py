"""Hard-negative mining with exact integer scores from a residue-number-system product.

The component matrices are taken modulo several small primes and multiplied in float32:
balanced residues are at most 125 in size, so sums of up to 1,024 products stay below 2**24
and float32 holds them exactly. The residues of a score are put together by Chinese
remaindering (mixed radix with balanced digits, which gives the sign too). As many primes
are taken as the largest score needs, so every score is the exact integer.

Anchors meet all rows in pieces of bounded size, twice: for the best rows of the same label,
then for the rows in the score window that each of these opens. A piece keeps the best few
rows per anchor (and window), so what leaves it doesn't grow with its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import drop, save
from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys, top_k_per_key

# Anchors and rows that meet in one piece, and scores held at a time.
PIECE_ANCHORS, PIECE_ROWS, SCORES = 1024, 8192, 1 << 21
# Products that are summed in float32 before the sum is reduced: 1024 * 125**2 < 2**24.
SUMMED = 1024
# Squared length (of integer components) from which a score may not fit in a long.
TOO_LONG = float(1 << 62)


def primes_for(bound: int) -> list[int]:
    """The largest primes below 256, as many as tell all integers of size ``bound`` apart."""
    out, product = [], 1
    for p in range(255, 2, -1):
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            out.append(p)
            product *= p
            if product > 2 * bound + 1:
                return out
    raise ValueError(f"no primes left for scores of size {bound}")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    r = x % p
    return np.where(r > p // 2, r - p, r)


class Residues:
    """A matrix of integers as float32 matrices of balanced residues, one a prime."""

    def __init__(self, m: np.ndarray, primes: list[int]):
        self.primes = primes
        self.of = [_balanced(m, p).astype(np.float32) for p in primes]

    def times(self, other: Residues, rows: slice) -> np.ndarray:
        """Exact inner products (int64) of the ``rows`` of this matrix with all of the other's."""
        value, weight = None, 1  # the digits so far, and the weight of the next one
        digits: list[np.ndarray] = []
        for k, p in enumerate(self.primes):
            x, y = self.of[k][rows], other.of[k]
            r = np.zeros((x.shape[0], y.shape[0]), dtype=np.int32)
            for a in range(0, x.shape[1], SUMMED):
                r = (r + (x[:, a:a + SUMMED] @ y[:, a:a + SUMMED].T).astype(np.int32)) % p
            for q, d in zip(self.primes, digits):
                r = (r - d) * pow(q, -1, p) % p
            d = _balanced(r, p)
            digits.append(d)
            # the sum is within an int64 though the weight of a last, zero, digit may not be
            term = d.astype(np.int64) * np.int64((weight + (1 << 63)) % (1 << 64) - (1 << 63))
            value = term if value is None else value + term
            weight *= p
        return value


def quantize(vec: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component in double precision, as longs; null if the
    vector or any component is null or not finite."""
    v = vec.cast("array<double>")
    ok = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(ok, F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def _matrix(t: pa.Table, d: int) -> np.ndarray:
    flat = pa.chunked_array(t.column("vec")).combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(t.num_rows, d)


def _sides(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The anchors of a piece, and its rows by id (null last): among equal scores the
    earlier one goes first."""
    asks = t.column("asks")
    rows = t.filter(pc.invert(asks))
    return t.filter(asks), rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("uid", "ascending")]))


def _strips(anchors: pa.Table, rows: pa.Table, primes: list[int]) -> Iterator[tuple[slice, np.ndarray]]:
    d = anchors.column("d")[0].as_py()
    x, y = (Residues(_matrix(t, d), primes) for t in (anchors, rows))
    step = max(1, SCORES // max(1, rows.num_rows))
    for a in range(0, anchors.num_rows, step):
        s = slice(a, min(a + step, anchors.num_rows))
        yield s, x.times(y, s)


def _nearest(primes: list[int], k: int):
    def piece(t: pa.Table) -> pa.Table:
        anchors, rows = _sides(t)
        uid, other = (x.column("uid").to_numpy() for x in (anchors, rows))
        out = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64))]
        for s, score in _strips(anchors, rows, primes) if anchors.num_rows and rows.num_rows else ():
            else_than = uid[s, None] != other[None, :]
            least = np.iinfo(np.int64).min
            score = np.where(else_than, score, least)
            if k < len(other):
                least = np.partition(score, len(other) - k, axis=1)[:, len(other) - k][:, None]
            i, j = np.nonzero(else_than & (score >= least))
            order = np.lexsort((j, -score[i, j], i))
            i, j = i[order], j[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append((s.start + i[first], j[first], score[i[first], j[first]]))
        i, j, v = map(np.concatenate, zip(*out))
        return pa.table({"uid": anchors.column("uid").take(pa.array(i)), "pid": rows.column("id").take(pa.array(j)),
                         "positive_score": pa.array(v, pa.int64())})
    return piece


def _window(primes: list[int], k: int, low: int, high: int):
    def piece(t: pa.Table) -> pa.Table:
        anchors, rows = _sides(t)
        opened = [[(w["positive_score"], w["rank"]) for w in p] for p in anchors.column("positives").to_pylist()]
        edges = [[(-(-low * v // 100), high * v // 100, r) for v, r in p] for p in opened]
        label, other = (x.column("label").combine_chunks().dictionary_encode() for x in (anchors, rows))
        known = pc.index_in(label.dictionary, value_set=other.dictionary).to_numpy(zero_copy_only=False)
        known = np.where(np.isnan(known.astype(float)), -1, known).astype(int)
        mine, theirs = known[label.indices.to_numpy()], other.indices.to_numpy()
        out: list[tuple[int, int, int, int]] = []
        for s, score in _strips(anchors, rows, primes) if anchors.num_rows and rows.num_rows else ():
            reach = edges[s]
            lows = np.array([min(e[0] for e in p) for p in reach])[:, None]
            highs = np.array([max(e[1] for e in p) for p in reach])[:, None]
            i, j = np.nonzero((score >= lows) & (score <= highs) & (mine[s, None] != theirs[None, :]))
            v = score[i, j]
            order = np.lexsort((j, -v, i))
            i, j, v = i[order], j[order], v[order]
            cut = np.searchsorted(i, np.arange(len(reach) + 1))
            for n, p in enumerate(reach):
                a, b = cut[n], cut[n + 1]
                falling = -v[a:b]
                for lo, hi, r in p if b > a else ():
                    top = a + np.searchsorted(falling, -hi)
                    end = min(top + k, a + np.searchsorted(falling, -lo, side="right"))
                    out += [(s.start + n, r, int(j[e]), int(v[e])) for e in range(top, end)]
        i, r, j, v = zip(*out) if out else ((), (), (), ())
        at = pa.array(i, pa.int64())
        return pa.table({"uid": anchors.column("uid").take(at), "opened": pa.array(r, pa.int32()),
                         "nid": rows.column("id").take(pa.array(j, pa.int64())), "negative_score": pa.array(v, pa.int64())})
    return piece


def _dealt(df: DataFrame, own: str, n_own: Column, across: str, n_across: Column) -> DataFrame:
    return (df.withColumn(own, F.pmod(F.xxhash64("uid"), n_own))
            .withColumn(across, F.explode(F.sequence(F.lit(0).cast("long"), n_across - 1))))


def _sized(part: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """The rows of the groups that hold an anchor, with their groups' numbers of pieces."""
    kept = sizes.where("n_asks > 0")
    if measured_bytes(kept.select(F.to_json(F.struct(key)).alias("key"), "n_rows", "n_anchors")) <= BROADCAST_BYTES:
        return part.join(F.broadcast(kept.drop("n", "n_asks")), key)
    return salted_join(part, kept.drop("n", "n_asks"), key, top_hot_keys(kept, [key], "n"), "inner")


def _pieces(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("long")


def mine(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         is_anchor: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         piece_anchors: int = PIECE_ANCHORS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.

    ``vec_col`` holds integer components (see ``quantize``); a score is the integer inner
    product with the anchor, higher first, ties by smaller id (null last). The positives of
    an anchor (``is_anchor``, a condition on the columns; every row if None) are its
    ``positives`` first other rows of the same label. For each of them the first
    ``negatives`` rows of another label are returned whose score is between ``low`` and
    ``high`` percent of the positive's; a positive without such rows gives none.

    Rows with a null label, vector or component take no part; nor do vectors whose squared
    length is 2**62 or more, as their scores need not fit in a long. Only vectors of equal
    length are compared; empty ones score 0. Repeated rows are rows of their own, also as
    anchors, and a copy of an anchor is one of its other rows. An empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    anchor = F.lit(True) if is_anchor is None else F.coalesce(is_anchor, F.lit(False))
    vec = rows[vec_col].cast("array<long>")
    ok = F.forall(vec, lambda x: x.isNotNull())
    part = rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].alias("label"), F.when(ok, vec).alias("vec"), anchor.alias("asks"))
    part = part.where(F.col("label").isNotNull() & F.col("vec").isNotNull())
    part = part.withColumn("square", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    part = part.where(F.col("square") < TOO_LONG).withColumn("d", F.size("vec")).withColumn("uid", F.monotonically_increasing_id())
    part = save(part)
    largest = part.agg(F.max("square")).first()[0] or 0.0
    primes = primes_for(int(largest * (1 + 1e-9)) + 1)
    side = ["uid", "id", "label", "vec", "d"]

    # the same label: a group is as large as the label, and is dealt into pieces by its counts
    part = part.withColumn("g", F.struct("label", "d"))
    sizes = save(part.groupBy("g").agg(F.count(F.lit(1)).alias("n"), _pieces(F.count(F.lit(1)), piece_rows).alias("n_rows"),
                                       F.count_if("asks").alias("n_asks"), _pieces(F.count_if("asks"), piece_anchors).alias("n_anchors")))
    sized = _sized(part, sizes, "g")
    a = _dealt(sized.where("asks"), "i", F.col("n_anchors"), "j", F.col("n_rows")).select("g", "i", "j", F.lit(True).alias("asks"), *side)
    b = _dealt(sized, "j", F.col("n_rows"), "i", F.col("n_anchors")).select("g", "i", "j", F.lit(False).alias("asks"), *side)
    found = a.unionByName(b).groupBy("g", "i", "j").applyInArrow(_nearest(primes, positives), "uid bigint, pid bigint, positive_score bigint")
    best = save(top_k_per_key(found, "uid", [F.col("positive_score").desc(), F.col("pid").asc_nulls_last()], positives))

    # other labels: all rows of a length
    by_length = save(sizes.groupBy(F.col("g.d").alias("d")).agg(
        F.sum("n").alias("n"), F.sum("n_asks").alias("n_asks"), _pieces(F.sum("n"), piece_rows).alias("n_rows"),
        _pieces(F.sum("n_asks"), piece_anchors).alias("n_anchors")))
    lists = best.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("positives"))
    kind = lists.schema["positives"].dataType
    sized = _sized(part.drop("g"), by_length, "d")
    a = _dealt(sized.where("asks").join(lists, "uid"), "i", F.col("n_anchors"), "j", F.col("n_rows"))
    b = _dealt(sized, "j", F.col("n_rows"), "i", F.col("n_anchors")).withColumn("positives", F.lit(None).cast(kind))
    a, b = (x.select("d", "i", "j", F.lit(q).alias("asks"), "uid", "id", "label", "vec", "positives") for x, q in ((a, True), (b, False)))
    found = a.unionByName(b).groupBy("d", "i", "j").applyInArrow(
        _window(primes, negatives, low, high), "uid bigint, opened int, nid bigint, negative_score bigint")
    top = top_k_per_key(found, ["uid", "opened"], [F.col("negative_score").desc(), F.col("nid").asc_nulls_last()], negatives)
    named = best.withColumnRenamed("rank", "opened").join(part.where("asks").select("uid", "id"), "uid")
    out = top.join(named, ["uid", "opened"]).select(
        F.col("id").alias("anchor_id"), F.col("pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("nid").alias("negative_id"), "positive_score", "negative_score")
    drop(sizes)
    return out
