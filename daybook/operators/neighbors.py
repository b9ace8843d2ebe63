"""Nearest neighbours and similarity (survey: J1, J2, W1, O2, A9, F16, F17, M10, M11).

Two shapes, neither of which emits all pairs:

* against a labelled sample (KNN): the sample is what a fitted classifier consists of, so
  it is bounded by a documented parameter, broadcast once, and the queries stream past it
  with no shuffle. A sample that is itself a table of any size is placed into Voronoi cells,
  of which a query sees those that the triangle inequality doesn't exclude
  (``operators.cells``); where that can't be (cosine, unequal lengths, or a sample of one
  cell) both sides are dealt into parts of bounded size, and a piece is a pair of parts;
* among the rows of one table (similarity report): within a declared block key. A block of
  any size is dealt into pieces of bounded size, one task step each, and a piece emits at
  most ``k`` rows for each of its rows. Larger blocks go through cells as well, with a bound
  on the cosine.

Scores are evaluated in numpy: a matrix product makes a shortlist with an error margin, and
the shortlist is scored and ranked by the defining formula, so equal vectors score exactly
alike wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import cells
from daybook.operators.joins import top_k_per_key
from daybook.operators.vectors import SCORES, Vectors, best, differ, result_schema, rows

# Most rows of a KNN sample: it is collected and broadcast (at 64 cells about 50 MB).
MAX_SAMPLE = 100_000
# Rows of a block that meet in one piece.
BLOCK_ROWS = 2048
# Rows of either side in a piece where the sample is a table: at 64 cells some 4 MB each.
PIECE_ROWS = 8192


def _scored(ids: pa.Array, vecs: pa.Array, c: Vectors, k: int, metric: str, exclude_self: bool) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of ``c`` for each query, a bounded number of scores at a time."""
    step = max(1, SCORES // max(1, len(c)))
    for a in range(0, len(ids), step):
        part = Vectors(ids[a:a + step], vecs[a:a + step], np.zeros(len(ids[a:a + step])))
        i, j, sim = best(part, c, k, metric, differ(part.ids, c.ids, exclude_self))
        yield rows(part, c, i, j, sim, metric)


def _from_sample(d: DataFrame, s: DataFrame, k: int, metric: str, exclude_self: bool, max_sample: int, schema: str) -> DataFrame:
    known = s.limit(max_sample + 1).toArrow()
    if known.num_rows > max_sample:
        raise ValueError(f"a sample of more than max_sample = {max_sample} rows is no model to broadcast")
    shared = d.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        c = Vectors(t.column("id"), t.column("vec"), t.column("label").to_numpy())
        for batch in batches:
            if batch.num_rows and len(c):
                yield from _scored(batch.column(0), batch.column(1), c, k, metric, exclude_self)

    return d.mapInArrow(run, schema)


def _from_pieces(d: DataFrame, s: DataFrame, k: int, metric: str, exclude_self: bool, piece_rows: int, schema: str) -> DataFrame:
    kinds = d.schema["id"].dataType, s.schema["id"].dataType

    def dealt(df: DataFrame, own: str, other: DataFrame, across: str) -> DataFrame:
        # counted in int64, so that the pieces of any table are
        pieces = [x.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / piece_rows)).cast("long")).scalar() for x in (df, other)]
        return (df.withColumn(own, F.pmod(F.xxhash64(*df.columns), pieces[0]))
                .withColumn(across, F.explode(F.sequence(F.lit(0).cast("long"), pieces[1] - 1))))

    q = dealt(d, "i", s, "j").select("i", "j", F.lit(True).alias("asks"), F.col("id").alias("qid"),
                                     F.lit(None).cast(kinds[1]).alias("cid"), "vec", F.lit(0.0).alias("label"))
    c = dealt(s, "j", d, "i").select("i", "j", F.lit(False).alias("asks"), F.lit(None).cast(kinds[0]).alias("qid"),
                                     F.col("id").alias("cid"), "vec", "label")

    def piece(t: pa.Table) -> pa.Table:
        asks, known = t.filter(t.column("asks")), t.filter(pc.invert(t.column("asks")))
        c = Vectors(known.column("cid"), known.column("vec"), known.column("label").to_numpy())
        found = _scored(asks.column("qid"), asks.column("vec"), c, k, metric, exclude_self)
        none = Vectors(asks.column("qid")[:0], asks.column("vec")[:0], np.zeros(0))
        empty = np.zeros(0, dtype=int)
        return pa.Table.from_batches([rows(none, c, empty, empty, np.zeros(0), metric), *found])

    return q.unionByName(c).groupBy("i", "j").applyInArrow(piece, schema)


def top_k_neighbors(queries: DataFrame, sample: DataFrame, k: int, metric: str = "euclidean", query_id: str = "id",
                    cand_id: str = "id", vec: str = "vec", label: str | None = None, exclude_self: bool = False,
                    max_sample: int | None = MAX_SAMPLE, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Exact ``k`` most similar rows of ``sample`` per query: ``(qid, cid, sim, label, sim2,
    rank)``; ``sim2`` is the other metric of the same pair. Ids keep their types.

    ``metric`` is ``euclidean`` (F16, ``1/(1+dist)``) or ``cosine`` (F17; null for a zero
    vector, ranked last). Ranking is ``sim desc, label, cid`` (deviation D4 makes ties
    deterministic; a null id goes last). With ``exclude_self`` a query never matches a row with its own id.

    A fitted sample is bounded as a model is: more than ``max_sample`` rows are an error. It
    is broadcast, and the queries, however many, are scored where they lie. With
    ``max_sample=None`` the sample is a table of any size. Where one piece can't hold it,
    ``euclidean`` queries on vectors of one length see the cells that can hold a better row
    (``operators.cells``). Otherwise both sides are dealt by a hash of the row into parts of
    about ``piece_rows`` rows, each pair of parts is scored as one piece, and each row is
    sent once per part of the other side. The best ``k`` of all pieces stay. The result is
    exact either way.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    lab = F.coalesce(F.col(label).cast("double"), F.lit(0.0)) if label else F.lit(0.0)
    s = sample.select(F.col(cand_id).alias("id"), F.col(vec).cast("array<double>").alias("vec"), lab.alias("label"))
    d = queries.select(F.col(query_id).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    schema = result_schema(d.schema["id"].dataType.simpleString(), s.schema["id"].dataType.simpleString())
    most, one_length, finite = cells.comparable(d, s.withColumn("block", F.lit(0))) if max_sample is None else (0, False, False)
    if most > piece_rows and metric == "euclidean" and one_length and finite:
        d, s = (x.withColumn("block", F.lit(0)) for x in (d, s))
        found = cells.Search(d, s, k, metric, exclude_self, max(1, piece_rows // 2)).found()
    elif max_sample is None:
        found = _from_pieces(d, s, k, metric, exclude_self, piece_rows, schema)
    else:
        found = _from_sample(d, s, k, metric, exclude_self, max_sample, schema)
    return top_k_per_key(found, "qid", [F.col("sim").desc_nulls_last(), "label", F.col("cid").asc_nulls_last()], k)


def knn_classify(test: DataFrame, sample: DataFrame, k: int = 4, id_col: str = "id",
                 vec: str = "vec", label: str = "label", exclude_self: bool = False,
                 max_sample: int | None = MAX_SAMPLE) -> DataFrame:
    """K nearest labelled samples by Euclidean similarity, majority vote:
    ``predict = 1`` when ``sum(label) > k/2`` (with k = 4, a 2-2 tie predicts 0, as
    the reference's ``if(sum(label) > 2, 1, 0)``). Returns ``(id, predict)``. ``max_sample``
    as in ``top_k_neighbors``: None for a sample of any size."""
    nn = top_k_neighbors(test, sample, k, "euclidean", id_col, id_col, vec, label, exclude_self, max_sample)
    return (nn.groupBy(F.col("qid").alias(id_col))
            .agg(F.when(F.sum("label") > k / 2, F.lit(1)).otherwise(F.lit(0)).alias("predict")))


def similar_items(df: DataFrame, k: int, id_col: str = "id", vec: str = "vec", block: str | None = None,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """M11 as a top-k report: for every item its ``k`` most cosine-similar other items of
    the same ``block`` (a declared column; null is a block of its own; without one the
    whole table is one block) with both similarities: ``(id, other_id, rank, cos, eud)``.
    With one block and ``k = n - 1`` it is the reference's all-pairs table (each pair once
    per direction).

    Where a block has more than ``2 * block_rows`` rows, blocks are placed into cells, and a row
    sees those that can hold a better one than its ``k``-th so far (``operators.cells``).
    Otherwise a block of ``n`` rows is dealt into ``ceil(n / block_rows)`` parts by a hash of
    the id, and each pair of parts is scored as one piece.
    """
    key = F.struct(F.col(block) if block else F.lit(0))  # null is a block like others
    d = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec"), key.alias("block"))
    most, _, finite = cells.comparable(d, d)
    if most > 2 * block_rows and finite:
        found = cells.Search(d, d.withColumn("label", F.lit(0.0)), k, "cosine", True, block_rows).found()
        return _named(found, k, id_col)
    sizes = d.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    d = d.join(sizes, "block")
    d = d.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    d = d.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    d = d.withColumn("i", F.least("part", "k")).withColumn("j", F.greatest("part", "k")).drop("k", "parts")
    kind = d.schema["id"].dataType.simpleString()

    def piece(t: pa.Table) -> pa.Table:
        part = t.column("part").to_numpy()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        v = Vectors(t.column("id"), t.column("vec"), np.zeros(t.num_rows))
        other = differ(v.ids, v.ids, True)
        if i != j:
            other &= part[:, None] != part[None, :]
        return pa.Table.from_batches([rows(v, v, *best(v, v, k, "cosine", other), "cosine")])

    return _named(d.groupBy("block", "i", "j").applyInArrow(piece, result_schema(kind, kind)), k, id_col)


def _named(found: DataFrame, k: int, id_col: str) -> DataFrame:
    return (top_k_per_key(found, "qid", [F.col("sim").desc_nulls_last(), F.col("cid").asc_nulls_last()], k)
            .select(F.col("qid").alias(id_col), F.col("cid").alias("other_id"), "rank",
                    F.col("sim").alias("cos"), F.col("sim2").alias("eud")))
