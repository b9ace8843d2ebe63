"""Exact nearest neighbours without the product of all rows (survey: M10, M11, J1, J2).

The rows of a block are placed into cells around pivots, and a query asks in two rounds:

1. its nearest cells, until they hold more than ``k`` rows: the ``k``-th score found there is
   the query's threshold;
2. of the other cells, only those that can hold a better row. Two bounds say which:

   * ``euclidean``: the triangle inequality over a cell's smallest and largest distance to its
     pivot, and the distance to the half-space of the points nearer to that pivot than to
     the query's own (Voronoi cells);
   * ``cosine``: the same between unit vectors, and these on their leading principal
     directions with the length of the rest: no score of a cell exceeds the best product over
     its box of coordinates plus the product of the rests.

Both bounds are lowered by a margin for rounding, so the result is exact. A cell of any size
is dealt into pieces, and so are the queries that ask it. Where nothing is clustered the
bounds exclude nothing and a query meets every cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys
from daybook.operators.vectors import Alike, Vectors, best, differ, nearest, result_schema, rows
from daybook.sources.session import checkpoint_dir

# Rows of a cell aimed at, most pivots, and bytes of pivots that are broadcast at most.
CELL_ROWS, MAX_PIVOTS, PIVOT_BYTES = 4096, 2048, 32 << 20
# Leading directions of the cosine bound, and rows of the sample that they are taken from.
LEADING, SAMPLE = 8, 2048
# Queries that a task places at a time, and cells of the distance matrix held.
TASK_ASKS, HELD = 50_000, 1 << 21
_MARGIN = 1e-7


class Pivots:
    """Pivots of all blocks (a block uses the first few) and what the bounds need."""

    def __init__(self, metric: str, sample: np.ndarray, n: int):
        self.metric, self.width = metric, sample.shape[1]
        self.axes = None
        if metric == "cosine":
            sample = _unit(sample)
            _, axes = np.linalg.eigh(sample.T @ sample)
            self.axes = axes[:, ::-1][:, :LEADING]
        # the same vector twice would leave a cell empty
        first = np.sort(np.unique(sample, axis=0, return_index=True)[1])
        self.at = sample[first][:n]

    def points(self, cells: np.ndarray) -> np.ndarray:
        """Vectors as the pivots see them."""
        m = np.pad(cells, ((0, 0), (0, max(0, self.width - cells.shape[1]))))[:, :self.width]
        return _unit(m) if self.metric == "cosine" else m

    def distances(self, x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        p = self.at[pivots]
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2.0 * (x @ p.T), 0.0))

    def place(self, x: np.ndarray, usable: int) -> np.ndarray:
        usable = min(usable, len(self.at))
        out = np.zeros(len(x), dtype=np.int64)
        step = max(1, HELD // usable)
        for a in range(0, len(x), step):
            out[a:a + step] = self.distances(x[a:a + step], np.arange(usable)).argmin(1)
        return out

    def marks(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """What a cell's limits are made of: the distance to the pivot and, for the cosine,
        before it the leading coordinates and the length of the rest."""
        d = x - self.at[cell]
        far = np.sqrt((d * d).sum(1))[:, None]
        return far if self.metric == "euclidean" else np.column_stack((self._leading(x), far))

    def _leading(self, x: np.ndarray) -> np.ndarray:
        lead = x @ self.axes
        rest = np.sqrt(np.maximum((x * x).sum(1) - (lead * lead).sum(1), 0.0))
        return np.column_stack((lead, rest))

    def best_possible(self, x: np.ndarray, d: np.ndarray, cells: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """No member of a cell scores higher with the query than this (similarity)."""
        own = d.argmin(1)
        p = self.at[cells]
        apart = self.distances(p, cells)[own]  # between the query's own pivot and each
        near = d[np.arange(len(d)), own][:, None]
        scale = np.sqrt((x * x).sum(1))[:, None] + np.sqrt((p * p).sum(1))[None, :] + hi[:, -1]
        with np.errstate(divide="ignore", invalid="ignore"):  # pivots too near each other tell nothing exactly
            half = np.where(apart > 1e-4 * scale, (d * d - near * near) / (2.0 * apart), 0.0)
        least = np.maximum(np.maximum(d - hi[:, -1], lo[:, -1] - d), half)
        least = np.maximum(least - _MARGIN * scale, 0.0)
        if self.metric == "euclidean":
            return 1.0 / (1.0 + least)
        m = self._leading(x)
        out = m[:, -1:] * hi[None, :, -2]
        for i in range(m.shape[1] - 1):
            out = out + np.maximum(m[:, i, None] * lo[None, :, i], m[:, i, None] * hi[None, :, i])
        return np.minimum(out, 1.0 - least * least / 2.0) + _MARGIN


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.sqrt((m * m).sum(1))[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, m / n, 0.0)


def with_counts(df: DataFrame, counts: DataFrame, key: str, n: str) -> DataFrame:
    """``df`` with the columns of ``counts`` (one row a key; ``n``: about how many rows of
    ``df`` have it): broadcast where its measured size allows, else salted."""
    told = F.to_json(F.struct(key)).alias("_key")
    if measured_bytes(counts.select(told, *[c for c in counts.columns if c != key])) <= BROADCAST_BYTES:
        return df.join(F.broadcast(counts), key)
    return salted_join(df, counts, key, top_hot_keys(counts, [key], n), "inner")


def _placer(pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            x = p.points(Vectors(batch.column("id"), batch.column("vec"), np.zeros(batch.num_rows)).cells)
            usable = batch.column("cells").to_numpy(zero_copy_only=False)
            cell = np.zeros(batch.num_rows, dtype=np.int64)
            for u in np.unique(usable):
                of = usable == u
                cell[of] = p.place(x[of], int(u))
            marks = p.marks(x, cell)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * marks.shape[1], pa.int32()), pa.array(marks.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "id", "vec", "label")), pa.array(cell), flat],
                                             names=["block", "id", "vec", "label", "cell", "marks"])
    return run


def _asker(pivots, k: int):
    """Which pieces each query asks. A block's cells come before its queries; ``home`` are the
    cells asked in the first round (null before it), ``kth`` is what it found (null: fewer
    than ``k``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        cells = subs = counts = lo = hi = None
        for batch in batches:
            told = np.flatnonzero(batch.column("of_cells").is_valid().to_numpy(zero_copy_only=False))
            edges = sorted({0, *told.tolist(), batch.num_rows})
            for a, b in zip(edges, edges[1:]):
                if a in told:
                    of = batch.column("of_cells")[a].as_py()
                    cells, subs, counts = (np.array([c[n] for c in of]) for n in ("cell", "subs", "n"))
                    lo, hi = (np.array([c[n] for c in of], dtype=float) for n in ("lo", "hi"))
                    a += 1
                step = max(1, HELD // max(1, len(cells)))
                for s in range(a, b, step):
                    part = batch.slice(s, min(step, b - s))
                    x = p.points(Vectors(part.column("id"), part.column("vec"), np.zeros(part.num_rows)).cells)
                    d = p.distances(x, cells)
                    home = np.zeros(d.shape, dtype=bool)
                    asked = part.column("home")
                    if asked.null_count == 0:
                        place = np.searchsorted(cells, asked.flatten().to_numpy())
                        home[np.repeat(np.arange(part.num_rows), asked.value_lengths().to_numpy()), place] = True
                        kth = part.column("kth").to_numpy(zero_copy_only=False).astype(float)
                        open_ = np.isnan(kth)[:, None] | (p.best_possible(x, d, cells, lo, hi) >= kth[:, None])
                        q, c = np.nonzero(open_)
                        first = np.where(home[q, c], 1, 0)  # the first piece was asked before
                        n = subs[c] - first
                        sub = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                        q, c = np.repeat(q, n), np.repeat(c, n)
                    else:
                        order = np.argsort(d, axis=1, kind="stable")
                        before = np.cumsum(counts[order], axis=1) - counts[order]
                        np.put_along_axis(home, order, before <= k, axis=1)
                        q, c = np.nonzero(home)
                        sub = np.zeros(len(q), dtype=np.int64)
                    ends = np.searchsorted(q, np.arange(part.num_rows + 1)).astype(np.int32)
                    asked = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int64))) for v in (cells[c], sub)]
                    yield pa.RecordBatch.from_arrays([*(part.column(n) for n in ("block", "uid", "id", "vec", "kth")), *asked],
                                                     names=["block", "uid", "id", "vec", "kth", "cell", "sub"])
    return run


class Search:
    """Queries ``(block, id, vec)`` against members ``(block, id, vec, label)``: ``found()``
    gives ``qid, cid, sim, label, sim2`` rows that hold each query's ``k`` best."""

    def __init__(self, asks: DataFrame, members: DataFrame, k: int, metric: str, exclude_self: bool, cell_rows: int = CELL_ROWS):
        spark = members.sparkSession
        checkpoint_dir(spark)
        self.k, self.metric, self.exclude_self, self.piece_rows = k, metric, exclude_self, 2 * cell_rows
        self.kinds = {c: members.schema[c].dataType.simpleString() for c in ("block", "id")}
        self.ask_kind = asks.schema["id"].dataType.simpleString()
        usable = F.least(F.lit(MAX_PIVOTS), F.ceil(F.count(F.lit(1)) / cell_rows)).cast("int")
        blocks = members.groupBy("block").agg(F.count(F.lit(1)).alias("n"), usable.alias("cells"), F.max(F.size("vec")).alias("width")).checkpoint()
        most, width = blocks.agg(F.max("cells"), F.max("width")).first()
        n = max(1, min(max(SAMPLE, 2 * (most or 1)), PIVOT_BYTES // (8 * max(1, width or 1))))
        # a bounded sample, whatever the table's size
        sample = [r[0] for r in members.orderBy(F.xxhash64("id", "vec")).limit(n).select("vec").collect()]
        m = Vectors(pa.array(range(len(sample))), pa.array(sample, pa.list_(pa.float64())), np.zeros(len(sample))).cells
        pivots = Pivots(metric, np.pad(m, ((0, 0), (0, max(0, (width or 0) - m.shape[1])))) if len(m) else np.zeros((1, max(1, width or 1))), most or 1)
        self.pivots = spark.sparkContext.broadcast(pivots)
        marks = 1 if metric == "euclidean" else min(LEADING, pivots.width) + 2

        placed = with_counts(members, blocks.select("block", "n", "cells"), "block", "n").select("block", "cells", "id", "vec", "label")
        kind = f"block {self.kinds['block']}, id {self.kinds['id']}, vec array<double>, label double, cell bigint, marks array<double>"
        placed = placed.mapInArrow(_placer(self.pivots), kind).checkpoint()
        limits = [f(F.col("marks")[i]).alias(f"{name}{i}") for name, f in (("lo", F.min), ("hi", F.max)) for i in range(marks)]
        per_cell = placed.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n"), *limits)
        per_cell = per_cell.select("block", "cell", "n", F.ceil(F.col("n") / self.piece_rows).cast("long").alias("subs"),
                                   F.array(*[f"lo{i}" for i in range(marks)]).alias("lo"), F.array(*[f"hi{i}" for i in range(marks)]).alias("hi")).checkpoint()
        subs = per_cell.select(F.struct("block", "cell").alias("_in"), F.col("n").alias("_n"), "subs")
        placed = with_counts(placed.withColumn("_in", F.struct("block", "cell")), subs, "_in", "_n")
        self.members = placed.select("block", "cell", F.pmod(F.xxhash64("id", "vec"), F.col("subs")).alias("sub"), "id", "vec", "label")
        # a block's cells are a list of at most MAX_PIVOTS
        self.lists = per_cell.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("cell", "n", "subs", "lo", "hi"))).alias("of_cells")).checkpoint()
        asks = asks.select("block", "id", "vec").withColumn("uid", F.monotonically_increasing_id())
        tasks = asks.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / TASK_ASKS).cast("long").alias("tasks"))
        tasks = tasks.join(blocks.select("block"), "block").checkpoint()  # a block without members answers nothing
        self.tasks = tasks
        self.asks = asks.checkpoint()

    def _reach(self, asks: DataFrame) -> DataFrame:
        """The queries ``(block, uid, id, vec, home, kth)`` with the pieces that they ask
        (checkpointed)."""
        lists = self.lists.join(self.tasks, "block").withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)))
        cells = lists.select("block", "task", "of_cells", F.lit(None).cast("long").alias("uid"), F.lit(None).cast(self.ask_kind).alias("id"),
                             F.lit(None).cast("array<double>").alias("vec"), F.lit(None).cast("array<bigint>").alias("home"), F.lit(None).cast("double").alias("kth"))
        held = self.lists.schema["of_cells"].dataType
        asks = with_counts(asks, self.tasks, "block", "n").select(
            "block", F.pmod(F.xxhash64("uid"), F.col("tasks")).alias("task"), F.lit(None).cast(held).alias("of_cells"), "uid", "id", "vec", "home", "kth")
        known = cells.unionByName(asks)
        known = known.repartition("block", "task").sortWithinPartitions("block", "task", F.col("uid").asc_nulls_first())
        kind = f"block {self.kinds['block']}, uid bigint, id {self.ask_kind}, vec array<double>, kth double, cell array<bigint>, sub array<bigint>"
        return known.mapInArrow(_asker(self.pivots, self.k), kind).where(F.size("cell") > 0).checkpoint()

    def _scored(self, asks: DataFrame) -> DataFrame:
        """The best ``k`` of each asked piece, without those that score below the query's
        ``kth``: ``uid`` and the result columns."""
        piece = F.struct("block", F.col("at.cell").alias("cell"), F.col("at.sub").alias("sub"))
        each = asks.select("uid", "id", "vec", "kth", "block", F.explode(F.arrays_zip("cell", "sub")).alias("at")).select(piece.alias("piece"), "uid", "id", "vec", "kth")
        counts = each.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / self.piece_rows).cast("long").alias("parts")).checkpoint()
        q = with_counts(each, counts, "piece", "n").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")))
        c = with_counts(self.members.withColumn("piece", F.struct("block", "cell", "sub")), counts, "piece", "n")
        c = c.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        none = F.lit(None)
        q = q.select("piece", "part", "uid", F.col("id").alias("qid"), none.cast(self.kinds["id"]).alias("cid"), "vec", F.lit(0.0).alias("label"), "kth")
        c = c.select("piece", "part", none.cast("long").alias("uid"), none.cast(self.ask_kind).alias("qid"), F.col("id").alias("cid"), "vec", "label", none.cast("double").alias("kth"))
        k, metric, exclude_self = self.k, self.metric, self.exclude_self
        one_length = metric == "euclidean"  # as the cells' bounds are

        def score(t: pa.Table) -> pa.Table:
            asking = pc.is_valid(t.column("uid"))
            a, b = t.filter(asking), t.filter(pc.invert(asking))
            members = Vectors(b.column("cid"), b.column("vec"), b.column("label").to_numpy())
            # a piece's queries at once where the scoring itself bounds what it holds
            out, step = [], max(1, a.num_rows if one_length else HELD // max(1, len(members)))
            for s in range(0, max(1, a.num_rows), step):
                of = a.slice(s, step)
                query = Vectors(of.column("qid"), of.column("vec"), np.zeros(of.num_rows))
                kth = of.column("kth").to_numpy().astype(float)
                if one_length:
                    i, j, sim = nearest(query, members, k, Alike(query.ids, members.ids) if exclude_self else None, kth)
                else:
                    i, j, sim = best(query, members, k, metric, differ(query.ids, members.ids, exclude_self))
                kth = kth[i]
                worth = np.isnan(kth) | (sim >= kth)  # the first round has k rows no worse than others
                i, j, sim = i[worth], j[worth], sim[worth]
                got = rows(query, members, i, j, sim, metric)
                out.append(pa.Table.from_batches([got]).append_column("uid", of.column("uid").take(pa.array(i))))
            return pa.concat_tables(out)

        return q.unionByName(c).groupBy("piece", "part").applyInArrow(score, result_schema(self.ask_kind, self.kinds["id"]) + ", uid bigint")

    def first_asks(self) -> DataFrame:
        asks = self.asks.withColumn("home", F.lit(None).cast("array<bigint>")).withColumn("kth", F.lit(None).cast("double"))
        return self._reach(asks)

    def thresholds(self, found: DataFrame) -> DataFrame:
        """``(uid, kth)``: the score of the ``k``-th best so far."""
        w = Window.partitionBy("uid").orderBy(F.col("sim").desc_nulls_last())
        return found.select("uid", "sim", F.row_number().over(w).alias("_r")).where((F.col("_r") <= self.k) & (F.col("_r") == self.k)).select("uid", F.col("sim").alias("kth"))

    def second_asks(self, first: DataFrame, found: DataFrame) -> DataFrame:
        """The queries that the first round leaves unfinished, with the pieces still to see."""
        asks = first.select("block", "uid", "id", "vec", F.col("cell").alias("home"))
        return self._reach(asks.join(self.thresholds(found), "uid", "left"))

    def found(self) -> DataFrame:
        first = self.first_asks()
        one = self._scored(first).checkpoint()
        return one.unionByName(self._scored(self.second_asks(first, one))).drop("uid")


def comparable(asks: DataFrame, members: DataFrame) -> tuple[int, bool, bool]:
    """Rows of the largest block of ``members``, whether all vectors of both sides have the
    same length, and whether all components are of a size that squares keep finite."""
    size = F.transform("vec", lambda x: F.when(F.isnan(x), F.lit(0.0)).otherwise(F.abs(F.coalesce(x, F.lit(0.0)))))
    large: Column = F.coalesce(F.max(F.array_max(size)), F.lit(0.0))
    length = F.coalesce(F.size("vec"), F.lit(0))
    sides = [x.agg(F.min(length).alias("a"), F.max(length).alias("b"), large.alias("m")).first() for x in ([members] if asks is members else [asks, members])]
    lengths = {v for s in sides for v in (s.a, s.b) if v is not None}
    most = members.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    return most, len(lengths) <= 1, all(s.m < 1e100 for s in sides)
