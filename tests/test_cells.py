"""Neighbours over cells: the same rows as scoring everything, and what is skipped."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.operators import cells, neighbors, vectors

NAN, INF = float("nan"), float("inf")


def _clustered(seed, n, d, clusters, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    return centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, d)) * spread


def _frame(spark, m, extra=()):
    rows = [(i, [float(x) for x in v], float(i % 2), "b" if i % 3 else None) for i, v in enumerate(m)]
    return spark.createDataFrame(rows + list(extra), "id long, vec array<double>, label double, block string").repartition(3)


def _knn(asks, members, k, rows, exclude_self=True, metric="euclidean"):
    out = neighbors.top_k_neighbors(asks, members, k, metric, label="label", exclude_self=exclude_self, max_sample=None, piece_rows=rows)
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("kind", ["clustered", "random", "copies"])
def test_knn_over_cells_is_exact(spark, kind):
    rng = np.random.default_rng(1)
    m = {"clustered": _clustered(2, 260, 8, 12), "random": rng.normal(size=(260, 8)),
         "copies": np.repeat(np.round(rng.normal(size=(20, 8)), 1), 13, axis=0)}[kind]
    extra = [(900, [0.0] * 8, 1.0, None), (901, [None] * 7 + [1.0], 0.0, None), (902, [NAN] * 8, 0.0, None), (3, m[3].tolist(), 1.0, None), (None, m[4].tolist(), 0.0, None)]
    df = _frame(spark, m, extra)
    whole = _knn(df, df, 4, 10_000)
    assert whole == _knn(df, df, 4, 32)
    asks = df.where("id % 5 = 0")
    assert _knn(asks, df, 7, 10_000, False) == _knn(asks, df, 7, 32, False)


def test_knn_that_cells_cannot_do(spark):
    """Vectors of several lengths and endless components take the product of pieces."""
    m = np.random.default_rng(3).normal(size=(120, 4))
    for extra in ([(900, [1.0, 2.0], 1.0, None)], [(900, [INF, 0.0, 0.0, 0.0], 1.0, None)], [(900, None, 1.0, None)]):
        df = _frame(spark, m, extra)
        assert _knn(df, df, 3, 10_000) == _knn(df, df, 3, 32)
    df = _frame(spark, m)
    assert _knn(df, df, 3, 10_000, metric="cosine") == _knn(df, df, 3, 32, metric="cosine")
    assert _knn(df.where("false"), df, 3, 32) == [] == _knn(df, df.where("false"), 3, 32)
    assert len(_knn(df, df.where("id < 2"), 3, 1)) == 2 * 120 - 2  # fewer than k


@pytest.mark.parametrize("kind", ["clustered", "copies"])
def test_similarity_over_cells_is_exact(spark, kind):
    rng = np.random.default_rng(5)
    m = {"clustered": _clustered(6, 240, 10, 9), "random": rng.normal(size=(240, 10)),
         "copies": np.repeat(np.round(rng.normal(size=(20, 10)), 1), 12, axis=0)}[kind]
    extra = [(900 + i, [0.0] * 10, 0.0, None) for i in range(7)] + [(950, [1.0, 2.0], 0.0, "b"), (951, [NAN] * 10, 0.0, "few"), (952, m[0].tolist(), 0.0, "few"), (953, None, 0.0, "b")]
    df = _frame(spark, m, extra)
    for block in ("block", None):
        got = [sorted(map(tuple, neighbors.similar_items(df, 5, block=block, block_rows=r).collect()), key=repr) for r in (10_000, 16)]
        assert got[0] == got[1]


def _asked(spark, m, metric, k=4, cell_rows=64):
    df = _frame(spark, m).withColumn("block", F.struct(F.lit(0)))
    s = cells.Search(df.select("block", "id", "vec"), df.select("block", "id", "vec", "label"), k, metric, True, cell_rows)
    first = s.first_asks()
    per_piece = s.members.groupBy("block", "cell", "sub").agg(F.count(F.lit(1)).alias("n"))
    second = s.second_asks(first, s._scored(first)).select(F.explode(F.arrays_zip("cell", "sub")).alias("p")).select("p.cell", "p.sub")
    seen = second.join(per_piece, ["cell", "sub"]).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    home = first.select(F.explode(F.arrays_zip("cell", "sub")).alias("p")).select("p.cell", "p.sub")
    seen += home.join(per_piece, ["cell", "sub"]).agg(F.sum("n")).first()[0]
    return seen / len(m) ** 2


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_share_of_the_product_that_is_scored(spark, metric, record_property):
    """Pairs scored, of all pairs: on clusters a small share that falls as the table grows
    (its power stays well below 2), on points without structure nearly all."""
    small, large = (_asked(spark, _clustered(8, n, 16, n // 50), metric) for n in (1000, 4000))
    none = _asked(spark, np.random.default_rng(9).normal(size=(1000, 16)), metric)
    power = 2 + np.log(large / small) / np.log(4)
    record_property("scored", {"1000": small, "4000": large, "random": none, "power": power})
    print(f"{metric}: scored {small:.3f} of 1000^2, {large:.3f} of 4000^2 (power {power:.2f}), {none:.2f} without clusters")
    assert small < 0.3 and power < 1.6 and none <= 1.01


def test_floor_spares_the_partition(monkeypatch):
    """With a floor the shortlist is one comparison: what ``best`` gives from the floor up."""
    rng = np.random.default_rng(3)
    m = np.round(rng.normal(size=(300, 5)), 1)
    m[50:60] = m[40:50]  # ties
    ids = pa.array([int(i) if i % 29 else None for i in rng.integers(0, 280, 300)], pa.int64())
    v = vectors.Vectors(ids, pa.array(m.tolist(), pa.list_(pa.float64())), rng.integers(0, 3, 300).astype(float))
    same = vectors.Alike(v.ids, v.ids)
    differ = np.ones((300, 300), dtype=bool)
    differ[same.pairs(0, 300)] = False
    assert (differ == vectors.differ(v.ids, v.ids, True)).all()
    monkeypatch.setattr(vectors, "SCORES", 140 * 300)
    for k in (1, 4, 400):
        want = vectors.best(v, v, k, "euclidean", differ)
        got = vectors.nearest(v, v, k, same, np.full(300, np.nan))
        assert all((a == b).all() for a, b in zip(got, want))
    kth = want[2].reshape(-1)[[np.flatnonzero(want[0] == i)[3] for i in range(300)]]
    want = vectors.best(v, v, 4, "euclidean", differ)

    def no(*a, **kw):
        raise AssertionError("partitioned")
    monkeypatch.setattr(np, "partition", no)
    i, j, s = vectors.nearest(v, v, 4, same, kth)
    worth = s >= kth[i]
    assert all((a[worth] == b).all() for a, b in zip((i, j, s), want))
