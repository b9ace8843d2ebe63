import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import rns_negatives as rns


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for d, m in ((64, 256), (0, 1), (1, 1), (2500, 300), (1024, 125), (1025, 125), (9, 1 << 29), (3, 1 << 30)):
        x, y = rng.integers(-m, m + 1, size=(12, d)), rng.integers(-m, m + 1, size=(9, d))
        x[0] = y[0] = -m
        bound = max(sum(int(c) ** 2 for c in r) for r in [*x, *y]) + 1
        primes = rns.primes_for(bound)
        assert all(p < 256 for p in primes) and math.prod(primes) > 2 * bound
        got = rns.Residues(x, primes).times(rns.Residues(y, primes), slice(2, 9))
        assert got.dtype == np.int64
        assert got.tolist() == [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in y] for u in x[2:9]]
        assert rns.Residues(x, primes).times(rns.Residues(y, primes), slice(0, 1))[0, 0] == d * m * m
    assert rns.primes_for(1)[:1] == [251] and len(rns.primes_for(1 << 62)) == 9


def _brute(rows, positives=5, negatives=10, low=30, high=90):
    """``rows``: (id, label, integer vector) that take part; anchors: ids divisible by 100."""
    def last(i):
        return math.inf if i is None else i

    out = []
    for n, (a, la, va) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), last(i), m, i, la == lab) for m, (i, lab, v) in enumerate(rows) if m != n and len(v) == len(va)]
        scored.sort()
        for s, _, _, p, _ in [r for r in scored if r[4]][:positives]:
            fit = [r for r in scored if not r[4] and low * -s <= 100 * -r[0] <= high * -s]
            out += [(a, p, k + 1, r[3], -s, -r[0]) for k, r in enumerate(fit[:negatives])]
    return sorted(out, key=repr)


def _near(rng, n, d, labels):
    centres = rng.normal(size=(4, d))
    v = centres[rng.integers(0, 4, n)] + rng.normal(size=(n, d)) * rng.choice([0.1, 0.6, 1.5], size=(n, 1))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(int(i), int(rng.integers(0, labels)), [math.floor(256 * x) for x in r.tolist()]) for i, r in enumerate(v)]


@pytest.mark.parametrize("sizes", [(1024, 8192), (2, 37)])
def test_mining_equals_brute_force(spark, sizes, monkeypatch):
    rng = np.random.default_rng(2)
    rows = _near(rng, 420, 16, 3)
    rows += [(1000 + i, 1, [30, -30] * 8) for i in range(25)] + [(2000, 2, [30, -30] * 8), (2001, 0, [30, -30] * 8)]  # ties, copies
    rows += [(2100, 1, [1 << 28] * 16), (2101, 2, [1 << 27] * 16), (2102, 1, [1 << 28] * 16), (2200, 0, [0] * 16), (2201, 0, [0] * 16), (2202, 1, [0] * 16)]
    rows += [(3000, 0, [5, 5]), (3001, 0, [4, 4]), (3002, 1, [3, 3]), (3003, 1, [-3, 3]), (3100, 0, []), (3101, 0, []), (3102, 1, [])]  # other lengths
    rows += [(None, 1, [30, -30] * 8), (None, 2, [20, -20] * 8), (100, 1, rows[100][2]), (100, 1, rows[100][2]), (7, 2, rows[7][2])]  # repeated, no id
    none = [(4000, None, [1] * 16), (4100, 1, None), (4200, 1, [None] + [1] * 15), (4300, 1, [1 << 32] * 16)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + none], "vec_id long, label int, embedding array<long>, uid string, rank int")
    got = rns.mine(df, is_anchor=F.col("vec_id") % 100 == 0, piece_anchors=sizes[0], piece_rows=sizes[1])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = _brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 100
    if sizes[0] == 2:
        monkeypatch.setattr(rns, "BROADCAST_BYTES", 0)
        again = rns.mine(df, is_anchor=F.col("vec_id") % 100 == 0, piece_anchors=3, piece_rows=50)
        assert sorted(map(tuple, again.collect()), key=repr) == want


def test_nothing_to_mine(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<long>")
    assert rns.mine(df).count() == 0
    one = spark.createDataFrame([(0, 1, [1]), (5, 2, [1])], "vec_id long, label int, embedding array<long>")
    assert rns.mine(one, is_anchor=F.col("vec_id") == 77).count() == 0
    assert rns.mine(one).count() == 0  # no positives


def test_quantize(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001, 1.0]), (1, None), (2, []), (3, [None]), (4, [nan]), (5, [inf]), (6, [-inf, 1.0]), (7, [-1.0, 0.00390625])]
    df = spark.createDataFrame(rows, "i int, v array<float>").select("i", rns.quantize(F.col("v")).alias("q"))
    assert {r.i: r.q for r in df.collect()} == {0: [128, -1, 256], 1: None, 2: [], 3: None, 4: None, 5: None, 6: None, 7: [-256, 1]}
