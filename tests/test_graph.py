from pyspark.sql import functions as F
import json
import random

from daybook.operators import graph, idmap
from daybook.functions import java_hash


def _uf_components(vertices, edges):
    parent = {v: v for v in vertices}
    for s, d in edges:
        parent.setdefault(s, s)
        parent.setdefault(d, d)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s, d in edges:
        a, b = find(s), find(d)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in parent}


import pytest


@pytest.mark.parametrize("hot_min", [100_000, 3])
def test_cc_random_against_union_find(spark, hot_min):
    rnd = random.Random(7)
    for n, m in ((30, 20), (200, 180), (60, 0)):
        verts = list(range(-n // 2, n // 2))
        edges = [(rnd.choice(verts), rnd.choice(verts)) for _ in range(m)]
        # a long chain, the worst case for label propagation
        edges += [(1000 + i, 1001 + i) for i in range(40)]
        v = spark.createDataFrame([(x,) for x in verts], "id long")
        e = spark.createDataFrame(edges, "src long, dst long")
        got = {r.id: r.component for r in graph.connected_components(v, e, hot_min=hot_min).collect()}
        assert got == _uf_components(verts, edges)


@pytest.mark.parametrize("hot_min", [100_000, 1])
def test_link_fixture(spark, hot_min):
    lines = ["13866778899,n1,wx_hz,2000", "13877669988,n2,wx_hz,3000", ",n1,wx_ldh,5000",
             "13912344321,n3,wx_mdh,12000", "13912344321,n4,wx_bj,3500", "13912664321,n5,wx_bj,5600"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.line: r.gid for r in idmap.link_lines(df, hot_min=hot_min).collect()}
    assert {got[x] for x in lines[:3]} == {-1485777898}
    assert {got[x] for x in lines[3:]} == {-1095633001}


def test_java_hash_values(spark):
    df = spark.createDataFrame([("wx_hz",), ("老师",), ("13912344321",), ("",)], "s string")
    assert [r[0] for r in df.select(java_hash("s")).collect()] == [113568560, 1039911, -1095633001, 0]


def _line(**ids):
    return json.dumps({"user": {"uid": ids.pop("uid", None), "phone": ids}})


@pytest.mark.parametrize("hot_min", [100_000, 1])
def test_identity_map_and_roll(spark, hot_min):
    # a-b seen 3 times (edge), c-d seen twice (no edge), e isolated
    lines = [_line(uid="a", imei="b")] * 3 + [_line(uid="c", imei="d")] * 2 + [_line(uid="e"), "not json"]
    ids = idmap.extract_ids(spark.createDataFrame([(x,) for x in lines], "value string"))
    day1 = {r.biaoshi_hashcode: r.guid for r in idmap.identity_map(ids).collect()}
    h = {k: v for k, v in spark.createDataFrame([(x,) for x in "abcde"], "s string")
         .select("s", java_hash("s").alias("h")).collect()}
    assert day1[h["a"]] == day1[h["b"]] == min(h["a"], h["b"])
    assert day1[h["c"]] == h["c"] and day1[h["d"]] == h["d"] and day1[h["e"]] == h["e"]
    # day 2: c-d now seen 3 times and e links to a, so {a,b,e} keep yesterday's guid
    prev = spark.createDataFrame(list(day1.items()), "biaoshi_hashcode long, guid long")
    lines2 = [_line(uid="c", imei="d")] * 3 + [_line(uid="e", imei="a")] * 3
    ids2 = idmap.extract_ids(spark.createDataFrame([(x,) for x in lines2], "value string"))
    day2 = {r.biaoshi_hashcode: r.guid for r in idmap.identity_map(ids2, prev, hot_min=hot_min).collect()}
    ab = day1[h["a"]]
    assert day2[h["a"]] == day2[h["b"]] == day2[h["e"]] == ab
    assert day2[h["c"]] == day2[h["d"]] == min(day1[h["c"]], day1[h["d"]])


def test_pairwise_and_chain(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "ids array<string>")
    got = sorted((r.p.src, r.p.dst) for r in df.select(F.explode(graph.pairwise(F.col("ids"))).alias("p")).collect())
    assert got == [("a", "b"), ("a", "c"), ("b", "c")]
    df2 = spark.createDataFrame([(["a", "", "c", " "],)], "ids array<string>")
    got = [(r.p.src, r.p.dst) for r in df2.select(F.explode(graph.chain(F.col("ids"))).alias("p")).collect()]
    assert got == [("a", ""), ("c", " ")]


def test_skew_join_split_matches_plain_join(spark):
    from daybook.operators.joins import skew_join, top_hot_keys
    big = spark.createDataFrame([(k if i % 3 else 7, i) for i, k in enumerate(list(range(20)) * 5)] + [(None, -1)],
                                "k long, v long")
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 20, 2)] + [(None, -10)], "k long, w long")
    key = lambda t: tuple((x is None, x) for x in t)
    plain = sorted((tuple(r) for r in big.join(dim, "k", "left").select("k", "v", "w").collect()), key=key)
    hot = top_hot_keys(big.groupBy("k").count(), ["k"], "count", 10)
    assert [r.k for r in hot.collect()] == [7]
    split = sorted((tuple(r) for r in skew_join(big, dim, "k", hot, "left").collect()), key=key)
    assert split == plain
    inner = sorted((tuple(r) for r in skew_join(big, dim, "k", hot, "inner").collect()), key=key)
    assert inner == [t for t in plain if t[2] is not None]
    ns = [tuple(r) for r in skew_join(big, dim, "k", hot, "left", null_safe=True).collect()]
    assert (None, -1, -10) in ns and len(ns) == len(plain)


def test_salted_join_matches_plain_join(spark):
    from daybook.operators.joins import salted_join, top_hot_keys
    big = spark.createDataFrame([(k if i % 3 else "h", i % 8) for i, k in enumerate(["a", "b", "c", None] * 10)],
                                "k string, v long")
    dim = spark.createDataFrame([("a", 1), ("h", 2), (None, 3)], "k string, w long")
    key = lambda t: tuple((x is None, x) for x in t)
    plain = sorted((tuple(r) for r in big.join(dim, "k", "left").select("k", "v", "w").collect()), key=key)
    hot = top_hot_keys(big.groupBy("k").count(), ["k"], "count", 10)
    for kw in ({}, {"repeats": True}):
        for h in (hot, None):
            got = sorted((tuple(r) for r in salted_join(big, dim, "k", h, "left", salt_rows=3, **kw).collect()), key=key)
            assert got == plain


def _rows_per_partition(df):
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_hot_null_and_repeated_keys_are_spread(spark):
    """Rows a task gets after the join, without adaptive execution: a hot key, null keys."""
    from daybook.operators.joins import salted_join, top_hot_keys
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.createDataFrame([(1, 10), (2, 20)], "k long, w long")
        hot_key = spark.range(4000).select(F.lit(1).cast("long").alias("k"), "id")
        hot = top_hot_keys(hot_key.groupBy("k").count(), ["k"], "count", 100)
        assert _rows_per_partition(salted_join(hot_key, dim, "k", hot, salt_rows=100))[0] < 2000
        no_key = spark.range(4000).select(F.lit(None).cast("long").alias("k"), "id")
        assert _rows_per_partition(salted_join(no_key, dim, "k", None))[0] < 2000
        # one row 4,000 times: joined once, expanded where it is
        same = spark.range(4000).select(F.lit(1).cast("long").alias("k"), F.lit("x").alias("v"))
        out = salted_join(same, dim, "k", None, repeats=True)
        assert out.count() == 4000 and out.distinct().collect()[0]["w"] == 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_more_hot_keys_than_the_limit(spark):
    """A key left out of the hot ones holds less than its share of all rows."""
    from daybook.operators.joins import top_hot_keys
    counts = spark.createDataFrame([(i, 1000 + i) for i in range(50)], "k long, n long")
    assert top_hot_keys(counts, ["k"], "n", 1, max_keys=10).count() == 0
    assert top_hot_keys(counts, ["k"], "n", 1, max_keys=50).count() == 25


def test_cc_giant_star_uses_hot_paths(spark, monkeypatch):
    # node 0 is the smaller end of 60 edges and node 1000 the larger end of 60 edges
    edges = [(0, i) for i in range(1, 61)] + [(1000, 100 + i) for i in range(60)] + [(60, 100)]
    edges += [(2000 + i, 2001 + i) for i in range(30)]  # a long chain
    seen = {"a": 0, "b": 0}
    orig = graph._round_info

    def spy(e, hot_min, **kw):
        star, ha, hb = orig(e, hot_min, **kw)
        seen["a"] += len(ha)
        seen["b"] += len(hb)
        return star, ha, hb

    monkeypatch.setattr(graph, "_round_info", spy)
    v = spark.createDataFrame([(5000,)], "id long")
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.component for r in graph.connected_components(v, e, hot_min=20).collect()}
    assert got == _uf_components([5000], edges)
    assert seen["a"] > 0 and seen["b"] > 0


def test_id_vertices_keep_names(spark):
    df = spark.createDataFrame([(["wx_hz", "13912344321"],), (["wx_hz"],)], "ids array<string>")
    got = {r.id: r.name for r in idmap.id_vertices(df).collect()}
    assert got == {113568560: "wx_hz", -1095633001: "13912344321"}
