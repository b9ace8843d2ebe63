"""Dense ids, identity dictionaries whose hashes collide, and the incremental roll."""

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import graph, identity, idmap

STEP = 1 << 32


def _hash(s):
    """Java's String.hashCode."""
    h = 0
    units = s.encode("utf-16-be")
    for a, b in zip(units[::2], units[1::2]):
        h = (h * 31 + (a << 8 | b)) & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def _classes(names, edges):
    of = {n: n for n in names}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    out = {}
    for n in names:
        out.setdefault(root(n), []).append(n)
    return [sorted(v) for v in out.values()]


def _strong(records, min_count):
    names, pairs = set(), {}
    for r in records:
        names.update(r)
        for i, a in enumerate(r):
            for b in r[i + 1:]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    return names, [p for p, n in pairs.items() if n >= min_count]


def _brute(records, prev=None, min_count=3):
    """The dictionary by definition: all of yesterday's rows linked to their guid."""
    prev = prev or {}
    names, edges = _strong(records, min_count)
    by_guid = {}
    for n, g in prev.items():
        by_guid.setdefault(g, []).append(n)
    for members in by_guid.values():
        edges += [(members[0], m) for m in members[1:]]
    out, new, taken = {}, [], {}
    for n, g in prev.items():
        k = (g - _hash(n)) // STEP + 1 if (g - _hash(n)) % STEP == 0 else 1
        taken[_hash(n)] = max(k, taken.get(_hash(n), 0))
    for c in _classes(names | set(prev), edges):
        old = [prev[n] for n in c if n in prev]
        if old:
            out.update((n, min(old)) for n in c)
        else:
            new.append((min(map(_hash, c)), c))
    for h, c in sorted(new):
        k = taken.get(h, 0)
        taken[h] = k + 1
        out.update((n, h + k * STEP) for n in c)
    return out


def _rows(spark, records):
    return spark.createDataFrame([(r,) for r in records], "ids array<string>")


def _dict(df):
    rows = df.collect()
    assert all(r.biaoshi_hashcode == _hash(r.name) for r in rows)
    got = {r.name: r.guid for r in rows}
    assert len(got) == len(rows)
    return got


def _records(seed, days=1):
    rng = random.Random(seed)
    # "Aa" and "BB" have one hash, and so have all words of n such halves
    word = lambda n: "".join(rng.choice(["Aa", "BB"]) for _ in range(n))
    names = [word(rng.choice([1, 2, 3])) + rng.choice(["", "x", "é"]) for _ in range(60)] + [f"u{i}" for i in range(30)]
    return [[list(dict.fromkeys(rng.choices(names, k=rng.choice([1, 2, 2, 3])))) for _ in range(120)] for _ in range(days)]


def test_dense_ids_are_ranks(spark):
    words = ["b", "a", "é", "B", "", "a", None, "Aa", "BB", "\U0001f600", "b"] * 3
    df = spark.createDataFrame([(w,) for w in words], "name string").repartition(5)
    got = {r.name: r.id for r in identity.dense_ids(df).collect()}
    order = sorted({w for w in words if w is not None}, key=lambda w: w.encode())
    assert got == {w: i for i, w in enumerate(order)}
    assert identity.dense_ids(df.where("false")).count() == 0
    many = spark.range(5000).select((F.col("id") * 7 % 4001).alias("v"))
    got = [r.id for r in identity.dense_ids(many, "v").orderBy("v").collect()]
    assert got == list(range(4001))


def test_vertices_take_no_join(spark, monkeypatch):
    """Names whose 64-bit hashes differ need no sorted order and no join with the edges."""
    def no(*a, **kw):
        raise AssertionError("joined")
    monkeypatch.setattr(identity, "dense_ids", no)
    monkeypatch.setattr(identity, "_ends_of", no)
    lines = spark.createDataFrame([("a,b,c",), ("d,,e",), ("c,x",), ("",), (None,), ("f,g",)], "value string")
    got = {r.line: r.gid for r in idmap.link_lines(lines).collect()}
    assert got == {"a,b,c": 97, "c,x": 97, "d,,e": 0, "": None, None: None, "f,g": 102}


@pytest.mark.parametrize("whole", [True, False])
def test_names_that_share_a_vertex_hash_stay_apart(spark, monkeypatch, whole):
    monkeypatch.setattr(identity, "_vertex", lambda name: F.length(name).cast("long"))
    names = spark.createDataFrame([(w,) for w in ("a", "b", "c", "dd", "ee", "f")], "name string")
    edges = spark.createDataFrame([("a", "dd"), ("dd", "a"), ("ee", "b"), ("c", "c"), ("f", "ee")], "src string, dst string")
    got = identity.name_components(names, edges, whole=whole).collect()
    parts = {}
    for r in got:
        parts.setdefault(r.component, set()).add(r.name)
    assert len(got) == 6 and sorted(map(sorted, parts.values())) == [["a", "dd"], ["b", "ee", "f"], ["c"]]


def test_colliding_strings_stay_apart(spark):
    assert _hash("Aa") == _hash("BB") == 2112
    got = _dict(idmap.identity_dictionary(_rows(spark, [["Aa", "z1"]] * 3 + [["BB", "z2"]] * 3 + [["BB"]])))
    assert got == {"Aa": 2112, "z1": 2112, "BB": 2112 + STEP, "z2": 2112 + STEP}
    hashed = idmap.identity_map(_rows(spark, [["p", "q"]] * 3 + [["r"]])).collect()
    assert sorted(map(tuple, hashed)) == [(112, 112), (113, 112), (114, 114)]


@pytest.mark.parametrize("hot_min", [100_000, 1])
def test_dictionary_and_rolls_equal_brute_force(spark, hot_min):
    days = _records(7, 2)
    got = want = None
    for day in days:
        prev = None if got is None else spark.createDataFrame(
            [(n, _hash(n), g) for n, g in got.items()], "name string, biaoshi_hashcode long, guid long")
        got = _dict(idmap.identity_dictionary(_rows(spark, day), prev, min_count=2, hot_min=hot_min))
        want = _brute(day, want, min_count=2)
        assert {frozenset(n for n in got if got[n] == g) for g in got.values()} == \
               {frozenset(n for n in want if want[n] == g) for g in want.values()}
        assert got == want
        assert any((g + (1 << 31)) // STEP for g in got.values())  # some guids are numbered


def test_roll_of_nothing(spark):
    prev = spark.createDataFrame([("a", 97, 97), ("b", 98, 97)], "name string, biaoshi_hashcode long, guid long")
    none = _rows(spark, []).select("ids")
    assert _dict(idmap.identity_dictionary(none, prev)) == {"a": 97, "b": 97}
    assert _dict(idmap.identity_dictionary(_rows(spark, [["a"], ["c"]]), prev)) == {"a": 97, "b": 97, "c": 99}
    assert _dict(idmap.identity_dictionary(_rows(spark, [["a", "c"]] * 3), prev.where("false"))) == {"a": 97, "c": 97}


def test_untouched_rows_enter_no_round(spark, monkeypatch):
    """Of yesterday's many rows only the guids that today's edges join go through the
    rounds, and the last join is the one that the others pass."""
    rows = [(f"n{i}", _hash(f"n{i}"), _hash(f"n{i - i % 2}")) for i in range(4000)]
    prev = spark.createDataFrame(rows, "name string, biaoshi_hashcode long, guid long").checkpoint()
    seen = []
    inside = graph.connected_components

    def spy(vertices, edges, **kw):
        seen.append((vertices.count(), edges.count()))
        return inside(vertices, edges, **kw)

    monkeypatch.setattr(identity, "connected_components", spy)
    out = idmap.identity_dictionary(_rows(spark, [["n0", "n7"]] * 3 + [["n1", "new"]] * 3 + [["n8", "n9"]] * 3 + [["lone"]]), prev)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # n0, n6's and the new name: two edges; n8 and n9 are one already
    assert seen == [(3, 2)]
    # yesterday's rows are read once more, for one join, which doesn't move them
    was = [line for line in plan.splitlines() if "Scan ExistingRDD" in line and "biaoshi_hashcode" in line]
    above = plan.splitlines()[:plan.splitlines().index(was[0])]
    assert len(was) == 1 and sum("Join" in line for line in above) == 1 and not any("Exchange hash" in line for line in above)
    got = _dict(out)
    low = min(_hash("n0"), _hash("n6"))
    assert got["n0"] == got["n1"] == got["n6"] == got["n7"] == got["new"] == low
    assert got["lone"] == _hash("lone") and len(got) == 4002
    assert all(got[n] == g for n, _, g in rows if n not in ("n0", "n1", "n6", "n7"))


def test_guid_lookup_by_name(spark):
    from daybook.operators.applog import guid_of_tuples
    d = spark.createDataFrame([("Aa", 2112, 2112), ("BB", 2112, 2112 + STEP)], "name string, biaoshi_hashcode long, guid long")
    t = spark.createDataFrame([("BB", None), (None, "Aa"), ("no", "BB"), ("no", "way")], "x string, y string")
    got = {tuple(r._k): r.guid for r in guid_of_tuples(t, d, ("x", "y")).collect()}
    assert got == {("BB", None): 2112 + STEP, (None, "Aa"): 2112, ("no", "BB"): 2112 + STEP}
    got = {tuple(r._k): r.guid for r in guid_of_tuples(t, d.drop("name"), ("x", "y")).collect()}
    assert got == {("BB", None): 2112, (None, "Aa"): 2112, ("no", "BB"): 2112}
