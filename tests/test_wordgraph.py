import itertools
import math

from pyspark.sql import functions as F

from daybook.operators import text, wordgraph

# "北京大学生" as longest match has 北京大学 and is left with 生; the graph weighs 北京 and 大学生.
LEX = [("北京", 50), ("北京大学", 2), ("大学", 40), ("大学生", 60), ("学生", 30), ("研究", 20), ("研究生", 30), ("生命", 40), ("命", 5), ("起源", 10),
       ("起源", 10), ("的", 100), ("x", None), (None, 3), ("", 4), ("不好", 0)]
TEXTS = ["北京大学生", "研究生命的起源", "没有词", "北京，大学 生", "Abc 研究生命 def", "", None, "起源起源起源", "命", "不好的", "的的", "研究生" * 40]


def _costs():
    n = {}
    for t, c in LEX:
        if t:
            n[t] = n.get(t, 0) + max(c or 1, 1)
    total = sum(n.values())
    return {t: round(math.log(total / c) * 1000) for t, c in n.items()}, round(math.log(2 * total) * 1000)


def _brute(run):
    """All ways to cut the run."""
    costs, alone = _costs()
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        words, at = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                words.append(run[at:i])
                at = i
        if any(len(w) > 1 and w not in costs for w in words):
            continue
        key = (sum(min(costs.get(w, alone), alone) if len(w) == 1 else costs[w] for w in words), len(words), [-len(w) for w in words])
        if best is None or key < best[0]:
            best = (key, words)
    return best[1]


def test_best_path_equals_all_ways(spark, monkeypatch):
    monkeypatch.setattr(text, "HELD_RUNS", 2)
    lex = spark.createDataFrame(LEX, "term string, count long")
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "k")], "id int, t string, run string")
    got = [sorted(map(repr, wordgraph.segment_best(df, "t", lex, "pos", broadcast_bytes=b).select("id", "run", "pos").collect())) for b in (1 << 20, 0)]
    assert got[0] == got[1]
    by = {r.id: r.pos for r in wordgraph.segment_best(df, "t", lex, "pos").collect()}
    for i, t in enumerate(TEXTS[:-1]):
        runs = df.where(f"id = {i}").select(text.tokens("t", han_bigrams=False).alias("r")).first().r or []
        assert by[i] == [w for r in runs for w in (_brute(r) if len(r) > 1 and not r.isascii() else [r])], t
    assert by[0] == ["北京", "大学生"] and by[1] == ["研究", "生命", "的", "起源"] and by[11] == ["研究生"] * 40
    longest = text.segment(df, "t", lex.where("length(term) > 1").select("term")).where("id = 0").first().words
    assert longest == ["北京大学", "生"]


def test_no_lexicon_and_no_rows(spark):
    lex = spark.createDataFrame(LEX, "term string, count long")
    df = spark.createDataFrame([(1, "研究生命")], "id int, t string")
    for b in (1 << 20, 0):
        assert wordgraph.segment_best(df, "t", lex.where("false"), broadcast_bytes=b).first().words == list("研究生命")
        assert wordgraph.segment_best(df.where("false"), "t", lex, broadcast_bytes=b).count() == 0


def test_long_runs(spark):
    lex = spark.createDataFrame([("ab", 3), ("bab", 1), ("aa", 1)], "term string, count long")
    df = spark.createDataFrame([("ab" * 20_000,)], "t string")
    words = wordgraph.segment_best(df, "t", lex, script=r"\p{L}").select(F.size("words"), F.array_join("words", "")).first()
    assert words[0] == 20_000 and words[1] == "ab" * 20_000


def test_best_paths_equals_best_path(monkeypatch):
    import random

    chance = random.Random(7)
    letters = "abc一\U0001F600"
    for held in (1, 60, wordgraph.HELD):
        monkeypatch.setattr(wordgraph, "HELD", held)
        for size in (0, 1, 30):
            words = {"".join(chance.choices(letters, k=chance.randint(1, 6))): chance.choice([0, 1, 700, 1500]) for _ in range(size)}
            known = wordgraph._Trie(words, max(map(len, words), default=0))
            runs = ["".join(chance.choices(letters + "xz", k=chance.choice([0, 1, 2, 5, 9, 64, 65]))) for _ in range(60)]
            assert wordgraph.best_paths(runs, known, 1000) == [wordgraph.best_path(r, known.edges(r), 1000) for r in runs]


def _read_once(spark, lex, work):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lex.schema.fields)
    work(lex.mapInArrow(counted, kind))
    return read.value


def test_best_path_lexicon_is_read_once(spark):
    df = spark.createDataFrame([(1, "研究生命")], "id int, t string")
    lex = spark.createDataFrame(LEX, "term string, count long")
    assert _read_once(spark, lex, lambda x: wordgraph.segment_best(df, "t", x).collect()) == len(LEX)


def test_longest_match_lexicon_is_read_once(spark, monkeypatch):
    monkeypatch.setattr(text, "HELD_RUNS", 2)
    monkeypatch.setattr(text, "REMEMBERED", 1)
    df = spark.createDataFrame([(1, "研究生命, 研究生命 的研究"), (2, None), (3, "研究生命 ok 研究")], "id int, t string").coalesce(1)
    lex = spark.createDataFrame([("研究",), ("生命",)], "term string")
    got = []
    assert _read_once(spark, lex, lambda x: got.extend(text.segment(df, "t", x).collect())) == 2
    assert {r.id: r.words for r in got} == {1: ["研究", "生命", "研究", "生命", "的", "研究"], 2: [], 3: ["研究", "生命", "ok", "研究"]}
