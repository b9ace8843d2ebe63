import pytest
from pyspark.sql import functions as F

from daybook.operators import bayes, classify, features, neighbors, text

SAMPLE = """r1,老师,中,青年,男,pos
r2,老师,中,中年,女,pos
r3,老师,低,青年,男,neg
r4,老师,高,老年,女,pos
r5,老师,低,青年,女,neg
r6,程序员,高,青年,男,neg
r7,程序员,高,青年,女,pos
r8,程序员,中,中年,男,neg
r9,程序员,中,中年,男,neg
r10,程序员,中,老年,男,pos
r11,公务员,中,老年,女,neg
r12,公务员,低,老年,女,neg
r13,公务员,高,中年,男,pos
r14,公务员,低,中年,女,neg
r15,公务员,低,青年,男,pos"""
TEST = [("t1", "老师", "中", "青年", "女"), ("t2", "程序员", "高", "中年", "女"), ("t3", "公务员", "低", "青年", "男")]
FEATS = ["job", "income", "age", "sex"]


@pytest.fixture(scope="module")
def sample(spark):
    rows = [tuple(l.split(",")) for l in SAMPLE.splitlines()]
    return spark.createDataFrame(rows, "name string, job string, income string, age string, sex string, label string")


@pytest.fixture(scope="module")
def test_df(spark):
    return spark.createDataFrame(TEST, "name string, job string, income string, age string, sex string")


def test_counting_bayes_golden(sample, test_df):
    m = bayes.bayes_fit(sample, FEATS, "label", "pos")
    got = {r.name: r.probability for r in bayes.bayes_score(m, test_df, "name", FEATS).collect()}
    assert got["t1"] == pytest.approx(0.6325489379425236, abs=1e-9)
    assert got["t2"] == pytest.approx(0.5060391503540191, abs=1e-9)
    assert got["t3"] == pytest.approx(0.19679300291545185, abs=1e-9)
    prior = {r.label: r.label_prob for r in m.label_prior.collect()}
    assert prior["pos"] == pytest.approx(7 / 15)


def test_hash_buckets_and_library_nb_golden(spark, sample, test_df):
    vec_cols = [F.col(c) for c in FEATS]
    train = sample.select("name", F.when(F.col("label") == "pos", 0.0).otherwise(1.0).alias("label"),
                          features.hash_vectorize(vec_cols).alias("vec"))
    model = classify.nb_fit(train, "vec", "label")
    tv = test_df.select("name", features.hash_vectorize(vec_cols).alias("vec"),
                        features.hash_vector_array(vec_cols).alias("arr"))
    pred = classify.probability_columns(classify.nb_predict(model, tv), 2).collect()
    got = {r.name: r for r in pred}
    assert [i for i, x in enumerate(got["t1"].arr) if x] == [11, 13, 18, 19]
    assert [i for i, x in enumerate(got["t2"].arr) if x] == [0, 3, 12, 19]
    assert [i for i, x in enumerate(got["t3"].arr) if x] == [2, 7, 18, 19]
    assert got["t1"].p0 == pytest.approx(0.6239554317548746, abs=1e-9)
    assert got["t2"].p0 == pytest.approx(0.5833333333333336, abs=1e-9)
    assert got["t3"].p1 == pytest.approx(0.6676557863501488, abs=1e-9)
    assert [got[t].prediction for t in ("t1", "t2", "t3")] == [0.0, 0.0, 1.0]


def test_model_save_load(spark, sample, tmp_path):
    train = sample.select(F.lit(0.0).alias("label"), features.hash_vectorize(FEATS).alias("vec"))
    m = classify.nb_fit(train.union(train.withColumn("label", F.lit(1.0))), "vec", "label")
    classify.save_model(m, str(tmp_path / "nb"))
    assert classify.load_model(str(tmp_path / "nb")).numFeatures == 20


def test_encode_categories(sample):
    enc = sample.select("name",
                        features.encode_categories("job", {"老师": 0, "程序员": 1}, 2.0).alias("j"),
                        features.encode_categories("income", {"低": 0, "中": 1}, 2.0).alias("i"),
                        features.encode_categories("age", {"青年": 0, "中年": 1}, 2.0).alias("a"),
                        features.encode_categories("sex", {"男": 0, "女": 1}).alias("s"))
    got = {r.name: [r.j, r.i, r.a, r.s] for r in enc.collect()}
    assert got["r1"] == [0, 1, 0, 0] and got["r4"] == [0, 2, 2, 1] and got["r15"] == [2, 0, 0, 0]


KNN_SAMPLE = [(0, [10.20, 30, 40, 30, None]), (0, [12.22, 29, 42, 35, None]), (0, [11.21, None, None, None, None]),
              (0, [13, 22, 30, 42, 32]), (0, [12, 22, 32, 41, 33]), (0, [10, 21, 33, 45, 35]),
              (1, [30, 11, 21, 40, 34]), (1, [33, 16, 20, 43, 30]), (1, [30, 12, 23, 40, 33]),
              (1, [32, 10, 20, 42, 33]), (1, [30, 13, 20, 42, 30]), (1, [30, 9, 22, 41, 32])]
KNN_TEST = [(1, [11, 21.31, 44, 32, None]), (2, [14, 26, 32, 39, 30]), (3, [32, 14, 21, 42, 32]),
            (4, [34, 12, 22, 42, 34]), (5, [34, 12, 22, 42, 34])]


def test_knn_golden(spark):
    fl = lambda v: [None if x is None else float(x) for x in v]
    s = spark.createDataFrame([(i, float(l), fl(v)) for i, (l, v) in enumerate(KNN_SAMPLE, 100)],
                              "id long, label double, vec array<double>")
    t = spark.createDataFrame([(i, fl(v)) for i, v in KNN_TEST], "id long, vec array<double>")
    got = {r.id: r.predict for r in neighbors.knn_classify(t, s, 4).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}
    nn = neighbors.top_k_neighbors(t, s, 4, label="label").where("qid = 1").orderBy("rank").collect()
    assert [r.label for r in nn] == [0, 0, 0, 0]
    assert nn[0].sim == pytest.approx(0.10437899076741942, abs=1e-9)
    assert nn[1].sim == pytest.approx(0.09254185155014702, abs=1e-9)
    # a 2-2 vote predicts 0
    s2 = spark.createDataFrame([(1, 1.0, [0.0]), (2, 1.0, [0.1]), (3, 0.0, [-0.05]), (4, 0.0, [-0.15])],
                               "id long, label double, vec array<double>")
    t2 = spark.createDataFrame([(9, [0.0])], "id long, vec array<double>")
    assert neighbors.knn_classify(t2, s2, 4).collect()[0].predict == 0


def test_similarity_golden(spark):
    rows = [(1, [40, 50, 10, 2, 5]), (2, [80, 100, 20, 4, 10]), (3, [121, 148, 28, 6, 15]),
            (4, [35, 45, 8, 2, 4]), (5, [70, 92, 16, 4, 7.9]), (6, [103, 136, 23, 6.6, 12.5])]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, vec array<double>")
    got = {(r.id, r.other_id): (r.eud, r.cos) for r in neighbors.similar_items(df, 5).collect()}
    assert len(got) == 30
    want = {(1, 2): (0.015144456469147692, 1.0000000000000002), (1, 3): (0.007700577545741217, 0.99990041217511),
            (1, 4): (0.11881849050177154, 0.9997527973144605), (2, 5): (0.0685882141503055, 0.9995120587735609),
            (4, 5): (0.016582078577669957, 0.9999415231243769), (5, 6): (0.01763827608205801, 0.9999712827883961)}
    for k, (e, c) in want.items():
        assert got[k][0] == pytest.approx(e, abs=1e-9) and got[k][1] == pytest.approx(c, abs=1e-9)


def test_tokens_and_stopwords(spark):
    df = spark.createDataFrame([(1, "Hello, World! hello-again 123 中华人民"), (2, "")], "id long, t string")
    toks = {r.id: r.w for r in df.select("id", text.tokens("t").alias("w")).collect()}
    assert toks[1] == ["hello", "world", "hello", "again", "中华", "华人", "人民"] and toks[2] == []
    w = df.select("id", text.tokens("t").alias("words"))
    a = {r.id: r.words for r in text.remove_stopwords(w, "words", ["hello"]).collect()}
    stop = spark.createDataFrame([("hello",)], "term string")
    b = {r.id: r.words for r in text.remove_stopwords(w, "words", stop).collect()}
    assert a[1] == b[1] == ["world", "again", "中华", "华人", "人民"] and b[2] == []


def test_sparse_vector_and_assemble(spark):
    from pyspark.ml.linalg import SparseVector
    df = spark.createDataFrame([(0, 3, 2.5), (1, 0, 1.0)], "id int, idx int, v double")
    v = df.select("id", features.sparse_vector(10, "idx", "v").alias("sv"))
    got = {r.id: r.vec for r in features.assemble(v, ["sv"], "vec").select("id", "vec").collect()}
    assert isinstance(got[0], SparseVector) and got[0][3] == 2.5 and got[0].numNonzeros() == 1


def test_sql_hash_vector(spark):
    from daybook.functions import register_functions
    register_functions(spark)
    r = spark.sql("SELECT hash_vector(array('老师', '中', '青年', '女'), 20) AS v").first()
    assert [i for i, x in enumerate(r.v) if x] == [11, 13, 18, 19]


def test_bayes_score_without_broadcast(sample, test_df):
    m = bayes.bayes_fit(sample, FEATS, "label", "pos")
    got = {r.name: r.probability for r in bayes.bayes_score(m, test_df, "name", FEATS, broadcast_bytes=0).collect()}
    assert got["t3"] == pytest.approx(0.19679300291545185, abs=1e-9)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_block_top_k_matches_brute_force(spark, metric):
    import numpy as np
    rnd = np.random.default_rng(5)
    vecs = rnd.normal(size=(40, 6)).round(1)  # rounding makes exact ties likely
    vecs[7] = vecs[3]                          # a duplicate vector: a tie at distance 0
    labels = rnd.integers(0, 2, size=40).astype(float)
    df = spark.createDataFrame([(i, float(labels[i]), [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "id long, label double, vec array<double>")
    k = 5
    got = neighbors.top_k_neighbors(df, df, k, metric, label="label", exclude_self=True)
    got = {(r.qid, r.rank): r.cid for r in got.collect()}

    def sim(a, b):
        if metric == "euclidean":
            return 1.0 / (1.0 + np.sqrt(((a - b) ** 2).sum()))
        return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))

    for q in range(40):
        cands = sorted((-round(sim(vecs[q], vecs[c]), 12), labels[c], c) for c in range(40) if c != q)
        for rank, (_, _, c) in enumerate(cands[:k], 1):
            assert got[(q, rank)] == c, (q, rank)


def test_identical_and_distant_vectors_score_by_definition(spark):
    from daybook.functions import euclidean_similarity, register_functions
    big = [[1e8, 0.0], [1e8 + 1, 3.0], [1e8, 1.0]]
    c = spark.createDataFrame([(float(i), v) for i, v in enumerate(big)], "id double, vec array<double>")
    q = spark.createDataFrame([(1.2, [1e8, 1.0]), (1.7, [1e8, 1.0])], "id double, vec array<double>")
    got = {(r.qid, r.cid): r.sim for r in neighbors.top_k_neighbors(q, c, 3).collect()}
    assert set(k[0] for k in got) == {1.2, 1.7}  # ids keep their type
    cols = q.alias("q").crossJoin(c.alias("c")).select("q.id", F.col("c.id").alias("cid"), euclidean_similarity("q.vec", "c.vec").alias("s"))
    assert got == {(r.id, r.cid): r.s for r in cols.collect()}
    assert got[(1.2, 2.0)] == 1.0
    # unequal lengths: as far as both go, in all three forms
    register_functions(spark)
    a = spark.createDataFrame([(1, [1.0, 2.0])], "id long, vec array<double>")
    b = spark.createDataFrame([(2, [1.0, 2.0, 3.0])], "id long, vec array<double>")
    assert neighbors.top_k_neighbors(a, b, 1).first().sim == 1.0
    assert spark.sql("select euclidean_similarity(array(1D, 2D), array(1D, 2D, 3D)) s").first().s == 1.0
    with pytest.raises(ValueError):
        neighbors.top_k_neighbors(a, c, 1, max_sample=2)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_neighbors_of_a_table_in_pieces_match_a_broadcast_sample(spark, metric):
    import numpy as np
    rnd = np.random.default_rng(7)
    df = spark.createDataFrame([(i, float(i % 3 == 0), [float(x) for x in rnd.normal(size=3).round(1)]) for i in range(90)],
                               "id long, label double, vec array<double>")
    want = sorted(map(tuple, neighbors.top_k_neighbors(df, df, 4, metric, label="label", exclude_self=True).collect()))
    got = neighbors.top_k_neighbors(df, df, 4, metric, label="label", exclude_self=True, max_sample=None, piece_rows=20)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 360
    few = df.where("id < 2").select(F.col("id").cast("string").alias("id"), "vec")  # k rows aren't there; ids of two types
    assert neighbors.top_k_neighbors(few, df.where("id < 3"), 4, metric, max_sample=None, piece_rows=1).count() == 6
    assert neighbors.top_k_neighbors(df, df.limit(0), 4, metric, max_sample=None).count() == 0
    assert neighbors.top_k_neighbors(df.limit(0), df, 4, metric, max_sample=None).count() == 0


def test_knn_queries_take_tables_beyond_a_fitted_sample(spark, sf_dir, monkeypatch):
    """The registered queries neither raise nor lose rows where the table exceeds what a
    fitted sample may hold, and no table passes through the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    from daybook.plans import ml
    monkeypatch.setattr(DataFrame, "toArrow", None)
    monkeypatch.setattr(neighbors.top_k_neighbors, "__defaults__", tuple(
        {neighbors.MAX_SAMPLE: 10, neighbors.PIECE_ROWS: 300}.get(x, x) if isinstance(x, int) else x for x in neighbors.top_k_neighbors.__defaults__))
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert n > 300
    assert ml.q_knn(spark, sf_dir).count() == n and ml.q_knn_top(spark, sf_dir).count() == 4 * n


def test_similar_items_in_pieces_match_one_piece(spark):
    import numpy as np
    rnd = np.random.default_rng(6)
    df = spark.createDataFrame([(i, i % 2 if i % 7 else None, [float(x) for x in rnd.normal(size=4).round(1)]) for i in range(60)],
                               "id long, class long, vec array<double>")
    want = sorted(map(tuple, neighbors.similar_items(df, 4, block="class").collect()))
    got = sorted(map(tuple, neighbors.similar_items(df, 4, block="class", block_rows=5).collect()))
    assert got == want and len(got) == 240


def test_stopword_branches_agree(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["c"]), (2, None), (3, ["b", None]), (4, [])], "id long, w array<string>")
    stop = spark.createDataFrame([("b",), ("b",), (None,)], "term string")
    small = text.remove_stopwords(df, "w", stop, "kept")
    large = text.remove_stopwords(df, "w", stop, "kept", inline_bytes=0)
    rows = lambda d: sorted(map(repr, d.select("id", "w", "kept").collect()))
    assert rows(small) == rows(large) == rows(text.remove_stopwords(df, "w", ["b"], "kept"))
    assert {repr(r.kept) for r in small.collect()} == {"['a', 'a']", "['c']", "None", "[None]", "[]"}


def test_term_counts_within_a_row(spark):
    from collections import Counter

    from daybook.operators import features
    rows = [["b", "a", "b"], [], None, ["x"], [None, "a", None], [f"w{i % 97}" for i in range(5000)], ["", "", "é"]]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(rows)], "i int, w array<string>").select("i", features.term_counts("w").alias("c"))
    got = {r.i: r.c and [tuple(x) for x in r.c] for r in df.collect()}
    assert got == {i: None if w is None else sorted(Counter(x for x in w if x is not None).items()) for i, w in enumerate(rows)}
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_lexicon_segmentation(spark):
    long_word = "一二三四五六七八九十"
    df = spark.createDataFrame([(1, "质量很好，物流快 OK!"), (2, None), (1, "甲乙丙质量"), (3, long_word), (3, "一" + long_word)],
                               "id long, t string")
    lex = spark.createDataFrame([("质量",), ("很好",), ("物流",), ("快",), (long_word,), ("一二",), (None,)], "term string")
    got = sorted(repr(r.words) for r in text.segment(df, "t", lex).collect())
    assert got == sorted(repr(r.words) for r in text.segment(df, "t", lex, broadcast_bytes=0).collect())
    assert got == sorted(map(repr, [["质量", "很好", "物流", "快", "ok"], [], ["甲乙", "乙丙", "质量"], [long_word], ["一", long_word]]))
    assert [r.words for r in text.segment(df, "t", lex.where("false")).where("t = '甲乙丙质量'").collect()] == [["甲乙", "乙丙", "丙质", "质量"]]


def test_term_counts_of_stretches(spark, monkeypatch):
    from collections import Counter

    import pyarrow as pa

    from daybook.operators import features
    rows = [["b", None, "a", "b"], None, [], ["b"] * 7, [None], ["é", "z", "\U0001F600", "\uffee"]]
    want = [w if w is None else sorted(Counter(x for x in w if x is not None).items(), key=lambda t: t[0].encode()) for w in rows]
    got = features._count_terms(pa.array([["skipped"], *rows], pa.list_(pa.string())).slice(1)).to_pylist()
    assert [g if g is None else [(t["term"], t["tf"]) for t in g] for g in got] == want
    df = spark.createDataFrame([(w,) for w in rows], "w array<string>").select(features.term_counts("w").alias("c"))
    # before, a lambda was interpreted for each word
    assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(features, "HELD_WORDS", 2)
    assert [r.c and [tuple(x) for x in r.c] for r in df.collect()] == want
