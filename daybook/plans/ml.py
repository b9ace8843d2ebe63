"""Driver queries for the user-profile operators (Q-BAY, Q-NB, Q-VEC, Q-KNN, Q-SIM,
Q-CMT, T1, T2, M7, M8)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import sources
from daybook.operators import bayes, classify, features, neighbors, text, wordgraph
from daybook.plans.registry import register
from daybook.plans.sqlutil import geohash_sql, hashing_tf_bucket, jh
from daybook.plans.tables import table

BAYES_FEATURES = ["priority", "segment", "year", "nation"]


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("o_orderstatus").alias("label"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
        F.year("o_orderdate").cast("string").alias("year"), F.col("c_nationkey").cast("string").alias("nation"))


_ORDER_FEATURES_SQL = """d AS (SELECT o_orderkey, o_orderstatus AS label, o_orderpriority AS priority, c_mktsegment AS segment,
       CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(c_nationkey AS VARCHAR) AS nation
       FROM orders JOIN customer ON o_custkey = c_custkey)"""

_BAYES_MODEL_CTE = f"""{_ORDER_FEATURES_SQL}, FIT
l AS (SELECT 'priority' AS feature, priority AS value, label FROM fit UNION ALL SELECT 'segment', segment, label FROM fit
      UNION ALL SELECT 'year', year, label FROM fit UNION ALL SELECT 'nation', nation, label FROM fit),
c AS (SELECT feature, value, count(*) AS n, count(*) FILTER (WHERE label = 'F') AS n_pos FROM l GROUP BY ALL),
m AS (SELECT feature, value, n / sum(n) OVER (PARTITION BY feature) AS feature_prob,
             n_pos / sum(n_pos) OVER (PARTITION BY feature) AS cond_prob FROM c)"""


def _bayes_model(spark, sf_dir, before: str | None = None):
    d = order_features(spark, sf_dir)
    return bayes.bayes_fit(d.where(F.col("year") < before) if before else d, BAYES_FEATURES, "label", "F")


_FIT_ALL, _FIT_EARLY = "fit AS (SELECT * FROM d),", "fit AS (SELECT * FROM d WHERE year < '1997'),"


@register("q_bayes_model", f"WITH {_BAYES_MODEL_CTE} SELECT * FROM m".replace("FIT", _FIT_ALL))
def q_bayes_model(spark, sf_dir):
    """M1 (A4-A6): per (feature, value) frequency and positive-class likelihood;
    positive = finished order (``o_orderstatus = 'F'``)."""
    return _bayes_model(spark, sf_dir).features


@register("q_bayes_prior", f"""WITH {_ORDER_FEATURES_SQL}
SELECT label, count(*) / sum(count(*)) OVER () AS label_prob FROM d GROUP BY label""")
def q_bayes_prior(spark, sf_dir):
    return _bayes_model(spark, sf_dir).label_prior


_SCORE_JOINS = "\n".join(
    f"LEFT JOIN m m{i} ON m{i}.feature = '{f}' AND m{i}.value = d.{f}" for i, f in enumerate(BAYES_FEATURES))


@register("q_bayes_score", f"""WITH {_BAYES_MODEL_CTE},
p AS (SELECT count(*) FILTER (WHERE label = 'F') / count(*) AS prior FROM fit)
SELECT d.o_orderkey,
  ((SELECT prior FROM p) * coalesce(m0.cond_prob, 1.0) * coalesce(m1.cond_prob, 1.0) * coalesce(m2.cond_prob, 1.0)
    * coalesce(m3.cond_prob, 1.0))
  / (coalesce(m0.feature_prob, 1.0) * coalesce(m1.feature_prob, 1.0) * coalesce(m2.feature_prob, 1.0)
    * coalesce(m3.feature_prob, 1.0)) AS probability
FROM d {_SCORE_JOINS}""".replace("FIT", _FIT_EARLY))
def q_bayes_score(spark, sf_dir):
    """M2: score every order with the model fitted on the orders before 1997, so that later
    years are unseen values (J8)."""
    d = order_features(spark, sf_dir)
    return bayes.bayes_score(_bayes_model(spark, sf_dir, "1997"), d, "o_orderkey", BAYES_FEATURES)


@register("q_encode", """SELECT o_orderkey,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.0 ELSE 2.0 END AS DOUBLE) AS priority_code,
  CAST(CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 END AS DOUBLE) AS status_code FROM orders""")
def q_encode(spark, sf_dir):
    """P13 (Q-VEC coding): an ``else`` default for priority, none for status."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    features.encode_categories("o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1}, 2.0)
                    .cast("double").alias("priority_code"),
                    features.encode_categories("o_orderstatus", {"F": 0, "O": 1}).cast("double").alias("status_code"))


@register("q_vectors", """SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.0 ELSE 2.0 END
  + 10 * coalesce(CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 END, 0.0)
  + 100 * o_totalprice AS weighted FROM orders""")
def q_vectors(spark, sf_dir):
    """M5 (R5): the coded columns and the price assembled into a vector column (null
    -> 0.0), read back element by element and compared through the weighted sum
    ``v0 + 10 v1 + 100 v2``."""
    from pyspark.ml.functions import vector_to_array
    o = table(spark, sf_dir, "orders")
    v = features.vectorize([
        features.encode_categories("o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1}, 2.0),
        features.encode_categories("o_orderstatus", {"F": 0, "O": 1}), F.col("o_totalprice")])
    arr = vector_to_array(v)
    return o.select("o_orderkey", (arr[0] + 10 * arr[1] + 100 * arr[2]).alias("weighted"))


@register("q_sparse_vectors", """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS DOUBLE)
  + 100.0 * (3 + o_orderkey % 7) AS at, o_totalprice + 2.0 AS total FROM orders""")
def q_sparse_vectors(spark, sf_dir):
    """M6 with two indices: the price at the priority's place and 2.0 at 3 to 9, assembled
    (sparse) and read back: the places weighted 1 and 100, and the sum of the cells."""
    from pyspark.ml.functions import vector_to_array
    o = table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    v = o.select("o_orderkey", "o_totalprice", features.sparse_vector(
        10, [code, 3 + F.col("o_orderkey") % 7], ["o_totalprice", F.lit(2.0)]).alias("sv"))
    cells = vector_to_array(F.col("vec"))
    at = F.aggregate(F.transform(cells, lambda x, i: F.when(x == 0, 0.0).when(i < 3, i.cast("double")).otherwise(100.0 * i)), F.lit(0.0),
                     lambda a, x: a + x)
    return features.assemble(v, ["sv"], "vec").select("o_orderkey", at.alias("at"),
                                                      F.aggregate(cells, F.lit(0.0), lambda a, x: a + x).alias("total"))


_SF_D = "((c_nationkey - c_custkey % 9) * (c_nationkey - c_custkey % 9) + (c_acctbal - 100.0) * (c_acctbal - 100.0))"


@register("q_sql_functions", f"""SELECT c_custkey, round({_SF_D}, 6) AS d2, round(1.0 / (1.0 + sqrt({_SF_D})), 12) AS eud,
  round(CASE WHEN c_nationkey = 0 AND c_acctbal = 0 THEN NULL ELSE (c_nationkey * (c_custkey % 9) + c_acctbal * 100.0)
    / (sqrt(c_nationkey * c_nationkey + c_acctbal * c_acctbal) * sqrt((c_custkey % 9) * (c_custkey % 9) + 10025.0)) END, 12) AS cos,
  {jh('c_name')} AS h, CAST(({jh('c_name')} & 2147483647) % 20 AS INTEGER) AS bucket,
  CAST(len(list_distinct([({jh('c_name')} & 2147483647) % 20, ({jh('c_mktsegment')} & 2147483647) % 20])) AS DOUBLE) AS ones,
  {geohash_sql("(c_acctbal * CAST(0.0175 AS DOUBLE) - CAST(87.5 AS DOUBLE))", "(CAST((c_custkey * 37) % 360 AS DOUBLE) - CAST(179.5 AS DOUBLE))", 7)} AS geo
FROM customer""")
def q_sql_functions(spark, sf_dir):
    """R1 to R4 and the geohash as SQL functions through ``spark.sql``, over every customer;
    the arrays compared have two and three cells."""
    from daybook.functions import register_functions

    register_functions(spark)
    view = f"daybook_customer_{uuid.uuid4().hex}"
    sources.as_view(table(spark, sf_dir, "customer"), view)
    return spark.sql(f"""WITH x AS (SELECT *, array(double(c_nationkey), c_acctbal) AS a,
          array(double(c_custkey % 9), 100D, 5D) AS b FROM {view})
        SELECT c_custkey, round(squared_distance(a, b), 6) AS d2, round(euclidean_similarity(a, b), 12) AS eud,
          round(cosine_similarity(a, b), 12) AS cos, java_hash(c_name) AS h, hash_bucket(c_name, 20) AS bucket,
          aggregate(hash_vector(array(c_name, c_mktsegment, null), 20), 0D, (s, v) -> s + v) AS ones,
          geohash_cell(c_acctbal * 0.0175D - 87.5D, double((c_custkey * 37) % 360) - 179.5D, 7) AS geo FROM x""")


_HB = [f"CAST(({jh(c)} & 2147483647) % 20 AS INTEGER)" for c in ("o_orderpriority", "c_mktsegment",
                                                                  "CAST(year(o_orderdate) AS VARCHAR)")]
_NB_SQL = f"""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE 1.0 END AS label,
              list_distinct([{', '.join(_HB)}]) AS b FROM orders JOIN customer ON o_custkey = c_custkey),
cls AS (SELECT label, count(*) AS n FROM x GROUP BY label),
fc AS (SELECT label, j, count(*) AS cnt FROM (SELECT label, unnest(b) AS j FROM x) GROUP BY ALL),
fs AS (SELECT g.label, g.j, coalesce(fc.cnt, 0) AS cnt FROM (SELECT label, j FROM cls, range(0, 20) r(j)) g
       LEFT JOIN fc ON g.label = fc.label AND g.j = fc.j),
ct AS (SELECT label, sum(cnt) AS tot FROM fs GROUP BY label),
th AS (SELECT fs.label, fs.j, ln(fs.cnt + 1.0) - ln(ct.tot + 20.0) AS t FROM fs JOIN ct ON fs.label = ct.label),
pi AS (SELECT label, ln(n + 1.0) - ln((SELECT sum(n) FROM cls) + 2.0) AS p FROM cls),
raw AS (SELECT u.o_orderkey, th.label, sum(th.t) AS s FROM (SELECT o_orderkey, unnest(b) AS j FROM x) u
        JOIN th ON u.j = th.j GROUP BY ALL),
r AS (SELECT raw.o_orderkey, max(CASE WHEN raw.label = 0.0 THEN raw.s + pi.p END) AS r0,
             max(CASE WHEN raw.label = 1.0 THEN raw.s + pi.p END) AS r1
      FROM raw JOIN pi ON raw.label = pi.label GROUP BY raw.o_orderkey)
SELECT o_orderkey, CAST(CASE WHEN r1 > r0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction,
  round(exp(r0 - greatest(r0, r1)) / (exp(r0 - greatest(r0, r1)) + exp(r1 - greatest(r0, r1))), 9) AS p0
FROM r"""


@register("q_nb_hash", _NB_SQL)
def q_nb_hash(spark, sf_dir):
    """Q-NB: 20-bucket binary hash vectors (M3) of priority, segment and year, library
    multinomial naive Bayes (M4, smoothing 1) fitted, saved and loaded again (S12), and
    applied to every order."""
    d = order_features(spark, sf_dir)
    cols = [F.col("priority"), F.col("segment"), F.col("year")]
    train = d.select("o_orderkey", F.when(F.col("label") == "F", 0.0).otherwise(1.0).alias("label"),
                     features.hash_vectorize(cols).alias("vec"))
    path = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-model-{uuid.uuid4().hex}"
    classify.save_model(classify.nb_fit(train, "vec", "label"), path)
    model = classify.load_model(path)
    pred = classify.probability_columns(classify.nb_predict(model, train), 2)
    return pred.select("o_orderkey", "prediction", F.round("p0", 9).alias("p0"))


# --------------------------------------------------------------------------- vectors
def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), F.col("label").alias("class"),
        F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("label"))


_EMB_PAIRS = """e AS (SELECT vec_id, label AS class, CAST(embedding AS DOUBLE[]) AS v, CAST(CASE WHEN label >= 5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label
       FROM embeddings),
pr AS (SELECT a.vec_id AS qid, b.vec_id AS cid, b.label, a.class IS NOT DISTINCT FROM b.class AS same,
              list_cosine_similarity(a.v, b.v) AS cos, 1.0 / (1.0 + list_distance(a.v, b.v)) AS eud
       FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


@register("q_similarity", f"""WITH {_EMB_PAIRS},
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY cos DESC, cid) AS rank FROM pr WHERE same)
SELECT qid AS vec_id, cid AS other_id, CAST(rank AS INTEGER) AS rank, round(cos, 9) AS cos, round(eud, 9) AS eud
FROM r WHERE rank <= 5""")
def q_similarity(spark, sf_dir):
    """M11 (F16, F17) as a top-5 report: each embedding's 5 most cosine-similar others of
    its class (the block key)."""
    s = neighbors.similar_items(_embeddings(spark, sf_dir), 5, "vec_id", "vec", "class")
    return s.select("vec_id", "other_id", "rank", F.round("cos", 9).alias("cos"), F.round("eud", 9).alias("eud"))


_KNN_TOP_SQL = f"""WITH {_EMB_PAIRS},
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY eud DESC, label, cid) AS rank FROM pr)"""


@register("q_knn_top", f"""{_KNN_TOP_SQL}
SELECT qid AS vec_id, cid AS neighbor_id, CAST(rank AS INTEGER) AS rank, label, round(eud, 9) AS sim FROM r WHERE rank <= 4""")
def q_knn_top(spark, sf_dir):
    """The 4 nearest labelled neighbours of every embedding (itself excluded)."""
    e = _embeddings(spark, sf_dir)
    nn = neighbors.top_k_neighbors(e, e, 4, "euclidean", "vec_id", "vec_id", "vec", "label", exclude_self=True, max_sample=None)
    return nn.select(F.col("qid").alias("vec_id"), F.col("cid").alias("neighbor_id"), "rank", "label",
                     F.round("sim", 9).alias("sim"))


@register("q_knn", f"""{_KNN_TOP_SQL}
SELECT qid AS vec_id, CASE WHEN sum(label) > 2 THEN 1 ELSE 0 END AS predict FROM r WHERE rank <= 4 GROUP BY qid""")
def q_knn(spark, sf_dir):
    """Q-KNN (M10, A9): leave-one-out 4-NN vote over all embeddings, label ``label >= 5``."""
    e = _embeddings(spark, sf_dir)
    return neighbors.knn_classify(e, e, 4, "vec_id", "vec", "label", exclude_self=True, max_sample=None)


# --------------------------------------------------------------------------- text
def _doc_words(spark, sf_dir):
    return text.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "words", False)


_TOK_SQL = r"""t AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents)"""


@register("q_tokens", rf"""WITH {_TOK_SQL}
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS n_letters,
       list_min(w) AS first_term, list_max(w) AS last_term FROM t""")
def q_tokens(spark, sf_dir):
    """T1 over every document's whole text: count, letters, min/max token."""
    w = _doc_words(spark, sf_dir)
    return w.select("doc_id", F.size("words").alias("n_tokens"),
                    F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_letters"),
                    F.array_min("words").alias("first_term"), F.array_max("words").alias("last_term"))


_STOP_SQL = rf"""{_TOK_SQL},
tf AS (SELECT doc_id, unnest(w) AS term FROM t),
dfq AS (SELECT term, count(DISTINCT doc_id) AS df FROM tf GROUP BY term),
stop AS (SELECT term FROM dfq WHERE df * 2 > (SELECT count(*) FROM documents))"""


@register("q_stopwords", rf"""WITH {_STOP_SQL},
sl AS (SELECT coalesce(list(term), []) AS sl FROM stop),
k AS (SELECT doc_id, list_filter(w, lambda x: NOT list_contains(sl, x)) AS kept FROM t, sl)
SELECT doc_id, CAST(len(kept) AS INTEGER) AS n_kept,
       CAST(coalesce(list_sum(list_transform(kept, lambda x: length(x))), 0) AS BIGINT) AS n_letters FROM k""")
def q_stopwords(spark, sf_dir):
    """T2 with a corpus stop list: terms in more than half of the documents."""
    w = _doc_words(spark, sf_dir)
    m = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    dfreq = features.document_frequency_of_words(w, "words", docs=m)
    stop = dfreq.where(F.col("df") * 2 > m).select("term")
    kept = text.remove_stopwords(w, "words", stop, "kept")
    return kept.select("doc_id", F.size("kept").alias("n_kept"),
                       F.aggregate("kept", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_letters"))


@register("q_term_freq", rf"""WITH {_TOK_SQL}
SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM t) GROUP BY doc_id, term""")
def q_term_freq(spark, sf_dir):
    """M7 in exact form: ``(doc_id, term, tf)``."""
    counted = _doc_words(spark, sf_dir).select("doc_id", features.term_counts("words").alias("counts"))
    return counted.select("doc_id", F.explode("counts").alias("c")).select("doc_id", "c.term", "c.tf")


@register("q_doc_freq", rf"""WITH {_TOK_SQL},
d AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(w) AS term FROM t) GROUP BY term)
SELECT term, df, round(ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)), 9) AS idf FROM d""")
def q_doc_freq(spark, sf_dir):
    """M8 in exact form: ``(term, df, idf)`` with ``idf = ln((m+1)/(df+1))`` over all
    documents."""
    m = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    d = features.document_frequency_of_words(_doc_words(spark, sf_dir), "words", docs=m)
    return d.select("term", "df", F.round("idf", 9).alias("idf"))


_SEG_MIN_SHARE, _SEG_SCRIPT = 50, r"\p{L}"


def _lexicon(words: DataFrame, m) -> DataFrame:
    """Terms of two to six letters in more than one of ``_SEG_MIN_SHARE`` documents."""
    df = features.document_frequency_of_words(words, "words", docs=m)
    return df.where(F.col("df") * _SEG_MIN_SHARE > m).where(F.length("term").between(2, 6)).select("term")


@register("q_segment", rf"""WITH RECURSIVE {_TOK_SQL},
docs AS (SELECT doc_id, unnest(w) AS run, generate_subscripts(w, 1) AS pos FROM t),
lex AS (SELECT run AS term, length(run) AS n FROM docs GROUP BY run
        HAVING count(DISTINCT doc_id) * {_SEG_MIN_SHARE} > (SELECT count(*) FROM documents) AND length(run) BETWEEN 2 AND 6),
runs AS (SELECT DISTINCT run FROM docs WHERE length(run) >= 2),
subs AS (SELECT run, i, n, substr(run, CAST(i AS BIGINT), CAST(n AS BIGINT)) AS sub
         FROM (SELECT run, unnest(range(1, length(run))) AS i FROM runs), (SELECT unnest(range(2, 7)) AS n) WHERE i + n <= length(run) + 1),
m AS (SELECT run, i, max(subs.n) AS n FROM subs JOIN lex ON sub = term GROUP BY run, i),
nx AS (SELECT a.run, a.i, a.n, min(b.i) AS nx FROM m a LEFT JOIN m b ON a.run = b.run AND b.i >= a.i + a.n GROUP BY ALL),
walk AS (SELECT run, min(i) AS i FROM m GROUP BY run
         UNION ALL SELECT w.run, nx.nx FROM walk w JOIN nx ON w.run = nx.run AND w.i = nx.i WHERE nx.nx IS NOT NULL),
taken AS (SELECT w.run, w.i, m.n, lag(w.i + m.n, 1, 1) OVER (PARTITION BY w.run ORDER BY w.i) AS prev
          FROM walk w JOIN m ON w.run = m.run AND w.i = m.i),
gaps AS (SELECT run, prev AS a, i AS b, substr(run, CAST(i AS BIGINT), CAST(n AS BIGINT)) AS word FROM taken
         UNION ALL SELECT r.run, coalesce(max(t.i + t.n), 1), length(r.run) + 1, NULL FROM runs r LEFT JOIN taken t ON r.run = t.run GROUP BY r.run),
cut AS (SELECT run, a, list_concat(CASE WHEN b - a <= 0 THEN [] WHEN b - a = 1 THEN [substr(run, CAST(a AS BIGINT), 1)]
          ELSE list_transform(range(CAST(a AS BIGINT), CAST(b AS BIGINT) - 1), lambda q: substr(run, q, 2)) END,
          CASE WHEN word IS NULL THEN [] ELSE [word] END) AS toks FROM gaps),
seg AS (SELECT run, flatten(list(toks ORDER BY a)) AS toks FROM cut GROUP BY run),
tok AS (SELECT doc_id, flatten(list(coalesce(toks, [docs.run]) ORDER BY pos)) AS words FROM docs LEFT JOIN seg ON docs.run = seg.run GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(len(words), 0) AS INTEGER) AS n_words, md5(coalesce(array_to_string(words, ' '), '')) AS words_md5
FROM documents LEFT JOIN tok ON documents.doc_id = tok.doc_id""")
def q_segment(spark, sf_dir):
    """T1 with a lexicon: every letter run of every document by forward maximum matching
    against the frequent short words of the table, bigrams for the rest."""
    w = _doc_words(spark, sf_dir)
    m = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seg = text.segment(docs, "text", _lexicon(w, m), script=_SEG_SCRIPT)
    return seg.select("doc_id", F.size("words").alias("n_words"), F.md5(F.array_join("words", " ")).alias("words_md5"))


@register("q_segment_best", rf"""WITH RECURSIVE {_TOK_SQL},
docs AS (SELECT doc_id, unnest(w) AS run, generate_subscripts(w, 1) AS pos FROM t),
lex AS (SELECT run AS term, count(DISTINCT doc_id) AS n FROM docs GROUP BY run
        HAVING count(DISTINCT doc_id) * {_SEG_MIN_SHARE} > (SELECT count(*) FROM documents) AND length(run) BETWEEN 2 AND 6),
tot AS (SELECT CAST(greatest(coalesce(sum(n), 1), 1) AS DOUBLE) AS t FROM lex),
cost AS (SELECT term, CAST(round(ln(t / n) * 1000) AS BIGINT) AS cost FROM lex, tot),
runs AS (SELECT DISTINCT run FROM docs WHERE length(run) >= 2),
subs AS (SELECT run, i, n, substr(run, CAST(i AS BIGINT), CAST(n AS BIGINT)) AS sub
         FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM runs), (SELECT unnest(range(1, 7)) AS n) WHERE i + n <= length(run) + 1),
edge AS (SELECT run, i, n, coalesce(cost, CAST(round(ln(2 * t) * 1000) AS BIGINT)) AS cost
         FROM subs CROSS JOIN tot LEFT JOIN cost ON sub = term WHERE cost IS NOT NULL OR n = 1),
lat AS (SELECT run, i, list({{'n': CAST(n AS BIGINT), 'c': cost}}) AS es FROM edge GROUP BY run, i),
dp AS (SELECT run, CAST(length(run) AS BIGINT) AS i, [CAST(0 AS BIGINT)] AS c, [CAST(0 AS BIGINT)] AS w, CAST([] AS BIGINT[]) AS s FROM runs
       UNION ALL
       SELECT run, i - 1, list_prepend(b.c, c), list_prepend(b.w, w), list_prepend(-b.m, s)
       FROM (SELECT dp.*, list_sort(list_transform(lat.es, lambda e: {{'c': e.c + dp.c[e.n], 'w': 1 + dp.w[e.n], 'm': -e.n}}))[1] AS b
             FROM dp JOIN lat ON lat.run = dp.run AND lat.i = dp.i)),
path AS (SELECT run, s, CAST(1 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS toks FROM dp WHERE i = 0
         UNION ALL SELECT run, s, i + s[i], list_append(toks, substr(run, i, s[i])) FROM path WHERE i <= length(run)),
seg AS (SELECT run, toks FROM path WHERE i > length(run)),
tok AS (SELECT doc_id, flatten(list(coalesce(toks, [docs.run]) ORDER BY pos)) AS words FROM docs LEFT JOIN seg ON docs.run = seg.run GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(len(words), 0) AS INTEGER) AS n_words, md5(coalesce(array_to_string(words, ' '), '')) AS words_md5
FROM documents LEFT JOIN tok ON documents.doc_id = tok.doc_id""")
def q_segment_best(spark, sf_dir):
    """T1 by the best path over a word graph: every letter run of every document, the
    frequent short words of the table as lexicon with their document counts."""
    m = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    df = features.document_frequency_of_words(_doc_words(spark, sf_dir), "words", docs=m)
    lex = df.where(F.col("df") * _SEG_MIN_SHARE > m).where(F.length("term").between(2, 6)).select("term", F.col("df").alias("count"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seg = wordgraph.segment_best(docs, "text", lex, script=_SEG_SCRIPT)
    return seg.select("doc_id", F.size("words").alias("n_words"), F.md5(F.array_join("words", " ")).alias("words_md5"))


# --------------------------------------------------------------------------- comments
_CMT_BUCKETS = 100_000


def _comments(spark, sf_dir):
    """The three label sets (good 0, neutral 1, poor 2) as the reference unions them."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    sources.checkpoint_dir(spark)
    j = d.join(table(spark, sf_dir, "labels"), "doc_id").checkpoint()  # once, for the three sets and the passes of the model
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    neutral = (F.col("quality") == 1) & ~good
    sets = [j.where(F.coalesce(c, F.lit(False))).select("doc_id", F.lit(float(i)).alias("label"), "text")
            for i, c in enumerate((good, neutral, ~(good | neutral)))]
    return text.tokenize(sets[0].unionByName(sets[1]).unionByName(sets[2]), "text", "words")


def _comment_model(spark, sf_dir):
    tf = features.term_frequency(_comments(spark, sf_dir), "words", "tf_vec", _CMT_BUCKETS)
    _, tfidf = features.tf_idf(tf, "tf_vec", "tf_idf_vec")
    return classify.train_eval(tfidf.select("doc_id", "label", "tf_idf_vec"), "tf_idf_vec", "label", "doc_id")


_CMT_SQL = rf"""WITH c AS (SELECT documents.doc_id, CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 0 WHEN quality = 1 THEN 1 ELSE 2 END AS DOUBLE) AS label,
         regexp_extract_all(lower(text), '\p{{L}}+') AS w,
         CAST('0x' || substr(md5(CAST(documents.doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 800 AS train
       FROM documents JOIN labels ON documents.doc_id = labels.doc_id),
tw AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(w) AS term FROM c) GROUP BY ALL),
hb AS (SELECT term, {hashing_tf_bucket('term', _CMT_BUCKETS)} AS j FROM (SELECT DISTINCT term FROM tw)),
tf AS (SELECT doc_id, j, sum(n) AS tf FROM tw JOIN hb USING (term) GROUP BY doc_id, j),
idf AS (SELECT j, ln(((SELECT count(*) FROM c) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY j),
x AS (SELECT tf.doc_id, tf.j, tf.tf * idf.idf AS v FROM tf JOIN idf USING (j)),
cls AS (SELECT label, count(*) AS n FROM c WHERE train GROUP BY label),
pi AS (SELECT label, ln(n + 1.0) - ln((SELECT sum(n) FROM cls) + 1.0 * (SELECT count(*) FROM cls)) AS p FROM cls),
s AS (SELECT c.label, x.j, sum(x.v) AS s FROM x JOIN c USING (doc_id) WHERE c.train GROUP BY ALL),
tot AS (SELECT label, sum(s) AS t FROM s GROUP BY label),
raw AS (SELECT c.doc_id, c.label, cls.label AS k, pi.p + coalesce(sum(x.v * (coalesce(ln(s.s + 1.0), 0.0) - ln(tot.t + {_CMT_BUCKETS}.0))), 0.0) AS r
        FROM c CROSS JOIN cls JOIN pi ON pi.label = cls.label JOIN tot ON tot.label = cls.label LEFT JOIN x ON x.doc_id = c.doc_id
        LEFT JOIN s ON s.label = cls.label AND s.j = x.j WHERE NOT c.train GROUP BY c.doc_id, c.label, cls.label, pi.p),
pred AS (SELECT doc_id, label, arg_max(k, r + 0.0 - k * 1e-12) AS prediction, 
         exp(max(r) FILTER (WHERE k = 0) - max(r)) / sum(exp(r - mx)) AS p0 FROM (SELECT *, max(r) OVER (PARTITION BY doc_id) AS mx FROM raw)
         GROUP BY doc_id, label)"""


@register("q_comment_classify", f"{_CMT_SQL}\nSELECT doc_id, label, prediction, round(p0, 6) AS p0 FROM pred")
def q_comment_classify(spark, sf_dir):
    """Q-CMT: labelled documents (good 0 / neutral 1 / poor 2 from the quality and
    toxicity labels), tokens, hashed TF (100,000), IDF, 80/20 split by a hash of the id,
    multinomial naive Bayes; predictions of the test part."""
    _, pred, _ = _comment_model(spark, sf_dir)
    pred = classify.probability_columns(pred, 1)
    return pred.select("doc_id", "label", "prediction", F.round("p0", 6).alias("p0"))


@register("q_comment_accuracy", f"""{_CMT_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE label = prediction) AS correct,
       count(*) FILTER (WHERE label = prediction) / count(*) AS accuracy FROM pred""")
def q_comment_accuracy(spark, sf_dir):
    """Q-CMT accuracy row."""
    _, _, acc = _comment_model(spark, sf_dir)
    return acc


@register("q_sqdist", """WITH o AS (SELECT o_orderkey, o_custkey,
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.0 ELSE 2.0 END AS DOUBLE) AS c0,
    coalesce(CAST(CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 END AS DOUBLE), 0.0) AS c1,
    o_totalprice / 1000.0 AS c2 FROM orders),
c AS (SELECT o_custkey, avg(c0) AS m0, avg(c1) AS m1, avg(c2) AS m2 FROM o GROUP BY o_custkey)
SELECT o_orderkey, round((c0 - m0) * (c0 - m0) + (c1 - m1) * (c1 - m1) + (c2 - m2) * (c2 - m2), 6) AS sqdist
FROM o JOIN c ON o.o_custkey = c.o_custkey""")
def q_sqdist(spark, sf_dir):
    """F18 (M5): squared distance of every order's coded vector (priority code,
    status code with null as 0.0, price in thousands) to its customer's mean vector.
    The per-customer mean is one partial aggregate joined back, with a customer that
    holds a huge share of the orders salted over several partitions."""
    from daybook.functions import squared_distance
    from daybook.operators.joins import salted_join, top_hot_keys

    o = table(spark, sf_dir, "orders")
    v = o.select("o_orderkey", "o_custkey", F.array(
        features.encode_categories("o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1}, 2.0),
        F.coalesce(features.encode_categories("o_orderstatus", {"F": 0, "O": 1}), F.lit(0.0)),
        F.col("o_totalprice") / 1000.0).alias("vec"))
    cent = v.groupBy("o_custkey").agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(3)],
                                      F.count(F.lit(1)).alias("_n"))
    hot = top_hot_keys(cent, ["o_custkey"], "_n")
    j = salted_join(v.where(F.col("o_custkey").isNotNull()),
                    cent.select("o_custkey", F.array("m0", "m1", "m2").alias("mean")), "o_custkey", hot, "inner")
    return j.select("o_orderkey", F.round(squared_distance("vec", "mean"), 6).alias("sqdist"))
