"""The reference's batch jobs as path/table-driven functions (Q-GEO ... Q-CMT).

Each job reads its inputs with the ``sources`` readers, runs the operators and, where
the reference writes, writes with the ``sources`` writers. Dates are parameters (the
reference hard-codes them). A job that returns a DataFrame leaves the action to the
caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from daybook import sources
from daybook.operators import activity, applog, bayes, classify, features, idmap, neighbors, text

RANGE_COLUMNS = ("guid", "first_dt", "rng_start", "rng_end")


# --------------------------------------------------------------------------- reports
def uca_report(spark: SparkSession, range_csv: str, as_of: str) -> DataFrame:
    """Q-UCA: header CSV of active ranges (all strings) -> ``(dt, act_days, users)``
    ordered by ``act_days`` (O1). A stray line without an end date is dropped by the
    open-range filter."""
    rng = sources.read_csv(spark, range_csv, header=True)
    return activity.continuous_active_users(rng, as_of).orderBy("act_days")


def uca_report_table(spark: SparkSession, source_table: str, target_table: str, as_of: str,
                     source_dt: str | None = None) -> None:
    """Q-UCH: the same over a catalog table (partition ``dt`` pruned when given),
    appended to a catalog table partitioned by ``dt``; a rerun of the same day replaces
    that partition instead of duplicating it."""
    rng = sources.read_table(spark, source_table, f"dt = '{source_dt}'" if source_dt else None)
    res = activity.continuous_active_users(rng, as_of).select("act_days", "users", "dt")
    sources.append_table(res, target_table, partition_by=["dt"], overwrite_partitions=True)


def retention_table(spark: SparkSession, source_table: str, target_table: str, as_of: str) -> None:
    """Q-ART: open ranges of partition ``dt = as_of`` -> retention rows appended to a
    catalog table partitioned by ``dt``."""
    rng = sources.read_table(spark, source_table)
    res = activity.retention(rng, as_of, dt=as_of).select("act_dt", "rt_days", "rt_users", "dt")
    sources.append_table(res, target_table, partition_by=["dt"], overwrite_partitions=True)


def interval_report(spark: SparkSession, range_csv: str, as_of: str, window_days: int = 30) -> DataFrame:
    """Q-ITV: headerless CSV ``guid long, first_dt, rng_start, rng_end`` ->
    ``(guid, itv_days, cnts)``."""
    schema = StructType([StructField("guid", LongType())] +
                        [StructField(c, sources.string_schema(c).fields[0].dataType) for c in RANGE_COLUMNS[1:]])
    rng = sources.read_csv(spark, range_csv, schema, header=False)
    return activity.visit_intervals(rng, as_of, window_days)


# --------------------------------------------------------------------------- geo / ids / log
def geo_dictionary_from_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                             out_path: str, one_per_cell: bool = True, **partitioning) -> None:
    """Q-GEO: points (``BD09_LNG, BD09_LAT, province, city, district``) over JDBC ->
    parquet dictionary ``(geo, province, city, district)``."""
    pts = sources.read_jdbc(spark, url, table, properties, **partitioning)
    sources.write_parquet(applog.geo_dictionary(pts, one_per_cell=one_per_cell), out_path)


def identity_map_job(spark: SparkSession, log_paths: list[str], out_path: str,
                     prev_path: str | None = None, files: int | None = None) -> None:
    """Q-IDM / Q-IDR: JSON log lines of several sources (bag union, U1) -> identity
    dictionary ``(name, biaoshi_hashcode, guid)`` as parquet; with ``prev_path`` yesterday's
    dictionary is rolled in (G4/G5)."""
    lines = None
    for p in log_paths:
        d = sources.read_lines(spark, p)
        lines = d if lines is None else lines.unionByName(d)
    prev = sources.read_parquet(spark, prev_path) if prev_path else None
    ids = idmap.extract_ids(lines)
    named = prev is None or "name" in prev.columns
    res = idmap.identity_dictionary(ids, prev) if named else idmap.identity_map(ids, prev)
    sources.write_parquet(res, out_path, files=files)


def identity_table_job(spark: SparkSession, log_paths: list[str], table: str, prev_table: str | None = None,
                       buckets: int = 4096) -> None:
    """Q-IDM / Q-IDR over the catalog: the dictionary as a table bucketed by
    ``biaoshi_hashcode``. Neither the next day's roll (J6) nor the log cleanse (J4) shuffles
    it again. ``prev_table`` is yesterday's (another table)."""
    lines = sources.read_lines(spark, log_paths)
    prev = sources.read_table(spark, prev_table) if prev_table else None
    sources.write_bucketed(idmap.identity_dictionary(idmap.extract_ids(lines), prev), table, "biaoshi_hashcode", buckets)


def link_lines_job(spark: SparkSession, path: str) -> DataFrame:
    """Q-LINK: text lines -> ``gid,line`` strings."""
    tagged = idmap.link_lines(sources.read_lines(spark, path))
    return tagged.select(F.concat_ws(",", F.col("gid").cast("string"), F.col("line")).alias("value"))


def app_log_job(spark: SparkSession, log_path: str, geo_path: str, idmap_path: str, out_path: str) -> None:
    """Q-LOG: the four paths of the reference's job (log, geo dictionary, identity
    dictionary, output)."""
    res = applog.cleanse_app_log(sources.read_lines(spark, log_path), sources.read_parquet(spark, geo_path),
                                 sources.read_parquet(spark, idmap_path))
    sources.write_parquet(res, out_path)


# --------------------------------------------------------------------------- profile ML
def bayes_job(spark: SparkSession, sample_csv: str, test_csv: str, features_cols: list[str],
              label: str = "label", positive: str = "pos", id_col: str = "name") -> DataFrame:
    """Q-BAY: labelled header CSV + unlabelled header CSV -> ``(name, probability)``."""
    sample = sources.read_csv(spark, sample_csv)
    model = bayes.bayes_fit(sample, features_cols, label, positive)
    return bayes.bayes_score(model, sources.read_csv(spark, test_csv), id_col, features_cols)


def naive_bayes_job(spark: SparkSession, sample_csv: str, test_csv: str, features_cols: list[str],
                    label: str = "label", positive: str = "pos", id_col: str = "name",
                    n_buckets: int = 20, model_path: str | None = None) -> DataFrame:
    """Q-NB: hashed binary vectors (M3) -> multinomial naive Bayes (M4); the positive
    label is class 0.0. Returns the test rows with ``vec, rawPrediction, probability,
    prediction``; the model is saved when ``model_path`` is given (S12)."""
    cols = [F.col(c) for c in features_cols]
    sample = sources.read_csv(spark, sample_csv)
    train = sample.select(id_col, F.when(F.col(label) == positive, 0.0).otherwise(1.0).alias("label"),
                          features.hash_vectorize(cols, n_buckets).alias("vec"))
    model = classify.nb_fit(train, "vec", "label")
    if model_path:
        classify.save_model(model, model_path, overwrite=True)
    test = sources.read_csv(spark, test_csv).select(id_col, features.hash_vectorize(cols, n_buckets).alias("vec"))
    return classify.nb_predict(model, test)


def vector_job(spark: SparkSession, sample_csv: str, codes: dict[str, tuple[dict[str, float], float | None]],
               id_col: str = "name", label: str = "label", positive: str = "pos") -> DataFrame:
    """Q-VEC: category codes (P13) assembled into a vector column (M5):
    ``(name, label, vec)``."""
    s = sources.read_csv(spark, sample_csv)
    coded = [features.encode_categories(c, m, d) for c, (m, d) in codes.items()]
    return s.select(id_col, F.when(F.col(label) == positive, 0.0).otherwise(1.0).alias("label"),
                    features.vectorize(coded).alias("vec"))


def _numeric_csv(spark: SparkSession, path: str, id_col: str, n: int) -> DataFrame:
    schema = StructType([StructField(id_col, DoubleType())] +
                        [StructField(f"f{i}", DoubleType()) for i in range(1, n + 1)])
    df = sources.read_csv(spark, path, schema, header=True)
    return df.select(F.col(id_col), F.array(*[F.col(f"f{i}") for i in range(1, n + 1)]).alias("vec"))


def knn_job(spark: SparkSession, sample_csv: str, test_csv: str, n_features: int = 5, k: int = 4) -> DataFrame:
    """Q-KNN: sample ``label, f1..fn`` and test ``id, f1..fn`` header CSVs (short rows
    and unparsable cells are null and count as 0.0) -> ``(id, predict)``."""
    sample = _numeric_csv(spark, sample_csv, "label", n_features).withColumn(
        "id", F.monotonically_increasing_id())
    test = _numeric_csv(spark, test_csv, "id", n_features)
    return neighbors.knn_classify(test, sample, k, "id", "vec", "label")


def similarity_job(spark: SparkSession, csv: str, n_features: int = 5, k: int = 10) -> DataFrame:
    """Q-SIM: ``id, f1..fn`` header CSV -> ``(id, other_id, rank, cos, eud)``, the ``k``
    most similar items per item (a top-k report; the reference's all-pairs table is the
    case ``k = rows - 1``, which only suits small inputs)."""
    df = _numeric_csv(spark, csv, "id", n_features).withColumn("id", F.col("id").cast("long"))
    return neighbors.similar_items(df, k, "id", "vec")


def comment_classify_job(spark: SparkSession, good: str, neutral: str, poor: str,
                         stopwords_path: str | None = None, model_path: str | None = None,
                         lexicon_path: str | None = None):
    """Q-CMT: three text files of comments (labels 0, 1, 2, united) + optional stop-word
    file -> tokens (T1; with a lexicon, one term a line, Han runs are segmented by it), stop
    words removed (T2), hashed TF (M7), IDF (M8), 80/20 split by a hash of the comment,
    naive Bayes (M9). Returns ``(model, predictions, accuracy_row)``."""
    parts = [sources.read_lines(spark, p).select(F.col("value").alias("cmt"), F.lit(float(i)).alias("label"))
             for i, p in enumerate((good, neutral, poor))]
    sample = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def terms(path: str) -> DataFrame:
        return sources.read_lines(spark, path).select(F.col("value").alias("term"))

    if lexicon_path:
        words = text.segment(sample, "cmt", terms(lexicon_path), "words")
    else:
        words = text.tokenize(sample, "cmt", "words")
    if stopwords_path:
        words = text.remove_stopwords(words, "words", terms(stopwords_path))
    tf = features.term_frequency(words, "words", "tf_vec", 100_000)
    _, tfidf = features.tf_idf(tf)
    model, pred, acc = classify.train_eval(tfidf, "tf_idf_vec", "label", "cmt")
    if model_path:
        classify.save_model(model, model_path, overwrite=True)
    return model, pred, acc
