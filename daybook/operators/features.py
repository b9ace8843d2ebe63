"""Feature vectorisation (survey: P13, M3, M5-M8)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.core import hash_bucket


def encode_categories(c: str | Column, mapping: dict[str, float], default: float | None = None) -> Column:
    """``case c when k then v ... else default end``; without ``default`` an
    unmapped value gives null (as the reference's ``sex`` column)."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(float(v))) if expr is None else expr.when(col == F.lit(k), F.lit(float(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def hash_vector_array(cols: list[str | Column], n: int = 20) -> Column:
    """M3 as ``array<double>``: 1.0 at ``hash_bucket(v, n)`` of every value, else 0.0."""
    buckets = F.array(*[hash_bucket(c, n) for c in cols])
    # ``buckets`` is the aggregate's input, so each value is hashed once per row
    zero = F.array_repeat(F.lit(0.0), n)
    return F.aggregate(buckets, zero, lambda acc, b: F.transform(
        acc, lambda x, i: F.when(i == b, F.lit(1.0)).otherwise(x)))


def hash_vectorize(cols: list[str | Column], n: int = 20) -> Column:
    """M3: binary hashed feature vector (``VectorUDT``) of width ``n``; no Python UDF."""
    return array_to_vector(hash_vector_array(cols, n))


def vectorize(cols: list[str | Column]) -> Column:
    """M5: numeric columns -> dense vector (``VectorUDT``); null cells become 0.0."""
    return array_to_vector(F.array(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("double"),
                                                F.lit(0.0)) for c in cols]))


def sparse_vector(size: int, index: str | Column | list, value: str | Column | list) -> Column:
    """M6: vector of ``size`` with values at indices, zero elsewhere. ``index`` and ``value``
    are columns, or lists of columns of one length for several places.

    An index outside the vector or null is left out, of an index given twice the first
    value counts, and a null value is 0.0. Returned dense; ``assemble``
    (``VectorAssembler``) stores it sparse when that is smaller. Meant for modest sizes;
    text features come sparse from ``term_frequency`` directly."""
    idx = [(F.col(c) if isinstance(c, str) else c).cast("int") for c in (index if isinstance(index, list) else [index])]
    val = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in (value if isinstance(value, list) else [value])]
    if len(idx) != len(val):
        raise ValueError("as many values as indices")
    indices, values = F.array(*idx), F.array(*[F.coalesce(v, F.lit(0.0)) for v in val])

    def cell(i: Column) -> Column:
        return F.coalesce(F.get(values, F.coalesce(F.array_position(indices, i), F.lit(0)).cast("int") - 1), F.lit(0.0))

    return array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), cell))


def assemble(df: DataFrame, cols: list[str], out_col: str = "features") -> DataFrame:
    """``VectorAssembler`` over numeric / vector columns; each row's vector is stored
    sparse or dense, whichever is smaller (so one-hot columns from ``sparse_vector``
    come out sparse)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=cols, outputCol=out_col, handleInvalid="error").transform(df)


def term_frequency(df: DataFrame, words_col: str, out_col: str = "tf_vec", n: int = 100_000) -> DataFrame:
    """M7: hashed term-frequency vector (``HashingTF``, ``n`` buckets)."""
    return HashingTF(inputCol=words_col, outputCol=out_col, numFeatures=n).transform(df)


def tf_idf(df: DataFrame, tf_col: str = "tf_vec", out_col: str = "tf_idf_vec"):
    """M8: fit ``IDF`` (``ln((m+1)/(df+1))``) and return ``(model, transformed)``. The fit
    is one aggregate over the vectors; only the ``n``-wide document-frequency vector
    reaches the driver."""
    model = IDF(inputCol=tf_col, outputCol=out_col).fit(df)
    return model, model.transform(df)


def exact_term_frequency(tokens: DataFrame, doc_col: str, term_col: str = "term") -> DataFrame:
    """M7 in exact (unhashed) form over a token table: ``(doc, term, tf)``."""
    return tokens.groupBy(doc_col, term_col).agg(F.count(F.lit(1)).alias("tf"))


# Words that a task counts at a time.
HELD_WORDS = 500_000


def _count_terms(words: pa.ListArray) -> pa.ListArray:
    """The counted terms of each array of ``words``: a (row, place of the term) number for
    each word, sorted."""
    flat = words.flatten()
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy())
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    number = row[known] * max(1, len(order)) + place[coded.indices.drop_null().to_numpy()]
    number, times = np.unique(number, return_counts=True)
    row, term = np.divmod(number, max(1, len(order)))
    counted = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(order[term])), pa.array(times.astype(np.int64))], names=["term", "tf"])
    ends = pa.array(np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(ends, counted, mask=words.is_null())


def term_counts(words: str | Column) -> Column:
    """M7 in exact form within a row: ``array<struct<term, tf>>`` of a word array, terms in
    order, null words left out; a null array gives null. A document that is one row needs no
    shuffle: the words of a stretch of rows are numbered, sorted and counted together."""
    @F.arrow_udf("array<struct<term:string,tf:bigint>>")
    def count(arrays: pa.Array) -> pa.Array:
        before = np.cumsum(pc.fill_null(pc.list_value_length(arrays), 0).to_numpy())
        out, start = [], 0
        while start < len(arrays):  # a longer row is a stretch by itself
            stop = int(np.searchsorted(before, (before[start - 1] if start else 0) + HELD_WORDS, side="right"))
            out.append(_count_terms(arrays.slice(start, max(1, stop - start))))
            start += len(out[-1])
        return pa.concat_arrays(out) if out else _count_terms(arrays)

    return count(F.col(words) if isinstance(words, str) else words)


def document_frequency(tf: DataFrame, doc_col: str, term_col: str = "term", docs: Column | None = None) -> DataFrame:
    """M8 in exact form: ``(term, df, idf)`` with ``idf = ln((m + 1) / (df + 1))`` where
    ``m`` is the number of documents (a scalar subquery unless given)."""
    if docs is None:
        docs = tf.select(F.count_distinct(doc_col)).scalar()
    d = tf.groupBy(term_col).agg(F.count(F.lit(1)).alias("df"))
    return d.select(term_col, "df", F.ln((docs + 1) / (F.col("df") + 1)).alias("idf"))


def document_frequency_of_words(df: DataFrame, words_col: str, term_col: str = "term",
                                docs: Column | None = None) -> DataFrame:
    """M8 from word arrays: each document contributes its distinct terms once
    (``array_distinct`` before the explode), so one partial aggregate counts document
    frequency without a separate de-duplication shuffle. ``(term, df, idf)``."""
    if docs is None:
        docs = df.select(F.count(F.lit(1))).scalar()
    d = (df.select(F.explode(F.array_distinct(words_col)).alias(term_col))
         .groupBy(term_col).agg(F.count(F.lit(1)).alias("df")))
    return d.select(term_col, "df", F.ln((docs + 1) / (F.col("df") + 1)).alias("idf"))
