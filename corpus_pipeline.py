"""From raw documents to token ids: the training-data pipeline.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that the caller writes as Parquet and reads again as the next stage's
``docs``. Each stage works on all that its predecessor kept, its decisions take effect, and
all stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import byte_bpe, language, line_dedup, minhash, mixing
from daybook.llm.common import read, save


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters) go; of the others a null ``lang`` becomes
    the one found, if any document has a label to learn from."""
    return language.select(docs, language.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; documents stay, with the text that is left."""
    out = line_dedup.line_dedup(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    gone = minhash.near_dedup(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]
# Trained weights, hashes of minima and rounded probabilities are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs)
    return docs
