"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text (white space deleted) is cut into chunks where its own content says so: after a
fixed run of letter classes, never sooner than ``MIN_CHUNK`` and never later than
``MAX_CHUNK`` code points after the last cut. Each distinct chunk text crosses the network
once, to verify that its 64-bit hash names that text alone; from then on a document is its
recipe, the ordered list of chunk identifiers (8 bytes for about a thousand characters),
and equal recipes mean equal texts. Long documents never move again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import BLANKS, save, text_or_empty

MIN_CHUNK, MAX_CHUNK = 1024, 8192
# Cut after this context (about one place in a hundred of running text).
CUT_AFTER = "[a-m][n-z][a-m][n-z][a-m]"


def normalised(col: str = "text") -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(text_or_empty(col), BLANKS, "")


def chunks(text: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    """Content-defined chunks, in order; their concatenation is the text. Empty: no chunk."""
    rule = f"(?s).{{{min_chunk},{max_chunk}}}?(?<={CUT_AFTER})|.{{1,{max_chunk}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, hash_bits: int = 64) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256, n_chunks``.

    Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``. Of equal texts
    the row with the most code points in its original text stays, then the smallest id.

    * null text counts as empty; all empty texts are equal and have no chunk;
    * rows that repeat an id are counted each, and all rows with the id that stays are
      ``kept`` if their texts are equal; a null id loses ties to any id;
    * an empty table gives no rows; other columns are neither read nor returned.

    Chunk hashes that name more than one text (expected: none; ``hash_bits`` shortens the
    hash in tests) are told apart by the rank of the text among those with that hash.
    Groups are found by a partial aggregate, so a group with a third of all rows costs one
    row per task; the join back is a plain equi-join, which adaptive execution splits.
    """
    mask = F.lit(-1 if hash_bits >= 64 else (1 << hash_bits) - 1).cast("long")

    def named(c: Column) -> Column:
        return F.xxhash64(c).bitwiseAND(mask)

    d = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_raw"))
    d = d.withColumn("_text", F.translate("_raw", BLANKS, ""))
    d = d.withColumn("_chunks", chunks(F.col("_text"), min_chunk, max_chunk))

    # every distinct chunk text once; a hash with two texts is a collision
    distinct = d.select(F.explode("_chunks").alias("c")).select(named(F.col("c")).alias("h"), "c").distinct()
    clash = save(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))

    rows = d.select("_id", F.char_length("_raw").alias("_len"), F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"),
                    F.transform("_chunks", named).alias("_recipe"))
    if clash.isEmpty():
        rows = save(rows.withColumn("_ranks", F.lit("")))
    else:
        rows = save(_with_ranks(d, rows, clash, named))

    key = ["_recipe", "_ranks"]
    groups = rows.groupBy(*key).agg(
        F.min(F.struct((-F.col("_len")).alias("l"), F.col("_id").isNull().alias("u"), F.col("_id").alias("i"))).alias("_best"),
        F.count(F.lit(1)).alias("group_size"))
    return (rows.join(groups, key)
            .select(F.col("_id").alias(id_col), F.col("_best.i").alias("keep_id"), "group_size",
                    F.col("_id").eqNullSafe(F.col("_best.i")).alias("kept"), "text_sha256",
                    F.size("_recipe").alias("n_chunks")))


def _with_ranks(d: DataFrame, rows: DataFrame, clash: DataFrame, named) -> DataFrame:
    """Adds ``_ranks``: for chunks on a colliding hash, ``position:rank`` in order."""
    sha = F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256")
    at = d.select(sha, F.posexplode("_chunks").alias("p", "c")).withColumn("h", named(F.col("c")))
    at = at.join(clash, "h", "left_semi")
    ranked = at.select("h", "c").distinct().withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("c")))
    per_text = (at.join(ranked, ["h", "c"]).groupBy("text_sha256")
                .agg(F.sort_array(F.collect_set(F.struct("p", "r"))).alias("pr")))
    per_text = per_text.select("text_sha256", F.concat_ws(",", F.transform(
        "pr", lambda x: F.concat_ws(":", x["p"].cast("string"), x["r"].cast("string")))).alias("_ranks"))
    return rows.join(per_text, "text_sha256", "left").withColumn("_ranks", F.coalesce("_ranks", F.lit("")))
