"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times, rarely a whole
number. Two documents with fractional parts meet, and words move from one to the other, in
a random direction whose odds keep both expectations, until one of them is whole. The words
expected of the source never change, so in the end a source misses its target by at most
the last document that is still fractional. Long documents meet first, so that one is short.

Documents meet in leaves, dealt by a hash of their id; what a leaf cannot settle (one
document) goes to the next level of a reduction tree of fixed fan-in. A leaf is streamed
with one document in hand, and a source with a third of all rows is simply many leaves.
The tree depends on the rows alone, not on partitions, so reruns agree.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import save, text_or_empty

LEAF_ROWS, FAN_IN = 1024, 64
# Most rows of the table of sources that is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Adds ``target`` to ``(source, source_size, ...)``, one row a source.

    Sources in order of code points, null last, weigh ``weights`` in rotation and share the
    sum of all sizes by weight; a target stops at ``most`` times its source's size and the
    excess is shared again by weight among the rest, until none is above. In closed form:
    by ascending limit per weight, a source is at its limit while that is at most the level
    at which the remaining words and weights stand.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("rank", F.row_number().over(by_name).cast("long") - 1)
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), "rank")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    words_left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    s = s.withColumn("_level", words_left / weight_left)
    s = s.withColumn("_free", F.col("_cap") > F.col("_level") * F.col("_w"))
    level = F.first(F.when(F.col("_free"), F.col("_level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("_w")))
    return s.withColumn("target", target).drop("_w", "_cap", "_level", "_free")


def _settle(batches: Iterator[pa.RecordBatch], last: bool, seed: int) -> Iterator[pa.RecordBatch]:
    """One pass over rows sorted by (rank, leaf): at most one row a leaf stays fractional;
    in the ``last`` pass that one, of all its source, goes to the nearer whole number, which
    leaves the source within half that document of its target."""
    def throw(a: int, b: int) -> float:
        h = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9) & (2**64 - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ (h >> shift)) * factor) & (2**64 - 1)
        return (h ^ (h >> 31)) / 2**64

    held, where = None, None  # the row in hand: its batch's columns, number, and part

    def close(row):
        if last:
            row["copies"] += 1 if row["part"] >= 0.5 else 0
            row["part"] = 0.0

    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            if (r["rank"], r["leaf"]) != where:
                if held is not None:
                    close(held)
                    out.append(held)
                held, where = None, (r["rank"], r["leaf"])
            if r["part"] <= 0.0 or not r["size"]:
                r["part"] = 0.0
                out.append(r)
                continue
            if held is None:
                held = r
                continue
            a, b = held, r
            up = min((1 - a["part"]) * a["size"], b["part"] * b["size"])
            down = min(a["part"] * a["size"], (1 - b["part"]) * b["size"])
            if throw(a["hash"], b["hash"]) * (up + down) < down:
                whole_a = (1 - a["part"]) * a["size"] <= b["part"] * b["size"]
                whole_b = (1 - a["part"]) * a["size"] >= b["part"] * b["size"]
                a["part"] = 1.0 if whole_a else a["part"] + up / a["size"]
                b["part"] = 0.0 if whole_b else b["part"] - up / b["size"]
            else:
                whole_a = a["part"] * a["size"] <= (1 - b["part"]) * b["size"]
                whole_b = a["part"] * a["size"] >= (1 - b["part"]) * b["size"]
                a["part"] = 0.0 if whole_a else a["part"] - down / a["size"]
                b["part"] = 1.0 if whole_b else b["part"] + down / b["size"]
            held = None
            for x in (a, b):
                if 0.0 < x["part"] < 1.0 and held is None:
                    held = x
                else:
                    x["copies"] += round(x["part"])
                    x["part"] = 0.0
                    out.append(x)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
        schema = batch.schema
    if held is not None:
        close(held)
        yield pa.RecordBatch.from_pylist([held], schema=schema)


def _copies(d: DataFrame, weights: tuple[float, ...], most: float, seed: int, leaf_rows: int, fan_in: int) -> DataFrame:
    """Rounded ``copies`` (and ``source_size, target``) of the rows ``(id, source, size,
    hash, ...)`` of a saved table."""
    extra = [c for c in d.columns if c not in ("id", "source", "size", "hash")]
    sources = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = save(targets(sources, weights, most).select(F.col("source").alias("_source"), "source_size", "n", "rank", "target"))
    known = sources.agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("most")).first()
    small = F.broadcast(sources) if known["n"] <= BROADCAST_SOURCES else sources
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = d.join(small, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_e", expected)
    empty = F.col("size") == 0
    rows = rows.select(
        "id", "size", "source_size", "target", "rank", "hash", *extra,
        F.pmod(F.xxhash64(F.lit(seed + 1), F.col("hash")), F.ceil(F.col("n") / leaf_rows)).alias("leaf"),
        F.when(empty, F.lit(0)).otherwise(F.floor("_e")).cast("long").alias("copies"),
        F.when(empty, F.lit(0.0)).otherwise(F.col("_e") - F.floor("_e")).alias("part"))

    leaves, settled, level = -(-(known["most"] or 0) // leaf_rows), [], 0
    while True:
        last = leaves <= 1
        ordered = rows.repartition("rank", "leaf").sortWithinPartitions(
            "rank", "leaf", F.col("size").desc(), "hash", "id", *extra)
        done = save(ordered.mapInArrow(functools.partial(_settle, last=last, seed=seed + level), ordered.schema))
        settled.append(done.where("part = 0.0"))
        if last:
            break
        leaves, level = -(-leaves // fan_in), level + 1
        rows = done.where("part > 0.0").withColumn("leaf", F.expr(f"leaf div {fan_in}"))
    return functools.reduce(DataFrame.unionByName, settled)


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3, seed: int = 0, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: ``id_col, size, source_size, target, copies, taken``.

    ``size`` is the document's number of words (runs without ``[\\x20\\x09-\\x0D]``; null
    text has none), ``target`` its source's (see ``targets``), ``copies`` how often the mix
    takes it (0 to ``most``) and ``taken`` ``copies * size``. A source's taken words differ
    from its target by at most half of one of its documents.

    * a null source is a source of its own, the last; a document without words is never
      taken, and a source of such documents has target 0;
    * repeated ids and rows are separate documents; null ids stay; an empty table gives no
      rows; other columns are neither read nor returned.
    """
    d = save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_or_empty(text_col)).alias("size"),
                         F.xxhash64(F.lit(seed), F.col(id_col)).alias("hash")))
    out = _copies(d, weights, most, seed, leaf_rows, fan_in)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def sample(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3, seed: int = 0, id_col: str = "doc_id",
           source_col: str = "source", text_col: str = "text", leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """The rows and columns of ``docs``, each as often as the mix takes it.

    As ``mix``, except that rows equal in id, source and text are taken alike. Decisions are
    made without the texts, which move once, to meet them.
    """
    names = docs.columns
    d = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    at = {k: F.col(f"c{names.index(c)}") for k, c in (("id", id_col), ("source", source_col), ("text", text_col))}
    narrow = d.select(at["id"].alias("id"), at["source"].alias("source"), word_count(F.coalesce(at["text"].cast("string"), F.lit(""))).alias("size"),
                      F.xxhash64(at["text"]).alias("th"))
    narrow = narrow.groupBy("id", "source", "th").agg(F.sum("size").alias("size"))
    narrow = save(narrow.withColumn("hash", F.xxhash64(F.lit(seed), F.col("id"))).withColumn("of", F.col("source")))
    taken = _copies(narrow, weights, most, seed, leaf_rows, fan_in).where("copies > 0").select("id", "th", "of", "copies")
    met = d.withColumn("_h", F.xxhash64(at["text"])).join(
        taken, at["id"].eqNullSafe(F.col("id")) & (F.col("_h") == F.col("th")) & at["source"].eqNullSafe(F.col("of")))
    met = met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return met.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
