"""Line dedup by an exact set-similarity join (DataFrame functions only).

A line is the set of its words. Words are ordered by rarity (how often their hash bucket
occurs in all texts); two sets of Jaccard similarity 0.8 then share a word among the first
fifth of either (prefix filter), neither is smaller than 0.8 of the other (length filter),
the words left after the shared one must suffice (positional filter), and parity signatures
(64 bits, then 256) bound in how many words they agree. What passes is verified on the whole sets.

Lines with the same set are one class, so a line that a third of all documents carry is one
row of the join. A semi-join finds the prefix words at which a class meets any partner that
passes the filters; pairs are made at those alone, first with the earliest class of each
word, then, for the classes that this doesn't remove, with all.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import BLANKS, drop, release, save, text_or_empty

# Buckets of the table of word counts (its size is fixed, whatever the vocabulary).
RARITY_BUCKETS = 1 << 16
# Words up to which the short signature tells lines apart.
SHORT = 64
_LOW = (1 << 55) - 1
_PLACE = ["id", "th", "no"]  # a line: document id, hash of its text, number
_CLASS = ["h", "sig", "n"]  # a set of words
_WIDE = ["w0", "w1", "w2", "w3"]  # its wide signature


def _plain(text: Column) -> Column:
    """Text in lower case with spaces for all blanks but line feeds."""
    blanks = functools.reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in "\t\x0b\x0c\r"])
    return F.lower(F.when(blanks, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text))


def _hashes(line: Column) -> Column:
    """Hashes of a line's distinct words."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def rarity(docs: DataFrame) -> Column:
    """An array literal: by hash bucket, how often its words occur in all texts, in quarter
    octaves, in the bits that ``word_codes`` puts before the hash. The driver gets at most
    ``RARITY_BUCKETS`` pairs of numbers."""
    words = docs.select(F.explode(F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(RARITY_BUCKETS - 1)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    levels = [0] * RARITY_BUCKETS
    for b, level in counts.select("b", (F.log2("n") * 4).cast("int") + 1).collect():
        levels[b] = level << 55
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")


def word_codes(line: Column, levels: Column) -> Column:
    """A line's distinct words as 64-bit codes, rarest first: rarity, then hash."""
    def code(h: Column) -> Column:
        level = F.get(levels, h.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int"))
        return level.bitwiseOR(h.bitwiseAND(F.lit(_LOW)))
    return F.sort_array(F.transform(_hashes(line), code))


def _lines(docs: DataFrame) -> DataFrame:
    """The lines of ``(id, th, text)`` that have words, in plain form."""
    rows = docs.select("id", "th", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("no", "line"))
    return rows.where(F.trim("line") != "")


def _wide_signature() -> list[Column]:
    """Parity of the words in ``codes`` in 256 places, as four longs; zeros for short lines."""
    lanes = [f"aggregate(filter(codes, c -> (shiftright(c, 6) & 3) = {k}), 0L, (a, c) -> a ^ shiftleft(1L, int(c & 63)))" for k in range(4)]
    return [F.when(F.size("codes") > SHORT, F.expr(x)).otherwise(F.lit(0).cast("long")).alias(w) for x, w in zip(lanes, _WIDE)]


def _fits(wide: bool = False) -> Column:
    """Signature, length and positional filters on entries ``a`` and ``b`` of one prefix word:
    sets that differ in d words differ in at most d places."""
    na, nb = F.col("a.n"), F.col("b.n")
    room = F.least(na - F.col("a.pos"), nb - F.col("b.pos"))

    def apart(signature: list[str]) -> Column:
        return functools.reduce(Column.__add__, [F.bit_count(F.col(f"a.{k}").bitwiseXOR(F.col(f"b.{k}"))) for k in signature])
    near = 9 * apart(["sig"]) <= na + nb
    if wide:
        near &= (F.least(na, nb) <= SHORT) | (9 * apart(_WIDE) <= na + nb)
    return near & (5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (9 * room >= 4 * (na + nb))


def kept_lines(docs: DataFrame) -> DataFrame:
    """``(id, th, no)`` of every line of ``(id, text)`` with words that repeats no earlier one."""
    spark = docs.sparkSession
    docs = docs.withColumn("th", F.xxhash64("text"))
    levels = rarity(docs)
    release(spark)
    n = F.size("codes")
    lines = _lines(docs).select(*_PLACE, word_codes(F.col("line"), levels).alias("codes")).select(
        *_PLACE, F.xxhash64("codes").alias("h"), n.alias("n"),
        F.expr("aggregate(codes, 0L, (a, c) -> a ^ shiftleft(1L, int(c & 63)))").alias("sig"),
        F.slice("codes", 1, n - F.ceil(n * 0.8).cast("int") + 1).alias("prefix"))
    classes = save(lines.groupBy(*_CLASS).agg(F.min(F.struct(*_PLACE)).alias("ord"), F.first("prefix").alias("prefix")))
    release(spark)

    # prefix words at which a class meets a compatible one (of four words and more)
    e = classes.where("n >= 4").select(*_CLASS, F.posexplode("prefix").alias("pos", "code")).withColumn("word", F.hash("code")).drop("code")
    other = (F.col("a.word") == F.col("b.word")) & ((F.col("a.h") != F.col("b.h")) | (F.col("a.sig") != F.col("b.sig")))
    # written by itself: the two sides of this join are then one exchange
    met = save(e.alias("a").join(e.alias("b"), other & _fits(), "left_semi"))
    release(spark)

    # the words of their classes, which are numbered in the order of their first lines
    some = save(classes.select("h", "sig", "ord").join(met.select("h", "sig").distinct(), ["h", "sig"], "left_semi"))
    some = save(some.orderBy("ord").withColumn("k", F.monotonically_increasing_id()))
    release(spark)
    wanted = some.select("ord.*", "k").groupBy("id", "th").agg(F.map_from_entries(F.collect_list(F.struct("no", "k"))).alias("numbers"))
    same = F.col("p.id").eqNullSafe(F.col("w.id")) & (F.col("p.th") == F.col("w.th"))
    texts = docs.alias("p").join(wanted.alias("w"), same).select("p.id", "p.th", "text", "numbers")
    rows = texts.select("numbers", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("no", "line"))
    rows = rows.select(F.try_element_at("numbers", "no").alias("k"), "line").where("k is not null")
    # one row for a document that is given several times
    codes = save(rows.select("k", word_codes(F.col("line"), levels).alias("codes")).select("k", "codes", *_wide_signature()).dropDuplicates(["k"]))
    release(spark)
    e = save(met.join(some.select("h", "sig", "k"), ["h", "sig"]).join(codes.drop("codes"), "k").select("word", "k", "n", "pos", "sig", *_WIDE))
    drop(met)
    release(spark)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The later classes of the pairs that are similar indeed."""
        pairs = save(pairs.distinct())
        release(spark)
        p = pairs.join(codes.select(F.col("k").alias("b"), F.col("codes").alias("cb")), "b")
        p = p.join(codes.select(F.col("k").alias("a"), F.col("codes").alias("ca")), "a")
        shared = F.size(F.array_intersect("ca", "cb"))
        out = save(p.where(9 * shared >= 4 * (F.size("ca") + F.size("cb"))).select(F.col("b").alias("k")).distinct())
        drop(pairs)
        release(spark)
        return out

    def pairs(later: DataFrame, earlier: DataFrame) -> DataFrame:
        one = (F.col("a.word") == F.col("b.word")) & (F.col("a.k") < F.col("b.k")) & _fits(wide=True)
        return earlier.alias("a").join(later.alias("b"), one).select(F.col("a.k").alias("a"), F.col("b.k").alias("b"))

    # with the earliest class of each prefix word, then with all, for those still there
    first = e.groupBy("word").agg(F.min("k").alias("k"), *[F.min_by(c, "k").alias(c) for c in ["n", "pos", "sig", *_WIDE]])
    gone = confirmed(pairs(e, first))
    gone = gone.unionByName(confirmed(pairs(e.join(gone, "k", "left_anti"), e)))

    gone = some.join(gone, "k", "left_semi").select("ord")
    out = save(classes.select("ord").join(gone, "ord", "left_anti").select("ord.*"))
    for t in (classes, some, codes, e):
        drop(t)
    release(spark)
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines removed from ``text_col``, and
    with ``counts`` also ``n_lines, n_removed`` (in place of columns of these names).

    A line (between line feeds) is the set of its words (between blanks, in lower case).
    It is removed if an earlier line, by document id then line number, has the same set or
    one of Jaccard similarity of at least 0.8, whether that line itself stays or not. The
    other lines stay, byte for byte and in order.

    * lines without words are never removed; null text stays null (0 lines);
    * a document whose lines are all removed stays, with empty text;
    * rows with equal id and text are one document, given twice: neither removes lines of
      the other; rows that share an id alone are ordered by a hash of their texts; null ids
      come first;
    * an empty table gives no rows; other columns pass through, whatever their names.

    Sets are compared by 64-bit codes of their words (55 bits of hash besides the rarity),
    equal sets are recognised by their size and 128 bits of hash and parity.
    """
    d = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kept = kept_lines(d).groupBy("id", "th").agg(F.collect_list("no").alias("kept"))
    cols = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    t, k = f"c{docs.columns.index(text_col)}", f"c{docs.columns.index(id_col)}"
    all_rows = docs.select(*cols).withColumn("th", F.xxhash64(F.coalesce(F.col(t).cast("string"), F.lit(""))))
    joined = all_rows.alias("p").join(kept.alias("w"), F.col(f"p.{k}").eqNullSafe(F.col("w.id")) & (F.col("p.th") == F.col("w.th")), "left")
    joined = joined.withColumn("lines", F.split(t, "\n"))
    rest = F.filter("lines", lambda x, i: F.array_contains("kept", i) | (F.btrim(x, F.lit(BLANKS)) == ""))
    joined = joined.withColumn("rest", rest)
    n_lines, n_rest = [F.when(F.col(t).isNull(), F.lit(0)).otherwise(F.size(c)).cast("long") for c in ("lines", "rest")]
    text = F.when(n_lines == n_rest, F.col(t)).otherwise(F.array_join("rest", "\n"))
    added = {"n_lines": n_lines, "n_removed": n_lines - n_rest} if counts else {}
    columns = [text.alias(c) if c == text_col else F.col(f"p.c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added]
    return joined.select(*columns, *[v.alias(k) for k, v in added.items()])
