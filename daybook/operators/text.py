"""Text operators (survey: T1, T2).

Tokens are maximal runs of letters (``\\p{L}``), lower-cased. A run of Han characters
longer than two is split into overlapping character bigrams (a dictionary-free
stand-in for the reference's segmenter, deviation D5). Everything is a Spark
expression over the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys

_LETTERS = r"\p{L}+"
_HAN = r"^\p{IsHan}{3,}$"


def tokens(text: str | Column, han_bigrams: bool = True) -> Column:
    """``array<string>`` of lower-cased letter runs of the whole text."""
    t = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_extract_all(F.lower(t), F.lit(_LETTERS), 0)
    if not han_bigrams:
        return runs
    return F.flatten(F.transform(runs, lambda w: F.when(
        w.rlike(_HAN),
        F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, 2)),
    ).otherwise(F.array(w))))


def tokenize(df: DataFrame, col: str, out_col: str = "words", han_bigrams: bool = True) -> DataFrame:
    return df.withColumn(out_col, tokens(col, han_bigrams))


def token_rows(df: DataFrame, doc_col: str, words_col: str = "words") -> DataFrame:
    """Words as rows ``(doc, pos, term)`` (1-based position)."""
    return df.select(doc_col, F.posexplode(words_col).alias("pos", "term")).withColumn("pos", F.col("pos") + 1)


# A stop list is handed to the tasks whole up to this many bytes of terms; a longer one is
# joined. Either way the result is the same.
INLINE_BYTES = 1 << 20


def remove_stopwords(df: DataFrame, words_col: str, stop: list[str] | DataFrame, out_col: str | None = None,
                     inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """Drop stop words from a word array, keeping order and duplicates of the rest.

    ``stop`` is a list or a DataFrame with a column ``term``; nulls in it mean nothing. A
    null array stays null, a null word stays; every row is treated by itself, whatever its
    other columns hold, and no column needs to identify it.

    A list of at most ``inline_bytes`` bytes (measured first) is a hash set in the JVM. A
    longer one is joined: words are exploded with their position, common ones dealt over
    several tasks by their counts, and each row's array is rebuilt in order.
    """
    from pyspark.ml.feature import StopWordsRemover

    out_col = out_col or words_col
    if not isinstance(stop, list):
        terms = stop.select(F.col("term").cast("string").alias("term")).where("term is not null").distinct()
        size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()[0]
        if size > inline_bytes:
            return _anti_join_words(df, words_col, terms, out_col)
        stop = [r[0] for r in terms.collect()]
    stop = [t for t in stop if t is not None]
    words = F.coalesce(F.col(words_col), F.array().cast("array<string>"))
    kept = StopWordsRemover(inputCol="__words", outputCol="__kept", stopWords=stop, caseSensitive=True).transform(
        df.withColumn("__words", words))
    kept = kept.withColumn("__kept", F.when(F.col(words_col).isNotNull(), F.col("__kept")))
    return kept.withColumn(out_col, F.col("__kept")).drop("__words", "__kept")


def _per_array(df: DataFrame, words_col: str, wanted: Column, work, out_col: str) -> DataFrame:
    """Adds ``out_col``: for arrays that are ``wanted`` what ``work`` makes of them, else null.

    ``work`` gets the distinct arrays as ``(__row, __words)`` and returns ``(__row, __out)``.
    They are written first (``checkpoint``), so a number names the same array in every use;
    the result goes back to the rows by the array itself."""
    from daybook.sources.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    each = (df.where(wanted).groupBy(F.col(words_col).alias("__words")).agg(F.count(F.lit(1)).alias("__uses"))
            .withColumn("__row", F.monotonically_increasing_id()).checkpoint())
    made = each.join(work(each.select("__row", "__words")), "__row", "left").select("__words", F.col("__out").alias(out_col))
    keyed = df.withColumn("__words", F.when(wanted, F.col(words_col)))
    return salted_join(keyed, made, "__words", top_hot_keys(each, ["__words"], "__uses"), "left").drop("__words")


def _anti_join_words(df: DataFrame, words_col: str, terms: DataFrame, out_col: str) -> DataFrame:
    def work(arrays: DataFrame) -> DataFrame:
        rows = arrays.select("__row", F.posexplode("__words").alias("pos", "term"))
        counts = rows.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        marked = salted_join(rows, terms.withColumn("is_stop", F.lit(True)), "term", top_hot_keys(counts, ["term"], "n"), "left")
        return marked.where("is_stop is null").groupBy("__row").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "term"))), lambda s: s["term"]).alias("__out"))

    out = _per_array(df, words_col, F.col(words_col).isNotNull(), work, "__kept")
    rest = F.when(F.col(words_col).isNotNull(), F.coalesce("__kept", F.array().cast("array<string>")))
    return out.withColumn(out_col, rest).drop("__kept")


# Cut runs that a task remembers from one stretch of rows to the next where the lexicon is
# broadcast, and runs of a stretch.
REMEMBERED, HELD_RUNS = 50_000, 500_000


def cut_beside(df: DataFrame, runs_col: str, wanted: Callable[[Column], Column], lexicon: DataFrame,
               cut: Callable[[list[str], dict, int], list[list[str]]], out_col: str) -> DataFrame:
    """Adds ``out_col``, the words of ``runs_col`` (neither arrays nor words null) with each
    ``wanted`` run replaced by what ``cut(different runs, lexicon, longest)`` makes of it,
    where the rows lie. ``lexicon`` (a term and a
    value) is sent to every task: check its size before."""
    known = lexicon.toArrow()
    terms = known.column(0).to_pylist()
    shared = df.sparkSession.sparkContext.broadcast((dict(zip(terms, known.column(1).to_pylist())), max(map(len, terms), default=0)))
    marked = df.withColumn("__cut", F.transform(runs_col, wanted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, longest = shared.value
        remembered: dict[str, list[str]] = {}

        def cut_rows(runs: pa.ListArray, chosen: np.ndarray) -> pa.ListArray:
            # each different run of the stretch is cut once; its pieces are placed by number
            nonlocal remembered
            flat = runs.flatten().dictionary_encode()
            which = flat.indices.to_numpy()
            chosen_runs = np.zeros(len(flat.dictionary), dtype=bool)
            chosen_runs[which] = chosen
            different = flat.dictionary.to_pylist()
            asked = list(compress(different, chosen_runs.tolist()))
            unknown = [w for w in asked if w not in remembered]
            cuts = remembered | dict(zip(unknown, cut(unknown, words, longest)))
            pieces = [cuts[w] if c else (w,) for w, c in zip(different, chosen_runs.tolist())]
            remembered = {w: cuts[w] for w in asked[:REMEMBERED]}  # frequent ones come early
            sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
            made = sizes[which]
            ends = np.concatenate(([0], np.cumsum(made)))
            at = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], made)
            rows = np.concatenate(([0], np.cumsum(pc.list_value_length(runs).to_numpy())))
            words_of = pa.array([t for p in pieces for t in p], pa.string()).take(pa.array(at))
            return pa.ListArray.from_arrays(pa.array(ends[rows].astype(np.int32)), words_of)

        for batch in batches:
            names = batch.schema.names
            rest = [n for n in names if n not in (runs_col, "__cut", out_col)]
            before = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(names.index(runs_col))), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:  # a stretch of rows at a time; a longer row is one by itself
                stop = int(np.searchsorted(before, (before[start - 1] if start else 0) + HELD_RUNS, side="right"))
                part = batch.slice(start, max(1, stop - start))
                start += part.num_rows
                runs, cuts = (part.column(names.index(c)) for c in (runs_col, "__cut"))
                out = cut_rows(runs, cuts.flatten().to_numpy(zero_copy_only=False).astype(bool))
                yield pa.RecordBatch.from_arrays([*(part.column(names.index(n)) for n in rest), out], names=[*rest, out_col])

    kept = [f for f in marked.schema.fields if f.name not in (runs_col, "__cut", out_col)]
    return marked.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` array<string>"]))


def longest_match(run: str, words: dict, longest: int) -> list[str]:
    """Forward maximum matching by words of two characters or more; bigrams in between."""
    out, gap, i = [], 0, 0
    while i <= len(run):
        n = 0
        for k in range(min(longest, len(run) - i), 1, -1):
            if run[i:i + k] in words:
                n = k
                break
        if n or i == len(run):
            between = run[gap:i]
            out += [between[k:k + 2] for k in range(max(1, len(between) - 1))] if between else []
            if n:
                out.append(run[i:i + n])
            gap = i + n
        i += max(1, n)
    return out


def longest_matches(runs: list[str], words: dict, longest: int) -> list[list[str]]:
    return [longest_match(run, words, longest) for run in runs]


def segment(df: DataFrame, col: str, lexicon: DataFrame, out_col: str = "words", script: str = r"\p{IsHan}",
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """T1 with a lexicon: letter runs as ``tokens`` makes them, and every run of ``script``
    segmented by forward maximum matching against ``lexicon`` (column ``term``); stretches
    that no word covers become bigrams (a single character stays). Null text gives [].

    A lexicon of at most ``broadcast_bytes`` (measured) is sent to the tasks, and rows are cut
    where they lie. Neither words nor lexicon are limited: with a larger one, at each place
    of each distinct run all substrings up to the length of the longest word are joined with
    it (common substrings dealt over several tasks), and the longest matches are walked
    through in order. Rows without such a run take no part in any shuffle of words.
    """
    def wanted(w: Column) -> Column:
        return (F.length(w) >= 2) & F.regexp(w, F.lit(f"^(?:{script})+$"))

    from daybook.sources.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    # written once: it is measured, then sent or joined, and is often made from the whole corpus
    lex = lexicon.select(F.col("term").cast("string").alias("sub")).where("length(sub) >= 2").distinct().checkpoint()

    words = F.coalesce(tokens(col, han_bigrams=False), F.array().cast("array<string>"))
    if measured_bytes(lex) <= broadcast_bytes:
        return cut_beside(df.withColumn("__runs", words), "__runs", wanted, lex.withColumn("known", F.lit(True)), longest_matches, out_col)

    def work(arrays: DataFrame) -> DataFrame:
        hit = arrays.select("__row", F.posexplode("__words").alias("pos", "run"))
        runs = hit.where(wanted(F.col("run"))).groupBy("run").agg(F.count(F.lit(1)).alias("uses"))
        longest = F.coalesce(lex.agg(F.max(F.length("sub"))).scalar(), F.lit(0))
        at = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run") - 1)).alias("i"), longest.alias("most"))
        reach = F.least(F.col("most"), F.length("run") - F.col("i") + 1)
        at = at.where(reach >= 2).select("run", "i", F.explode(F.sequence(F.lit(2), reach)).alias("n"))
        at = at.withColumn("sub", F.substring("run", F.col("i"), F.col("n")))
        hot = top_hot_keys(at.groupBy("sub").agg(F.count(F.lit(1)).alias("c")), ["sub"], "c")
        found = salted_join(at, lex.withColumn("known", F.lit(True)), "sub", hot, "inner").groupBy("run", "i").agg(F.max("n").alias("n"))
        found = found.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("i", "n"))).alias("matches"))
        none = F.array().cast("array<struct<i:int,n:int>>")
        cut = runs.join(found, "run", "left").select("run", "uses", _walk(F.col("run"), F.coalesce("matches", none)).alias("seg"))
        parts = salted_join(hit, cut.select("run", "seg"), "run", top_hot_keys(cut, ["run"], "uses"), "left")
        parts = parts.select("__row", F.struct("pos", F.coalesce("seg", F.array("run")).alias("seg")).alias("p"))
        return parts.groupBy("__row").agg(F.flatten(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["seg"])).alias("__out"))

    out = _per_array(df.withColumn("__runs", words), "__runs", F.exists("__runs", wanted), work, "__seg")
    return out.withColumn(out_col, F.coalesce("__seg", "__runs")).drop(*{"__runs", "__seg"} - {out_col})


def _walk(run: Column, matches: Column) -> Column:
    """Forward maximum matching: of the longest matches by place, each that starts at or
    after the end of the one taken before; bigrams in between."""
    def gap(start: Column, end: Column) -> Column:
        n = end - start
        bigrams = F.transform(F.sequence(start, F.greatest(start, end - 2)), lambda i: F.substring(run, i, F.lit(2)))
        return F.when(n <= 0, F.array().cast("array<string>")).when(n == 1, F.array(F.substring(run, start, F.lit(1)))).otherwise(bigrams)

    def take(acc: Column, m: Column) -> Column:
        taken = F.struct((m["i"] + m["n"]).alias("at"), F.concat(
            acc["out"], gap(acc["at"], m["i"]), F.array(F.substring(run, m["i"], m["n"]))).alias("out"))
        return F.when(m["i"] >= acc["at"], taken).otherwise(acc)

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(matches, start, take, lambda acc: F.concat(acc["out"], gap(acc["at"], F.length(run) + 1)))
