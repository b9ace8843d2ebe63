"""Segmentation by the best path over a word graph (survey: T1).

Every lexicon word found in a run of letters is an edge of the run's graph, its cost
``ln(total / count)`` (a unigram model, in thousandths); a character that no word covers is an
edge too, at the cost of half an occurrence. The cheapest path from the run's begin to its end
is its segmentation; of paths that cost the same the one with fewer words, then the one whose
first word is longer. Longest match, by contrast, takes the longest word wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys
from daybook.operators.text import cut_beside, tokens
from daybook.sources.session import checkpoint_dir

# Fixed value: thousandths of a nat are the unit of cost.
UNIT = 1000.0
# Longer runs are cut one at a time; edges of the others' graphs held at a time.
LONG_RUN, HELD = 64, 1 << 22


def lexicon_costs(lexicon: DataFrame) -> tuple[DataFrame, int]:
    """``(term, cost)`` of the different non-empty terms (``term, count``; counts of one term
    are summed, null ones and those below 1 count 1), and the cost of a character alone. The
    summed counts are checkpointed: the lexicon, often made from the whole corpus, is read once."""
    checkpoint_dir(lexicon.sparkSession)
    count = F.greatest(F.coalesce(F.col("count"), F.lit(1)), F.lit(1)).cast("long")
    lex = lexicon.select(F.col("term").cast("string").alias("term"), count.alias("count")).where("length(term) >= 1")
    lex = lex.groupBy("term").agg(F.sum("count").alias("count")).checkpoint()
    total = lex.agg(F.sum("count")).first()[0] or 1
    cost = F.round(F.log(F.lit(float(total)) / F.col("count")) * UNIT).cast("long")
    return lex.select("term", cost.alias("cost")), int(round(float(np.log(2.0 * total)) * UNIT))


def best_path(run: str, edges: list[list[tuple[int, int]]], alone: int) -> list[str]:
    """The words of the cheapest path; ``edges[i]``: (length, cost) of the words at ``i``."""
    n = len(run)
    cost, words, step = [0] * (n + 1), [0] * (n + 1), [1] * n
    for i in range(n - 1, -1, -1):
        least, fewest, longest = cost[i + 1] + alone, words[i + 1] + 1, 1
        for length, c in edges[i]:
            c += cost[i + length]
            if c <= least:
                w = words[i + length] + 1
                if c < least or w < fewest or (w == fewest and length > longest):
                    least, fewest, longest = c, w, length
        cost[i], words[i], step[i] = least, fewest, longest
    out, i = [], 0
    while i < n:
        out.append(run[i:i + step[i]])
        i += step[i]
    return out


class _Trie:
    """The words with their costs, also as steps ``(node, character) -> node``, sorted for a
    binary search."""

    def __init__(self, words: dict[str, int], longest: int):
        self.words, self.longest = words, longest
        letters = sorted({c for w in words for c in w})
        self.letters = np.array([ord(c) for c in letters], dtype=np.uint32)
        number, steps, costs = {c: i for i, c in enumerate(letters)}, {}, {}
        for word, cost in words.items():
            node = 0
            for c in word:
                node = steps.setdefault(node * len(letters) + number[c], len(steps) + 1)
            costs[node] = cost
        keys = np.fromiter(steps, dtype=np.int64, count=len(steps))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(steps.values(), dtype=np.int64, count=len(steps))[order]
        self.cost = np.full(len(steps) + 1, -1, dtype=np.int64)  # -1: no word ends here
        self.cost[list(costs)] = list(costs.values())

    def edges(self, run: str) -> list[list[tuple[int, int]]]:
        ends = [range(a + 1, min(a + self.longest, len(run)) + 1) for a in range(len(run))]
        return [[(b - a, self.words[run[a:b]]) for b in to if run[a:b] in self.words] for a, to in enumerate(ends)]

    def places(self, points: np.ndarray) -> np.ndarray:
        """Code points as places in the alphabet, -1 for those of no word."""
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, -1)

    def step(self, node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the nodes have a step by this character, and where it leads."""
        key = node * len(self.letters) + place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (place >= 0) & (self.keys[at] == key)
        return found, self.to[at[found]]


def best_paths(runs: list[str], known: _Trie, alone: int) -> list[list[str]]:
    """``best_path`` of each run by the words that stand in it. Runs of up to ``LONG_RUN``
    characters go through the path's recurrence together, ``HELD`` edges at a time."""
    short = sorted((i for i, run in enumerate(runs) if len(run) <= LONG_RUN), key=lambda i: -len(runs[i])) if known.words else []
    out: dict[int, list[str]] = {}
    before = np.cumsum([len(runs[i]) + 1 for i in short])
    start = 0
    while start < len(short):
        held = (before[start - 1] if start else 0) + HELD // known.longest
        part = short[start:max(start + 1, int(np.searchsorted(before, held, side="right")))]
        out.update(zip(part, _paths([runs[i] for i in part], known, alone)))
        start += len(part)
    return [out[i] if i in out else best_path(run, known.edges(run), alone) for i, run in enumerate(runs)]


def _paths(runs: list[str], known: _Trie, alone: int) -> list[list[str]]:
    """The same for runs in order of their length, longest first."""
    longest = known.longest
    whole = "".join(run + "\n" for run in runs)  # a run's end is a place too
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(run) for run in runs], dtype=np.int64)
    first = np.cumsum(size + 1) - size - 1
    end = np.repeat(first + size, size + 1)
    place = known.places(points)
    # edges[k][p]: the cost of the word of k + 1 characters at p, -1 for none
    edges = np.full((longest, len(points)), -1, dtype=np.int64)
    at = np.flatnonzero(end > np.arange(len(points)))
    node = np.zeros(len(at), dtype=np.int64)
    for k in range(longest):
        inside = at + k < end[at]
        at, node = at[inside], node[inside]
        found, node = known.step(node, place[at + k])
        at = at[found]
        edges[k, at] = known.cost[node]
    # cost, then number of words, in one number; a longer first word wins a tie
    unit = int(size[0]) + 1
    least, step = np.zeros(len(points), dtype=np.int64), np.ones(len(points), dtype=np.int64)
    for t in range(1, int(size[0]) + 1):
        p = (first + size)[:int(np.searchsorted(-size, -t, side="right"))] - t
        best, far = least[p + 1] + alone * unit + 1, np.ones(len(p), dtype=np.int64)
        for k in range(min(longest, t)):
            c = edges[k, p]
            other = least[p + k + 1] + c * unit + 1
            better = (c >= 0) & (other <= best)
            best, far = np.where(better, other, best), np.where(better, k + 1, far)
        least[p], step[p] = best, far
    begins = np.zeros(len(points), dtype=bool)
    p, last = first[size > 0], (first + size)[size > 0]
    while len(p):
        begins[p] = True
        p = p + step[p]
        p, last = p[p < last], last[p < last]
    a = np.flatnonzero(begins)
    pieces = [whole[i:j] for i, j in zip(a.tolist(), (a + step[a]).tolist())]
    ends = np.searchsorted(a, first + size).tolist()
    return [pieces[x:y] for x, y in zip([0, *ends], ends)]


def _wanted(w: Column, script: str) -> Column:
    return (F.length(w) >= 2) & F.regexp(w, F.lit(f"^(?:{script})+$"))


def segment_best(df: DataFrame, col: str, lexicon: DataFrame, out_col: str = "words", script: str = r"\p{IsHan}",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Letter runs as ``text.tokens`` makes them, and every run of ``script`` (of two
    characters or more) cut along its best path. ``lexicon``: ``term, count``. Null text
    gives []; every row is treated by itself, and other columns stay as they are.

    A lexicon of at most ``broadcast_bytes`` (measured) is sent to the tasks, and rows are cut
    where they lie, without a shuffle. A larger one is joined with the substrings of the
    different runs (common ones salted); each run's edges meet in its row, and the cut runs
    go back to the numbered rows. Either way the result is the same.
    """
    checkpoint_dir(df.sparkSession)
    costs, alone = lexicon_costs(lexicon)
    runs = F.coalesce(tokens(col, han_bigrams=False), F.array().cast("array<string>"))
    if measured_bytes(costs) <= broadcast_bytes:
        made: list[_Trie] = []  # a task makes it once

        def cut(runs: list[str], words: dict, longest: int) -> list[list[str]]:
            if not made:
                made.append(_Trie(words, longest))
            return best_paths(runs, made[0], alone)

        return cut_beside(df.withColumn("__runs", runs), "__runs", lambda w: _wanted(w, script), costs, cut, out_col)
    return _joined(df.withColumn("__runs", runs), costs, alone, script, out_col)


def _joined(df: DataFrame, costs: DataFrame, alone: int, script: str, out_col: str) -> DataFrame:
    rows = df.withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    hit = rows.select("__row", F.posexplode("__runs").alias("pos", "run"))
    runs = hit.where(_wanted(F.col("run"), script)).groupBy("run").agg(F.count(F.lit(1)).alias("uses")).checkpoint()
    most = costs.agg(F.coalesce(F.max(F.length("term")), F.lit(0))).first()[0]
    at = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("i"))
    at = at.where(F.lit(most) > 0).select("run", "i", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(most), F.length("run") - F.col("i") + 1)))).alias("n"))
    at = at.withColumn("term", F.substring("run", F.col("i"), F.col("n")))
    counts = at.groupBy("term").agg(F.count(F.lit(1)).alias("c"))
    edges = salted_join(at, costs, "term", top_hot_keys(counts, ["term"], "c"), "inner")
    edges = edges.groupBy("run").agg(F.collect_list(F.struct("i", "n", "cost")).alias("edges"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for run, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by: list[list[tuple[int, int]]] = [[] for _ in run]
                for e in found or ():
                    by[e["i"] - 1].append((e["n"], e["cost"]))
                out.append(best_path(run, by, alone))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["run", "seg"])

    cut = runs.select("run").join(edges, "run", "left").mapInArrow(work, "run string, seg array<string>")
    parts = salted_join(hit, cut, "run", top_hot_keys(runs, ["run"], "uses"), "left")
    parts = parts.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("seg", F.array("run")).alias("seg")))).alias("p"))
    made = parts.select("__row", F.flatten(F.transform("p", lambda p: p["seg"])).alias("__out"))
    out = rows.join(made, "__row", "left").withColumn(out_col, F.coalesce("__out", F.array().cast("array<string>")))
    return out.drop(*{"__row", "__runs", "__out"} - {out_col})
