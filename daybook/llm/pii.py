"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Four kinds of entity are recognised by their form: the base. These are the seeds. The words
before a seed, one and two of them, are its lexical patterns, and a pattern is as good as
the share of all its occurrences in the corpus, counted exactly, that are followed by an
instance of the kind.
Patterns and instances form a graph that is scored in rounds: patterns gain confidence from
their instances, and instances outside the base (tokens of a fitting shape that the forms
miss) from their patterns, which then count as instances themselves and induce patterns of
their own. It ends when a round accepts no further instance. Instances that reach a high
confidence are reported wherever they occur.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import drop, release, save, text_or_empty
from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys

# The base's kinds in order and their forms (possessive where no shorter match
# could help, and anchored so that a long run is tried once).
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What else may be an identifier: a token with @, or a run of digits and their punctuation.
CANDIDATE = (r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D]++"
             r"|(?<![0-9A-Za-z.@])[+(]?[0-9][0-9().:/-]*+(?:\x20[(]?[0-9][0-9().:/-]*+)*+(?![A-Za-z@])")
# Shapes by which a candidate can be an instance of a kind.
SHAPES = {
    "email": r"^[^@]+@[^@]*[0-9A-Za-z]",
    "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){2,4}$",
    "card": r"^([0-9][ -]?){11,18}[0-9]$",
    "phone": r"^[+(]?([0-9][ ().-]{0,3}){6,14}[0-9]$",
}
CONTEXT_CHARS = 64
# Least rounds of scoring; distinct instances a pattern needs; its least confidence; an instance's.
ROUNDS, SUPPORT, PATTERN_CONFIDENCE, CONFIDENCE = 3, 3, 0.2, 0.8


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp(p, F.lit("^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        digits = F.translate(m, " -", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def matches(text: Column, form: str) -> Column:
    """All leftmost non-overlapping matches: array of ``(left, text, start, end)``, where
    ``left`` is what stands before, back to the match before or ``CONTEXT_CHARS``; code
    points, end exclusive. What lies between matches and the matches themselves add up."""
    found, gaps = F.regexp_extract_all(text, F.lit(form), F.lit(0)), F.split(text, form, -1)
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("text"))
    empty = F.array().cast("array<struct<left:string,text:string,start:int,end:int>>")

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.length(p["text"])
        left = F.substring(p["gap"], -CONTEXT_CHARS, CONTEXT_CHARS)
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            left.alias("left"), p["text"].alias("text"), start.alias("start"), end.alias("end")))).alias("out"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda acc: acc["out"])


def _context(left: Column) -> Column:
    """The one and two words before a match, as patterns (absent ones left out)."""
    w = F.array_remove(F.split(F.lower(left), r"[\x20\x09-\x0D]+"), "")
    n = F.size(w)
    one = F.when(n >= 1, F.element_at(w, -1))
    two = F.when(n >= 2, F.concat_ws(" ", F.element_at(w, -2), F.element_at(w, -1)))
    return F.filter(F.array(one, two), lambda x: x.isNotNull())


def _entities(docs: DataFrame) -> DataFrame:
    """``(row, id, base, others)``: the base spans and the other candidates of each row."""
    text = F.col("text")
    has_digit, spans = F.regexp(text, F.lit("[0-9]")), []
    empty = F.array().cast("array<struct<left:string,text:string,start:int,end:int>>")
    guard = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": has_digit, "card": has_digit}
    for k, kind in enumerate(KINDS):
        found = F.filter(F.when(guard[kind], matches(text, FORMS[kind])).otherwise(empty), functools.partial(_ok, kind))
        spans.append(F.transform(found, functools.partial(_span, k)))
    others = F.when(has_digit | guard["email"], matches(text, CANDIDATE)).otherwise(empty)
    d = docs.select("id", F.sort_array(F.concat(*spans)).alias("base"), others.alias("others"))
    free = F.filter("others", lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))
    return d.select(F.monotonically_increasing_id().alias("row"), "id", "base", F.transform(free, _trimmed).alias("others"))


def _ok(kind: str, m: Column) -> Column:
    return _valid(kind, m["text"])


def _span(k: int, m: Column) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"),
                    F.lower(m["text"]).alias("value"), _context(m["left"]).alias("patterns"))


def _trimmed(o: Column) -> Column:
    head = F.length(o["text"]) - F.length(F.regexp_replace(o["text"], "^[^0-9A-Za-z+(]+", ""))
    value = F.regexp_replace(F.regexp_replace(o["text"], "^[^0-9A-Za-z+(]+", ""), "[^0-9A-Za-z)]+$", "")
    start = o["start"] + head
    return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.lower(value).alias("value"),
                    _context(o["left"]).alias("patterns"))


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern, total)``: how often each of the distinct ``patterns``, one or two whole
    words, occurs in all texts. Patterns that occur nowhere as whole words (the form begins
    inside a word) have no row."""
    w = F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), "")
    d = docs.select(w.alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))),
                       lambda a, b: F.concat_ws(" ", a, b))
    d = d.select(F.explode(F.concat("w", pairs)).alias("pattern"))
    total = F.count(F.lit(1)).alias("total")
    if measured_bytes(patterns) <= BROADCAST_BYTES:
        return d.join(F.broadcast(patterns), "pattern", "left_semi").groupBy("pattern").agg(total)
    # counted in each task first, so that a common word is one row a task
    return d.groupBy("pattern").agg(total).join(patterns, "pattern", "left_semi")


def _edges(entities: DataFrame) -> DataFrame:
    """``(kind, pattern, value, seed)``, a row for each time that a pattern stands before an
    instance: of the base, or (not ``seed``) of a candidate, for each kind that it fits."""
    seeds = entities.select(F.explode("base").alias("s")).select("s.kind", F.explode("s.patterns").alias("pattern"), "s.value")
    fits = F.filter(F.array(*[F.when(F.regexp("s.value", F.lit(SHAPES[k])), F.lit(i)) for i, k in enumerate(KINDS)]), lambda x: x.isNotNull())
    new = entities.select(F.explode("others").alias("s")).select(fits.alias("kinds"), "s.value", "s.patterns")
    new = new.select(F.explode("kinds").alias("kind"), "value", "patterns").select("kind", F.explode("patterns").alias("pattern"), "value")
    return seeds.withColumn("seed", F.lit(True)).unionByName(new.withColumn("seed", F.lit(False)))


def _graph(entities: DataFrame, docs: DataFrame) -> DataFrame:
    """``(kind, pattern, value, seed, n, seen, total)``: the edges of all patterns that can
    reach the support and the confidence of a pattern, were all their instances accepted."""
    edges = _edges(entities)
    each = edges.groupBy("kind", "pattern", "value", "seed").agg(F.count(F.lit(1)).alias("n"))
    patterns = each.groupBy("kind", "pattern").agg(F.sum("n").alias("seen"), F.count(F.lit(1)).alias("instances"))
    patterns = save(patterns.where(F.col("instances") >= SUPPORT))
    totals = _occurrences(docs, patterns.select("pattern").distinct())
    patterns = patterns.join(totals, "pattern", "left").withColumn("total", F.greatest("seen", F.coalesce("total", F.lit(0))))
    key = F.concat_ws(" ", F.col("kind").cast("string"), "pattern")
    patterns = save(patterns.where(F.col("seen") / F.col("total") >= PATTERN_CONFIDENCE)
                    .select(key.alias("key"), "seen", "total"))
    if measured_bytes(patterns) <= BROADCAST_BYTES:
        return edges.withColumn("key", key).join(F.broadcast(patterns), "key").groupBy(
            "kind", "pattern", "value", "seed", "seen", "total").agg(F.count(F.lit(1)).alias("n"))
    hot = top_hot_keys(patterns, ["key"], "seen")
    return salted_join(each.withColumn("key", key), patterns, "key", hot, "inner").drop("key")


def bootstrap(entities: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, value, confidence)`` of the instances outside the base that are accepted.

    After ``rounds`` rounds it goes on until a round accepts no further instance. Accepted
    instances give patterns support like seeds do, so patterns that no seed has come in.
    """
    edges = save(_graph(entities, docs))
    scores, accepted, done = None, 0, 0
    while True:
        e = edges.withColumn("c", F.col("seed").cast("double"))
        if scores is not None:
            e = edges.join(scores, ["kind", "value"], "left").withColumn(
                "c", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0))))
        patterns = e.groupBy("kind", "pattern").agg(
            F.sum(F.col("n") * F.col("c")).alias("mass"), F.count_if(F.col("c") >= CONFIDENCE).alias("support"),
            F.max("total").alias("total"))
        patterns = patterns.withColumn("p", F.col("mass") / F.col("total")).where(
            (F.col("support") >= SUPPORT) & (F.col("p") >= PATTERN_CONFIDENCE)).select("kind", "pattern", "p")
        # an instance is as sure as the chance that not all of its patterns err
        last, scores = scores, save(edges.where("not seed").join(patterns, ["kind", "pattern"]).groupBy("kind", "value")
                                    .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))))).alias("confidence")))
        if last is not None:
            drop(last)
        before, done = accepted, done + 1
        scored, accepted = scores.agg(F.count(F.lit(1)), F.count_if(F.col("confidence") >= CONFIDENCE)).first()
        if not scored or (done >= rounds and accepted == before):
            break
    return scores.where(F.col("confidence") >= CONFIDENCE)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``id_col, base, found``, both arrays of ``(start, kind, end)``
    in code points (end exclusive; ``kind`` an index of ``KINDS``), sorted by start, kind.

    ``base`` holds what the forms match: leftmost, non-overlapping within a kind, less the
    matches that fail their kind's test (ip parts at most 255, card of 14 to 19 digits that
    pass Luhn's check, phone of 10 to 15 digits). ``found`` holds the further instances.

    * null text counts as empty: no spans; the whole text is read, however long;
    * repeated ids and rows are documents of their own, null ids stay; an empty table gives
      no rows; other columns are neither read nor returned;
    * without seeds there are no patterns, and nothing is found beyond the base.
    """
    d = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    entities = save(_entities(d))
    release(d.sparkSession)
    accepted = bootstrap(entities, d, rounds)
    others = entities.select("row", F.explode("others").alias("o")).select("row", "o.start", "o.end", "o.value")
    hits = others.join(accepted.select("kind", "value"), "value").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return (entities.select("row", "id", base.alias("base")).join(hits, "row", "left")
            .select(F.col("id").alias(id_col), "base", F.coalesce("found", none).alias("found")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
