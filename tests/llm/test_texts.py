"""Language, exact dedup, line dedup, near-dedup, mixing and token ids: edge cases and
brute force."""

import base64
import hashlib
import re
import struct
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.llm import byte_bpe, exact_dedup, language, line_dedup, minhash, mixing, shingles

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c d e"), (5, "A b  c d e"), (6, LONG), (7, LONG + " end"), (7, LONG + " end"),
         (8, "12 34 !!"), (None, "a b c d e"), (9, "x"), (10, "été ñandú 中文 \U0001f600")]


# ------------------------------------------------------------------ op1
def test_language_edges(docs_of, spark):
    train = [(i, ("the and of that with " if i % 2 else "der und ist nicht mit ") * 30) for i in range(1, 80)]
    df = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in train], "doc_id long, text string, lang string")
    model = language.fit(df)
    got = [tuple(r) for r in language.identify(docs_of(EDGES), model).collect()]
    assert len(got) == len(EDGES)
    by = {(r[0], r[1]): r[2] for r in got}
    for i in (1, 2, 3, 8):
        assert by[(i, "und")] == 0.0
    assert all(0.0 <= r[2] <= 1.0 and r[1] in ("en", "de", "und") for r in got)
    assert {r[1] for r in language.identify(df, model).collect()} == {"en", "de"}
    empty = docs_of([])
    assert language.fit(empty) is None and language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs_of(EDGES), None).collect()} == {"und"}
    kept = language.select(docs_of(EDGES), model)
    assert kept.columns == docs_of(EDGES).columns and kept.count() == len(EDGES) - 4


def test_selection_without_labels_keeps_texts(spark, docs_of):
    import corpus_pipeline
    docs = docs_of(EDGES).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, "").collect()
    want = [i for i, t in EDGES if t and any(c.isalpha() for c in t)]
    assert sorted(map(repr, (r.doc_id for r in kept))) == sorted(map(repr, want))
    assert all(r.lang is None for r in kept)


def test_selection_fills_null_languages(spark):
    import corpus_pipeline
    rows = [(i, ("the and of that with " if i % 2 else "der und ist nicht mit ") * 30, ("en" if i % 2 else "de") if i % 3 else None)
            for i in range(1, 80)]
    rows += [(200, "12 34", "en"), (201, "56", None), (202, "the and of that with " * 30, "x"), (None, "der und ist nicht mit " * 30, None),
             (3, rows[2][1], None), (3, rows[2][1], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.identify_language(spark, df, "")
    want = [(i, t, lang or ("en" if t.startswith("the") else "de")) for i, t, lang in rows if i not in (200, 201)]
    assert got.columns == df.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_language_held_out_accuracy(sf_docs):
    model = language.fit(sf_docs)
    out = language.identify(sf_docs, model).join(sf_docs.select("doc_id", "lang"), "doc_id")
    out = out.where(language.held_out()).where("lang is not null")
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert n >= 20 and right >= 0.95 * n


def test_training_ignores_held_out_rows(sf_docs):
    a = language.fit(sf_docs)
    b = language.fit(sf_docs.where(~language.held_out()))
    assert all((a.tables[w] == b.tables[w]).all() for w in language.WIDTHS)


# ------------------------------------------------------------------ op4
def _exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[ \t-\r]", "", t or "")].append((-len(t or ""), i is None, i if i is not None else 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("bits", [64, 5])
def test_exact_dedup(docs_of, bits):
    rows = EDGES + [(20, "ab cd"), (21, "a bcd  "), (22, "abcd"), (23, LONG.replace(" ", "\n")), (24, "x" * 20_000), (25, "x" * 20_001)]
    out = exact_dedup.exact_dedup(docs_of(rows), hash_bits=bits, min_chunk=4, max_chunk=64)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()), key=repr)
    want = _exact(rows)
    exp = []
    for i, t in rows:
        k = re.sub("[ \t-\r]", "", t or "")
        exp.append((i, *want[k], i == want[k][0], hashlib.sha256(k.encode()).hexdigest()))
    assert got == sorted(exp, key=repr)
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0


def test_chunks_follow_content(spark):
    body = "".join(chr(97 + int(x)) for x in np.random.default_rng(3).integers(0, 26, 20_000))
    df = spark.createDataFrame([(body,), ("zz" + body,)], "t string")
    a, b = (r[0] for r in df.select(exact_dedup.chunks(F.col("t"), 64, 1024)).collect())
    assert "".join(a) == body and "".join(b) == "zz" + body
    assert len(set(a) & set(b)) > len(a) // 2


# ------------------------------------------------------------------ op3
def _lines_brute(rows):
    seen, gone = [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        for k, line in enumerate((t or "").split("\n")):
            w = frozenset(x for x in re.split("[ \t\x0b\x0c\r]+", line.lower()) if x)
            if w:
                if any(5 * len(w & s) >= 4 * len(w | s) for s in seen):
                    gone.add((i, k))
                seen.append(w)
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_line_dedup(docs_of):
    base = [f"w{i}" for i in range(10)]
    rows = [(1, None), (2, ""), (3, " ".join(base) + "\nown line\n\n"), (4, "Own  LINE\n" + " ".join(base[:9])),
            (5, " ".join(base[:8]) + " other\nlast"), (6, " ".join(base[:8]) + "\n" + " ".join(reversed(base))), (None, "own line\tx"),
            (8, "\n".join(["own line"] * 5)), (9, LONG), (10, LONG.replace("word7 ", "changed ")), (11, "a b c d e\na b c d"), (12, "a b c")]
    got = line_dedup.line_dedup(docs_of(rows))
    assert {r.doc_id: r.text for r in got.collect()} == _lines_brute(rows)
    assert set(docs_of(rows).columns) | {"n_removed"} == set(got.columns)
    assert [r.n_removed for r in got.where("doc_id = 8").collect()] == [5]
    assert line_dedup.line_dedup(docs_of([])).count() == 0


def test_rows_given_twice_keep_their_lines(docs_of):
    got = line_dedup.line_dedup(docs_of([(1, "one two\nthree four"), (1, "one two\nthree four"), (2, "one two")]), counts=False)
    assert sorted(r.text for r in got.collect()) == ["", "one two\nthree four", "one two\nthree four"]


def test_line_dedup_random_sets(docs_of):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(40):
        lines = []
        for _ in range(4):
            start = int(rng.integers(0, 12))
            w = [f"t{start + j}" for j in range(int(rng.integers(3, 14)))]
            rng.shuffle(w)
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(docs_of(rows)).collect()}
    assert got == _lines_brute(rows)


def test_line_dedup_long_lines(docs_of):
    """Lines on both sides of the length from which the wide signature is used."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(30):
        lines = []
        for _ in range(3):
            size, base = int(rng.integers(55, 130)), int(rng.integers(0, 3)) * 40
            lines.append(" ".join(f"t{base + j}" for j in rng.permutation(int(size * 1.1))[:size]))
        rows.append((i, "\n".join(lines)))
    rows += rows[:5] + rows[:5]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(docs_of(rows)).collect()}
    want = _lines_brute(rows[:30])
    assert got == want and any(t == "" for t in want.values()) and any("\n" in t for t in want.values())


def test_line_dedup_cuts_each_line_once_a_pass(docs_of, monkeypatch):
    """No step cuts a line twice, as a pushed-down filter on its words did, and none splits
    the whole text again for each line that it takes from it."""
    plans, save = [], line_dedup.save
    monkeypatch.setattr(line_dedup, "save", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), save(df))[1])
    line_dedup.line_dedup(docs_of([(1, "a b c d e f\ng h"), (2, "a b c d e\ng h i j k")]))
    cuts = [p.count("xxhash64(lambda") for p in plans]
    assert max(cuts) == 1 and sum(cuts) == 2
    # the text is split once for a document, where its lines become rows
    assert all(p.count("split(lower") == p.count("explode(split(lower") for p in plans)


# ------------------------------------------------------------------ op7
def _near_brute(rows, percent=80):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    comp = {i: i for i, _ in rows if i is not None}
    change = True
    while change:
        change = False
        for a in range(len(rows)):
            for b in range(a):
                i, j = rows[a][0], rows[b][0]
                if i is None or j is None or not sets[a] or not sets[b]:
                    continue
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    change = True
    return [(i, len(s), None if i is None else comp[i], i is None or comp[i] == i) for (i, _), s in zip(rows, sets)]


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_near_dedup(docs_of, block_rows):
    rng = np.random.default_rng(1)
    rows = list(EDGES)
    for g in range(4):
        words = [f"g{g}w{int(x)}" for x in rng.integers(0, 5000, 120)]
        for c in range(9):
            w = list(words)
            for _ in range(int(rng.integers(0, 7))):
                w[int(rng.integers(0, len(w)))] = f"new{int(rng.integers(0, 10**6))}"
            rows.append((100 + 20 * g + c, " ".join(w)))
    got = [tuple(r) for r in minhash.near_dedup(docs_of(rows), block_rows=block_rows).collect()]
    assert sorted(got, key=repr) == sorted(_near_brute(rows), key=repr)
    assert minhash.near_dedup(docs_of([])).count() == 0


def test_shingle_sets_match_python():
    texts = ["", "a", "A b c", "a b c d", "x  y\tz\nw v a b c d a b c d", LONG[:5000], "é ñ é ñ é ñ"]
    for t, s in zip(texts, shingles.shingle_sets([t.encode() for t in texts])):
        w = t.encode().lower().split()
        want = len({tuple(w[k:k + 4]) for k in range(len(w) - 3)}) if len(w) >= 4 else int(bool(w))
        assert len(s) == want and (np.diff(s.astype(object)) > 0).all()
    a, b = shingles.shingle_sets([b"p q r s t u", b"zz p q r s t"])
    assert shingles.common(a, b) == 2


def test_min_max_values_agree_with_probability_j():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = np.unique(x[:900]), np.unique(x[100:])
    share = (minhash.signature(a, minhash._FINE) == minhash.signature(b, minhash._FINE)).mean()
    assert abs(share - 0.8) < 0.07


# ------------------------------------------------------------------ op10
def _targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        level = (sum(sizes.values()) - sum(most * sizes[s] for s in capped)) / sum(w[s] for s in free) if free else 0
        new = {s for s in free if level * w[s] > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in capped else level * w[s] for s in names}
        capped |= new


def test_mix(docs_of):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), s) for i, s in enumerate(["a", "b", "c", "d", None] * 60)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (1002, LONG, "b"), (1003, "tiny", "é"), (1003, "tiny", "é"), (None, "x y", "c")]
    df = docs_of(rows)
    kw = {"leaf_rows": 8, "fan_in": 3}
    got = [r for r in mixing.mix(df, **kw).collect()]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = _targets(dict(sizes)), defaultdict(int)
    src = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        s = src[r.doc_id]
        assert r.target == pytest.approx(want[s]) and r.source_size == sizes[s]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[s] += r.taken
    for s, t in want.items():
        longest = max((len((x or "").split()) for _, x, z in rows if z == s), default=0)
        assert abs(taken[s] - t) <= longest / 2 + 1e-6
    again = mixing.mix(df.repartition(7), **kw)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))
    assert mixing.mix(docs_of([])).count() == 0
    sample = mixing.sample(df, **kw)
    assert sample.columns == df.columns
    assert sample.where("doc_id is null or doc_id > 2000").count() in (0, 1, 2, 3)


def test_mix_expectation(docs_of):
    rows = [(i, " ".join(["w"] * (1 + i % 5)), "a" if i % 2 else "b") for i in range(60)]
    df = docs_of(rows, clash=False)
    n = 12
    total = defaultdict(int)
    for seed in range(n):
        for r in mixing.mix(df, weights=(1, 2), seed=seed).collect():
            total[r.doc_id] += r.copies
    p = {0: 0, 1: 0}
    for i, c in total.items():
        p[i % 2] += c
    assert p[1] / (30 * n) == pytest.approx(2 / 3, abs=0.12) and p[0] / (30 * n) == pytest.approx(4 / 3, abs=0.12)
    assert len({c for i, c in total.items() if i % 2}) > 2  # it is random


# ------------------------------------------------------------------ op6
def _tiktoken():
    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_tiktoken(docs_of, sf_rows):
    import public_tokenizers as P
    enc, path = _tiktoken(), P.path("byte_bpe_50k.tiktoken")
    rows = EDGES + [(50, "a" * 5000), (51, "<|endoftext|> it's I'LL"), (52, "ab" * 3000 + "é" * 500)] + [(i + 1000, t) for i, t in sf_rows]
    ids = byte_bpe.encode(docs_of(rows), path, P.PATTERN)
    out = byte_bpe.decode(ids, path).collect()
    assert len(out) == len(rows)
    want = defaultdict(list)
    for i, t in rows:
        w = enc.encode_ordinary(t or "")
        want[i].append((len(w), b"".join(struct.pack("<I", x) for x in w), (t or "").encode()))
    for r in out:
        assert (r.n_tokens, bytes(r.ids), bytes(r.decoded)) in want[r.doc_id]
    assert byte_bpe.encode(docs_of([]), path, P.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_bpe_merges_any_text(texts):
    import public_tokenizers as P
    global _enc, _vocabulary
    if "_enc" not in globals():
        _enc = _tiktoken()
        _vocabulary = byte_bpe.Vocabulary(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
    words = [t.encode("utf-8", "ignore") for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for x in _vocabulary.merge(words)]
    assert got == [_enc._encode_single_piece(w) if w else [] for w in words]


def test_rank_queue_orders_like_a_heap():
    q, rng = byte_bpe.RankQueue(50_256), np.random.default_rng(0)
    ranks = rng.integers(0, 50_256, 500).tolist()
    for p, r in enumerate(ranks):
        q.push(r, p)
    out = []
    while (r := q.first()) >= 0:
        out += [(r, p) for p in q.take(r)]
    assert out == sorted(out) and len(out) == 500


# ------------------------------------------------------------------ op1, more
def test_scorer_equals_the_convolution():
    """Every filter over every place by definition: a sum of table rows, its maximum, a
    rectifier and a softmax."""
    rng = np.random.default_rng(4)
    tables = {w: rng.normal(size=(w, 256, language.FILTERS)).astype(np.float32) for w in language.WIDTHS}
    model = language.Model(["a", "b", "c"], tables, rng.normal(size=(len(tables) * language.FILTERS, 3)).astype(np.float32),
                           rng.normal(size=3).astype(np.float32))
    x = rng.integers(0, 256, size=(5, language.WINDOW)).astype(np.uint8)
    got = language.Scorer(model).probabilities(x)
    for row, p in zip(x, got):
        hidden = []
        for w in language.WIDTHS:
            at = np.array([sum(tables[w][k][row[i + k]].astype(float) for k in range(w)) for i in range(len(row) - w + 1)])
            hidden.append(np.maximum(at.max(axis=0), 0))
        z = np.concatenate(hidden) @ model.weight.astype(float) + model.bias
        e = np.exp(z - z.max())
        assert np.allclose(p, e / e.sum(), atol=1e-4)


def test_number_signs_are_no_letters(spark, docs_of, sf_docs):
    model = language.fit(sf_docs)
    rows = [(1, "½"), (2, "²³ 12 ⅷ"), (3, "½ a"), (4, "٣"), (5, "ª"), (6, "日")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs_of(rows), model).collect()}
    want = {i: any(c.isalpha() for c in t) for i, t in rows}
    assert {i: v[0] != "und" for i, v in got.items()} == want and got[1] == ("und", 0.0)


def test_sample_bound_holds_for_repeated_ids(spark):
    from pyspark.sql import functions as F
    same = next(i for i in range(99) if __import__("zlib").crc32(str(i).encode()) % 5)
    for text in (F.concat(F.lit("text "), F.col("id").cast("string")), F.concat(F.lit("text "), (F.col("id") % 30).cast("string"))):
        df = spark.range(6000).select(F.lit(same).cast("long").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang"))
        seen = []
        train, language.train = language.train, lambda x, y, labels, seed=0: seen.append(np.bincount(y))
        try:
            language.fit(df, train_docs=50, train_windows=1)
        finally:
            language.train = train
        assert all(0 < n <= 50 for n in seen[0]) if "id) AS" in str(text) else all(n <= 50 for s in seen for n in s)
