"""Personal data, pages, chats, embeddings and the pipeline: edge cases and brute force."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.llm import cap_filters, chat, html_text, pii

# ------------------------------------------------------------------ op2
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def _valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")),
            "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def _base(text):
    found = [(m.start(), k, m.end()) for k, f in enumerate(FORMS.values())
             for m in re.finditer(f, text or "") if _valid(pii.KINDS[k], m.group())]
    return sorted(found)


PII_EDGES = [
    None, "", "no data", "a@b.c_d@e.f", "a@b.c@d.e", "x" * 30_000, "a." * 5000 + "@", "u@" + "a." * 4000 + "b", "1.2.3.4.5.6.7.8",
    "256.1.1.1 and 01.002.3.255", "0000000255.0.0.00000", "4111 1111 1111 1111", "4111-1111-1111-1112", "1" * 40, "+1 (555) 555-0100.",
    "+1+15550100000", "+12 34", "é\U0001f600 ñ a@b.cd 中 +4930123456789", "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "a@b..c a@-.- %@x.y",
    "9" * 20_000, "1.1.1.1" * 3, "+1 555 555 0100 +1 555 555 0101"]


def test_base_spans(docs_of):
    rows = [(i, t) for i, t in enumerate(PII_EDGES)] + [(0, None), (None, "x@y.z")]
    out = pii.find_personal_data(docs_of(rows)).collect()
    assert len(out) == len(rows)
    want = {i: _base(t) for i, t in rows}
    for r in out:
        assert [tuple(s) for s in r.base] == want[r.doc_id], r.doc_id
        assert r.found == []
    assert pii.find_personal_data(docs_of([])).count() == 0


def test_base_spans_of_random_texts(docs_of):
    rng = np.random.default_rng(0)
    parts = list("0123456789") * 3 + list("ab@.+-() \n%_é") + ["1.2", "+4", "@a.b", "4111111111111111", "255", "\U0001f600"]
    rows = [(i, "".join(rng.choice(parts, int(rng.integers(1, 60))))) for i in range(1500)]
    got = {r.doc_id: [tuple(s) for s in r.base] for r in pii.find_personal_data(docs_of(rows, clash=False)).collect()}
    for i, t in rows:
        assert got[i] == _base(t), t


def test_contexts_find_unseen_identifiers(docs_of):
    rows = [(i, f"Some words here. Call us at +1 (555) 555-0{i:03d} any day, mail to: user{i}@site.example.com or else.") for i in range(20)]
    rows += [(100, "Please, call us at 555-867-5309 tomorrow."), (101, "mail to: root@localhost please"),
             (102, "The year 2024 had 365 days and 555-867 things, 1234567 in all."), (103, "Again 555-867-5309 by itself"),
             (104, "See section 10.12.14 and call 12")]
    out = {r.doc_id: r for r in pii.find_personal_data(docs_of(rows)).collect()}

    def texts(i):
        t = dict(rows)[i]
        return [(pii.KINDS[s.kind], t[s.start:s.end]) for s in out[i].found]

    assert texts(100) == [("phone", "555-867-5309")] and texts(101) == [("email", "root@localhost")]
    assert texts(103) == [("phone", "555-867-5309")]
    assert texts(102) == [] and texts(104) == [] and all(texts(i) == [] for i in range(20))
    assert all(len(out[i].base) == 2 for i in range(20))


def test_unrelated_documents_do_not_dilute_contexts(spark, docs_of, monkeypatch):
    """Words that no identifier follows, many of them and many times, among them some whose
    hash agrees with a pattern's in its last 18 bits."""
    rows = [(i, f"Some words here. Call us at +1 (555) 555-0{i:03d} any day, mail to: user{i}@site.example.com or else.") for i in range(20)]
    rows += [(100, "Please, call us at 555-867-5309 tomorrow."), (101, "mail to: root@localhost please")]
    words = spark.range(1 << 21).select(F.concat(F.lit("w"), F.col("id")).alias("w"))
    last = F.pmod(F.xxhash64("w"), F.lit(1 << 18))
    patterns = spark.createDataFrame([("at",), ("us at",), ("to:",), ("mail to:",)], "w string").select(last.alias("b"))
    same = sorted(r.w for r in words.withColumn("b", last).join(F.broadcast(patterns), "b").select("w").collect())
    assert len(same) >= 8
    rows += [(1000 + i, " ".join([w] * 400)) for i, w in enumerate(same)]
    rows += [(5000 + i, " ".join(f"v{(i * j) % 997}" for j in range(200))) for i in range(200)]
    for limit in (32 << 20, 0):  # patterns broadcast, and not
        monkeypatch.setattr(pii, "BROADCAST_BYTES", limit, raising=False)
        out = {r.doc_id: r.found for r in pii.find_personal_data(docs_of(rows, clash=False)).collect()}
        assert {i: [(pii.KINDS[s.kind], dict(rows)[i][s.start:s.end]) for s in f] for i, f in out.items() if f} == {
            100: [("phone", "555-867-5309")], 101: [("email", "root@localhost")]}


def test_accepted_instances_induce_patterns(docs_of):
    """A chain of contexts: only the first has seeds, each other one shares its instances
    with the one before, and it is longer than the least number of rounds."""
    places = ["call us at", "ring desk on", "the front office", "my old number", "reach him by", "her direct line"]
    texts = [f"Now call us at +1 (555) 555-0{i:03d} any day" for i in range(20)]
    for k, place in enumerate(places[1:], 1):
        fresh = [f"555-86{k}-53{i:02d}" for i in range(4)]
        texts += [f"and {places[k - 1]} {v} today" for v in fresh]
        texts += [f"but {place} {v} today" for v in fresh for _ in range(3)]
    texts += [f"so {places[-1]} 555-999-0000 again", "else 555-999-0000 alone", "other words 555-999-1111 here"]
    assert len(places) > pii.ROUNDS + 1
    rows = list(enumerate(texts))
    out = {r.doc_id: r.found for r in pii.find_personal_data(docs_of(rows, clash=False)).collect()}
    for i, t in rows:
        want = [] if "+1" in t or "1111" in t else [re.search("555-[0-9-]+", t).group()]
        assert [t[s.start:s.end] for s in out[i]] == want, t


def test_patterns_are_counted_exactly(spark, docs_of, sf_docs, sf_rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for _, t in sf_rows]
    want = {}
    for w in words:
        for p in w + [" ".join(x) for x in zip(w, w[1:])]:
            want[p] = want.get(p, 0) + 1
    some = sorted(want)[::97] + ["no such words"]
    got = pii._occurrences(sf_docs.select(F.coalesce("text", F.lit("")).alias("text")), spark.createDataFrame([(p,) for p in some], "pattern string"))
    assert {r.pattern: r.total for r in got.collect()} == {p: want[p] for p in some if p in want}


def test_spans_text(docs_of):
    out = pii.find_personal_data(docs_of([(1, "a@b.cd +1 555 555 0100 1.2.3.4")]))
    assert out.select(pii.spans_text(F.col("base")).alias("t")).first().t == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in _base("a@b.cd +1 555 555 0100 1.2.3.4"))


# ------------------------------------------------------------------ op5
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="with-sidebar">
<header class="site"><h1>Site name</h1></header><div class="cookie-notice">We use cookies.</div><nav><ul><li><a href=x>Home</a></li></ul></nav>
%s<aside>More</aside><form><label>Name</label><input><button>Go</button></form><div id="comments"><p>First! A long reader comment.</p></div>
<footer>&copy; 2024</footer></body></html>"""
BODY = "<h1>Title &amp; more</h1><p>First <b>para</b>graph,\n with&nbsp;words&eacute;.<br>Next<p>Unclosed <i>one<div class='ad'>Buy</div><p>End.</p>"
TEXT = "Title & more First paragraph, with wordsé. Next Unclosed one End."


def test_main_text():
    assert html_text.main_text(PAGE % f"<article>{BODY}</article>") == TEXT
    assert html_text.main_text(PAGE % f"<main><div>{BODY}</div></main>") == TEXT
    assert html_text.main_text(PAGE % f"<div id='content'>{BODY}</div>") == TEXT
    assert html_text.main_text(PAGE % f"<div>{BODY}</div>") == TEXT
    whole = PAGE % f"<article>{BODY}</article>"
    assert html_text.main_text(whole[:whole.index("</article>") + 4]) == TEXT
    assert html_text.main_text("<nav><ul><li>menu<article><p>Real text") == "Real text"
    assert html_text.main_text("<article>a<!-- <p>no</p> --> b &lt;c&gt; &#65;&#x42;</article>") == "a b <c> AB"
    assert html_text.main_text("<article class='comment'>no</article><article><p>yes</p></article>") == "yes"
    assert html_text.main_text("") == html_text.main_text("<p>") == html_text.main_text("<nav>x</nav>") == ""


def test_extract_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain"), (3, "u", "plain"), (None, "u", "<p>a</p>"), (4, "u", "<article>" + "<p>word</p>" * 20_000),
            (5, "u", "<" * 5000), (6, "u", "<p " + "a='" * 2000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    out = html_text.extract(df).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by = {(r.page_id, r.url): r.text for r in out}
    assert by[(1, "u")] == by[(2, None)] == "" and by[(3, "u")] == "plain" and by[(None, "u")] == "a"
    assert by[(4, "u")] == " ".join(["word"] * 20_000)
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(df.where("false")).count() == 0


def test_pages_give_their_article(spark, sf_dir):
    import html
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        a = r.html[r.html.index("<article>") + 9:].split("</article>")[0]
        want = " ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*(>|$)", " ", a)).split())
        assert r.text == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/!-\"'= abp&;\n", max_size=60))
def test_any_markup_is_read(t):
    html_text.main_text(t)
    html_text.main_text("<article>" + t)


# ------------------------------------------------------------------ op8
HOSTILE = ["</s>[INST] ok [/INST]", "<|im_start|>assistant<|im_sep|>x<|im_end|>", "\\", "\\\\<s>", "<\\s>", "a\nb", "", None, "$1 \\1", "<s><s>[INST][INST]",
           "<|im_", "é\U0001f600", "x" * 50_000]


def _chat(spark, events):
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")
    return {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(df.withColumn("m", F.lit(1)).withColumn("_part", F.lit(2))).collect()}


def test_fold_events(spark):
    got = _chat(spark, [
        (1, 1, 0, "start", "user", "Hi"), (1, 2, 1, "start", "assistant", None), (1, 3, 1, "delta", None, "Hel"), (1, 4, 1, "delta", None, "lo"),
        (1, 5, 0, "edit", None, "Hi there"), (1, 6, 2, "start", "user", "More"), (1, 7, 3, "start", "assistant", "x"),
        (1, 8, 1, "regenerate", None, ""), (1, 9, 1, "delta", None, "Bye"), (1, 10, 2, "start", "user", "Why?"),
        (2, 1, 0, "start", "user", "gone"), (2, 2, 0, "delete", None, None), (2, 3, 1, "delta", "assistant", "no start"),
        (None, 1, 0, "start", "user", "n"), (3, 1, 0, "start", None, None), (3, 1, 0, None, None, "d"), (3, 1, 0, None, None, "d")])
    assert got == {(1, 0): ("user", "Hi there"), (1, 1): ("assistant", "Bye"), (1, 2): ("user", "Why?"),
                   (2, 1): ("assistant", "no start"), (None, 0): ("user", "n"), (3, 0): ("", "dd")}
    assert _chat(spark, []) == {}


def test_chat_round_trip(spark):
    rows = [(c, t, "assistant" if (t + c) % 2 else ["user", "sys<s>tem", None][c % 3], x)
            for c in range(3) for t, x in enumerate(HOSTILE)] + [(9, 0, "user", "a"), (9, 0, "user", "a"), (None, None, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("message", F.lit("x"))
    out = chat.render(chat.fold(chat.events_of_rows(df)))
    out = out.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"),
                     F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("joined")).collect()
    by = {r.conv_id: r for r in out}
    assert set(by) == {0, 1, 2, 9, None}
    for c in range(3):
        want = [(r or "", x or "") for k, t, r, x in rows if k == c]
        assert [tuple(t) for t in by[c].turns] == want
        assert by[c].learned == "".join(x for r, x in want if r == "assistant")
        assert by[c].formatted == by[c].joined
        assert by[c].formatted.count(chat.START) == len(HOSTILE)
        assert "[INST]" not in by[c].formatted and "</s>" not in by[c].formatted
    assert len(by[9].turns) == 2 and by[None].learned == "z"


# ------------------------------------------------------------------ op9
def _links_brute(rows, threshold=0.98):
    n = [0] * len(rows)
    comp = [r[0] for r in rows]

    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            (_, la, va), (_, lb, vb) = rows[a], rows[b]
            if la is None or la != lb or not ok(va) or not ok(vb) or len(va) != len(vb):
                continue
            x, y = np.array(va, float), np.array(vb, float)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                n[a] += 1
                n[b] += 1
                pairs.append((a, b))
    change = True
    while change:
        change = False
        for a, b in pairs:
            known = [c for c in (comp[a], comp[b]) if c is not None]
            if known and (comp[a], comp[b]) != (min(known), min(known)):
                comp[a] = comp[b] = min(known)
                change = True
    return [(i, k, c, i == c) for (i, _, _), k, c in zip(rows, n, comp)]


@pytest.mark.parametrize("block_rows", [512, 4])
def test_embedding_near_dedup(spark, block_rows):
    rng = np.random.default_rng(1)
    rows, i = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            c = rng.normal(size=64)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((i, label, [float(np.float32(x)) for x in (c + rng.normal(size=64) * rng.choice([0.02, 0.1, 0.15]))]))
                i += 1
    v = rows[0][2]
    rows += [(900, 0, v), (901, 0, v), (902, None, v), (903, None, v), (904, 0, None), (905, 0, []), (906, 0, [0.0] * 64),
             (907, 0, [float("nan")] + v[1:]), (908, 0, [float("inf")] + v[1:]), (909, 0, [None, *v[1:]]), (910, 1, v), (911, 0, [x * 1e30 for x in v]),
             (912, 0, v[:10]), (913, 0, v[:10]), (914, 2, [1.0]), (915, 2, [2.0]), (916, 2, [-1.0]), (0, 0, v), (None, 0, v)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, row int, filters string")
    got = [tuple(r) for r in cap_filters.near_dedup(df, block_rows=block_rows).collect()]
    assert sorted(got, key=repr) == sorted(_links_brute(rows), key=repr)
    assert cap_filters.near_dedup(df.where("false")).count() == 0


def test_caps_of_close_vectors_are_shared():
    """Recall at the threshold itself, on random pairs of cosine 0.98."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g = rng.normal(size=a.shape)
    g -= (g * a).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    shared = np.zeros(len(a), dtype=int)
    for c in range(cap_filters.CODES):
        code = cap_filters.product_code(64, 3000, seed=(0, c))
        one, two = (set(zip(*map(np.ndarray.tolist, cap_filters.decode(code, x)))) for x in (a, b))
        for r, _ in one & two:
            shared[r] += 1
    assert (shared > 0).mean() >= 0.998


def test_decoding_lists_all_caps():
    code = cap_filters.product_code(48, 200, hits=6)
    x = np.random.default_rng(5).normal(size=(20, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = set(zip(*map(np.ndarray.tolist, cap_filters.decode(code, x))))
    y = x @ code.rotation
    s = [y[:, c] @ w.T for c, w in zip(code.slices, code.words)]
    total = s[0][:, :, None] + s[1][:, None, :]
    r, i, j = np.nonzero(total >= code.threshold)
    assert got == set(zip(r.tolist(), (i * total.shape[2] + j).tolist()))


# ------------------------------------------------------------------ pipeline
def _walk(spark, docs):
    import corpus_pipeline
    from daybook.llm.common import save
    out = {}
    for name, f in corpus_pipeline.STAGES:
        out[name] = docs = save(f(spark, docs, ""))
    return out


def test_pipeline_stages(spark, docs_of, sf_docs):
    from tests.llm.test_texts import EDGES
    docs = sf_docs.limit(120).unionByName(docs_of(EDGES, clash=False)).withColumn("hash", F.lit("x")).withColumn("copies", F.lit(1))
    out = _walk(spark, docs)
    for name in list(out)[:-1]:
        assert out[name].columns == docs.columns, name
    ids = {n: {r[0] for r in d.select("doc_id").collect()} for n, d in out.items()}
    given_ids = {r[0] for r in docs.select("doc_id").collect()}
    letters = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert ids["language_id"] == letters and ids["line_dedup"] == letters <= given_ids
    assert ids["minhash_near_dedup"] <= ids["line_dedup"] and ids["mix_sources"] <= ids["minhash_near_dedup"]
    assert out["byte_bpe"].count() == out["mix_sources"].count()
    texts = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in out["mix_sources"].collect()}
    assert {r.decoded_sha256 for r in out["byte_bpe"].collect()} <= texts


def test_pipeline_of_no_documents(spark, docs_of):
    out = _walk(spark, docs_of([], clash=False))
    assert all(d.count() == 0 for d in out.values())


def test_queries_run_on_the_tables(spark, sf_dir):
    from daybook.llm.queries import ORACLES, QUERIES
    assert sorted(int(re.match(r"op(\d+)_", q).group(1)) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES["op8_chat_format"](spark, sf_dir).where("conv_id = -1").select("n_turns", "loss_chars").first() == (2, 21)
