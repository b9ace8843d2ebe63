import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from daybook.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    with open(A, "rb") as f:
        tokens = alignment.ByteBpe(f.read()).token
    return a, tokens, sentencepiece.SentencePieceProcessor(model_file=B)


def _ranges(ids, token):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(token[i]), i))
        at += len(token[i])
    return out


def _brute(rows, libraries):
    """By definition: every pair of tokens of a text compared, every end looked up."""
    a, token_a, b = libraries
    with open(B, "rb") as f:
        token_b = alignment.Pieces(f.read()).token
    parts, count = [], defaultdict(int)
    for _, text in rows:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(token_a[i] for i in x) != raw or b"".join(token_b[i] for i in y) != raw:
            parts.append(None)
            continue
        ra, rb = _ranges(x, token_a), _ranges(y, token_b)
        found, first = [], 0
        for s, e, i in ra:
            while rb[first][1] <= s:
                first += 1
            found += [(i, j) for s2, e2, j in rb[first:first + len(raw)] if s2 < e and e2 > s]
        cuts = sorted({e for _, e, _ in ra} & {e for _, e, _ in rb})
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in r if low <= s and e <= c) for r in (ra, rb)))
            low = c
        parts.append((len(x), len(y), len(cuts), found, ";".join(groups)))
        for p in set(found):
            count[p] += 1
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(k, 0, 0, 0, 0, 0, 0, "") if p is None else
            (k, p[0], p[1], p[2], len(p[3]), sum(count[q] == best[q[0]] for q in p[3]), sum(count[q] for q in p[3]), p[4])
            for (k, _), p in zip(rows, parts)]


TEXTS = ["", None, " ", "a", "two  spaces\n\n\tand tabs ", "▁already marked", "<s> </s> <unk> <|endoftext|> <0x41>", "Straße naïve façade",
         "日本語のテキスト 中文", "😀 emoji 👩‍👩‍👧", "x" * 300, "the the the the", "the the the the", "\x00nul", "don't we'll 123456 3.14", "ﬁ ligature Ａ",
         "é combining", "0123456789abcdef" * 50, "\r\n" * 20]


def test_alignment_equals_brute_force(spark, docs_of, sf_rows, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 400)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again"), (77, "again")]
    rows += [(1000 + i, t and t[:300]) for i, t in sf_rows[:25]]
    df = docs_of(rows).withColumnRenamed("th", "chunk").withColumnRenamed("hash", "pairs")
    got = [tuple(r) for r in alignment.align(df, A, B).collect()]
    assert sorted(got, key=repr) == sorted(_brute(rows, libraries), key=repr)
    hashed = {r.doc_id: r.groups for r in alignment.align(df.where("doc_id >= 1000"), A, B, hashed=True).collect()}
    assert hashed == {r[0]: r[7] and hashlib.sha256(r[7].encode()).hexdigest() for r in got if r[0] is not None and r[0] >= 1000}
    assert alignment.align(df.where("false"), A, B).count() == 0


def test_query_equals_brute_force(spark, tmp_path, docs_of, sf_rows, libraries):
    from daybook.llm.queries import QUERIES
    rows = sf_rows[:60] + [(5000, None), (5001, ""), (5002, sf_rows[0][1])]
    docs_of(rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
           for r in QUERIES["op11_token_alignment"](spark, str(tmp_path)).collect()]
    want = [(*r[:7], r[7] and hashlib.sha256(r[7].encode()).hexdigest()) for r in _brute(rows, libraries)]
    assert sorted(got) == sorted(want)


def test_ids_are_those_of_the_library(libraries, sf_rows):
    """The ranked form against the file's own merge list, on texts and on token soup."""
    a, token, _ = libraries
    with open(A, "rb") as f:
        spec = f.read()
    bpe = alignment.ByteBpe(spec)
    rng = np.random.default_rng(0)
    soup = [b"".join(token[i] for i in rng.integers(0, 50256, size=20)).decode(errors="replace") for _ in range(300)]
    texts = [t for _, t in sf_rows if t][:100] + soup + [t for t in TEXTS if t]
    assert bpe.encode(texts) == [e.ids for e in a.encode_batch(texts, add_special_tokens=False)]
    assert bpe._listed()(texts[:50]) == bpe.encode(texts[:50])
    # merges out of the order of their ids are left to the library
    import json
    other = json.loads(spec)
    other["model"]["merges"] = other["model"]["merges"][1:] + other["model"]["merges"][:1]
    odd = alignment.ByteBpe(json.dumps(other).encode())
    assert odd._ranked(other["model"]["vocab"], {"<|endoftext|>"}) is None


@pytest.mark.parametrize("seed", range(6))
def test_shared_cuts_are_the_common_ends(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        ea, eb, la, lb, base = [], [], [], [], 0
        for _ in range(int(rng.integers(1, 6))):
            size = int(rng.integers(1, 400))
            x, y = (np.unique(np.append(rng.integers(1, size + 1, size=int(rng.integers(0, max(1, size // d)) + 1)), size)) for d in rng.choice([1, 3, 40], 2))
            ea += (base + x).tolist()
            eb += (base + y).tolist()
            la.append(len(ea) - 1)
            lb.append(len(eb) - 1)
            base += size
        ea, eb = np.array(ea), np.array(eb)
        cut_a, cut_b = alignment.shared_cuts(ea, eb, np.array(la), np.array(lb))
        assert (cut_a == np.isin(ea, eb)).all() and (cut_b == np.isin(eb, ea)).all()
        i, j = alignment.links(ea, eb, cut_a, cut_b)
        sa, sb = np.concatenate(([0], ea[:-1])), np.concatenate(([0], eb[:-1]))
        want = np.argwhere((sa[:, None] < eb[None, :]) & (sb[None, :] < ea[:, None]))
        assert np.array_equal(np.column_stack((i, j)), want)


def test_shared_cuts_of_long_runs():
    """No inner cut over a long stretch, and cuts at one end only: few levels, no scan of
    the stretch for each of them."""
    n = 20_000
    ea, eb = np.append(np.arange(1, 2 * n, 2), 2 * n), np.append(np.arange(2, 2 * n, 2), 2 * n)
    cut_a, _ = alignment.shared_cuts(ea, eb, np.array([len(ea) - 1]), np.array([len(eb) - 1]))
    assert np.flatnonzero(cut_a).tolist() == [len(ea) - 1]
    empty = np.zeros(0, dtype=np.int64)
    assert all(len(x) == 0 for x in alignment.shared_cuts(empty, empty, empty, empty))
