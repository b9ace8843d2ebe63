"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both token sequences of a text end at byte offsets. In an interval of tokens that covers the
same bytes on both sides, a common end near the middle is located by bisection: from the
middle token's end leap to the first end at or after it on the other side, and back, until
the two agree (or the same way to the left). The interval is cut there and both halves are
treated alike; an interval without an inner common end is a leaf, a group. All intervals of
a stretch of documents go through each level together, as arrays.

Documents are read once, in chunks. A chunk keeps its different id pairs, with the number of
its documents that hold each; these lists, not the documents, are shuffled for the corpus
counts, and each chunk gets the counts of its own list back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import per_worker, save
from daybook.operators.joins import salted_join, top_hot_keys

# Characters of text that make a chunk (a longer text is one by itself).
CHUNK_CHARS = 2_000_000


class ByteBpe:
    """Byte-level BPE from a ``tokenizers`` JSON file: ids of a text, and each id's bytes.

    Where the merges stand in the order of their ids and every token encodes to itself,
    merging the adjacent pair with the lowest id gives the same ids as the file's merge
    list: before a token's merge, its text can only stand as that merge's two halves. Then
    ``tiktoken`` does it, several times faster; else the ``tokenizers`` library itself.
    """

    # Fixed value: the split pattern that the format's ByteLevel step stands for.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, spec: bytes):
        self.spec = json.loads(spec)
        vocab = self.spec["model"]["vocab"]
        # the format writes each byte as a character: printable ones as themselves, the
        # others as the characters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        self.token = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in self.spec["added_tokens"])]))
        special = {t["content"] for t in self.spec["added_tokens"]}
        for t, i in vocab.items():
            self.token[i] = t.encode() if t in special else bytes(map(byte.__getitem__, t))
        for t in self.spec["added_tokens"]:
            self.token[t["id"]] = t["content"].encode()
        self.encode = self._ranked(vocab, special) or self._listed()

    def _ranked(self, vocab: dict, special: set):
        import tiktoken
        from tokenizers import Tokenizer

        s, model = self.spec, self.spec["model"]
        split = s["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and s["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
                 and not split.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges"))
        if not plain:
            return None
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        bare = Tokenizer.from_str(json.dumps(s | {"pre_tokenizer": None, "added_tokens": []}))
        names = [t for t in vocab if t not in special]
        itself = all(e.ids == [vocab[t]] for t, e in zip(names, bare.encode_batch(names, add_special_tokens=False)))
        if not itself or any(a >= b for a, b in zip(made, made[1:])):
            return None
        ranks = {self.token[vocab[t]]: vocab[t] for t in names}
        one = tiktoken.Encoding("json", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: [one(t) for t in texts]

    def _listed(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(json.dumps(self.spec))
        t.encode_special_tokens = True
        return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model with byte fallback: ids of a text, and each id's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [(i, p.id_to_piece(i)) for i in range(p.get_piece_size())]
        self.token = [bytes([int(t[3:-1], 16)]) if p.is_byte(i) else t.replace("▁", " ").encode() for i, t in names]
        self.encode = lambda texts: p.encode(texts, num_threads=1) if texts else []


def shared_cuts(ea: np.ndarray, eb: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the ascending ends ``ea`` and ``eb`` are common to both, as two masks, by
    divide and conquer. ``last_a, last_b``: the positions of each text's last end, where
    both sides agree."""
    cut_a, cut_b = np.zeros(len(ea), dtype=bool), np.zeros(len(eb), dtype=bool)
    cut_a[last_a] = cut_b[last_b] = True
    a0, b0 = (np.concatenate(([0], x[:-1] + 1)) if len(x) else x for x in (last_a, last_b))
    a1, b1 = last_a + 1, last_b + 1
    while True:
        inner = (a1 - a0 > 1) & (b1 - b0 > 1)  # an end of one token alone leaves nothing to cut
        a0, a1, b0, b1 = a0[inner], a1[inner], b0[inner], b1[inner]
        if not len(a0):
            return cut_a, cut_b
        mid = (a0 + a1 - 1) >> 1
        at_a, at_b = mid.copy(), np.zeros_like(mid)
        todo = np.arange(len(mid))
        while len(todo):  # to the right; the interval's own end stops it
            x = ea[at_a[todo]]
            j = np.searchsorted(eb, x)
            at_b[todo] = j
            todo, j = todo[eb[j] != x], j[eb[j] != x]
            y = eb[j]
            i = np.searchsorted(ea, y)
            at_a[todo] = i
            todo = todo[ea[i] != y]
        found = at_a < a1 - 1
        todo = np.flatnonzero(~found & (mid > a0))
        at_a[todo] = mid[todo] - 1
        while len(todo):  # to the left, down to the interval's begin
            x = ea[at_a[todo]]
            j = np.searchsorted(eb, x, side="right") - 1
            on = j >= b0[todo]
            todo, j, x = todo[on], j[on], x[on]
            at_b[todo] = j
            hit = eb[j] == x
            found[todo[hit]] = True
            todo, y = todo[~hit], eb[j[~hit]]
            i = np.searchsorted(ea, y, side="right") - 1
            on = i >= a0[todo]
            todo, i, y = todo[on], i[on], y[on]
            at_a[todo] = i
            hit = ea[i] == y
            found[todo[hit]] = True
            todo = todo[~hit]
        i, j = at_a[found], at_b[found]
        cut_a[i] = cut_b[j] = True
        a0, a1, b0, b1 = (np.column_stack(x).ravel() for x in ((a0[found], i + 1), (i + 1, a1[found]), (b0[found], j + 1), (j + 1, b1[found])))


def links(ea: np.ndarray, eb: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of tokens whose byte ranges overlap, in order: one for each
    stretch between neighbouring ends of either side."""
    only_b = ~cut_b
    ends = np.concatenate((ea, eb[only_b]))
    order = np.argsort(ends, kind="stable")
    in_a = (np.arange(len(ends)) < len(ea))[order]
    in_b = np.concatenate((cut_a, np.ones(int(only_b.sum()), dtype=bool)))[order]
    return np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b


class Aligner:
    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteBpe(a), Pieces(b)
        self.len_a, self.len_b = (np.array([len(t) for t in x.token], dtype=np.int64) for x in (self.a, self.b))
        self.flat = [(np.frombuffer(b"".join(x.token), dtype=np.uint8), np.cumsum(n) - n) for x, n in ((self.a, self.len_a), (self.b, self.len_b))]
        n = max(len(self.a.token), len(self.b.token))
        self.width = n
        self.shown = [f"{i}{sep}" for sep in (",", "|", ";", "") for i in range(n)]

    def _joined(self, one: list, two: list) -> tuple[np.ndarray, ...]:
        """Ids and numbers of tokens of both sides, and where each token ends."""
        na, nb = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (one, two))
        ia, ib = (np.fromiter(chain.from_iterable(x), dtype=np.int64, count=int(c.sum())) for x, c in ((one, na), (two, nb)))
        return ia, ib, na, nb, np.cumsum(self.len_a[ia]), np.cumsum(self.len_b[ib])

    def _bytes(self, side: int, ids: np.ndarray, ends: np.ndarray) -> bytes:
        flat, start = self.flat[side]
        n = (self.len_a, self.len_b)[side][ids]
        return flat[np.repeat(start[ids] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()

    def chunk(self, texts: list[str | None], hashed: bool) -> dict:
        """Of a chunk's texts: counts and groups of each, its id pairs (``pairs``, and
        ``docs``, how many texts hold each) and each text's ``own`` links as (index of the
        pair, times)."""
        n = len(texts)
        full = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in full]
        one, two = self.a.encode(spaced), self.b.encode([texts[k] for k in full])
        raw = [t.encode() for t in spaced]
        tok_a, tok_b = self.a.token.__getitem__, self.b.token.__getitem__
        ia, ib, na, nb, ea, eb = self._joined(one, two)
        whole, sizes = b"".join(raw), list(map(len, raw))
        sides = ((0, ia, na, ea), (1, ib, nb, eb))
        if any(np.diff(np.append(0, e)[np.append(0, np.cumsum(n))]).tolist() != sizes or self._bytes(k, i, e) != whole for k, i, n, e in sides):
            same = [b"".join(map(tok_a, x)) == r == b"".join(map(tok_b, y)) for x, y, r in zip(one, two, raw)]
            full, one, two = ([v for v, ok in zip(x, same) if ok] for x in (full, one, two))
            ia, ib, na, nb, ea, eb = self._joined(one, two)
        del one, two, raw, spaced, whole, sides
        last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
        cut_a, cut_b = shared_cuts(ea, eb, last_a, last_b)

        out = {k: np.zeros(n, dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        at = np.array(full, dtype=np.int64)
        text_a = np.repeat(np.arange(len(full)), na)
        out["n_a"][at], out["n_b"][at] = na, nb
        out["n_groups"][at] = np.bincount(text_a[cut_a], minlength=len(full))
        out["n_links"][at] = na + nb - out["n_groups"][at]

        pa_, pb_ = links(ea, eb, cut_a, cut_b)
        pairs, which = np.unique(ia[pa_] * len(self.len_b) + ib[pb_], return_inverse=True)
        own, times = np.unique(text_a[pa_] * max(1, len(pairs)) + which, return_counts=True)
        owner, own = own // max(1, len(pairs)), (own % max(1, len(pairs))).astype("<i4")
        edge = np.searchsorted(owner, np.arange(len(full) + 1))
        out["own"] = [b""] * n
        for k, s, e in zip(full, edge, edge[1:]):
            out["own"][k] = own[s:e].tobytes() + times[s:e].astype("<i4").tobytes()
        out["pairs"], out["docs"] = pairs, np.bincount(own, minlength=len(pairs))

        # tokens in the order in which the groups name them: a group's A ids, then its B ids
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        first_b = np.concatenate(([0], np.flatnonzero(cut_b) + 1))
        after_a = np.flatnonzero(cut_a) + 1
        code = np.empty(len(ia) + len(ib), dtype=np.int64)
        code[np.arange(len(ia)) + first_b[group_a]] = ia + np.where(cut_a, self.width, 0)
        ends_b = np.where(cut_b, 2 * self.width, 0)
        ends_b[last_b] = 3 * self.width
        code[np.arange(len(ib)) + after_a[group_b]] = ib + ends_b
        out["groups"] = [""] * n
        stop = np.cumsum(na + nb)
        for k, s, e in zip(full, stop - na - nb, stop):
            told = "".join(map(self.shown.__getitem__, code[s:e].tolist()))
            out["groups"][k] = hashlib.sha256(told.encode()).hexdigest() if hashed else told
        return out


def _chunker(a: bytes, b: bytes, hashed: bool):
    key = "aligner:" + hashlib.sha256(a + b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(key, lambda: Aligner(a, b))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start = 0
            while start < batch.num_rows:
                part, chars, stop = [], 0, start
                while stop < batch.num_rows and (chars < CHUNK_CHARS or stop == start):
                    part.append(texts[stop].as_py())
                    chars += len(part[-1] or "")
                    stop += 1
                got = aligner.chunk(part, hashed)
                n = stop - start
                lists = [pa.array([got[k]] + [None] * (n - 1), pa.list_(t)) for k, t in (("pairs", pa.int64()), ("docs", pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int64()), ids.slice(start, n), *(pa.array(got[k]) for k in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(got["groups"], pa.string()), pa.array(got["own"], pa.binary()), *lists],
                    names=["chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "own", "pairs", "docs"])
                number += 1
                start = stop
    return run


def _told(rows: pa.Table, counted: pa.Table) -> pa.Table:
    size = counted.num_rows
    place = counted.column("pos").to_numpy()
    count, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    count[place], best[place] = counted.column("n").to_numpy(), counted.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for x in rows.column("own").to_pylist():
        own = np.frombuffer(x, dtype="<i4").astype(np.int64).reshape(2, -1)
        sums.append(int(count[own[0]] @ own[1]))
        bests.append(int(best[own[0]] @ own[1]))
    kept = rows.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    kept = kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
    return kept.append_column("groups", rows.column("groups"))


def align(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """Aligns the tokens of a byte-level BPE (A: ``json_path``, over a space and the text) and
    of a sentencepiece model (B: ``model_path``, over the text) in every whole text:
    ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``groups``: ``a1,a2|b1;a3|b2,b3`` (or, ``hashed``, its SHA-256 in hex), cut at the bytes
    where tokens of both end. ``n_links``: pairs of tokens whose bytes overlap. An id pair's
    count is the number of rows that hold it linked; ``count_sum`` is its sum over the links,
    ``n_best`` the links whose count is the highest that their A id has (ties included).

    Texts that are null, empty, or that either tokenizer doesn't give back byte for byte have
    no tokens: zeros and an empty ``groups``. Strings of special tokens are plain text.
    Repeated rows count as often as they occur, null ids stay, an empty table gives no rows;
    other columns, whatever their names, are not read. The two files are read on the driver
    and sent along (their size is the vocabularies').
    """
    with open(json_path, "rb") as f, open(model_path, "rb") as g:
        a, b = f.read(), g.read()
    d = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    fields = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
    rows = save(d.mapInArrow(_chunker(a, b, hashed), f"chunk bigint, id {kind}, {fields}, groups string, own binary, pairs array<bigint>, docs array<bigint>"))
    width = len(Pieces(b).token)

    entries = rows.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("pos", "e"))
    entries = entries.select("chunk", "pos", F.col("e.pairs").alias("pair"), F.col("e.docs").alias("docs"))
    counts = save(entries.groupBy("pair").agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("chunks")))
    of_a = F.expr(f"pair div {width}")
    top = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))  # a row for each id of A at most
    flagged = counts.join(F.broadcast(top), of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # a chunk names a pair once, so a pair's rows are the chunks that hold it
    hot = top_hot_keys(counts, ["pair"], "chunks")
    told = salted_join(entries.select("chunk", "pos", "pair"), flagged, "pair", hot, "inner").select(F.col("chunk").alias("of"), "pos", "n", "best")
    out = rows.drop("pairs", "docs").groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(
        _told, f"id {kind}, {fields}, n_best bigint, count_sum bigint, groups string")
    return out.withColumnRenamed("id", id_col)
