"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The merges of a batch of pre-tokens run over one linked list of bytes, each pre-token a
chain of its own. Positions wait in one bucket per merge rank; a bitmap of three levels
(64 children a word) says which buckets hold any, and find-first-set on each level gives
the next rank. An entry whose pair has changed since it was queued is stale and skipped.
Each byte is queued a bounded number of times, so a pre-token of a million bytes costs a
million steps, where rescanning it for the lowest rank would cost their square.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from daybook.llm.common import per_worker

# Encoded pre-tokens a Python worker remembers before it starts afresh, and the longest
# pre-token (in characters) it remembers: together they bound its memory.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64
# Pairs of tokens whose merge a worker remembers.
KNOWN_PAIRS = 400_000
# Characters of text that are pre-tokenised and merged together, and ids decoded at a time.
BATCH_CHARS, DECODED = 1_000_000, 1 << 18


class RankQueue:
    """Buckets of list positions by rank under a hierarchical bitmap."""

    def __init__(self, n_ranks: int):
        n = (n_ranks + 63) >> 6
        self.low = [0] * n
        self.mid = [0] * ((n + 63) >> 6)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        b = self.buckets.get(rank)
        if b is not None:
            b.append(position)
            return
        self.buckets[rank] = [position]
        self._mark(rank)

    def fill(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        self._mark(rank)

    def _mark(self, rank: int) -> None:
        w = rank >> 6
        self.low[w] |= 1 << (rank & 63)
        self.mid[w >> 6] |= 1 << (w & 63)
        self.top |= 1 << (w >> 6)

    def first(self) -> int:
        """The lowest rank with a bucket; -1 if all are empty."""
        top = self.top
        if not top:
            return -1
        u = (top & -top).bit_length() - 1
        m = self.mid[u]
        w = (u << 6) + (m & -m).bit_length() - 1
        x = self.low[w]
        return (w << 6) + (x & -x).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        w = rank >> 6
        self.low[w] &= ~(1 << (rank & 63))
        if not self.low[w]:
            self.mid[w >> 6] &= ~(1 << (w & 63))
            if not self.mid[w >> 6]:
                self.top &= ~(1 << (w >> 6))
        return self.buckets.pop(rank)


class Vocabulary:
    """Token bytes by rank, read from the lines ``base64 rank`` of a ranks file."""

    def __init__(self, ranks_file: bytes):
        pairs = (line.split() for line in ranks_file.splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.size = max(self.ranks.values()) + 1
        self.token = [b""] * self.size
        for t, r in self.ranks.items():
            self.token[r] = t
        self.flat = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        self.length = np.fromiter(map(len, self.token), dtype=np.int64, count=self.size)
        self.start = np.cumsum(self.length) - self.length
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        none = -1
        self.byte_pair = np.array([self.ranks.get(bytes([a, b]), none) for a in range(256) for b in range(256)],
                                  dtype=np.int64)
        self._pair: dict[int, int] = {}

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ``ids`` stand for, a stretch of them gathered at a time."""
        out = []
        for a in range(0, len(ids), DECODED):
            part = ids[a:a + DECODED]
            n = self.length[part]
            ends = np.cumsum(n)
            at = np.repeat(self.start[part] - ends + n, n) + np.arange(int(ends[-1]))
            out.append(self.flat[at].tobytes())
        return b"".join(out)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers.

        The lowest rank of any chain merges first and, at equal rank, the leftmost
        position; chains don't touch, so each word gets the ids it would get alone.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        total = int(lengths.sum())
        if not total:
            return [b""] * len(words)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        pair = np.full(total, -1, dtype=np.int64)
        pair[:-1] = self.byte_pair[(raw[:-1] << 8) | raw[1:]]
        last = ends[lengths > 0] - 1
        pair[last] = -1
        nxt_a = np.arange(1, total + 1)
        nxt_a[last] = -1
        prv_a = np.arange(-1, total - 1)
        prv_a[(last + 1)[:-1]] = -1
        ids, nxt, prv, rank_at = self.byte_id[raw].tolist(), nxt_a.tolist(), prv_a.tolist(), pair.tolist()

        queue = RankQueue(self.size)
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, starts = np.unique(pair[at], return_index=True)
        for r, positions in zip(ranks.tolist(), np.split(at, starts[1:])):
            queue.fill(r, positions.tolist())

        known, token, by_bytes, push, first = self._pair, self.token, self.ranks, queue.push, queue.first
        while (rank := first()) >= 0:
            entries = queue.take(rank)
            entries.sort()
            for k, p in enumerate(entries):
                if rank_at[p] != rank:
                    continue  # stale
                q = nxt[p]
                ids[p] = rank
                ids[q] = -1
                rank_at[q] = -1
                after = nxt[q]
                nxt[p] = after
                lower = False
                if after >= 0:
                    prv[after] = p
                    key = rank << 20 | ids[after]
                    r = known.get(key)
                    if r is None:
                        r = known[key] = by_bytes.get(token[rank] + token[ids[after]], -1)
                    rank_at[p] = r
                    if r >= 0:
                        push(r, p)
                        lower = r < rank
                else:
                    rank_at[p] = -1
                before = prv[p]
                if before >= 0:
                    key = ids[before] << 20 | rank
                    r = known.get(key)
                    if r is None:
                        r = known[key] = by_bytes.get(token[ids[before]] + token[rank], -1)
                    rank_at[before] = r
                    if r >= 0:
                        push(r, before)
                        lower = lower or r < rank
                if lower:  # a lower rank has come up: it goes first
                    for p in entries[k + 1:]:
                        push(rank, p)
                    break
        if len(known) > KNOWN_PAIRS:
            known.clear()
        out = np.array(ids, dtype=np.int64)
        left = out >= 0
        counts = np.concatenate(([0], np.cumsum(left)))
        flat = out[left].astype("<u4").tobytes()
        cut = (counts[np.concatenate(([0], ends))] * 4).tolist()
        return [flat[a:b] for a, b in zip(cut, cut[1:])]


class Encoder:
    """A vocabulary, a pre-token pattern and the pre-tokens encoded so far."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.vocabulary, self.find = Vocabulary(ranks_file), regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        cache, words = self.cache, [self.find(t) for t in texts]
        missing = list({w for ws in words for w in ws if w not in cache})
        cache.update(zip(missing, self.vocabulary.merge([w.encode() for w in missing])))
        out = [b"".join(map(cache.__getitem__, ws)) for ws in words]
        for w in missing:
            if len(w) > CACHE_CHARS:
                del cache[w]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        return out


def _worker(ranks_file: bytes, pattern: str, make):
    """``mapInArrow`` function of ``(id, text)``: a stretch of texts at a time goes through the
    worker's encoder, and ``make(encoder, ids)`` gives the columns after ``id``."""
    key = "byte_bpe:" + hashlib.sha256(ranks_file + pattern.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(key, lambda: Encoder(ranks_file, pattern))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, n = 0, batch.num_rows
            while start < n:
                part, chars, stop = [], 0, start
                while stop < n and (chars < BATCH_CHARS or stop == start):
                    part.append(texts[stop].as_py() or "")
                    chars += len(part[-1])
                    stop += 1
                columns = make(encoder, encoder.ids(part))
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), *columns.values()], names=["id", *columns])
                start = stop
    return run


def _tokens(encoder: Encoder, ids: list[bytes]) -> dict[str, pa.Array]:
    return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}


def _digests(encoder: Encoder, ids: list[bytes]) -> dict[str, pa.Array]:
    def sha(x: bytes) -> str:
        return hashlib.sha256(x).hexdigest()

    decoded = [sha(encoder.vocabulary.decode(np.frombuffer(x, "<u4"))) for x in ids]
    return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": pa.array(map(sha, ids), pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string())}


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, make, columns: str) -> DataFrame:
    with open(ranks_path, "rb") as f:
        ranks_file = f.read()
    d = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(_worker(ranks_file, pattern, make), f"id {kind}, n_tokens bigint, {columns}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_tokens, ids`` (binary: little-endian unsigned
    32-bit token ids).

    ``ranks_path`` is a ranks file (``base64 rank`` lines, a byte each among them), read on
    the driver and sent along (its size is the vocabulary's); ``pattern`` splits the text
    into pre-tokens, each encoded by itself, with no special tokens. Null and empty text:
    no tokens. Repeated ids give repeated rows, null ids stay, an empty table gives no
    rows; other columns are neither read nor returned. Texts are never cut.
    """
    return _mapped(docs, ranks_path, pattern, id_col, text_col, _tokens, "ids binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, where the ids themselves are not wanted: one row
    per document, ``id_col, n_tokens, ids_sha256, decoded_sha256`` (lowercase hex digests of
    the ids as ``encode`` gives them and of the bytes that they decode to). Cases as there."""
    return _mapped(docs, ranks_path, pattern, id_col, text_col, _digests, "ids_sha256 string, decoded_sha256 string")


def decode(ids: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes that the token ids in ``ids_col`` stand for.
    Null ids give null; an id outside the vocabulary is an error. A column ``decoded`` of the
    input gives way to the new one."""
    with open(ranks_path, "rb") as f:
        ranks_file = f.read()
    key = "byte_bpe_tokens:" + hashlib.sha256(ranks_file).hexdigest()
    ids = ids.select(ids[ids_col].alias("_ids"), *[c for c in ids.columns if c != "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = per_worker(key, lambda: Vocabulary(ranks_file))
        for batch in batches:
            out = [None if x is None else vocabulary.decode(np.frombuffer(x, "<u4")) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.binary())],
                                             names=[*batch.schema.names[1:], "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema.fields[1:])
    return ids.mapInArrow(run, f"{schema}, decoded binary")
