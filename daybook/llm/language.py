"""Language identification by a byte convolutional network, trained and applied in numpy.

Filters of several widths slide over the bytes of a window, each keeps its largest answer
(max pooling), and a softmax over these answers gives the languages' probabilities. As a
byte is a one-hot input, a filter of width w is w tables of 256 weights, and its answer at
a place a sum of w table entries; pairs of tables are joined into tables over byte pairs
before use. Whole texts are cut into windows of a fixed number of bytes, which are scored
in batches; a document's probabilities are the means over its windows, by their bytes.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import save
from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, top_k_per_key

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
# The training sample: at most so many documents of a language, and windows of a document.
TRAIN_DOCS, TRAIN_WINDOWS = 500, 3
# Windows scored together.
BATCH = 2048
UNKNOWN = "und"


@dataclasses.dataclass
class Model:
    labels: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    weight: np.ndarray  # (len(WIDTHS) * FILTERS, labels)
    bias: np.ndarray


def windows(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """The text in consecutive windows, the last one filled up with spaces."""
    n = -(-len(raw) // size)
    out = np.full(n * size, 32, dtype=np.uint8)
    out[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out.reshape(n, size)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01,
          seed: int = 0) -> Model:
    """Fit the network to windows ``x`` (n, WINDOW) and label numbers ``y`` with Adam."""
    rng = np.random.default_rng(seed)
    width_of = {w: i for i, w in enumerate(WIDTHS)}
    p = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p["v"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
    p["b"] = np.zeros(len(labels), dtype=np.float32)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    cols, step = np.arange(FILTERS), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            xs, ys = x[order[at:at + batch]], y[order[at:at + batch]]
            n, hidden, best = len(xs), [], {}
            for w in WIDTHS:
                places = xs.shape[1] - w + 1
                z = p[w][0][xs[:, :places]]
                for k in range(1, w):
                    z += p[w][k][xs[:, k:places + k]]
                best[w] = z.argmax(axis=1)
                hidden.append(np.take_along_axis(z, best[w][:, None, :], axis=1)[:, 0])
            h = np.concatenate(hidden, axis=1)
            a = np.maximum(h, 0)
            g = _softmax(a @ p["v"] + p["b"])
            g[np.arange(n), ys] -= 1
            g /= n
            grad = {"v": a.T @ g, "b": g.sum(axis=0)}
            gh = (g @ p["v"].T) * (h > 0)
            for w in WIDTHS:
                d, part = np.zeros_like(p[w]), gh[:, width_of[w] * FILTERS:(width_of[w] + 1) * FILTERS]
                for k in range(w):
                    np.add.at(d[k], (xs[np.arange(n)[:, None], best[w] + k], cols[None, :]), part)
                grad[w] = d
            step += 1
            for k, gr in grad.items():
                m[k] += 0.1 * (gr - m[k])
                v[k] += 0.001 * (gr * gr - v[k])
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(labels, {w: p[w] for w in WIDTHS}, p["v"], p["b"])


class Scorer:
    """A model's tables joined over byte pairs, ready for batches of windows."""

    def __init__(self, model: Model):
        self.model = model
        self.parts = {}
        for w, t in model.tables.items():
            pairs = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, w - 1, 2)]
            self.parts[w] = ([np.ascontiguousarray(q) for q in pairs], np.ascontiguousarray(t[w - 1]) if w % 2 else None)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(n, labels) for windows (n, WINDOW)."""
        n, size = x.shape
        xt = np.ascontiguousarray(x.T)
        pair = (xt[:-1].astype(np.int64) << 8) | xt[1:]
        single = xt.astype(np.int64)
        hidden = []
        z, more = (np.empty((n, FILTERS), dtype=np.float32) for _ in range(2))
        for w, (pairs, odd) in self.parts.items():
            top = np.full((n, FILTERS), -np.inf, dtype=np.float32)
            for at in range(size - w + 1):
                np.take(pairs[0], pair[at], axis=0, out=z, mode="clip")
                for k, q in enumerate(pairs[1:], 1):
                    np.take(q, pair[at + 2 * k], axis=0, out=more, mode="clip")
                    z += more
                if odd is not None:
                    np.take(odd, single[at + w - 1], axis=0, out=more, mode="clip")
                    z += more
                np.maximum(top, z, out=top)
            hidden.append(top)
        a = np.maximum(np.concatenate(hidden, axis=1), 0)
        return _softmax((a @ self.model.weight + self.model.bias).astype(np.float64))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5
    (a null id is kept from training too)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", train_docs: int = TRAIN_DOCS,
        train_windows: int = TRAIN_WINDOWS, seed: int = 0) -> Model | None:
    """Train on documents that are not held out and have text and label.

    Of each language at most ``train_docs`` documents, drawn by a hash of id and text over
    the whole table (repeated rows share a draw, and the bound holds for them too), give
    ``train_windows`` windows each from evenly spread places of the text; the driver gets
    these and a count per language. None if there is no such document.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    d = d.where(~held_out("id") & F.col("text").isNotNull() & F.col("label").isNotNull() & (F.char_length("text") > 0))
    counts = {r["label"]: r["n"] for r in d.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, train_docs / n))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 20))
    # somewhat more than wanted by the hash, then the first of them
    drawn = d.withColumn("draw", draw).where(F.col("draw") < 1.5 * share[F.col("label")] * (1 << 20))
    drawn = top_k_per_key(drawn, "label", ["draw", "id", "text"], train_docs)
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(train_windows - 1)), lambda k: F.substring(
        "text", (room * k / max(1, train_windows - 1)).cast("int") + 1, WINDOW))
    rows = drawn.select("id", "label", F.array_distinct(pieces).alias("pieces")).collect()
    rows.sort(key=lambda r: (r["label"], str(r["id"]), r["pieces"]))
    labels = sorted(counts)
    x, y = [], []
    for r in rows:
        for piece in r["pieces"]:
            x.append(windows(piece.encode()[:WINDOW])[:1])
            y.append(labels.index(r["label"]))
    if not x:
        return None
    return train(np.concatenate(x), np.array(y), labels, seed=seed)


def _predict(model: Model | None, unscored: str | None = UNKNOWN):
    """``unscored``: what a text with letters gets without a model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            letters = [any(map(str.isalpha, t)) for t in texts]  # number signs are none
            has = [scorer is not None and x for x in letters]
            labels, scores = [unscored if x else UNKNOWN for x in letters], [0.0] * len(texts)
            sums = np.zeros((len(texts), len(model.labels) if model else 0))
            owner, share, parts, held = [], [], [], 0

            def flush():
                if parts:
                    p = scorer.probabilities(np.concatenate(parts)) * np.concatenate(share)[:, None]
                    np.add.at(sums, np.concatenate(owner), p)
                    owner.clear(), share.clear(), parts.clear()

            for i, t in enumerate(texts):
                if not has[i]:
                    continue
                raw = t.encode()
                w = windows(raw)
                weight = np.full(len(w), WINDOW / len(raw))
                weight[-1] = (len(raw) - WINDOW * (len(w) - 1)) / len(raw)
                for a in range(0, len(w), BATCH):
                    parts.append(w[a:a + BATCH])
                    share.append(weight[a:a + BATCH])
                    owner.append(np.full(len(parts[-1]), i))
                    held += len(parts[-1])
                    if held >= BATCH:
                        flush()
                        held = 0
            flush()
            for i, ok in enumerate(has):
                if ok:
                    k = int(sums[i].argmax())
                    labels[i], scores[i] = model.labels[k], min(1.0, float(sums[i, k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, lang_pred, score`` from the whole text alone.

    ``lang_pred`` is a learned label (of equal scores the first in order), ``score`` its
    mean probability over the text's windows. Null or empty text, text without letters, and
    any text when there is no model: ``und`` with score 0. Repeated and null ids stay rows
    of their own, an empty table gives no rows; other columns are not read. Long texts are
    scored in batches of windows.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = d.mapInArrow(_predict(model), f"id {_kind(d, 'id')}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def select(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows and columns of ``docs`` whose text has letters. A null ``label_col`` (if there
    is such a column) is filled with the label found; labels given stay. Without a model the
    same rows stay, and null labels stay null.

    The texts go to Python, not back: what is rejected or filled is found by id and a hash of
    the text."""
    names = docs.columns
    d = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    label = f"c{names.index(label_col)}" if label_col in names else None
    d = d.withColumn("_h", F.xxhash64(text))
    fill = F.col(label).isNull() if label else F.lit(False)
    asked = d.select(F.struct(F.col(key).alias("id"), F.col("_h").alias("th"), fill.alias("fill")).alias("id"),
                     F.col(text).cast("string").alias("text"))
    found = asked.mapInArrow(_predict(model, None), f"id {_kind(asked, 'id')}, lang_pred string, score double")
    found = found.where((F.col("lang_pred") == UNKNOWN) | (F.col("id.fill") & F.col("lang_pred").isNotNull()))
    found = save(found.groupBy("id.id", "id.th").agg(F.min("lang_pred").alias("_pred")))
    found = F.broadcast(found) if measured_bytes(found) <= BROADCAST_BYTES else found
    d = d.join(found, F.col(key).eqNullSafe(F.col("id")) & (F.col("_h") == F.col("th")), "left")
    d = d.where(F.col("_pred").isNull() | (F.col("_pred") != UNKNOWN))
    if label:
        d = d.withColumn(label, F.coalesce(label, F.col("_pred").cast(d.schema[label].dataType)))
    return d.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def _kind(d: DataFrame, column: str) -> str:
    return d.schema[column].dataType.simpleString()
