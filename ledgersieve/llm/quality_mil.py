"""Document quality by attention over passages.

A document is a bag of passages. Each passage is encoded, a gated attention gives it a weight, and
the weighted sum is scored. Encoder, attention and score are learned together from document labels
alone. Fitting uses a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.sampling import bounded_sample
from ledgersieve.llm.words import ranges, row_offsets, slices, split_words, text_bytes

PASSAGE_WORDS = 64
# Labelled rows that the model is fitted on: those with the least hashes of their ids.
FIT_ROWS = 4000
HIDDEN, ATTENTION, WORD_DIMS = 24, 12, 16
STEPS, RATE, DECAY = 400, 0.02, 1e-4
SEED = 7

# Classes of bytes. Other printable marks are class 6, letters beyond ASCII 7.
_CLASS = np.full(256, 7, np.int64)
_CLASS[:128] = 6
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
_CLASS[[44, 46]] = 4
_CLASS[[33, 63]] = 5
_CLASSES = 8
FEATURES = _CLASSES + 6 + WORD_DIMS


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the bounds of the documents. A text without words is one zero row."""
    data, offsets = text_bytes(texts)
    words = split_words(data, offsets)
    counts = np.diff(words.bounds)
    per_doc = np.maximum(1, -(-counts // PASSAGE_WORDS))
    bounds = row_offsets(per_doc)
    n = int(bounds[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if not len(words.starts):
        return out, bounds
    hashes = words.hashes()
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(doc)) - words.bounds[doc]
    owner = bounds[doc] + place // PASSAGE_WORDS
    size = np.bincount(owner, minlength=n)
    some = np.maximum(size, 1)
    lengths = words.ends - words.starts
    at = ranges(words.starts, lengths)
    kinds = np.bincount(np.repeat(owner, lengths) * _CLASSES + _CLASS[words.data[at]], minlength=n * _CLASSES)
    out[:, :_CLASSES] = kinds.reshape(n, _CLASSES) / np.maximum(1, np.bincount(owner, lengths, n))[:, None]
    first, last = words.data[words.starts], words.data[words.ends - 1]
    low = np.uint64(0xFFFFFF)
    seen = np.sort(owner.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    again = np.flatnonzero(seen[1:] == seen[:-1])
    repeated = np.bincount((seen[again] >> np.uint64(40)).astype(np.int64), minlength=n)
    pairs = hashes.copy()
    pairs[:-1] += hashes[1:] * np.uint64(3)
    whole = doc.astype(np.uint64) << np.uint64(40) | (pairs >> np.uint64(40)) & low
    order = np.argsort(whole, kind="stable")
    twice = np.zeros(len(whole), bool)
    twice[order[1:]] = whole[order[1:]] == whole[order[:-1]]
    columns = [
        np.log1p(np.bincount(owner, lengths, n) / some), repeated / some, np.bincount(owner, twice, n) / some,
        np.bincount(owner, (_CLASS[first] == 1), n) / some, np.bincount(owner, (_CLASS[last] >= 5), n) / some,
        np.bincount(owner, lengths == 1, n) / some]
    for k, column in enumerate(columns, _CLASSES):
        out[:, k] = column
    signs = np.unpackbits((hashes & np.uint64(0xFFFF)).astype("<u2").view(np.uint8)).reshape(-1, WORD_DIMS)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sums = np.add.reduceat(signs, starts, axis=0, dtype=np.int32)
    out[owner[starts], _CLASSES + len(columns):] = (2 * sums / some[owner[starts], None] - 1) * np.sqrt(some[owner[starts], None]) / 8
    return out, bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """h = tanh(Wx), attention softmax(w . (tanh(Vh) * sigmoid(Uh))), score sigmoid(c . sum(a h))."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        shapes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION),
                  "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, bounds: np.ndarray):
        p, starts = self.p, bounds[:-1]
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        owner = np.repeat(np.arange(len(starts)), np.diff(bounds))
        a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        a /= np.add.reduceat(a, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return _sigmoid(z @ p["c"] + p["d"][0]), (x, h, t, s, a, z, owner)

    def fit(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> None:
        p = self.p
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, STEPS + 1):
            score, (xs, h, t, s, a, z, owner) = self.forward(x, bounds)
            err = (score - y) / len(y)
            dz = err[:, None] * p["c"]
            da = (h * dz[owner]).sum(axis=1)
            de = a * (da - np.add.reduceat(a * da, bounds[:-1])[owner])
            dgate = de[:, None] * p["w"]
            dt, ds = dgate * s * (1 - t**2), dgate * t * s * (1 - s)
            dh = (a[:, None] * dz[owner] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h**2)
            grads = {"W": xs.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
                     "c": z.T @ err, "d": err.sum(keepdims=True)}
            for k, g in grads.items():
                g = g + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> GatedAttention | None:
    """A model from `labels` (id, label 0 or 1). At most FIT_ROWS rows are used; None without both labels.

    Rows without id, label or text are left out.
    """
    marked = labels.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    chosen = bounded_sample(marked, FIT_ROWS, F.col("id"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text"):
                x, bounds = passages(batch["text"].slice(a, b - a))
                rows = [x[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(a, b - a), batch["label"].slice(a, b - a), pa.array(rows, pa.binary())],
                    names=["id", "label", "x"])

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    kind = docs.schema[id_col].dataType.simpleString()
    # The sample has at most FIT_ROWS rows of two numbers, so it is safe to broadcast.
    rows = own.join(F.broadcast(chosen), "id").select("id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        encode, f"id {kind}, label int, x binary").collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    y = np.array([r["label"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    x = np.concatenate(bags).astype(np.float64)
    model = GatedAttention(x.mean(axis=0), x.std(axis=0) + 1e-3)
    model.fit(x, row_offsets(np.array([len(b) for b in bags])), y)
    return model


def score(docs: DataFrame, model: GatedAttention | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, score (0 to 1).

    NULL, empty and blank texts are one passage without words. Without a model every score is 0.5.
    Repeated rows get equal scores. Other columns are not read. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b in slices(batch, "text"):
                if known is None:
                    found = np.full(b - a, 0.5)
                else:
                    x, bounds = passages(batch["text"].slice(a, b - a))
                    found = known.forward(x.astype(np.float64), bounds)[0]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(a, b - a), pa.array(found, pa.float64())], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        judge, f"`{id_col}` {kind}, score double")
