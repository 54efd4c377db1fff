"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read whole, in overlapping chunks. Each learned filter
spans a few bytes; a filter's response at a place is the sum of one table entry
per byte, so a layer of embeddings and convolution is a handful of look-ups.
The responses are max-pooled within each chunk; the mean and the maximum over
the chunks, and the chunk-wise mean response, are combined by a logistic layer
into one probability. Neither label, language, source nor id is an input.

Training is by gradient descent on a sample of labelled documents whose id does
not fall into the held-out fold. The sample is bounded: at most MAX_PER_CLASS
documents of each class, and at most TRAIN_CHUNKS chunks of a document, both
chosen by a seeded hash. Scoring reads every byte of every text.

Nulls and odd rows: a null text counts as empty; an empty text is one chunk of
padding and so has a score; labels that are null or neither 0 nor 1 are not
learned from; a null doc_id is in no fold, held_out is null and nothing is
learned from it; repeated label rows weigh as one; each document row gives one
output row; other columns are ignored, whatever their names. Without any
labelled rows, or with one class alone, the score is the base rate of the
labels (one half without labels). Empty documents give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.common import first_by, text_of

CHUNK, OVERLAP = 512, 64
FILTERS, WIDTH = 12, 6
FOLDS, HELD_OUT = 3, 1
#: Bounds of the training sample.
MAX_PER_CLASS, TRAIN_CHUNKS = 800, 6
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.02, 7
#: Bytes that one pass of the scorer holds at once.
GROUP_BYTES = 1 << 17

Model = dict[str, np.ndarray]


def chunks_of(data: bytes) -> list[np.ndarray]:
    """Overlapping chunks that cover all bytes; the last is padded with zeros."""
    b = np.frombuffer(data, np.uint8)
    step = CHUNK - OVERLAP
    out = []
    for at in range(0, max(1, len(b) - OVERLAP), step):
        part = b[at:at + CHUNK]
        out.append(part if len(part) == CHUNK else np.concatenate([part, np.zeros(CHUNK - len(part), np.uint8)]))
    return out


def responses(model: Model, x: np.ndarray) -> np.ndarray:
    """Filter responses of chunks (n, CHUNK) -> (n, places, FILTERS)."""
    places = x.shape[1] - WIDTH + 1
    out = model["table"][0][x[:, :places]]
    for k in range(1, WIDTH):
        out += model["table"][k][x[:, k:k + places]]
    return out


def _pooled(model: Model, x: np.ndarray) -> np.ndarray:
    """Per chunk: the largest response of each filter and the mean of its positive part."""
    r = responses(model, x)
    return np.concatenate([np.maximum(r.max(1) + model["bias"], 0), np.maximum(r + model["bias"], 0).mean(1)], 1)


def _combined(pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Document features: mean and maximum over its chunks."""
    n = np.diff(np.append(starts, len(pooled)))[:, None]
    return np.concatenate([np.add.reduceat(pooled, starts) / n, np.maximum.reduceat(pooled, starts)], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: list[list[np.ndarray]], labels: np.ndarray) -> Model:
    """Fit filters and weights by Adam on the log loss, classes weighted alike."""
    rng = np.random.default_rng(SEED)
    labels = np.asarray(labels, float)
    rate = labels.mean() if len(labels) else 0.5
    model: Model = {
        "table": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32), "weight": np.zeros(4 * FILTERS), "offset": np.zeros(1)}
    if not len(labels) or rate in (0.0, 1.0):
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        model["offset"][:] = np.log(rate / (1 - rate))
        return model
    model["weight"] = rng.normal(0, 0.1, 4 * FILTERS)
    balance = np.where(labels == 1, 0.5 / rate, 0.5 / (1 - rate))
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v2 = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x = np.stack([c for i in pick for c in docs[i]])
            counts = np.array([len(docs[i]) for i in pick])
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            grads = _gradients(model, x, starts, counts, labels[pick], balance[pick])
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                change = RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
                model[k] = (model[k] - change).astype(model[k].dtype)
    return model


def _gradients(model: Model, x: np.ndarray, starts: np.ndarray, counts: np.ndarray, y: np.ndarray, w: np.ndarray) -> Model:
    r = responses(model, x) + model["bias"]
    top = r.argmax(1)
    n, places = r.shape[0], r.shape[1]
    rows, cols = np.arange(n)[:, None], np.arange(FILTERS)[None]
    best = r[rows, top, cols]
    active = r > 0
    pooled = np.concatenate([np.maximum(best, 0), np.where(active, r, 0).mean(1)], 1)
    doc = np.repeat(np.arange(len(starts)), counts)
    mean = np.add.reduceat(pooled, starts) / counts[:, None]
    most = np.maximum.reduceat(pooled, starts)
    features = np.concatenate([mean, most], 1)
    error = (_sigmoid(features @ model["weight"] + model["offset"]) - y) * w / len(y)
    back = error[:, None] * model["weight"][None]
    half = 2 * FILTERS
    d_pooled = back[doc, :half] / counts[doc][:, None]
    is_most = pooled == most[doc]
    ties = np.add.reduceat(is_most.astype(float), starts)
    d_pooled = d_pooled + np.where(is_most, back[doc, half:] / ties[doc], 0)
    d_best = np.where(best > 0, d_pooled[:, :FILTERS], 0)
    d_mean = d_pooled[:, FILTERS:] / places
    grad_table = np.zeros((WIDTH, 256, FILTERS))
    flat = active.reshape(-1, FILTERS) * np.repeat(d_mean, places, axis=0)
    for k in range(WIDTH):
        own = x[:, k:k + places]
        for f in range(FILTERS):
            grad_table[k, :, f] += np.bincount(own.ravel(), weights=flat[:, f], minlength=256)
        np.add.at(grad_table[k], (x[rows, top + k], cols), d_best)
    return {"table": grad_table.astype(np.float32),
            "bias": (d_best.sum(0) + flat.sum(0)).astype(np.float32),
            "weight": features.T @ error + 1e-4 * model["weight"], "offset": np.array([error.sum()])}


def score(model: Model, texts: list[str]) -> np.ndarray:
    """Probability of label 1 for each whole text, in groups of bounded size."""
    parts: list[np.ndarray] = []  # chunks in waiting
    pooled: list[np.ndarray] = []
    starts, n = [], 0

    def flush() -> None:
        if parts:
            pooled.append(_pooled(model, np.stack(parts)))
            parts.clear()

    for text in texts:
        starts.append(n)
        for c in chunks_of(text.encode("utf-8", "surrogatepass")):
            parts.append(c)
            n += 1
            if len(parts) * CHUNK >= GROUP_BYTES:
                flush()
    flush()
    if not starts:
        return np.empty(0)
    features = _combined(np.concatenate(pooled), np.array(starts))
    return _sigmoid(features @ model["weight"] + model["offset"])


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[list[list[np.ndarray]], np.ndarray]:
    """The bounded training sample: chunks and labels."""
    order = F.xxhash64(F.lit(SEED), "doc_id")
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (_fold(F.col("doc_id")) != HELD_OUT))
    rows = rows.groupBy("doc_id").agg(F.min(label).alias("y")).select("doc_id", "y", order.alias("o"))
    # bounded by MAX_PER_CLASS rows for each class, hence broadcast
    own = [first_by(rows.filter(F.col("y") == y), "o", MAX_PER_CLASS, "doc_id") for y in (0, 1)]
    chosen = F.broadcast(own[0].unionByName(own[1]).select(F.col("doc_id").alias("chosen"), "y", "o"))

    @F.pandas_udf("array<binary>")
    def pick(texts: pd.Series, orders: pd.Series) -> pd.Series:
        out = []
        for t, o in zip(texts, orders, strict=True):
            found = chunks_of(t.encode("utf-8", "surrogatepass"))
            if len(found) > TRAIN_CHUNKS:
                rng = np.random.default_rng(int(o) & 0xFFFFFFFF)
                found = [found[i] for i in sorted(rng.choice(len(found), TRAIN_CHUNKS, replace=False))]
            out.append([c.tobytes() for c in found])
        return pd.Series(out, dtype=object)

    got = (docs.select("doc_id", text_of("text").alias("text")).join(chosen, F.col("doc_id") == F.col("chosen"))
           .select("doc_id", "y", "o", pick("text", "o").alias("chunks")).collect())
    got.sort(key=lambda r: (r["o"], r["doc_id"], [bytes(c) for c in r["chunks"]]))
    return [[np.frombuffer(c, np.uint8) for c in r["chunks"]] for r in got], np.array([r["y"] for r in got], float)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    model = train(*sample(docs, labels, label))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score(model, texts.fillna("").tolist()))

    out = docs.select("doc_id", (_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), scored("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
