"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole document. FILTERS learned filters
of WIDTH bytes, over learned byte vectors, slide over each chunk by STRIDE; a filter's answers are
max-pooled over the chunk, and the chunk answers over the document, by maximum and by mean. A
small layer combines both into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import nn
from spanloom.llm.common import as_bytes, crc_mod_py, table
from spanloom.llm.labelled import sample

#: Labelled documents of each class that the model learns from, at most; chunks of each that a pass draws.
SAMPLE, DRAWN, EPOCHS = 900, 8, 7
CHUNK, WIDTH, STRIDE, DEPTH, FILTERS, COMBINED = 512, 12, 4, 6, 20, 12
FOLDS, HELD = 3, 1


def chunks(text: str | None) -> np.ndarray:
    """Bytes of the chunks, (n, CHUNK), padded with 256; neighbours share WIDTH - STRIDE bytes, so every window of
    the text at a multiple of STRIDE lies in one. An empty text is one chunk of padding."""
    raw = np.frombuffer(as_bytes(text), np.uint8)
    step = CHUNK - (WIDTH - STRIDE)
    n = max(1, -(-(len(raw) - (WIDTH - STRIDE)) // step))
    out = np.full(n * step + (WIDTH - STRIDE), 256, np.int64)
    out[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::step]


def pooled(p: dict, rows: np.ndarray):
    """(n, FILTERS): each filter's maximum over each chunk."""
    windows = np.lib.stride_tricks.sliding_window_view(rows, WIDTH, axis=1)[:, ::STRIDE]
    n, k, _ = windows.shape
    x = nn.reshape(nn.take(p["bytes"], np.ascontiguousarray(windows)), n * k, WIDTH * DEPTH)
    return nn.top(nn.reshape(nn.relu(nn.add(nn.matmul(x, p["filters"]), p["fbias"])), n, k, FILTERS), 1)


def combined(p: dict, most, mean):
    h = nn.tanh(nn.add(nn.matmul(nn.concat([most, mean]), p["mix"]), p["mbias"]))
    return nn.reshape(nn.add(nn.matmul(h, p["out"]), p["obias"]), nn.val(h).shape[0])


def train(texts: list[str], y: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Learns from chunk sets of equal size; with one class or none the score is its share."""
    rng = np.random.default_rng(seed)
    p = nn.init(rng, bytes=(257, DEPTH), filters=(WIDTH * DEPTH, FILTERS), fbias=(FILTERS,), mix=(2 * FILTERS, COMBINED), mbias=(COMBINED,), out=(COMBINED, 1), obias=(1,))
    p["bytes"] = (rng.normal(0, 0.5, (257, DEPTH))).astype(np.float32)
    if len(set(y.tolist())) < 2:
        p["out"] *= 0
        p["obias"] = np.array([0.0 if not len(y) else 4.0 * (2 * y[0] - 1)], np.float32)
        return p
    cut = [chunks(t) for t in texts]
    adam, order = nn.Adam(p, 0.01, 1e-5), np.arange(len(cut))
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    for epoch in range(EPOCHS):
        adam.rate = 0.01 if epoch < EPOCHS - 2 else 0.002
        rng.shuffle(order)
        for i in range(0, len(order), 32):
            some = order[i : i + 32]
            rows = np.concatenate([cut[k][rng.integers(0, len(cut[k]), DRAWN)] if len(cut[k]) < DRAWN else cut[k][rng.permutation(len(cut[k]))[:DRAWN]] for k in some])

            def loss(live):
                each = nn.reshape(pooled(live, rows), len(some), DRAWN, FILTERS)
                return nn.bce(combined(live, nn.top(each, 1), nn.mul(nn.total(each, 1), np.float32(1 / DRAWN))), y[some], weight[some])

            adam.step(loss)
    return adam.p


def scores(p: dict, texts: list[str | None]) -> np.ndarray:
    cut = [chunks(t) for t in texts]
    n = np.array([len(c) for c in cut])
    if not len(n):
        return np.zeros(0)
    rows = np.concatenate(cut)
    each = np.concatenate([pooled(p, rows[i : i + 64]) for i in range(0, len(rows), 64)])
    starts = np.concatenate(([0], np.cumsum(n)[:-1]))
    z = combined(p, np.maximum.reduceat(each, starts, 0), np.add.reduceat(each, starts, 0) / n[:, None].astype(np.float32))
    return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))


def scored(docs: DataFrame, score, folds: int, held: int) -> DataFrame:
    """doc_id, held_out, score, predicted, with ``score`` from texts to probabilities."""

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            s = np.concatenate([score(texts[i : i + 256]) for i in range(0, len(texts), 256)]) if texts else np.zeros(0)
            out = [crc_mod_py(d, folds) == held for d in b.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.bool_()), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Null and empty texts score as padding; repeated rows score alike; empty documents give no rows; without
    labels every score is 0.5; other columns are ignored.
    """
    p = train(*sample(spark, docs, labels, "quality", FOLDS, HELD, SAMPLE))
    return scored(docs, lambda texts: scores(p, texts), FOLDS, HELD)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
