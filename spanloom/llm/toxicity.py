"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text's words (lower case, ASCII punctuation as space) are read in windows of WINDOW words that overlap
and cover the whole document. A word's input is a learned vector of its hash and the mean of learned vectors of all its
bytes with their neighbours. Two gated recurrent passes, one each way, feed an attention that pools the window's states
to one vector and a logit; the output sees the words through these states only. The document's score is that of its most toxic
window, calibrated on the learning sample. Labels are for documents, so each step learns from the
window that scores highest (and, for clean documents, a random one too). All weights start at random, words unseen at nothing.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import nn
from spanloom.llm.common import as_bytes, prefix_hash, range_hash, table, word_bounds
from spanloom.llm.labelled import sample
from spanloom.llm.quality_cnn import scored

SAMPLE, EPOCHS, RATE, RARE = 1500, 8, 0.01, 0.3
WINDOW, STEP = 32, 24
SLOTS, GRAMS, WORD, CHAR, HIDDEN, ASK = 1 << 16, 1 << 13, 12, 12, 16, 8
FOLDS, HELD = 5, 0
#: Words that are hashed at once.
HASHED = 1 << 16
_PLAIN = bytes.maketrans((string.ascii_uppercase + string.punctuation).encode(), (string.ascii_lowercase + " " * len(string.punctuation)).encode())


class Words:
    """The different words of some texts: slot, and slots of their bytes with neighbours (``grams``, ``n`` for each word); the
    number of each word of the texts (``which``), and of words of each text (``count``)."""

    def __init__(self, texts: list[str | None]):
        raws = [as_bytes(t).translate(_PLAIN) for t in texts]
        raw = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
        start, end = word_bounds(raw)
        self.count = np.diff(np.searchsorted(start, np.cumsum([0] + [len(r) + 1 for r in raws])[1:]), prepend=0)
        hashes = [np.zeros(0, np.uint64)]
        for i in range(0, len(start), HASHED):
            a, b = start[i : i + HASHED], end[i : i + HASHED]
            hashes.append(range_hash(prefix_hash(raw[a[0] : b[-1]]), a - a[0], b - a[0]))
        key, first, self.which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.slot = (key % np.uint64(SLOTS)).astype(np.int64)
        start, self.n = start[first], (end - start)[first]
        at = np.repeat(start - (np.cumsum(self.n) - self.n), self.n) + np.arange(self.n.sum())
        self.grams = ((raw[at - 1].astype(np.int64) * 256 + raw[at]) * 256 + raw[at + 1]) * 0x9E3779B1 % (1 << 32) % GRAMS  # white space closes a word

    def inputs(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """For windows of word numbers (-1: none): slots, grams and their numbers of the different words in them, and the windows in these."""
        which = np.where(at >= 0, self.which[np.maximum(at, 0)] if len(self.which) else 0, -1)
        used = np.unique(which[which >= 0])
        n = self.n[used]
        begin = (np.cumsum(self.n) - self.n)[used]
        grams = self.grams[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return self.slot[used], grams, n, np.where(which >= 0, np.searchsorted(used, np.maximum(which, 0)), -1)


def windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of every window (-1: none), and the text it belongs to. A text without words has one, empty."""
    per = np.maximum(1, -(-(count - (WINDOW - STEP)) // STEP))
    owner = np.repeat(np.arange(len(count)), per)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    inside = nth[:, None] * STEP + np.arange(WINDOW)
    first = np.cumsum(count) - count
    return np.where(inside < count[owner][:, None], first[owner][:, None] + inside, -1), owner


def forward(p: dict, slot: np.ndarray, grams: np.ndarray, n: np.ndarray, at: np.ndarray):
    """Logits of windows, from what Words.inputs gives."""
    k = len(at)
    mask = (at >= 0).T.astype(np.float32)[:, :, None]
    x = nn.concat([nn.take(p["words"], slot), nn.bag(p["chars"], grams, n, True)])
    both = []
    for d in ("f", "b"):
        z = nn.concat([nn.add(nn.matmul(x, p["x" + d]), p["b" + d]), np.zeros((1, 3 * HIDDEN), np.float32)], 0)  # once for each word; the last is no word
        z = nn.reshape(nn.take(z, np.where(at >= 0, at, len(slot)).T.reshape(-1)), WINDOW, k, 3 * HIDDEN)
        both.append(nn.gru(z, p["h" + d], p["n" + d], HIDDEN, mask, d == "b"))
    h = nn.concat(both)
    weight = nn.softmax(nn.add(nn.matmul(nn.tanh(nn.matmul(h, p["ask"])), p["key"]), (mask - 1) * 30), 0)
    pooled = nn.total(nn.mul(h, weight), 0)
    return nn.reshape(nn.add(nn.matmul(pooled, p["out"]), p["bias"]), k)


def _logits(p: dict, words: Words, at: np.ndarray) -> np.ndarray:
    return np.concatenate([forward(p, *words.inputs(at[i : i + 1024])) for i in range(0, len(at), 1024)])


def train(texts: list[str], y: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    wide = WORD + CHAR
    p = nn.init(
        rng, words=(SLOTS, WORD), chars=(GRAMS, CHAR), xf=(wide, 3 * HIDDEN), xb=(wide, 3 * HIDDEN), hf=(HIDDEN, 2 * HIDDEN), hb=(HIDDEN, 2 * HIDDEN),
        nf=(HIDDEN, HIDDEN), nb=(HIDDEN, HIDDEN), bf=(3 * HIDDEN,), bb=(3 * HIDDEN,), ask=(2 * HIDDEN, ASK), key=(ASK, 1), out=(2 * HIDDEN, 1), bias=(1,),
    )
    p["words"] *= 0
    p["scale"], p["shift"] = np.array([1.0], np.float32), np.array([0.0], np.float32)
    if len(set(y.tolist())) < 2:
        p["out"] *= 0
        p["bias"] = np.array([0.0 if not len(y) else 4.0 * (2 * y[0] - 1)], np.float32)
        return p
    words = Words(texts)
    count = words.count
    at, owner = windows(count)
    adam = nn.Adam({k: v for k, v in p.items() if k not in ("scale", "shift")}, RATE)
    firsts = np.searchsorted(owner, np.arange(len(count) + 1))
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - 0.9 * epoch / EPOCHS)
        now = _logits(adam.p, words, at)
        best = np.array([firsts[d] + now[firsts[d] : firsts[d + 1]].argmax() for d in range(len(count))])
        other = np.array([rng.integers(firsts[d], firsts[d + 1]) for d in np.flatnonzero(y == 0)])
        rows = np.concatenate([best, other])
        rng.shuffle(rows)
        for i in range(0, len(rows), 96):
            k = rows[i : i + 96]
            some = words.inputs(at[k])
            adam.step(lambda live: nn.bce(forward(live, *some), y[owner[k]], np.ones(len(k))))
    p.update(adam.p)
    most = np.maximum.reduceat(_logits(p, words, at), firsts[:-1])
    a, b = 1.0, 0.0
    weight = np.where(y > 0, RARE, 1.0)
    for _ in range(300):  # calibration by gradient descent; toxic documents are rarer than in the sample
        q = 1 / (1 + np.exp(-np.clip(a * most + b, -30, 30)))
        d = weight * (q - y)
        a, b = max(0.05, a - 0.3 * float((d * most).mean() / max(1.0, most.var()))), b - 0.5 * float(d.mean())
    p["scale"], p["shift"] = np.array([a], np.float32), np.array([b], np.float32)
    return p


def scores(p: dict, texts: list[str | None]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    words = Words(texts)
    count = words.count
    at, owner = windows(count)
    most = np.maximum.reduceat(_logits(p, words, at), np.searchsorted(owner, np.arange(len(count))))
    return 1 / (1 + np.exp(-np.clip(most.astype(float) * p["scale"][0] + p["shift"][0], -30, 30)))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Texts without words score as an empty window; repeated rows score alike; empty documents give no
    rows; without labels every score is 0.5; other columns are ignored.
    """
    p = train(*sample(spark, docs, labels, "toxic", FOLDS, HELD, SAMPLE))
    return scored(docs, lambda texts: scores(p, texts), FOLDS, HELD)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
