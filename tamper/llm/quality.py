"""Operator 1: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words; the label belongs to the bag. Every
passage is encoded from the shape of its text (shares of byte classes, word lengths,
repetition, letter case), h = tanh(W x + b). Gated attention gives each passage the weight
softmax(w . (tanh(V h) * sigmoid(U h))), and the weighted passage representation is
scored by a logistic unit. All parts are learned together from document labels.

Fitting uses a bounded sample (``max_train`` labelled documents, ``MAX_BAG`` evenly spaced
passages of each); scoring reads every passage of every text. Weighting of passages
happens within a document, so scoring is a map over rows without a shuffle.

Defined cases: null, empty and wordless texts are a bag of one empty passage and get a
score like any other; null ids are scored (not held out, never learned from); repeated
rows are scored each; without labels of both classes the score is the share of label 1
(0.5 without labels); empty table, empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm import _text as X
from tamper.llm._learn import MAX_TRAIN, held_out, training_rows
from tamper.llm._spark import arrow_batches, boxed, table, unboxed

PASSAGE = 64
MAX_BAG = 256
CHUNK = 2 << 20  # text bytes that a worker encodes at a time
HIDDEN, GATE = 24, 12
EPOCHS, RATE, DECAY = 220, 0.02, 1e-4

N_CLASSES = 40


def _byte_classes() -> np.ndarray:
    """0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5.. punctuation one by one,
    37 control, 38 first byte of a multi-byte character, 39 its further bytes."""
    kind = np.full(256, 37, np.int64)
    kind[0x61:0x7B], kind[0x41:0x5B], kind[0x30:0x3A] = 0, 1, 2
    kind[[0x20, 0x09]], kind[[0x0A, 0x0D]] = 3, 4
    marks = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    kind[marks] = 5 + np.arange(len(marks))
    kind[0x80:0xC0], kind[0xC0:] = 39, 38
    return kind


CLASSES = _byte_classes()
N_FEATURES = N_CLASSES + 9


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, first passage of every row, n + 1 entries)."""
    data, offsets = X.text_bytes(column)
    starts, ends, first = X.words(data, offsets, X.WHITE)
    n_words = np.diff(first)
    bags = np.maximum(-(-n_words // PASSAGE), 1)
    bag_first = np.concatenate(([0], np.cumsum(bags)))
    n = int(bag_first[-1])
    out = np.zeros((n, N_FEATURES), np.float32)
    if len(starts):
        row = X.owners(first)
        passage = bag_first[row] + (np.arange(len(starts)) - first[row]) // PASSAGE
        lead = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        # the bytes of a passage: from its first word to the end of its last
        tail = np.append(lead[1:], len(starts)) - 1
        owner = np.repeat(np.arange(len(lead)), ends[tail] - starts[lead])
        at = np.arange(len(owner)) + np.repeat(
            starts[lead] - np.concatenate(([0], np.cumsum(ends[tail] - starts[lead])[:-1])),
            ends[tail] - starts[lead])
        counts = np.bincount(owner * N_CLASSES + CLASSES[data[at]],
                             minlength=len(lead) * N_CLASSES).reshape(len(lead), N_CLASSES)
        size = counts.sum(axis=1)
        out[passage[lead], :N_CLASSES] = np.sqrt(counts / size[:, None])
        length = ends - starts
        words = np.diff(np.append(lead, len(starts)))
        mean = np.add.reduceat(length, lead) / words
        key = X.hash_spans(data, starts, ends)
        same = np.zeros((2, len(starts)))
        for lag in (1, 2):
            same[lag - 1, lag:] = (key[lag:] == key[:-lag]) & (passage[lag:] == passage[:-lag])
        slot = np.repeat(np.arange(len(lead), dtype=np.uint64), words)
        unique = np.unique((slot << np.uint64(40)) | (key >> np.uint64(24)))
        distinct = np.bincount((unique >> np.uint64(40)).astype(np.int64), minlength=len(lead))
        head, end = CLASSES[data[starts]], CLASSES[data[ends - 1]]
        cols = [mean / 8, np.sqrt(np.maximum(np.add.reduceat(length * length, lead) / words - mean ** 2, 0)) / 8,
                distinct / words, np.add.reduceat(same[0], lead) / words,
                np.add.reduceat(same[1], lead) / words,
                np.add.reduceat((head == 1).astype(float), lead) / words,
                np.add.reduceat((end >= 5) & (end < 37), lead, dtype=float) / words,
                np.add.reduceat((length == 1).astype(float), lead) / words, words / PASSAGE]
        out[passage[lead], N_CLASSES:] = np.stack(cols, axis=1)
    return out, bag_first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class GatedAttention:
    """The network: encoder, gated attention over a bag, logistic unit."""

    def __init__(self, n_features: int, seed: int = 7):
        rng = np.random.default_rng(seed)

        def init(*shape):
            return rng.standard_normal(shape) / np.sqrt(shape[0])

        self.mean, self.scale, self.shift = np.zeros(n_features), np.ones(n_features), 0.0
        self.p = {"W": init(n_features, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, GATE),
                  "U": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray):
        """Logit of each bag, and what the gradient needs."""
        p, lead, per = self.p, first[:-1], np.diff(first)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, lead), per))
        a = e / np.repeat(np.add.reduceat(e, lead), per)
        z = np.add.reduceat(a[:, None] * h, lead)
        return z @ p["c"] + p["d"], (h, t, g, a, z)

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, prior: float) -> GatedAttention:
        """Full-batch Adam on the logistic loss. ``prior``: log odds of label 1 over all
        labels, less those of the sample, added to the logit afterwards."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        per, p = np.diff(first), self.p
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, EPOCHS + 1):
            logit, (h, t, g, a, z) = self.forward(x, first)
            dl = (_sigmoid(logit) - y) / len(y)
            dz = np.repeat(dl, per)[:, None] * p["c"]
            da = (dz * h).sum(axis=1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, first[:-1]), per))
            dt, dg = de[:, None] * p["w"] * g, de[:, None] * p["w"] * t
            dv, du = dt * (1 - t * t), dg * g * (1 - g)
            dh = (a[:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            grad = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du,
                    "w": ((t * g) * de[:, None]).sum(axis=0), "c": z.T @ dl, "d": dl.sum()[None]}
            for k, v in grad.items():
                v = v + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        self.shift = prior
        return self

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward((x - self.mean) / self.scale, first)[0] + self.shift)


class Constant:
    """Stands in where labels of one class at most are known."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x, first):
        return np.full(len(first) - 1, self.share)


def _feature_batches(batches):
    """Labelled documents -> their passages, evenly thinned to MAX_BAG, as bytes."""
    for batch in batches:
        for part in X.chunks(batch, limit=CHUNK):
            x, first = encode(part.column("text"))
            blobs = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                pick = np.arange(a, b) if b - a <= MAX_BAG else np.linspace(a, b - 1, MAX_BAG).astype(np.int64)
                blobs.append(x[pick].tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.string()), part.column("y"),
                                              pa.array(blobs, pa.binary())],
                                             names=["id", "y", "bag"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN):
    rows, counts = training_rows(docs, labels, label, max_train)
    got = sorted(((r["id"], r["y"], r["bag"]) for r in
                  rows.mapInArrow(_feature_batches, "id string, y int, bag binary").collect()))
    y = np.array([r[1] for r in got], float)
    if len(set(y)) < 2:
        total = sum(counts.values())
        return Constant(counts.get(1, 0) / total if total else 0.5)
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, N_FEATURES) for r in got]
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    prior = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return GatedAttention(N_FEATURES).fit(np.concatenate(bags).astype(np.float64), first, y, prior)


def _score_batches(model):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch, limit=CHUNK):
                x, first = encode(part.column("text"))
                score = model.score(x, first)
                cols = [part.column(c) for c in part.schema.names if c != "text"]
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score)], names=[*names, "score"])
    return run


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, score of every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score_batches(model),
                                                    f"doc_id {kind}, score double")


def _accept_batches(model, threshold: float):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch, limit=CHUNK):
                yield part.filter(pa.array(model.score(*encode(part.column("text"))) >= threshold))
    return run


def accepted(docs: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``."""
    arrow_batches(docs.sparkSession)
    box = boxed(docs)
    return unboxed(box.mapInArrow(_accept_batches(model, threshold), box.schema), docs.columns)


def predict(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    arrow_batches(docs.sparkSession)
    return score(docs, train(docs, labels, "quality", max_train)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents", "doc_id", "text"),
                   table(spark, sf_dir, "labels", "doc_id", "quality"))
