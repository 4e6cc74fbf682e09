"""Operator 5: toxicity by classifier chains.

A chain predicts toxicity categories one after the other: each link is a linear
(logistic) model over word features plus the probabilities of all earlier links. While
learning, those probabilities are out-of-fold predictions, so a later link sees the kind
of input that it will get on new texts; the links kept are refitted on all rows.

``fit_chain`` takes any list of 0/1 targets. The test tables hold one ``toxic`` flag, so
``train`` derives categories: the toxic training documents fall into ``KINDS`` groups by
the discriminating words that they use (spherical k-means); the chain predicts the groups,
the largest first, and then ``toxic`` itself from the words and the group probabilities.

Features are presence of words and of their 4- and 6-byte beginnings (A-Z lower-cased),
so inflected forms share evidence. Fitting uses a bounded sample of ``max_train`` labelled
documents and up to ``VOCABULARY`` features that tell the classes apart; scoring reads whole texts
and is a map over rows.

Defined cases: null, empty and wordless texts have no features and get the base score;
null ids are scored (not held out); repeated rows are scored each; without labels of both
classes the score is the share of toxic labels (0 without labels); empty table, empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm import _text as X
from tamper.llm._learn import MAX_TRAIN, held_out, training_rows
from tamper.llm._spark import arrow_batches, table

KINDS, VOCABULARY, FOLDS = 3, 800, 3
SUPPORT, TELLING = 3, 6.0  # documents with a feature, chi-square over chance
EPOCHS, RATE, RIDGE = 150, 0.15, 2e-4
PREFIXES = (4, 6)
LETTERS = X.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, 32-bit feature) for every word and word beginning of a string column."""
    data, offsets = X.text_bytes(column)
    data = X.LOWER[data]
    starts, ends, first = X.words(data, offsets, LETTERS)
    row = X.owners(first)
    rows, found = [row], [X.hash_spans(data, starts, ends)]
    for n in PREFIXES:
        pick = np.flatnonzero(ends - starts > n)
        rows.append(row[pick])
        found.append(X.hash_spans(data, starts[pick], starts[pick] + n, base=0xA0761D6478BD642F))
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(32)).astype(np.uint32)


def _pairs(row: np.ndarray, feature: np.ndarray):
    """Distinct (row, feature), sorted."""
    both = np.unique((row.astype(np.uint64) << np.uint64(32)) | feature)
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _feature_batches(batches):
    for batch in batches:
        for part in X.chunks(batch):
            row, feature = _pairs(*features(part.column("text")))
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
            blobs = [feature[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.string()), part.column("y"),
                                              pa.array(blobs, pa.binary())], names=["id", "y", "found"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias (last) of a ridge logistic model, by full-batch Adam. The classes
    weigh alike: missing a rare category costs as much as a false alarm."""
    w, m, s = (np.zeros(x.shape[1] + 1) for _ in range(3))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    for step in range(1, EPOCHS + 1):
        error = weight * (_sigmoid(x @ w[:-1] + w[-1]) - y) / len(y)
        grad = np.append(error @ x + RIDGE * w[:-1], error.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return w


def _chance(x: np.ndarray, earlier: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    logit = x @ w[:n] + w[-1]
    for p, v in zip(earlier, w[n:-1], strict=True):
        logit = logit + v * p
    return _sigmoid(logit)


def fit_chain(x: np.ndarray, targets: list[np.ndarray], folds: int = FOLDS) -> list[np.ndarray]:
    """One weight vector for each target: [features, earlier probabilities, bias]."""
    fold = np.arange(len(x)) % folds
    earlier, chain = [], []
    for y in targets:
        full = np.column_stack([x, *earlier]) if earlier else x
        chain.append(logistic(full, y))
        p = np.empty(len(x))
        for k in range(folds):
            out = fold == k
            p[out] = _chance(x[out], [e[out] for e in earlier], logistic(full[~out], y[~out]))
        earlier.append(p)
    return chain


def kinds_of(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means over rows, started from mutually distant rows."""
    unit = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
    seeds = [int(np.argmax(x.sum(axis=1)))]
    for _ in range(1, k):
        seeds.append(int(np.argmin((unit @ unit[seeds].T).max(axis=1))))
    centre = unit[seeds]
    for _ in range(rounds):
        group = np.argmax(unit @ centre.T, axis=1)
        centre = np.stack([unit[group == g].sum(axis=0) if (group == g).any() else centre[g]
                           for g in range(k)])
        centre = centre / (np.linalg.norm(centre, axis=1, keepdims=True) + 1e-9)
    return group


class Chain:
    def __init__(self, vocabulary: np.ndarray, links: list[np.ndarray]):
        self.vocabulary, self.links = vocabulary, links

    def score(self, column: pa.Array) -> np.ndarray:
        """Probabilities (rows, links) of every text."""
        row, feature = features(column)
        at = np.minimum(np.searchsorted(self.vocabulary, feature), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == feature
        row, at = _pairs(row[known], at[known].astype(np.uint32))
        n, out = len(column), []
        for w in self.links:
            logit = np.bincount(row, weights=w[at], minlength=n) + w[-1]
            for p, v in zip(out, w[len(self.vocabulary):-1], strict=True):
                logit = logit + v * p
            out.append(_sigmoid(logit))
        return np.stack(out, axis=1)


class Constant:
    def __init__(self, share: float, links: int):
        self.share, self.links = share, links

    def score(self, column):
        return np.full((len(column), self.links), self.share)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, kinds: int = KINDS):
    rows, counts = training_rows(docs, labels, "toxic", max_train)
    got = sorted((r["id"], r["y"], r["found"]) for r in
                 rows.mapInArrow(_feature_batches, "id string, y int, found binary").collect())
    y = np.array([r[1] for r in got], float)
    if len(set(y)) < 2:
        total = sum(counts.values())
        return Constant(counts.get(1, 0) / total if total else 0.0, kinds + 1)
    sets = [np.frombuffer(r[2], np.uint32) for r in got]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known, index = np.unique(np.concatenate(sets), return_inverse=True)
    a = np.bincount(index, weights=y[row], minlength=len(known))  # toxic documents with it
    b = np.bincount(index, minlength=len(known)) - a
    pos, neg = y.sum(), len(y) - y.sum()
    # chi-square of presence against the label
    expect = (a + b) / len(y)
    chi = (a - expect * pos) ** 2 / (expect * pos + 1) + (b - expect * neg) ** 2 / (expect * neg + 1)
    chi[a + b < SUPPORT] = -1  # seen in fewer documents: chance
    pick = np.sort(np.argsort(-chi, kind="stable")[:min(VOCABULARY, max(1, (chi > TELLING).sum()))])
    place = np.full(len(known), -1)
    place[pick] = np.arange(len(pick))
    x = np.zeros((len(sets), len(pick)), np.float32)
    keep = place[index] >= 0
    x[row[keep], place[index][keep]] = 1
    toxic = np.flatnonzero(y)
    telling = a[pick] / pos > b[pick] / neg
    group = kinds_of(x[toxic][:, telling] + 0.0, kinds)
    targets = []
    for g in np.argsort(-np.bincount(group, minlength=kinds), kind="stable"):
        t = np.zeros(len(y))
        t[toxic[group == g]] = 1
        targets.append(t)
    return Chain(known[pick], fit_chain(x, [*targets, y]))


def _score_batches(model):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch):
                p = model.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p[:, -1]), pa.array(p[:, :-1].tolist(), pa.list_(pa.float64()))],
                    names=["doc_id", "score", "kinds"])
    return run


def predict(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score (probability of ``toxic``), predicted (1 if score >= 0.5) and
    kind_1.. (probability of each category in chain order) of every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    model = train(docs, labels, max_train)
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = docs.select("doc_id", "text").mapInArrow(
        _score_batches(model), f"doc_id {kind}, score double, kinds array<double>")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                      *[F.col("kinds")[k].alias(f"kind_{k + 1}") for k in range(KINDS)])


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents", "doc_id", "text"),
                   table(spark, sf_dir, "labels", "doc_id", "toxic"))
