"""Toxicity by FTRL-proximal logistic regression (operator 10).

A document's features are the distinct hashes, in ``2**BITS`` buckets, of its words, word
pairs, skip pairs (one word between) and word stems (the first bytes of longer words, so
that inflected forms share what is learned).  The model is fitted by FTRL-proximal: each
coordinate has its own learning rate from the gradients that it has seen, and L1 keeps most
weights at exactly zero, so that the weights that are broadcast are few.

It is fitted on the driver from a bounded sample of labelled rows outside fold 0 (about
``SAMPLE`` documents, picked by hash, with all their features; a document has at most
``2**BITS``); scoring covers every row in one scan without a shuffle.  A score is the logistic of the
weights of the features that a document has, so that clean text of any length adds nothing.

Null and empty texts have only the bias.  Without labels of both kinds the score is the
share of toxic labels (0.5 if there are none).  Repeated labels of a document count once,
toxic if any is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bounded_batches, drop, fold, save, steps, table

BITS = 20
SAMPLE = 12_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1.0, 0.1
STEMS = (4, 5, 6, 7)
EPOCHS = 6

_PAIR, _SKIP = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_PUNCT = bytes(32 if (33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126) else c for c in range(256))


def features(col: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, ascending, and text offsets."""
    raw, at = tk.buffers(col)
    if len(raw):
        raw = np.frombuffer(raw.tobytes().translate(_PUNCT), np.uint8)
    starts, ends = tk.spans(raw, at)  # words lie between white space and ASCII punctuation
    ids, at = tk.span_hashes(raw, starts, ends), np.searchsorted(starts, at)
    shift = np.uint64(64 - bits)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    found = [(owner, ids)]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        if len(ids) > gap:
            same = owner[gap:] == owner[:-gap]
            found.append((owner[gap:][same], tk.mix((ids[:-gap] * salt + ids[gap:]))[same]))
    for n in STEMS:
        longer = np.flatnonzero(ends - starts > n)
        stems = tk.span_hashes(raw, starts[longer], starts[longer] + n)
        found.append((owner[longer], tk.mix(stems + np.uint64(n))))
    own = np.concatenate([o for o, _ in found]).astype(np.uint64)
    keys = (own << np.uint64(bits)) | (np.concatenate([v for _, v in found]) >> shift)
    keys = np.unique(keys)
    own = (keys >> np.uint64(bits)).astype(np.int64)
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), np.searchsorted(own, np.arange(len(at)))


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; features are 0 or 1."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    @property
    def bias(self) -> float:
        return float(-self.bias_z / ((self.beta + np.sqrt(self.bias_n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w, bias = self.weights(at), self.bias
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
        g = p - y
        g2 = g * g
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g2) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g2
        self.bias_z += g - (np.sqrt(self.bias_n + g2) - np.sqrt(self.bias_n)) / self.alpha * bias
        self.bias_n += g2


def labelled(docs: DataFrame, labels: DataFrame, test_mod: int = 5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, y of at most about ``sample`` labelled documents outside fold 0."""
    marks = labels.filter((fold("doc_id", test_mod) != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    n = marks.count()
    if n > sample:
        bound = F.lit(int((1 << 30) * sample / n))
        marks = marks.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < bound)
        docs = docs.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < bound)
    return docs.filter(fold("doc_id", test_mod) != 0).select("doc_id", "text").join(marks, "doc_id")


def train(docs: DataFrame, labels: DataFrame, test_mod: int = 5, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature numbers, weights, bias) of the non-zero weights."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            f, at = features(step.column("text"), bits)
            rows = [f[a:b] for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("y"), pa.array([x.tobytes() for x in rows], pa.binary())], names=["doc_id", "y", "f"])

    # Made on all executors at once, then read part by part.
    made = save(labelled(docs, labels, test_mod).mapInArrow(run, "doc_id bigint, y int, f binary"), "features")
    rows = [(r["doc_id"], r["y"], bytes(r["f"])) for r in made.toLocalIterator()]
    drop(made)
    # One order whatever the partitions; repeated rows stay.
    rows.sort(key=lambda r: (r[0], r[2]))
    ys = [y for _, y, _ in rows]
    empty = np.empty(0, np.int64), np.empty(0)
    if len(set(ys)) < 2:
        share = np.clip(np.mean(ys), 1e-6, 1 - 1e-6) if ys else 0.5
        return *empty, float(np.log(share / (1 - share)))
    model, rng = Ftrl(1 << bits), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            model.learn(np.frombuffer(rows[i][2], np.int32), rows[i][1])
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    return at, w[at], model.bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], test_mod: int = 5, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = sent.value
        weights = np.zeros(1 << bits)
        weights[at] = w
        for step in steps(batches, "text", 2 << 20):
            f, to = features(step.column("text"), bits)
            x = tk.segment_sums(weights[f], to) + bias
            p = 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), step.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", F.coalesce(fold("doc_id", test_mod) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
