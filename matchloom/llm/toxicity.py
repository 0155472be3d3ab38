"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import pieces_of, text_or_empty
from matchloom.llm.sampling import labelled_sample, prior

SIZES = (3, 4, 5)
BUCKETS = 1 << 17
DIMENSIONS = 4
#: Labelled documents for fitting, for each label; the only bound on what is read.
PER_CLASS = 4_000
#: A subword in d of the sample's documents counts d / (d + SHRINK) times: the rarer, the nearer to no weight, but never none.
SHRINK = 8.0
EPOCHS = 8
BATCH = 128
#: A small sample is gone over more often, until there were so many steps.
MIN_STEPS = 300
RATE = 0.5
# averages over thousands of subwords are small; the softmax sees them enlarged
GAIN = 50.0

_WORD = np.full(256, 32, dtype=np.uint8)
_WORD[48:58], _WORD[97:123], _WORD[65:91], _WORD[128:] = range(48, 58), range(97, 123), range(97, 123), range(128, 256)


def subwords(texts) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, texts) of all runs of 3, 4 and 5 bytes of lower-case words, each with a blank at both ends.

    Words that share a stem or differ in a letter share most runs.
    """
    from matchloom.llm import bytesplit as B

    data, doc_starts = B.buffers(texts)
    x = np.concatenate((np.array([32], np.uint8), _WORD[data]))
    blank = x == 32
    before = np.concatenate(([0], np.cumsum(blank)))
    buckets, owners = [], []
    for size in SIZES:
        n = len(x) - size + 1
        if n <= 0:
            continue
        # blanks at the ends only, and a letter at least
        inner = before[size - 1 : size - 1 + n] - before[1 : 1 + n]
        at = np.flatnonzero((inner == 0) if size > 2 else inner >= 0)
        h = np.zeros(len(at), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j, odd in enumerate(B.odd_numbers(size, 31 + size)):
                h += (x[at + j].astype(np.uint64) + np.uint64(1)) * odd
        buckets.append((B.mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
        # the run's second byte is in its word, so in its text; x is one byte ahead of the texts
        owners.append(np.searchsorted(doc_starts, at, side="right") - 1)
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class ToxicityModel:
    """``weights`` holds each subword's part in the difference of the two logits.

    The softmax is linear in the average of embeddings, so scoring needs only the product of the two.
    """

    weights: np.ndarray
    bias: float

    def scores(self, texts) -> np.ndarray:
        buckets, owner = subwords(texts)
        n = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, weights=self.weights[buckets], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -30, 30)))


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text with their shrunken share of its subwords, where each text starts, and each bucket's factor."""
    import pyarrow as pa

    ids, shares, sizes = [], [], []
    # small pieces: the arrays of a piece are many times its size
    for batch in pieces_of([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])], 0, 500_000):
        buckets, owner = subwords(batch.column(0))
        whole = np.bincount(owner, minlength=batch.num_rows)
        key, count = np.unique(owner * BUCKETS + buckets, return_counts=True)
        own = key // BUCKETS
        ids.append((key % BUCKETS).astype(np.int32))
        shares.append((count / whole[own]).astype(np.float32))
        sizes.append(np.bincount(own, minlength=batch.num_rows))
    starts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    ids, shares = np.concatenate(ids), np.concatenate(shares)
    documents = np.bincount(ids, minlength=BUCKETS)
    scale = (documents / (documents + SHRINK)).astype(np.float32)
    return ids, shares * scale[ids], starts, scale


def fit(sample: list[tuple[str, int]], share: float, seed: int = 3) -> ToxicityModel:
    """Train embeddings and softmax together on (text, label); ``share`` is that of label 1 among all labels.

    Where a class is missing the score is the share. Every subword of the sample has a weight, shrunk by how few
    documents hold it. The sample is gone over ``EPOCHS`` times, a small one as often as makes ``MIN_STEPS`` steps.
    """
    y = np.array([v for _, v in sample], dtype=np.int64)
    odds = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return ToxicityModel(np.zeros(BUCKETS, np.float32), odds)
    ids, shares, starts, scale = _bags([t for t, _ in sample])
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    w = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    b = np.zeros(2, dtype=np.float32)
    e2, w2, b2 = np.full(e.shape, 1e-6, np.float32), np.full(w.shape, 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    epochs = max(EPOCHS, MIN_STEPS * BATCH // len(y))
    for epoch in range(epochs):
        order, rate = rng.permutation(len(y)), RATE * (1 - epoch / epochs)
        for lo in range(0, len(y), BATCH):
            docs = order[lo : lo + BATCH]
            docs = docs[starts[docs + 1] > starts[docs]]
            if not len(docs):
                continue
            sizes = starts[docs + 1] - starts[docs]
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            at = np.arange(int(sizes.sum())) - np.repeat(first, sizes) + np.repeat(starts[docs], sizes)
            own, part = ids[at], shares[at] * GAIN
            v = np.add.reduceat(e[own] * part[:, None], first)
            z = v @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), y[docs]] -= 1
            p /= len(docs)
            dv, dw, db = p @ w.T, v.T @ p, p.sum(0)
            touched, place = np.unique(own, return_inverse=True)
            spread = np.repeat(np.arange(len(docs)), sizes)
            de = np.stack([np.bincount(place, part * dv[spread, k], len(touched)) for k in range(DIMENSIONS)], 1).astype(np.float32)
            e2[touched] += de**2
            e[touched] -= rate * 0.2 * de / np.sqrt(e2[touched])
            w2 += dw**2
            w -= rate * 0.2 * dw / np.sqrt(w2)
            b2 += db**2
            b -= rate * 0.2 * db / np.sqrt(b2)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    known = np.unique(ids)
    weights[known] = GAIN * scale[known] * (e[known] @ (w[:, 1] - w[:, 0]))
    balance = float(np.log(y.sum() / (len(y) - y.sum())))
    return ToxicityModel(weights, float(b[1] - b[0]) + odds - balance)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts have the score of a text without subwords."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed

    def run(batches):
        own = shared.value
        for b in pieces_of(batches, 1, 1_000_000):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.scores(b.column(1)))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """Fit on ``labels`` (doc_id, ``label``) and score all of ``docs``: (doc_id, score), one row per row.

    Scores depend on texts only. The fit takes at most ``per_class`` documents of each label; repeated rows
    and ties are scored alike; other columns are not read; empty tables give no row.
    """
    return score(docs, fit(labelled_sample(docs, labels, label, per_class), prior(labels, label)))
