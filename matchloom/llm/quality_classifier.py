"""Document quality by random-indexing word vectors and a small network."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import pieces_of, text_or_empty
from matchloom.llm.sampling import labelled_sample, prior

BUCKETS = 1 << 15
DIMENSIONS = 48
NONZERO = 6
CONTEXT = 2
HIDDEN = 24
#: Labelled documents for fitting, for each label; the only bound on what is read.
PER_CLASS = 2_000
EPOCHS = 60


def _character_classes() -> np.ndarray:
    """Lower, upper, digit and other letters; each mark of punctuation is a class of its own."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 1, 2, 3, 4
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


CLASSES = _character_classes()


def tokens(data: np.ndarray, starts: np.ndarray, doc_starts: np.ndarray, ends: np.ndarray):
    """(buckets, texts) of two streams: words in lower case, and runs of characters of one class."""
    from matchloom.llm import bytesplit as B

    words = B.word_hashes(B.LOWER[data], starts, ends, 21)
    kind = CLASSES[data]
    edge = np.flatnonzero(np.diff(kind, prepend=255) != 0)
    length = np.diff(np.append(edge, len(kind)))
    runs = kind[edge]
    keep = runs > 0
    # a run of one, two, or more characters
    code = runs[keep].astype(np.uint64) * np.uint64(4) + np.minimum(length[keep], 3).astype(np.uint64)
    run_hash = B.mix(code + np.uint64(1 << 40))
    mask = np.uint64(BUCKETS - 1)
    return (
        ((words & mask).astype(np.int64), B.texts_of_words(doc_starts, starts)),
        ((run_hash & mask).astype(np.int64), B.texts_of_words(doc_starts, edge[keep])),
    )


def index_vectors(seed: int = 5) -> np.ndarray:
    """A sparse random vector of ones and minus ones for every bucket."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    at = rng.integers(0, DIMENSIONS, (BUCKETS, NONZERO))
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], dtype=np.float32), (BUCKETS, NONZERO)), axis=1)
    return out


def context_vectors(streams, index: np.ndarray) -> np.ndarray:
    """Random indexing: every bucket's sum of the index vectors of its neighbours, plus its own, scaled to length one."""
    total = np.zeros_like(index)
    for buckets, owner in streams:
        for step in range(1, CONTEXT + 1):
            same = owner[step:] == owner[:-step]
            left, right = buckets[:-step][same], buckets[step:][same]
            for word, neighbour in ((left, right), (right, left)):
                for lo in range(0, len(word), 100_000):
                    w, n = word[lo : lo + 100_000], neighbour[lo : lo + 100_000]
                    order = np.argsort(w, kind="stable")
                    first = np.flatnonzero(np.diff(w[order], prepend=-1))
                    total[w[order][first]] += np.add.reduceat(index[n[order]], first)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    vectors = total / np.maximum(norm, 1e-9) + index / np.sqrt(NONZERO)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _mean_by_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]), dtype=np.float64)
    if len(owner):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        sums = np.add.reduceat(values, first)
        out[owner[first]] = sums / np.diff(np.append(first, len(owner)))[:, None]
    return out


def pooled(streams, n: int, vectors: np.ndarray) -> np.ndarray:
    """A row per text: mean vectors of both streams, their lengths, and shares of repeated neighbours."""
    parts = []
    for buckets, owner in streams:
        mean = np.zeros((n, vectors.shape[1]))
        # long texts in bounded memory
        bounds = np.searchsorted(owner, np.arange(n + 1))
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + 200_000, side="right")) - 1)
            a, b = bounds[lo], bounds[hi]
            mean[lo:hi] = _mean_by_text(vectors[buckets[a:b]], owner[a:b] - lo, hi - lo)
            lo = hi
        again = np.zeros(len(owner))
        again[1:] = (buckets[1:] == buckets[:-1]) & (owner[1:] == owner[:-1])
        parts += [mean, np.linalg.norm(mean, axis=1, keepdims=True), _mean_by_text(again[:, None], owner, n)]
    return np.hstack(parts)


def features(texts, vectors: np.ndarray) -> np.ndarray:
    from matchloom.llm import bytesplit as B

    data, doc_starts = B.buffers(texts)
    starts, ends = B.word_spans(data)
    return pooled(tokens(data, starts, doc_starts, ends), len(texts), vectors)


@dataclass
class QualityModel:
    """``bias`` moves the balanced sample's odds to those of all labels."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature + self.bias, -30, 30)))


def _train(x: np.ndarray, y: np.ndarray, rng) -> tuple:
    w = {
        "w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "b2": np.zeros(1),
    }
    m, v, step = {k: 0 * a for k, a in w.items()}, {k: 0 * a for k, a in w.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 256):
            at = order[lo : lo + 256]
            h = np.tanh(x[at] @ w["w1"] + w["b1"])
            p = 1 / (1 + np.exp(-np.clip(h @ w["w2"] + w["b2"], -30, 30)))
            d = (p - y[at]) / len(at)
            dh = np.outer(d, w["w2"]) * (1 - h * h)
            g = {"w1": x[at].T @ dh + 1e-4 * w["w1"], "b1": dh.sum(0), "w2": h.T @ d + 1e-4 * w["w2"], "b2": d.sum(keepdims=True)}
            step += 1
            for k in w:  # Adam
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return w["w1"], w["b1"], w["w2"], float(w["b2"][0])


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the fit has not seen."""
    grid = np.geomspace(0.25, 8, 41)
    loss = [np.mean(np.logaddexp(0, np.where(y == 1, -logits, logits) / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(sample: list[tuple[str, int]], share: float, seed: int = 3) -> QualityModel:
    """Fit on (text, label); ``share`` is that of label 1 among all labels.

    Each class has the same weight in the sample; where a class is missing the score is the share.
    """
    import pyarrow as pa

    from matchloom.llm import bytesplit as B

    index, streams = index_vectors(), [[], []]
    texts, y = pa.array([t for t, _ in sample], pa.string()), np.array([v for _, v in sample], dtype=np.float64)
    seen = 0
    for batch in pieces_of([pa.RecordBatch.from_arrays([texts], ["t"])], 0):
        data, doc_starts = B.buffers(batch.column(0))
        starts, ends = B.word_spans(data)
        for stream, (buckets, owner) in zip(streams, tokens(data, starts, doc_starts, ends), strict=True):
            stream.append((buckets, owner + seen))
        seen += batch.num_rows
    joined = [tuple(np.concatenate(a) for a in zip(*s, strict=True)) if s else (np.zeros(0, np.int64),) * 2 for s in streams]
    vectors = context_vectors(joined, index)
    x = pooled(joined, len(y), vectors)
    width = x.shape[1]
    ones = y.sum()
    if not 0 < ones < len(y):
        return QualityModel(vectors, np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    order = rng.permutation(len(y))
    held, own = order[: len(y) // 8], order[len(y) // 8 :]
    z = (x - mean) / scale
    w1, b1, w2, b2 = _train(z[own], y[own], rng)
    model = QualityModel(vectors, mean, scale, w1, b1, w2, b2, 1.0, 0.0)
    if len(held):
        model.temperature = temperature_of(model.logits(x[held]), y[held])
    model.bias = float(np.log(share / (1 - share)) - np.log(ones / (len(y) - ones)))
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts have the score of a text without words."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed

    def run(batches):
        own = shared.value
        for b in pieces_of(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.scores(features(b.column(1), own.vectors)))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """Fit on ``labels`` (doc_id, ``label``) and score all of ``docs``: (doc_id, score), one row per row.

    Scores depend on texts only. The fit takes at most ``per_class`` documents of each label; repeated rows
    and ties are scored alike; other columns are not read; empty tables give no row.
    """
    return score(docs, fit(labelled_sample(docs, labels, label, per_class), prior(labels, label)))
