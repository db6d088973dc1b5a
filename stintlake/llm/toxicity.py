"""Toxicity: embeddings of subword n-grams, averaged over the text, under a linear softmax.

A word's n-grams (3 to 5 bytes, blanks standing for its edges) share their vectors with every word
that has them, so an unseen misspelling keeps most of the vector of the word it comes from. Every hashed
n-gram has a vector. Vectors and softmax are trained together in numpy, in small batches over a bounded
sample (SAMPLE_ROWS). The average is weighted: an n-gram whose share of documents differs by z standard
errors between the classes of the sample weighs z^4 / (z^4 + CLEAR^4), so the many that are common in both
don't drown the few that tell.

Null texts count as empty; a text without n-grams gets the score of the bias. Repeated rows give the
same score each; ties don't occur, as each row is scored alone. A very long text is one slice: memory is a
few hundred times its bytes at most. An empty table gives an empty result. Only doc_id (any type) and
text are read, so extra columns have no influence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.scratch import keep
from stintlake.llm.training import fold, labelled_sample, sigmoid

BINS, WIDTH, LENGTHS, CLEAR = 1 << 16, 4, (3, 4, 5), 4.0
TOXIC_FROM = 0.5
#: Neutral n-grams added to every text, so that a few n-grams of a short text don't decide alone.
NEUTRAL = 40
#: The bound of the training sample, in documents.
SAMPLE_ROWS = 8000
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_fold[[c for c in range(128) if not chr(c).isalpha()]] = 32


def subwords(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and row of every n-gram, grouped by length, rows in order within each. Each row stands between
    blanks, so its n-grams don't depend on its neighbours."""
    n = len(at) - 1
    clean = np.full(len(data) + n + 1, 32, np.uint8)
    clean[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = _fold[data]
    edge = at[:-1] + np.arange(n)  # the blank before each row
    blank = clean == 32
    code = T.byte_table(21)[clean]
    bins, rows = [], []
    for size in LENGTHS:
        m = len(clean) - size + 1
        if m <= 0:
            continue
        value, good = code[:m].copy(), np.ones(m, bool)
        for k in range(1, size):
            value = value * np.uint64(0x9E3779B97F4A7C15) + code[k : k + m]
            if k < size - 1:
                good &= ~blank[k : k + m]
        spot = np.flatnonzero(good)
        bins.append((T.mix(value[spot]) % np.uint64(BINS)).astype(np.int64))
        rows.append(np.searchsorted(edge, spot, "right") - 1)
    return (np.concatenate(bins), np.concatenate(rows)) if bins else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def weights(parts: list[tuple], y: np.ndarray) -> np.ndarray:
    """Weight of every bin, from how its share of documents differs between the classes."""
    seen = np.zeros((2, BINS))
    for (bins, _, _), label in zip(parts, y, strict=True):
        seen[int(label), bins] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])[:, None]
    p = (seen + 0.5) / (n + 1)
    z = (p[1] - p[0]) ** 4 / ((p * (1 - p) / n).sum(0)) ** 2
    return (z / (z + CLEAR**4)).astype(np.float32)


def fit(sample: DataFrame, epochs: int = 3, batch: int = 64, rate: float = 0.5, decay: float = 1e-5) -> dict:
    """Trains on a bounded frame (text, label) by AdaGrad. With one class or no row the score is constant.

    The encoded sample is stored and read a partition at a time, so the driver's JVM holds one partition
    of it; Python holds bins and counts (6 bytes an n-gram), and features of the batch at work only.
    """

    def encode(kept, data, at):
        bins, rows = subwords(data, at)
        n = len(at) - 1
        key, times = np.unique(rows * BINS + bins, return_counts=True)
        cut = T.per_row(key // BINS, n)
        pick = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
        return [*kept, np.bincount(rows, minlength=n), pick((key % BINS).astype(np.uint16)), pick(times.astype(np.uint32))]

    ordered = sample.select("label", "text").orderBy(F.xxhash64("text"), "text", "label").withColumn("place", F.monotonically_increasing_id())
    stored = keep(T.map_texts(ordered, ["label", "place"], "text", encode, "label int, place long, total long, bins binary, times binary"))
    placed = [(r.place, r.label, np.frombuffer(r.bins, np.uint16), np.frombuffer(r.times, np.uint32), r.total) for r in stored.toLocalIterator()]
    placed.sort(key=lambda r: r[0])
    y, parts = np.array([r[1] for r in placed], np.float32), [r[2:] for r in placed]
    if len(parts) < 2 or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return {"e": np.zeros((BINS, WIDTH), np.float32), "w": np.zeros((WIDTH, 2), np.float32), "b": np.log(np.array([1 - p, p], np.float32))}
    weight = weights(parts, y)
    share = lambda part: part[1] * weight[part[0]] / np.float32(part[2] + NEUTRAL)
    scale = np.float32(1 / max(np.sqrt(np.mean([(s * s).sum() for s in map(share, parts)])), 1e-9))
    rng = np.random.default_rng(7)
    e, w, b = rng.normal(0, 0.1, (BINS, WIDTH)).astype(np.float32), rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    steps = [np.full_like(x, 1e-6) for x in (e, w, b)]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in range(0, len(parts), batch):
            some, label = parts[k : k + batch], y[k : k + batch].astype(int)
            own = np.repeat(np.arange(len(some)), [len(p[0]) for p in some])
            bins, at = np.unique(np.concatenate([p[0] for p in some]), return_inverse=True)
            x = np.concatenate([share(p) for p in some]) * scale
            near = e[bins]
            sums = lambda index, values, size: np.stack([np.bincount(index, v, minlength=size) for v in values.T], axis=1).astype(np.float32)
            h = sums(own, near[at] * x[:, None], len(some))
            g = softmax(h @ w + b)
            g[np.arange(len(some)), label] -= 1
            g /= len(some)
            de = sums(at, (g @ w.T)[own] * x[:, None], len(bins)) + decay * near
            steps[0][bins] += de * de
            e[bins] = near - step * de / np.sqrt(steps[0][bins])
            for p, s, d in ((w, steps[1], h.T @ g), (b, steps[2], g.sum(0))):
                s += d * d
                p -= step * d / np.sqrt(s)
    return {"e": e * (weight * scale)[:, None], "w": w, "b": b}


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def toxic_share(model: dict, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The softmax of the averaged vectors. It is linear up to the softmax, so what each bin adds to the
    difference of the two classes is looked up and summed."""
    n = len(at) - 1
    bins, rows = subwords(data, at)
    total = np.bincount(rows, minlength=n) + NEUTRAL
    apart = (model["e"] @ (model["w"][:, 1] - model["w"][:, 0])).astype(np.float64)
    return sigmoid(np.bincount(rows, apart[bins], minlength=n) / total + float(model["b"][1] - model["b"][0]))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Labels of crc32(doc_id) mod 5 = 0 are held out."""
    return fit(labelled_sample(docs, labels, "toxic", fold("doc_id", 5) != 0, rows))


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    scored = T.map_texts(docs, ["doc_id"], "text", lambda kept, data, at: [kept[0], toxic_share(model, data, at)], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
