"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

score(x) = w0 + sum w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so a document costs time linear in its distinct features. Words enter with damped, length-normalised
counts in WORD_BINS hashed bins; the statistics of STATS are standardised over the training sample.
Training is on a bounded sample (training.SAMPLE_ROWS) of labelled rows.

Null texts count as empty; an empty text has a score (from its statistics alone). Repeated rows give
the same score each; rows are scored alone, so there are no ties. A very long text is a slice of its own:
memory is some hundred times its bytes. An empty table gives an empty result, and without labels all
scores are equal. Only doc_id (any type) and text are read, so further columns have no influence.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.training import SAMPLE_ROWS, adam, fold, labelled_sample, sigmoid

WORD_BINS, FACTORS = 2048, 8
KEEP_FROM = 0.7
STATS = ("log bytes", "log words", "word length", "capitals", "digits", "marks", "wide bytes", "line breaks", "distinct words", "word repeats", "line repeats", "short")


def features(data: np.ndarray, at: np.ndarray):
    """(statistics per row, row of each entry, bin of each entry, value of each entry), entries by row."""
    n, size = len(at) - 1, np.diff(at)
    start, end, row = T.words(data, at)
    count = np.bincount(row, minlength=n)
    hashes = T.span_hash(T.prefix_hash(data, T.FOLDED), start, end)

    def share(mask: np.ndarray) -> np.ndarray:
        ahead = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=ahead[1:])
        return (ahead[at[1:]] - ahead[at[:-1]]) / np.maximum(size, 1)

    letters = ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | (data >= 128)
    marks = (data > 32) & ~letters & ~((data >= 48) & (data <= 57))
    distinct = _distinct(row, hashes, n)
    same = np.zeros(n)
    if len(row) > 1:
        same = np.bincount(row[1:][(hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])], minlength=n) / np.maximum(count, 1)
    broken = np.zeros(len(data), bool)
    broken[data == 10] = True
    line_start = np.flatnonzero(np.concatenate([[True], broken[:-1]])) if len(data) else np.zeros(0, np.int64)
    line_start = np.union1d(line_start, at[:-1][size > 0])
    line_row = np.searchsorted(at, line_start, "right") - 1
    line_end = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    lines = np.bincount(line_row, minlength=n)
    line_kinds = _distinct(line_row, T.span_hash(T.prefix_hash(data), line_start, line_end), n)
    stats = np.stack(
        [np.log1p(size), np.log1p(count), np.bincount(row, end - start, minlength=n) / np.maximum(count, 1), share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57)), share(marks), share(data >= 128), share(broken), distinct / np.maximum(count, 1), same, 1 - line_kinds / np.maximum(lines, 1), count < 20],
        axis=1,
    ).astype(np.float32)
    key, times = np.unique(row * WORD_BINS + (hashes % np.uint64(WORD_BINS)).astype(np.int64), return_counts=True)
    value = np.log1p(times).astype(np.float32)
    entry_row = key // WORD_BINS
    norm = np.sqrt(np.bincount(entry_row, value * value, minlength=n))
    return stats, entry_row, key % WORD_BINS, value / np.maximum(norm, 1e-9)[entry_row].astype(np.float32)


def _distinct(row: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    if not len(row):
        return np.zeros(n)
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
    return np.bincount(r[new], minlength=n)


def fit(sample: DataFrame, steps: int = 160, rate: float = 0.03, decay: float = 2e-4) -> dict:
    """Trains on a bounded frame (text, label), in one task. With no row, or one class only, the score is
    constant. The driver gets the model alone, whatever the sample holds."""

    def encode(kept, data, at):
        stats, row, column, value = features(data, at)
        cut = T.per_row(row, len(at) - 1)
        pick = lambda x: [x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [kept[0], pa.array([s.tobytes() for s in stats], pa.binary()), pa.array(pick(column.astype(np.uint16)), pa.binary()), pa.array(pick(value), pa.binary())]

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=lambda r: (r[1:], r[0]))
        model = trained(rows, steps, rate, decay)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    encoded = T.map_texts(sample, ["label"], "text", encode, "label int, stats binary, bins binary, vals binary")
    found = encoded.repartition(1).mapInArrow(train_all, "model binary").collect()  # one row, none of an empty sample
    return pickle.loads(found[0].model) if found else trained([], steps, rate, decay)


def trained(rows: list[tuple], steps: int, rate: float, decay: float) -> dict:
    """The model of the rows (label, statistics, bins, values), in their order."""
    y = np.array([r[0] for r in rows], np.float32)
    width = WORD_BINS + len(STATS)
    if len(rows) < 2 or y.min() == y.max():
        rate_of_one = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return {"bias": float(np.log(rate_of_one / (1 - rate_of_one))), "w": np.zeros(width, np.float32), "v": np.zeros((width, FACTORS), np.float32), "mean": np.zeros(len(STATS), np.float32), "scale": np.ones(len(STATS), np.float32)}
    stats = np.stack([np.frombuffer(r[1], np.float32) for r in rows])
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    x = np.zeros((len(rows), width), np.float32)
    for k, r in enumerate(rows):
        x[k, np.frombuffer(r[2], np.uint16)] = np.frombuffer(r[3], np.float32)
    x[:, WORD_BINS:] = np.clip((stats - mean) / scale, -4, 4)
    x2 = x * x
    rng = np.random.default_rng(5)
    bias, w, v = np.array([np.log(y.mean() / (1 - y.mean()))], np.float32), np.zeros(width, np.float32), rng.normal(0, 0.02, (width, FACTORS)).astype(np.float32)

    def gradients(params):
        b, w, v = params
        s = x @ v
        g = (sigmoid(b[0] + x @ w + 0.5 * (s * s - x2 @ (v * v)).sum(1)) - y) / len(y)
        return [np.array([g.sum()], np.float32), x.T @ g + decay * w, x.T @ (g[:, None] * s) - v * (x2.T @ g)[:, None] + decay * v]

    bias, w, v = adam([bias, w, v], gradients, steps, rate)
    return {"bias": float(bias[0]), "w": w, "v": v, "mean": mean, "scale": scale}


def machine(model: dict, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores of the rows of one slice, by the sum-of-squares identity."""
    n = len(at) - 1
    stats, row, column, value = features(data, at)
    z = np.clip((stats - model["mean"]) / model["scale"], -4, 4)
    w, v = model["w"], model["v"]
    ws, vs = w[WORD_BINS:], v[WORD_BINS:]
    linear = z @ ws + np.bincount(row, w[column] * value, minlength=n)
    first, second = z @ vs, (z * z) @ (vs * vs)
    for f in range(v.shape[1]):
        part = v[column, f] * value
        first[:, f] += np.bincount(row, part, minlength=n)
        second[:, f] += np.bincount(row, part * part, minlength=n)
    return sigmoid(model["bias"] + linear + 0.5 * (first * first - second).sum(1)).astype(np.float64)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score of every row of docs."""
    return T.map_texts(docs, ["doc_id"], "text", lambda kept, data, at: [kept[0], machine(model, data, at)], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """The model of the query and of the pipeline: labels of crc32(doc_id) mod 4 = 2 are held out."""
    return fit(labelled_sample(docs, labels, "quality", fold("doc_id", 4) != 2, rows))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, train(docs, labels)).select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of KEEP_FROM or more, with all their columns."""
    model, place = train(docs, labels), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept = np.concatenate([machine(model, data, at) for _, _, data, at in T.slices(batch.column(place))] or [np.zeros(0)]) >= KEEP_FROM
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
