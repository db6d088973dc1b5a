"""Threshold-scaled sketches: every five-word shingle whose hash is below a fixed fraction is kept.

Because the threshold is the same for all texts, the sketch of a union is the union of sketches
(merge), and the share of a small sketch found in a large one estimates how much of the small
document the large one contains, however unequal they are. A sketch that would be empty keeps its
smallest hash instead, so that short texts stay comparable with their copies.

A fingerprint is the ascending kept hashes, 16 hex digits each, in one string. Null and empty texts
have the empty fingerprint; two empty fingerprints have likeness 1, an empty and another one 0. Equal
texts have equal fingerprints. A very long text is a slice of its own: memory is some hundred times its
bytes. An empty table gives an empty result. Only doc_id and text are read, so extra columns have no
influence; doc_id must be a number or cast to one, else it is an error.

The next document is the next row by (doc_id, text), nulls first; repeated ids are thus neighbours,
and after the last row comes the first. A table of one row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm import textops as T

FRACTION, SHINGLE = 8, 5  # one hash in FRACTION is kept
_LIMIT = np.uint64((1 << 64) // FRACTION)


def sketches(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The kept hashes of every row, ascending."""
    n = len(at) - 1
    start, end, row = T.words(data, at)
    hashes, row = T.shingles(T.span_hash(T.prefix_hash(data), start, end), row, n, SHINGLE)
    cut = T.per_row(row, n)
    keep = hashes < _LIMIT
    lone = np.flatnonzero((np.diff(cut) > 0) & (np.bincount(row[keep], minlength=n) == 0))
    for r in lone:
        keep[cut[r] + int(np.argmin(hashes[cut[r] : cut[r + 1]]))] = True
    hashes, row = hashes[keep], row[keep]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return np.split(hashes[new], T.per_row(row[new], n)[1:-1]) if n else []


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def merge(a: str, b: str) -> str:
    """The fingerprint of two documents taken together (for texts with at least one kept shingle)."""
    return as_text(np.union1d(from_text(a), from_text(b)))


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(containment of the smaller in the larger, Jaccard similarity) of two ascending sketches."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / min(len(a), len(b)), both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return T.map_texts(docs, ["doc_id"], "text", lambda kept, data, at: [kept[0], pa.array([as_text(s) for s in sketches(data, at)], pa.string())], f"doc_id {kind}, fingerprint string")


def _range_cuts(ids: DataFrame, ranges: int) -> np.ndarray:
    """Ascending ids that split the rows into about `ranges` equal ranges (as many values at most)."""
    cuts = ids.select(F.percentile_approx("_key", F.array(*[F.lit(k / ranges) for k in range(1, ranges)]), F.lit(20 * ranges))).first()[0]
    return np.unique(np.array(cuts or [], np.int64))


def _range_firsts(ids: DataFrame, cuts: np.ndarray) -> list[tuple[int, int]]:
    """(range, smallest id) of every range that has rows; each task sends one row for a range."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for batch in batches:
            key = np.sort(batch.column(0).to_numpy())
            place, first = np.unique(np.searchsorted(cuts, key, "right"), return_index=True)
            for r, k in zip(place.tolist(), key[first].tolist(), strict=True):
                best[r] = min(k, best.get(r, k))
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array(list(best.values()), pa.int64())], names=["r", "k"])

    rows = ids.mapInArrow(least, "r int, k long").groupBy("r").agg(F.min("k").alias("k")).collect()
    return sorted((r.r, r.k) for r in rows)


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (_range, _wrap, _own, doc_id, text), sorted in each partition so that a row's next document
    is the row below it.

    The rows are cut into ranges of doc_id at approximate quantiles, a few ranges for each shuffle
    partition. The first row of a range also goes to the range before it, that of the first range to
    the last one: one shuffle of the texts is enough, and tasks stream through sorted ranges.
    """
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = _range_cuts(keyed.select("_key"), 4 * parts)
    firsts = _range_firsts(keyed.select("_key"), cuts)
    before = {k: (firsts[i - 1][0], int(i == 0)) for i, (_, k) in enumerate(firsts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(sorted(before), np.int64)
        for batch in batches:
            key = batch.column(1).to_numpy()
            place = np.searchsorted(cuts, key, "right")
            again = np.flatnonzero(np.isin(key, known))
            zeros = np.zeros(len(key), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(zeros), pa.array(zeros == 0), *batch.columns], names=[*"rwodkt"])
            if len(again):
                to = [before[k] for k in key[again].tolist()]
                extra = batch.take(pa.array(again))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in to], pa.int32()), pa.array([x[1] for x in to], pa.int32()), pa.array(np.zeros(len(to), bool)), *extra.columns], names=[*"rwodkt"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = keyed.mapInArrow(deal, f"_range int, _wrap int, _own boolean, doc_id {kind}, _key long, text string")
    return dealt.repartition(parts, "_range").sortWithinPartitions("_range", "_wrap", "_key", "text", F.desc("_own")).drop("_key")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and the
    Jaccard estimates jaccard_edited, jaccard_next, for every row. near_* are containments."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double, jaccard_next double"
    arrow = [pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            for i, j, _, _ in T.slices(batch.column(4)):
                part = batch.slice(i, j - i)
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                held = part.slice(len(part) - 1, 1)
                if len(part) < 2:
                    continue
                place, own = part.column(0).to_numpy(), part.column(2).to_numpy(zero_copy_only=False)
                texts = part.column(4).to_pylist()
                sketch = sketches(*T.buffers(part.column(4)))
                rows = [k for k in range(len(part) - 1) if own[k] and place[k] == place[k + 1]]
                new = [edited(texts[k], texts[k + 1]).encode() for k in rows]
                after = sketches(*T.buffers(pa.array(new, pa.binary())))
                near = [(likeness(sketch[k], e), likeness(sketch[k], sketch[k + 1])) for k, e in zip(rows, after, strict=True)]
                columns = [[len(texts[k]) for k in rows], [hashlib.sha256(x).hexdigest() for x in new], [as_text(sketch[k]) for k in rows], [as_text(x) for x in after], [a[0] for a, _ in near], [b[0] for _, b in near], [a[1] for a, _ in near], [b[1] for _, b in near]]
                yield pa.RecordBatch.from_arrays([part.column(3).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, arrow, strict=True)]], names=[f.split()[0] for f in schema.split(", ")])

    return neighbours(docs).mapInArrow(run, schema)
