"""Importance resampling towards a target distribution, with exact weights by bit-sliced aggregation.

Features are runs of LOW to HIGH consecutive words; a feature's bucket is its crc32 modulo BUCKETS. All
documents and all target texts are counted (S features, s in a bucket; T and t), which gives every
bucket an integer gain, floor(SCALE * ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS)))). A document's weight is
the sum of the gains of its features.

The sum is taken on bit planes. The counts of a document's buckets are cut into planes of BUCKETS bits,
the k-th with the k-th bit of every count; the gains are planes in two's complement, whose highest one
counts negative. The number of features that have bit i in their count and bit j in their gain is the
popcount of two planes ANDed, and the weight is the sum of those numbers times 2^(i+j), exact in
integers and independent of the order of addition.

Tasks add up their own counts before the shuffle (at most BUCKETS rows a task); gains are BUCKETS numbers
at any size of the input, and go to the tasks with the code. score adds seeded Gumbel noise, so the
highest scores are a draw without replacement in proportion to exp(weight / SCALE). The rank is found
without a sort in one task: score ranges (cut points chosen by a sample, counted exactly) are ranked each
on its own, the rows of the ranges before are added, and ranges beyond the draw get no rank at all.

Null and empty texts have no features and weight 0. Null doc_ids are hashed as the text 'null'. Repeated
rows count as often as they stand there; ties of score and doc_id are broken by n_features and weight
(rows that agree in all are interchangeable). An empty table, or none eligible, draws nothing; an empty
target has T = 0. A very long text is one slice of its own. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.scratch import keep

BUCKETS, LOW, HIGH, SCALE = 10_000, 1, 1, 1000
SEED, MIN_WORDS, PERCENT = 2024, 20, 10
#: Ranges of scores that are ranked apart.
RANGES = 400
#: Words whose buckets a task remembers.
REMEMBERED = 1 << 16
#: The words of lower-cased UTF-8: digits, small letters and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text: bytes, low: int = LOW, high: int = HIGH) -> tuple[int, Counter]:
    """(number of words, how often each run of low to high words stands in the text)."""
    words = _WORD.findall(text.lower())  # bytes: A-Z only
    if low == high == 1:
        return len(words), Counter(words)
    return len(words), Counter(b" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1))


def bucket_counts(found: Counter, known: dict[bytes, int], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (with repeats) and counts of a document's features; `known` remembers buckets."""
    if len(known) > REMEMBERED:
        known.clear()
    place = np.empty(len(found), np.int64)
    for k, f in enumerate(found):
        b = known.get(f)
        if b is None:
            b = known[f] = zlib.crc32(f) % buckets
        place[k] = b
    return place, np.fromiter(found.values(), np.int64, len(found))


def _documents(column: pa.Array) -> Iterator[bytes]:
    for _, _, data, at in T.slices(column):
        body = data.tobytes()
        for k in range(len(at) - 1):
            yield body[at[k] : at[k + 1]]


def count_buckets(docs: DataFrame, buckets: int = BUCKETS, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(bucket, n): the features of all texts by bucket, added up within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), {}
        for batch in batches:
            for text in _documents(batch.column(0)):
                place, n = bucket_counts(features(text, low, high)[1], known, buckets)
                np.add.at(total, place, n)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, low: int = LOW, high: int = HIGH) -> np.ndarray:
    """The integer gain of every bucket."""
    both = []
    for table in (docs, target):
        n = np.zeros(buckets, np.int64)
        for r in count_buckets(table, buckets, low, high).collect():  # at most `buckets` rows
            n[r.bucket] = r.n
        both.append(n)
    s, t = both
    of_s, of_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(SCALE * math.log((float(y) + 1) * of_s / ((float(x) + 1) * of_t))) for x, y in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits x words): the k-th row has the k-th bit of every value, in two's complement, 64 to a word."""
    size = -(-len(values) // 64) * 64
    padded = np.zeros(size, np.int64)
    padded[: len(values)] = values
    return np.stack([np.packbits((padded >> k & 1).astype(np.uint8), bitorder="little").view(np.uint64) for k in range(bits)])


def gain_planes(gain: np.ndarray) -> np.ndarray:
    """Planes of signed gains; the last one is the sign."""
    return planes(gain, 1 + max(int(x).bit_length() for x in (gain.max(), -gain.min(), 1)))


def weigh(count: np.ndarray, gain: np.ndarray) -> int:
    """The sum of count * gain from the counts of all buckets and the planes of the gains.

    The counts' planes only hold the 64-bit words in which the document has a bucket at all.
    """
    if not count.any():
        return 0
    count = np.pad(count, (0, 64 * gain.shape[1] - len(count)))
    words = np.flatnonzero(count.reshape(-1, 64).any(1))
    mine = planes(count.reshape(-1, 64)[words].ravel(), int(count.max()).bit_length())
    ones = np.bitwise_count(mine[:, None, :] & gain[None, :, words]).sum(2, dtype=np.int64)  # by bit of count and of gain
    power = np.int64(1) << np.arange(len(gain), dtype=np.int64)
    power[-1] = -power[-1]
    return int((np.int64(1) << np.arange(len(mine), dtype=np.int64)) @ ones @ power)


def weights(docs: DataFrame, gain: np.ndarray, low: int = LOW, high: int = HIGH) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    sliced, buckets = gain_planes(gain), len(gain)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            out = []
            for text in _documents(batch.column(1)):
                n_words, found = features(text, low, high)
                place, n = bucket_counts(found, known, buckets)
                count = np.zeros(buckets, np.int64)
                np.add.at(count, place, n)
                out.append((n_words, int(n.sum()), weigh(count, sliced)))
            columns = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(columns[:, k]) for k in range(3)]], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """-ln(-ln(u)) of a seeded uniform number, times SCALE and floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """Adds rank 1, 2, 3 ... to floor(percent * N / 100) of the N eligible rows: the highest by score, then
    the least by doc_id; null else. `scored` is read several times, so it should be a stored table."""
    rows = scored.withColumn("_in", F.coalesce(eligible, F.lit(False)))
    cuts = rows.where("_in").select(F.percentile_approx("score", F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)]), F.lit(20 * RANGES))).first()[0]
    cuts = sorted(set(cuts or []))
    # number of cut points above the score: 0 holds the highest scores
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > F.col("score"))) if cuts else F.lit(0)
    rows = rows.withColumn("_range", place)
    counts = {r["_range"]: r["n"] for r in rows.where("_in").groupBy("_range").agg(F.count("*").alias("n")).collect()}  # a row for each range
    wanted, above, starts = percent * sum(counts.values()) // 100, 0, {}
    for k in sorted(counts):
        if above >= wanted:
            break
        starts[k] = above
        above += counts[k]
    asked = F.col("_in") & (F.col("_range") <= max(starts, default=-1))
    rest = rows.where(~asked).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    if not starts:
        return rest
    line = Window.partitionBy("_range").orderBy(F.desc("score"), "doc_id", "n_features", "weight")
    before = F.element_at(F.array(*[F.lit(starts.get(k, 0)).cast("long") for k in range(max(starts) + 1)]), F.col("_range") + 1)
    ranked = rows.where(asked).withColumn("rank", F.row_number().over(line) + before)
    return rest.unionByName(ranked.select(*scored.columns, F.when(F.col("rank") <= wanted, F.col("rank")).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs; target needs a column text."""
    weighed = weights(docs, gains(docs, target, buckets, low, high), low, high)
    scored = keep(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    return draw(scored, F.col("n_words") >= min_words, percent).select("doc_id", "n_features", "weight", "score", "rank")


_CLASS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ORACLE_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
words_ AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}') AS w FROM documents),
numbered AS (SELECT row_number() OVER () AS r, * FROM words_),
target_ AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}')) AS f FROM benchmark),
each_ AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest(w) AS f FROM numbered) GROUP BY r, f),
kinds AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM (SELECT f FROM each_ UNION ALL SELECT f FROM target_)),
bucket AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda k: CAST('0x' || substr(x, CAST(k AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c // 256, tab[1 + xor(c % 256, b)])), 4294967295) % {BUCKETS} AS b FROM kinds, crc),
s_ AS (SELECT b, sum(n) AS s FROM each_ JOIN bucket USING (f) GROUP BY b),
t_ AS (SELECT b, count(*) AS t FROM target_ JOIN bucket USING (f) GROUP BY b),
totals AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM s_) + {BUCKETS} AS DOUBLE) AS ss, CAST((SELECT coalesce(sum(t), 0) FROM t_) + {BUCKETS} AS DOUBLE) AS tt),
gain AS (SELECT b, CAST(floor(CAST({SCALE} AS DOUBLE) * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * ss / ((CAST(s AS DOUBLE) + 1) * tt))) AS BIGINT) AS g FROM s_ LEFT JOIN t_ USING (b), totals),
weight_ AS (SELECT r, CAST(sum(n * g) AS BIGINT) AS weight FROM each_ JOIN bucket USING (f) JOIN gain USING (b) GROUP BY r),
hashed AS (SELECT n.r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, CAST(CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS DOUBLE) AS h FROM numbered n LEFT JOIN weight_ USING (r)),
scored AS (SELECT *, weight + CAST(floor(CAST(-{SCALE} AS DOUBLE) * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM hashed),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS k, count(*) OVER () AS n FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN k <= {PERCENT} * n // 100 THEN CAST(k AS BIGINT) END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
