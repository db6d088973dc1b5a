"""Language ID by the nearest of several centroids per language.

A text is a TF-IDF vector over hashed byte n-grams (1 to 3) of its letters, scaled to length 1. For
every language of the sample, spherical k-means gives CENTROIDS centroids; the language of the most
similar centroid wins. The distance-based rejection marks texts that are further from every centroid
than all but REJECT of the sample's texts were: `accepted` is then false and the score halved.

Null texts and texts without a letter (Unicode category L) give `und` with score 0, not accepted.
Ties go to the first language by name. Repeated rows give the same prediction each and count once in
training. A very long text is one slice of its own; its counts are exact. An empty table gives an empty
result; without any labelled row every text gives `und`. Only doc_id (any type), text and, for training,
lang are read, so extra columns have no influence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.scratch import keep
from stintlake.llm.training import fold

BINS, CENTROIDS, ROUNDS, REJECT = 4096, 4, 12, 0.005
#: Bound of the training sample, in documents of each language. Every language that occurs is learned.
PER_LANGUAGE = 600
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_fold[[c for c in range(128) if not chr(c).isalpha()]] = 32


def vectors(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one dense row for each text of a slice."""
    clean = _fold[data]
    capital = np.flatnonzero((clean[1:] >= 0x80) & (clean[1:] < 0x9F) & (clean[:-1] == 0xC3)) + 1 if len(clean) else np.zeros(0, np.int64)
    clean[capital] += 32  # the Latin-1 capitals
    blank = clean == 32
    grams = clean.astype(np.int64)
    out = np.zeros((len(at) - 1, BINS))
    keys = []
    for n in (1, 2, 3):
        m = len(clean) - n + 1
        if m <= 0:
            break
        if n > 1:
            grams = grams[:m] * 257 + clean[n - 1 :] + n
        ok = ~(blank[:m] & blank[1 : m + 1]) if n == 3 and m < len(blank) else ~blank[:m]
        keys.append((ok, (grams[:m] * 0x9E3779B1 >> 7) % BINS))
    for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        for n, (ok, key) in enumerate(keys):
            end = max(a, b - n)
            part = key[a:end][ok[a:end]]
            out[k] += np.bincount(part, minlength=BINS)
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1)), 1e-9)[:, None]


def _sparse(sample: DataFrame) -> DataFrame:
    """lang, bins and counts (exact, of the bins that occur) of every text."""

    def encode(kept, data, at):
        rows = []
        for a in range(0, len(at) - 1, 128):
            part = at[a : a + 129]
            rows += list(vectors(data[part[0] : part[-1]], part - part[0]))
        some = [np.flatnonzero(r) for r in rows]
        return [kept[0], pa.array([b.tolist() for b in some], pa.list_(pa.int32())), pa.array([r[b].tolist() for r, b in zip(rows, some, strict=True)], pa.list_(pa.float64()))]

    return T.map_texts(sample, ["lang"], "text", encode, "lang string, bins array<int>, counts array<double>")


def _dense(table: pa.Table | pa.RecordBatch, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows of _sparse."""
    out = np.zeros((table.num_rows, BINS), np.float64)
    for k, (b, c) in enumerate(zip(table.column("bins").to_pylist(), table.column("counts").to_pylist(), strict=True)):
        out[k, b] = c
    return weigh(out, idf)


def k_means(own: np.ndarray, centroids: int = CENTROIDS) -> np.ndarray:
    """Spherical k-means from rows chosen by a fixed seed."""
    rng = np.random.default_rng(3)
    c = own[np.sort(rng.permutation(len(own))[: min(centroids, len(own))])]
    for _ in range(ROUNDS):
        near = (own @ c.T).argmax(1)
        c = np.stack([own[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(1)), 1e-9)[:, None]
    return c


def fit(sample: DataFrame) -> dict:
    """Learns from a frame (lang, text) that is bounded for each language.

    Each language's k-means is a task of its own; the driver receives document frequencies (BINS numbers)
    and CENTROIDS vectors of BINS floats a language (64 KB), and the rejection's quantile.
    """
    rows = keep(_sparse(sample))
    total = rows.count()
    if not total:
        return {"names": ["und"], "owner": np.zeros(1, np.int64), "centre": np.zeros((1, BINS)), "idf": np.ones(BINS), "floor": 2.0}
    seen = np.zeros(BINS)
    for r in rows.select(F.explode("bins").alias("bin")).groupBy("bin").count().collect():
        seen[r["bin"]] = r["count"]
    idf = np.log((1 + total) / (1 + seen)) + 1

    def cluster(group: pa.Table) -> pa.Table:
        rows = _dense(group, idf)
        centre = k_means(rows[np.lexsort(rows.T[::-64])])  # whatever order the rows came in
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(centre)), "centre": pa.array([c.astype(np.float32).tobytes() for c in centre], pa.binary())})

    found = sorted((r["lang"], bytes(r["centre"])) for r in rows.groupBy("lang").applyInArrow(cluster, "lang string, centre binary").collect())
    names = sorted({lang for lang, _ in found})
    centre = np.stack([np.frombuffer(c, np.float32) for _, c in found]).astype(np.float64)

    def nearest(batches):
        for batch in batches:
            for k in range(0, len(batch), 128):
                part = batch.slice(k, 128)
                yield pa.RecordBatch.from_arrays([pa.array((_dense(part, idf) @ centre.T).max(1))], names=["near"])

    floor = rows.mapInArrow(nearest, "near double").agg(F.percentile("near", REJECT)).first()[0]
    return {"names": names, "owner": np.array([names.index(lang) for lang, _ in found]), "centre": centre, "idf": idf, "floor": float(floor)}


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """A sample of at most per_language documents of every language, cut from a hash of id and text, of those
    with crc32(doc_id) mod 3 other than 1. Rows with equal language and text count once in it."""
    allowed = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.coalesce(fold("doc_id", 3) != 1, F.lit(False)) & F.col("text").isNotNull())
    allowed = allowed.withColumn("_place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)))
    # stored, so that its size is known when the join is planned: texts are shuffled only if it is large
    share = keep(allowed.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(1.2 * per_language) / F.count("*")).alias("_share")))
    some = allowed.join(share, "lang").where(F.col("_place") < F.col("_share") * (1 << 40)).groupBy("lang", "text").agg(F.min("_place").alias("_place"))
    line = Window.partitionBy("lang").orderBy("_place", "text")
    return fit(some.withColumn("_n", F.row_number().over(line)).where(F.col("_n") <= per_language).select("lang", "text"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every document."""
    model = train(docs)
    letters = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))

    def label(kept, data, at):
        own = []
        for a in range(0, len(at) - 1, 128):  # dense rows: a few megabytes at a time
            part = at[a : a + 129]
            own.append(weigh(vectors(data[part[0] : part[-1]], part - part[0]), model["idf"]) @ model["centre"].T)
        near = np.concatenate(own)
        best = near.argmax(1)
        top = np.clip(near[np.arange(len(near)), best], 0, 1).astype(np.float64)
        letter = kept[1].to_numpy(zero_copy_only=False)
        accepted = letter & (top >= model["floor"])
        names = np.array(model["names"], object)[model["owner"][best]]
        return [kept[0], pa.array(np.where(letter, names, "und"), pa.string()), np.where(letter, np.where(accepted, top, top / 2), 0.0), pa.array(accepted)]

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = T.map_texts(letters, ["doc_id", "_letter"], "text", label, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
