"""Removal of repeated byte strings by merging transforms of sampled suffixes.

Every byte that is covered by a LENGTH-byte string which also starts somewhere else (in the same
document or another one; never across documents) is removed. Strings are judged on the input. The same
steps over words instead of bytes count the words in passages of WORDS words and more that occur in
another document, too.

A Burrows-Wheeler transform of all suffixes, merged by refining an interleave once for each byte of
depth, would move every byte of the corpus 400 times (measured: see README). So the suffixes are sampled
by content, and only what is not settled by counts is merged:

1. Sampling. The anchor of a string is its least gram in a hash order (leftmost on ties). Equal
   strings have equal anchors at the same place, so strings need only be compared with those of the
   same anchor. Consecutive starts share an anchor: about one stored row for 176 bytes or 22 words. A row
   is (anchor hash, hash of all that its starts cover), computed within each input shard.
2. Grouped counts settle most rows: an anchor seen once has no repeat; two rows that cover the same are
   repeats throughout.
3. Merge. What is left are anchors with several kinds of covered bytes. One example of each kind gives
   one sampled suffix (what follows the anchor) and, as in a Burrows-Wheeler transform, what stands
   before it. The interleave of the suffixes of an anchor is refined eight bytes at a time; blocks of
   one suffix are settled and leave, so most suffixes move a few times only, and splits give the
   common prefixes of neighbours. The column of what stands before is interleaved likewise, backwards.
   A start is repeated if another suffix shares its block at both depths. Bytes are compared, not hashes.
4. An anchor of more than HOT_KINDS kinds is not merged in one task: the hashes of its strings are
   counted by Spark instead, with the same result.

Null texts count as empty. Repeated rows are repeats of each other (for passages of words, rows with equal
id are one document). Documents shorter than 400 bytes stay whole; of very long ones a task holds one at a time. An empty table
gives an empty result. Only doc_id (any type that casts to a number, else it is an error) and text are
read. Memory of a task is a few times its largest document, or HOT_KINDS strings of less than 800 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.scratch import keep


class Unit(NamedTuple):
    """What strings are made of: their length and the gram's in units, bytes a unit, and whether only
    another document counts as elsewhere."""

    length: int
    gram: int
    width: int
    across: bool


LENGTH, WORDS, HOT_KINDS = 400, 51, 4096
BYTES, PASSAGES = Unit(LENGTH, 50, 1, False), Unit(WORDS, 8, 8, True)
_LOW = np.uint64((1 << 31) - 1)  # the low bits of an ordered gram hold its place


def _units(data: np.ndarray, at: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit code of every unit, offsets of the rows in units, and the units as bytes."""
    if unit.width == 1:
        return T.PLAIN[data], at, data
    start, end, row = T.words(data, at)
    codes = T.span_hash(T.prefix_hash(data), start, end)
    return codes, T.per_row(row, len(at) - 1), codes.view(np.uint8)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.uint64((1 << 64) - 1))
    full[: len(x)] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchored(codes: np.ndarray, at: np.ndarray, unit: Unit = BYTES):
    """(row, first start, last start, anchor, anchor's hash, hash of what is covered); places count in units."""
    none = np.zeros(0, np.int64)
    if len(codes) < unit.length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    begin = np.arange(len(codes) - unit.gram + 1)
    grams = T.span_hash(T.prefix_of(codes), begin, begin + unit.gram)
    least = _sliding_least((grams & ~_LOW) | begin.astype(np.uint64), unit.length - unit.gram + 1)
    edge = np.zeros(len(codes) + 1, np.int32)
    long = np.flatnonzero(np.diff(at) >= unit.length)
    np.add.at(edge, at[long], 1)
    np.add.at(edge, at[long + 1] - unit.length + 1, -1)
    start = np.flatnonzero(np.cumsum(edge)[: len(least)] > 0)  # strings that lie inside one row
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor = (least[start] & _LOW).astype(np.int64)
    turn = np.flatnonzero(np.diff(anchor)) + 1  # rows have anchors of their own, so they part here too
    first, last = start[np.append(0, turn)], start[np.append(turn, len(start)) - 1]
    anchor = anchor[np.append(0, turn)]
    covered = T.prime_hash(T.prime_prefix(codes), first, last + unit.length)
    return np.searchsorted(at, first, "right") - 1, first, last, anchor, grams[anchor], T.mix(covered + (anchor - first).astype(np.uint64))


# --- the merge -----------------------------------------------------------------------------------------


def _symbols(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian eight-byte symbols of each string, zeros after its end, and the lengths."""
    size = np.array([len(s) for s in strings], np.int64)
    wide = -(-max(int(size.max(initial=0)), 1) // 8) * 8
    out = np.zeros((len(strings), wide), np.uint8)
    out[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(strings), np.uint8)
    return out.view(">u8").astype(np.uint64), size


def interleave(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings in order within their groups, and the bytes that each has in common with the one before
    it (-1 at the first of a group).

    Blocks of strings that agree so far are split symbol by symbol; a block of one is settled.
    """
    symbols, size = _symbols(strings)
    order = np.lexsort((size, group))  # a string that ends comes before those that go on
    n = len(order)
    common = np.full(n, -1, np.int64)
    head = np.ones(n, bool)
    head[1:] = group[order][1:] != group[order][:-1]
    for s in range(symbols.shape[1]):
        alone = head & np.append(head[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        block = np.cumsum(head)[open_]
        key = symbols[order[open_], s]
        turn = np.lexsort((key, block))  # stable; blocks stay where they are
        order[open_], key = order[open_][turn], key[turn]
        split = np.flatnonzero(~head[open_][1:] & (key[1:] != key[:-1])) + 1
        differ = key[split] ^ key[split - 1]
        lead = 7 - np.floor(np.log2(np.maximum((differ >> np.uint64(32)).astype(np.float64), 0.5))).astype(np.int64) // 8 - 4
        low = 7 - np.floor(np.log2(np.maximum((differ & np.uint64(0xFFFFFFFF)).astype(np.float64), 0.5))).astype(np.int64) // 8
        common[open_[split]] = 8 * s + np.where(differ >> np.uint64(32) > 0, lead, low)
        head[open_[split]] = True
    same = ~head
    common[same] = size[order[1:]][same[1:]] if n else 0  # never split: they agree to the shorter one's end
    inside = common >= 0
    common[inside] = np.minimum(common, np.minimum(size[order], np.append(0, size[order][:-1])))[inside]
    return order, common


def repeated_starts(group: np.ndarray, strings: list[bytes], place: np.ndarray, who: np.ndarray, unit: Unit = BYTES) -> list[np.ndarray]:
    """For each string the starts (in units) of its substrings of unit.length that are also in a string of the same group with
    the same distance to the anchor and with another `who`. place: units before the string's anchor."""
    n, w = len(strings), unit.width
    length = np.array([len(s) // w for s in strings])
    whole = [np.frombuffer(s, np.uint8).reshape(-1, w) for s in strings]
    after, after_common = interleave(group, [x[p:].tobytes() for x, p in zip(whole, place, strict=True)])
    before, before_common = interleave(group, [x[:p][::-1].tobytes() for x, p in zip(whole, place, strict=True)])
    spot_after, spot_before = np.empty(n, np.int64), np.empty(n, np.int64)
    spot_after[after], spot_before[before] = np.arange(n), np.arange(n)
    line = np.arange(n)
    far, near = place, place - (length - unit.length)  # distances of the first and the last start
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(int(near.min(initial=0)), int(far.max(initial=-1)) + 1):
        own = np.flatnonzero((near <= d) & (d <= far))
        if len(own) < 2:
            continue
        right = np.maximum.accumulate(np.where(after_common < (unit.length - d) * w, line, 0))[spot_after[own]]
        left = np.maximum.accumulate(np.where(before_common < d * w, line, 0))[spot_before[own]]
        key = right * n + left
        turn = np.argsort(key, kind="stable")
        own, key = own[turn], key[turn]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.minimum.reduceat(who[own], first) != np.maximum.reduceat(who[own], first)
        hit = own[np.repeat(several, np.diff(np.append(first, len(own))))]
        found.append((hit, place[hit] - d))
    if not found:
        return [np.zeros(0, np.int64)] * n
    kind, start = (np.concatenate(x) for x in zip(*found, strict=True))
    turn = np.lexsort((start, kind))
    start, cut = start[turn], np.searchsorted(kind[turn], np.arange(n + 1))
    return [start[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = np.flatnonzero(np.diff(x) > 1) + 1
    return x[np.append(0, turn)], x[np.append(turn, len(x)) - 1]


# --- the tables ----------------------------------------------------------------------------------------


def _identity() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("id"), F.xxhash64(text, F.length(text)).alias("tx")]


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """columns, id, tx and the compressed text: texts go through two shuffles."""
    rows = docs.select(*columns, *_identity(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.slice(k, 512)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([squeeze.compress(x) for x in part.columns[-1].to_pylist()], pa.binary())], names=part.schema.names)

    return rows.mapInArrow(pack, rows.schema)


def _sampled(docs: DataFrame) -> DataFrame:
    """The rows of both units, from one scan; `words` marks those of PASSAGES, whose anchors have other hashes."""

    def sample(kept, data, at):
        out = []
        for unit in (BYTES, PASSAGES):
            codes, cut, _ = _units(data, at, unit)
            row, first, last, anchor, name, covered = anchored(codes, cut, unit)
            ids, tx = (c.to_numpy()[row] for c in kept)
            base, name = cut[row], T.mix(name + np.uint64(unit.width))
            out.append([ids, tx, np.full(len(row), unit.across), (first - base).astype(np.int32), (last - base).astype(np.int32), (anchor - first).astype(np.int16), name.view(np.int64), covered.view(np.int64)])
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    return T.map_texts(docs.select(*_identity(), "text"), ["id", "tx"], "text", sample, "id long, tx long, words boolean, first int, last int, place short, anchor long, covered long")


_EXAMPLE = "words boolean, anchor long, covered long, settled boolean, who long, id long, tx long, first int, place short, bytes binary"
_EXAMPLE_TYPES = [pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.binary()]
_NAMES = [f.split()[0] for f in _EXAMPLE.split(", ")]
_KEY = ["anchor", "covered", "id", "tx", "first"]
_SPANS = "id long, tx long, words boolean, low int, high int"


def _examples(kinds: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the units covered by the example of each kind."""
    by_doc = kinds.groupBy("id", "tx").agg(F.collect_set(F.struct("words", "anchor", "covered", "settled", "who", "first", "last", "place")).alias("list"))
    texts = _packed(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                texts = T.buffers(pa.array([unpack.decompress(t) for t in part.column(3).to_pylist()], pa.large_binary()))
                views = {unit.across: (unit, *_units(*texts, unit)[1:]) for unit in (BYTES, PASSAGES)}
                flat = []
                for n, (i, t, own) in enumerate(zip(*(part.column(c).to_pylist() for c in range(3)), strict=True)):
                    for x in own:
                        unit, at, body = views[x["words"]]
                        piece = body[unit.width * (at[n] + x["first"]) : unit.width * (at[n] + x["last"] + unit.length)].tobytes()
                        flat.append((x["words"], x["anchor"], x["covered"], x["settled"], x["who"], i, t, x["first"], x["place"], piece))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat, strict=True)), _EXAMPLE_TYPES, strict=True)], names=_NAMES)

    # a set, and one row of those that repeat an id and text: they bring one example, not one each
    joined = by_doc.join(texts, ["id", "tx"]).dropDuplicates(["id", "tx"]).select("id", "tx", "list", "text")
    return joined.mapInArrow(cut, _EXAMPLE)


def _merged(examples: DataFrame, batch_bytes: int = 1 << 20) -> DataFrame:
    """Repeated starts of the kinds that are not repeated as a whole; whole anchors at a time."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        out: list[tuple] = []
        for unit in (BYTES, PASSAGES):
            own = list({tuple(r[c] for c in _KEY): r for r in rows if r["words"] is unit.across}.values())
            column = lambda c: np.array([r[c] for r in own], np.int64)  # noqa: E731, B023
            starts_of = repeated_starts(column("anchor"), [r["bytes"] for r in own], column("place"), column("who"), unit)
            for r, starts in zip(own, starts_of, strict=True):
                if not r["settled"] and len(starts):
                    low, high = _runs(starts)
                    out += [(r["id"], r["tx"], unit.across, r["first"] + a, r["first"] + b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()], strict=True)], names=["id", "tx", "words", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for k in range(0, len(batch), 256):
                for r in batch.slice(k, 256).to_pylist():
                    if size >= batch_bytes and r["anchor"] != held[-1]["anchor"]:
                        yield solve(held)
                        held, size = [], 0
                    held.append(r)
                    size += len(r["bytes"])
        if held:
            yield solve(held)

    return examples.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _SPANS)


def _counted(examples: DataFrame) -> DataFrame:
    """The same for anchors of very many kinds: counts of string hashes, spread over all tasks."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                for unit in (BYTES, PASSAGES):
                    part = batch.slice(k, 256)
                    part = part.filter(pa.array([w is unit.across for w in part.column(0).to_pylist()]))
                    data, at = T.buffers(part.column(9))
                    codes, at = (T.PLAIN[data], at) if unit.width == 1 else (np.frombuffer(data.tobytes(), np.uint64), at // 8)
                    count = np.diff(at) - unit.length + 1
                    row = np.repeat(np.arange(len(part)), count)
                    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                    start = at[row] + inside
                    hashed = T.prime_hash(T.prime_prefix(codes), start, start + unit.length).view(np.int64)
                    take = lambda i: part.column(i).to_numpy(zero_copy_only=False)[row]  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((take(1), take(3), take(4), take(5), take(6), take(0), take(7) + inside, hashed), types, strict=True)], names=names)

    schema = "anchor long, settled boolean, who long, id long, tx long, words boolean, low int, hash long"
    names, types = [f.split()[0] for f in schema.split(", ")], [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64()]
    rows = keep(examples.dropDuplicates(_KEY).mapInArrow(explode, schema))
    several = keep(rows.groupBy("anchor", "hash").agg(F.min("who").alias("_a"), F.max("who").alias("_b")).where("_a != _b").select("anchor", "hash"))
    return rows.where("NOT settled").join(several, ["anchor", "hash"]).select("id", "tx", "words", "low", F.col("low").alias("high"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, tx, words, low, high): starts low..high of the document are starts of repeated strings; they
    count bytes, or words where `words` is true."""
    rows = keep(_sampled(docs))
    counts = [F.count("*").alias("times"), F.min("id").alias("_a"), F.max("id").alias("_b")]
    several = F.when(F.col("words"), F.col("_a") != F.col("_b")).otherwise(F.col("times") > 1)
    seen = rows.groupBy("words", "anchor").agg(F.min("covered").alias("_low"), F.max("covered").alias("_high"), *counts).where(several)
    anchors = keep(seen.select("anchor", (F.col("_low") != F.col("_high")).alias("mixed")))
    known = keep(rows.join(anchors, "anchor"))
    span = ["id", "tx", "words", F.col("first").alias("low"), F.col("last").alias("high")]
    mixed = known.where("mixed")
    example = [F.first(c).alias(c) for c in ("tx", "first", "last", "place", "id")]  # all of one row
    grouped = mixed.groupBy("words", "anchor", "covered").agg(*counts, *example).withColumn("settled", several)
    who = F.when(F.col("settled") | ~F.col("words"), F.col("covered")).otherwise(F.col("id"))
    columns = ["words", "anchor", "covered", "settled", "who", "id", "tx", "first", "last", "place"]
    kinds = keep(grouped.withColumn("who", who).select(*columns, "times"))
    again = mixed.join(kinds.where("settled").select("anchor", "covered"), ["anchor", "covered"])
    spans = known.where("NOT mixed").select(*span).union(again.select(*span))
    # what one document repeats has an example at each place
    alone = F.col("words") & ~F.col("settled") & (F.col("times") > 1)
    places = mixed.join(kinds.where(alone).select("anchor", "covered", "settled", "who"), ["anchor", "covered"])
    kinds = kinds.where(~alone).select(*columns).union(places.select(*columns))
    hot = keep(kinds.groupBy("anchor").count().where(F.col("count") > HOT_KINDS).select("anchor"))
    spans = spans.union(_merged(_examples(kinds.join(hot, "anchor", "left_anti"), docs)))
    if hot.limit(1).count():
        spans = spans.union(_counted(_examples(kinds.join(hot, "anchor", "left_semi"), docs)))
    return spans


def _cover(low: np.ndarray, high: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Union of the ranges [low, high + length)."""
    out: list[tuple[int, int]] = []
    for i in np.lexsort((high, low)).tolist():
        a, b = int(low[i]), int(high[i]) + length
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, shared_words, n_passages, kept (the remaining bytes) of every row."""
    # a set: rows with equal id and text bring the same spans
    by_doc = keep(repeated_spans(docs)).groupBy("id", "tx").agg(F.collect_set(F.struct("words", "low", "high")).alias("list"))
    texts = _packed(docs, "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                rows = []
                for packed, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    text = unpack.decompress(packed)
                    cover, passages = (_cover(np.array([s["low"] for s in spans or [] if s["words"] is w], np.int64), np.array([s["high"] for s in spans or [] if s["words"] is w], np.int64), n) for w, n in ((False, LENGTH), (True, WORDS)))
                    ends = [0, *[x for c in cover for x in c], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                    rows.append((len(text), len(text) - len(kept), len(cover), hashlib.sha256(kept).hexdigest(), sum(b - a for a, b in passages), len(passages), kept))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shared_words", "n_passages", "kept"])

    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shared_words long, n_passages long, kept binary"
    return texts.join(by_doc, ["id", "tx"], "left").select("doc_id", "text", "list").mapInArrow(run, out)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, shared_words and n_passages of every row."""
    return dedup(docs).drop("kept")
