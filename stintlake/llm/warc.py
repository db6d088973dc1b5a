"""A deterministic sharded WARC writer and its reader.

write() turns every row of a table of pages into a WARC/1.1 record, each a gzip member of its own:

* Records are sorted by page_id. The cuts between shards are ids taken at equal steps from the ids with
  the least hashes, and their number follows from the bytes of the payloads alone, so the archives don't
  depend on how many machines or partitions there are: equal tables give equal files, byte by byte.
* A shard is written by one task that streams through its sorted rows; a file is closed as soon as its
  compressed size reaches ROLL_BYTES. Dates, record ids and gzip headers are fixed by the content.
* Of records with equal payloads of at least `least_bytes` bytes the one with the smallest page_id is a
  response, the others are revisits (profile identical-payload-digest) that refer to it and have no
  payload. Who refers to whom comes from grouped minima over (page_id, hash), which are dealt into the
  same sorted shards, so the payloads are shuffled once and a payload of a third of all rows is no hot
  key anywhere.
* Files are written under _temporary with a name of their own for each attempt of a task. The manifest
  of the attempts that Spark accepted is stored, those files are renamed (again and again without harm),
  and only then the folder's manifest appears. Readers only open what the manifest names, so neither lost
  executors nor attempts that ran twice leave anything behind in a result.

read() opens the files of the manifest, one task for several files, and streams through their records.
Every block and payload is hashed again and compared with its header, every file with the manifest's
record count; what differs is an error that names file and offset.

Null html is an empty payload, a null url has no WARC-Target-URI. Rows with one page_id and payload: the
first (by url) is written as above, the others are revisits of the same page_id; of different
payloads each is a record. Null page_ids stand before all others and refer like others, but are only
referred to where no row with that payload has an id. page_id must be a whole number. A very long page
is one record in memory. An empty table gives a manifest without files. Columns besides page_id, url
and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm.scratch import folder, keep

#: Bytes of payloads that make a shard, unless that gave more than SHARDS of them.
SHARD_BYTES, SHARDS = 32 << 20, 20_000
#: Ids that are looked at for each cut; at most SHARDS * PER_CUT numbers reach the driver.
PER_CUT = 16
ROLL_BYTES, LEAST_BYTES, DATE = 4 << 20, 0, "2024-01-01T00:00:00Z"
#: Compression level of gzip: 6 is its default.
LEVEL = 6
# Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
_MANIFEST = "shard int, part int, name string, attempt string, records long, bytes long, first_id long, last_id long"


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str) -> str:
    """A url on one line: what is not printable ASCII is percent-encoded."""
    return "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in url.encode())


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A whole record as one gzip member without a time stamp."""
    head = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"WARC-Date: {DATE}", f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + END + block + END) + packer.flush()


def page_record(name: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response, or a revisit if it refers to another page; `name` is the page's id, made unique."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    fields = [("WARC-Record-ID", f"<urn:page:{name}>"), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if refers_to is None:
        return record("response", fields, http + payload)
    return record("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], http)


def _cuts(ids: DataFrame, shards: int) -> np.ndarray:
    """Ascending ids, each the first of a shard, at equal steps of the ids with the least hashes."""
    known = ids.where("page_id IS NOT NULL").select("page_id").distinct()
    few = known.orderBy(F.xxhash64("page_id"), "page_id").limit(PER_CUT * shards).collect() if shards > 1 else []
    found = np.sort(np.array([r.page_id for r in few], np.int64))
    return np.unique(found[[len(found) * k // shards for k in range(1, shards)]]) if len(found) else found


def _references(ids: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, same, first) of the rows whose payload also stands under another id, `first` the least."""
    large = ids.where(F.col("n") >= least_bytes)
    firsts = large.groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("_rows")).where("_rows > 1 AND first IS NOT NULL")
    # the added empty bytes hide that the rows are dealt by hash already: with an exchange on both sides
    # of the join, adaptive execution can split the partition of a hot payload
    firsts = firsts.select(F.concat("same", F.lit(b"")).alias("same"), "first")
    return large.join(firsts, "same").where("NOT (page_id <=> first)").select("page_id", "same", "first")


class _Shard:
    """Writes the records of a shard into files that roll by compressed size."""

    def __init__(self, base: str, shard: int, roll: int):
        self.store, self.base = fs.FileSystem.from_uri(base)
        self.shard, self.roll, self.part, self.stream = shard, roll, 0, None

    def add(self, page_id: int | None, data: bytes) -> tuple | None:
        """Writes a record; gives the manifest's row of the file if that is full now."""
        if self.stream is None:
            self.name = f"part-{self.shard:05d}-{self.part:05d}.warc.gz"
            self.attempt = f"{self.base}/_temporary/{uuid.uuid4().hex}-{self.name}"
            self.stream = self.store.open_output_stream(self.attempt, compression=None)
            info = f"software: stintlake\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {self.shard}\r\n".encode()
            head = record("warcinfo", [("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info)
            self.stream.write(head)
            self.records, self.bytes, self.first = 0, len(head), page_id
        self.stream.write(data)
        self.records, self.bytes, self.last = self.records + 1, self.bytes + len(data), page_id
        return self.close() if self.bytes >= self.roll else None

    def close(self) -> tuple | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream, self.part = None, self.part + 1
        return self.shard, self.part - 1, self.name, self.attempt.rpartition("/")[2], self.records, self.bytes, self.first, self.last


def _written(base: str, least_bytes: int, roll: int):
    """Streams over the sorted rows (shard, page_id, same, first, url, html) of one shard or several; rows
    without html but with `first` are references, and stand before the page they are about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, refers, key, names = None, None, None, {}

        def rows(*files) -> Iterator[pa.RecordBatch]:
            done = [f for f in files if f]
            if done:
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _MANIFEST.split(", ")])

        for batch in batches:
            shards, ids, same, first, urls, html = (batch.column(k) for k in range(6))
            for k in range(batch.num_rows):
                shard, page_id, hashed = shards[k].as_py(), ids[k].as_py(), same[k].as_py()
                if out is None or out.shard != shard:
                    yield from rows(out and out.close())
                    out, names = _Shard(base, shard, roll), {}
                if key is None or key[0] != page_id:
                    names = {"used": 0}  # records of this page_id so far
                if key != (page_id, hashed):
                    key, refers, again = (page_id, hashed), None, False
                if first[k].is_valid:
                    refers = first[k].as_py()
                    continue
                payload = html[k].as_buffer().to_pybytes() if html[k].is_valid else b""
                target = str(refers) if refers is not None else None
                if target is None and again and len(payload) >= least_bytes:
                    target = "null" if page_id is None else str(page_id)
                again, names["used"] = True, names["used"] + 1
                name = ("null" if page_id is None else str(page_id)) + (f":{names['used']}" if names["used"] > 1 else "")
                yield from rows(out.add(page_id, page_record(name, urls[k].as_py(), payload, target)))
        yield from rows(out and out.close())

    return run


def write(pages: DataFrame, base: str, least_bytes: int = LEAST_BYTES, roll: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the archives of `pages` to the folder `base`, which all machines share, and returns the
    manifest: name, records, bytes and id range of every file. A folder that has a manifest is an error."""
    spark, text = pages.sparkSession, F.coalesce("html", F.lit(""))
    store, root = fs.FileSystem.from_uri(base)
    if store.get_file_info(f"{root}/manifest").type != fs.FileType.NotFound:
        raise ValueError(f"{base} has a manifest already")
    store.create_dir(f"{root}/_temporary", recursive=True)
    ids = keep(pages.select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha2(text, 256)).alias("same"), F.octet_length(text).cast("long").alias("n")))
    total = ids.agg(F.sum("n")).first()[0] or 0
    cuts = _cuts(ids, min(SHARDS, 1 + total // shard_bytes))

    @F.pandas_udf("int")
    def shard(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, page_id.to_numpy(np.int64), "right").astype(np.int32))

    least = F.lit(-(1 << 63))
    columns = lambda first, url, html: ["page_id", "same", first.alias("first"), url.alias("url"), html.alias("html")]
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha2(text, 256)).alias("same"), "url", "html")
    records = records.select(*columns(F.lit(None).cast("long"), F.col("url"), F.coalesce("html", F.lit("")).cast("binary")))
    refers = _references(ids, least_bytes).select(*columns(F.col("first"), F.lit(None).cast("string"), F.lit(None).cast("binary")))
    dealt = records.unionByName(refers).withColumn("shard", shard(F.coalesce("page_id", least)))
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "same", F.col("first").isNull(), "url")
    done = keep(dealt.select("shard", "page_id", "same", "first", "url", "html").mapInArrow(_written(base, least_bytes, roll), _MANIFEST))
    _commit(done, base)
    store.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{base}/manifest")


def _commit(done: DataFrame, base: str) -> None:
    """Renames the files of the accepted attempts, then writes the manifest."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            for name, attempt in zip(batch.column("name").to_pylist(), batch.column("attempt").to_pylist(), strict=True):
                if store.get_file_info(f"{root}/_temporary/{attempt}").type != fs.FileType.NotFound:
                    store.move(f"{root}/_temporary/{attempt}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {attempt} nor {name} is in {base}")
            yield batch

    done.mapInArrow(rename, _MANIFEST).drop("attempt").write.parquet(f"{base}/manifest")


def records(data: Iterator[bytes], name: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record of a file of gzip members, given in pieces."""
    member, parts, offset, at = zlib.decompressobj(31), [], 0, 0
    for piece in data:
        while piece:
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
            piece = member.unused_data
            if member.eof:
                head, found, rest = b"".join(parts).partition(END)
                lines = head.decode().split("\r\n")
                fields = dict(line.split(": ", 1) for line in lines[1:])
                size = int(fields.get("Content-Length", -1))
                if not found or lines[0] != VERSION or len(rest) != size + len(END) or not rest.endswith(END):
                    raise ValueError(f"{name}: no whole record at {offset}")
                yield offset, fields, rest[:size]
                member, parts, offset = zlib.decompressobj(31), [], at
    if parts:
        raise ValueError(f"{name}: the member at {offset} ends too early")


def checked(fields: dict[str, str], block: bytes, where: str) -> tuple[str, int, bytes | None]:
    """(payload digest, payload bytes, payload or None for a revisit) of a page's record; both digests
    and the length are compared with the headers."""
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"{where}: the block's digest differs")
    http, _, payload = block.partition(END)
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        return said, size, None
    if len(payload) != size or said != digest(payload):
        raise ValueError(f"{where}: the payload differs from its header")
    return said, size, payload


def _pieces(stream, size: int = 1 << 18) -> Iterator[bytes]:
    while piece := stream.read(size):
        yield piece


_PAGE = "name string, offset long, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def read(spark: SparkSession, base: str, payload: bool = True) -> DataFrame:
    """The records of all archives of a folder: file name and offset, page_id, url, record_type, refers_to,
    payload_digest, payload_bytes, and the payload (null for revisits; left out if not asked for)."""
    manifest = spark.read.parquet(f"{base}/manifest")
    files = manifest.count()
    schema = _PAGE + (", payload binary" if payload else "")
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), *([pa.binary()] if payload else [])]

    def number(urn: str | None) -> int | None:
        found = urn and urn.removeprefix("<urn:page:").rstrip(">").split(":")[0]
        return int(found) if found and found != "null" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        batch_of = lambda held: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])
        for batch in batches:
            for name, expected in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist(), strict=True):
                held, size, seen = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, fields, block in records(_pieces(stream), name):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        said, n, body = checked(fields, block, f"{name} at {offset}")
                        row = (name, offset, number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"], number(fields.get("WARC-Refers-To")), said, n)
                        held.append((*row, body) if payload else row)
                        seen, size = seen + 1, size + (len(block) if payload else 200)
                        if size > 1 << 22:
                            yield batch_of(held)
                            held, size = [], 0
                if seen != expected:
                    raise ValueError(f"{name} has {seen} records, its manifest says {expected}")
                if held:
                    yield batch_of(held)

    few = max(1, min(files, 4 * spark.sparkContext.defaultParallelism))
    return manifest.select("name", "records").repartition(few).mapInArrow(run, schema)


def archive(pages: DataFrame, base: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives of `pages` and reads them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to of every row. Without `base` they go to a new folder in spark.checkpoint.dir."""
    spark = pages.sparkSession
    base = base or f"{folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, base, least_bytes)
    kind = pages.schema["page_id"].dataType
    return read(spark, base, payload=False).select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, octet_length(encode(h)) AS n, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST(1 + (CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN n >= {LEAST_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {LEAST_BYTES} AND page_id <> first THEN first END AS refers_to
FROM d
"""
