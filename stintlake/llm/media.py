"""MPEG audio columns: bytes stored losslessly in an MPEG stream, and a reader for such streams.

The writer lays a payload into MPEG-2 layer III frames (16 kHz, mono, 144 kbit/s, 648 bytes, 576
samples): header, CRC-16, nine bytes of side information that say "no main data", then 576 payload
bytes as ancillary data and a few filling bytes. A decoder plays silence; the payload is in the
stream byte by byte. In front stand an ID3v2.3 tag (with the unpadded length) and a frame with a
Xing table (frames, bytes, 100 seek points).

The reader knows all MPEG-1/2/2.5 layers I to III frame headers. It skips an ID3v2 tag, reads its text
frames, finds the first header that another one follows at the expected distance, follows the chain,
looks for the next such pair after damaged bytes, reads Xing/Info tables, compares CRCs, and adds up
exact durations (samples over rate, as a fraction) and frame offsets.

Null texts count as empty: the payload is then 576 bytes of 255. A stream without a frame gives zero
frames and an empty payload. Equal texts have equal streams, repeated rows equal values; nothing is
compared between rows, so there are no ties. A very long text is one stream: a task holds it and its
frames' offsets, some three times its bytes. An empty table gives an empty result. Only doc_id (any type)
and text are read, so extra columns have no influence.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame

UNIT, FRAME, SIDE = 576, 648, 9
# Fixed values of the MPEG audio format (ISO/IEC 11172-3 and 13818-3): kbit/s by header index.
KBITS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
# Fixed values of the same standards: samples a second by version bits and header index.
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
#: sync, MPEG-2, layer III, with CRC; 144 kbit/s, 16 kHz; mono.
HEADER = bytes([0xFF, 0xF2, 0xD8, 0xC0])


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        value = byte << 8
        for _ in range(8):
            value = (value << 1 ^ 0x8005 if value & 0x8000 else value << 1) & 0xFFFF
        table.append(value)
    return table


_TABLE = _crc_table()


def crc16(data: bytes) -> int:
    value = 0xFFFF
    for byte in data:
        value = (value << 8 & 0xFFFF) ^ _TABLE[value >> 8 ^ byte]
    return value


def pad(data: bytes) -> bytes:
    return data + b"\xff" * (UNIT - len(data) % UNIT if len(data) % UNIT or not data else 0)


def _frame(body: bytes) -> bytes:
    side = bytes(SIDE)
    return HEADER + _FRAME_CRC + side + body.ljust(FRAME - 6 - SIDE, b"\0")


_FRAME_CRC = crc16(HEADER[2:] + bytes(SIDE)).to_bytes(2, "big")


def encode(data: bytes) -> bytes:
    """The stream that holds data, padded."""
    payload = pad(data)
    count = len(payload) // UNIT
    note = b"\x00n_bytes\x00" + str(len(data)).encode()
    tag = b"TXXX" + struct.pack(">IH", len(note), 0) + note
    size = len(tag)
    tag = b"ID3\x03\x00\x00" + bytes(size >> s & 0x7F for s in (21, 14, 7, 0)) + tag
    total = FRAME * (count + 1)
    seek = bytes(min(255, int((FRAME * (1 + count * k // 100)) * 256 / total)) for k in range(100))
    table = b"Xing" + struct.pack(">III", 7, count, total) + seek
    return b"".join([tag, _frame(table), *[_frame(payload[i : i + UNIT]) for i in range(0, len(payload), UNIT)]])


_headers: dict[bytes, tuple | None] = {}


def header(four: bytes) -> tuple | None:
    """(bytes, samples, samples a second, has CRC, side information bytes, kbit/s) or None."""
    if four in _headers:
        return _headers[four]
    out = None
    if len(four) == 4 and four[0] == 0xFF and four[1] >> 5 == 7:
        version, layer, rate, index = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3), four[2] >> 2 & 3, four[2] >> 4
        if version != 1 and layer != 4 and rate != 3 and 0 < index < 15:
            old = 1 if version == 3 else 2
            kbits, hertz, extra, mono = KBITS[old, layer][index], RATES[version][rate], four[2] >> 1 & 1, four[3] >> 6 == 3
            samples = 384 if layer == 1 else 1152 if layer == 2 or old == 1 else 576
            size = (12 * kbits * 1000 // hertz + extra) * 4 if layer == 1 else samples // 8 * kbits * 1000 // hertz + extra
            side = 0 if layer != 3 else (17 if mono else 32) if old == 1 else (9 if mono else 17)
            out = (size, samples, hertz, not four[1] & 1, side, kbits)
    if len(_headers) < 4096:
        _headers[four] = out
    return out


def _text_frames(tag: bytes) -> dict[str, str]:
    found, at = {}, 0
    while at + 10 <= len(tag) and tag[at]:
        size = int.from_bytes(tag[at + 4 : at + 8], "big")
        name, body = tag[at : at + 4].decode("latin-1"), tag[at + 10 : at + 10 + size]
        if name == "TXXX" and body[:1] == b"\0":
            key, _, value = body[1:].partition(b"\0")
            found[key.decode("latin-1")] = value.decode("latin-1")
        elif name[:1] == "T" and body[:1] == b"\0":
            found[name] = body[1:].decode("latin-1")
        at += 10 + size
    return found


def read(stream: bytes) -> dict:
    """Payload, tags, seek table and statistics of a stream, damaged ones included."""
    at, tags = 0, {}
    if stream[:3] == b"ID3" and len(stream) >= 10:
        at = 10 + sum((b & 0x7F) << s for b, s in zip(stream[6:10], (21, 14, 7, 0), strict=True))
        tags = _text_frames(stream[10:at])
    checked: dict[bytes, bool] = {}
    frames, bodies, skipped, good, bad = [], [], 0, 0, 0
    length, table, samples, rates, kbits, chained = Fraction(0), None, 0, {}, {}, False
    n = len(stream)
    while at + 4 <= n:
        head = header(stream[at : at + 4])
        end = at + head[0] if head else 0
        # a frame counts if the chain led here or another header, or the stream's end, follows it
        if not head or end > n or not (chained or end == n or header(stream[end : end + 4])):
            nxt = stream.find(b"\xff", at + 1)
            nxt = n if nxt < 0 else nxt
            skipped, at, chained = skipped + nxt - at, nxt, False
            continue
        size, count, hertz, has_crc, side, rate = head
        start = at + 4 + 2 * has_crc
        if has_crc:
            part = stream[at + 2 : at + 6] + stream[start : start + side]
            if part not in checked:
                if len(checked) > 4096:
                    checked.clear()
                checked[part] = int.from_bytes(part[2:4], "big") == crc16(part[:2] + part[4:])
            ok = checked[part]
            good, bad = good + ok, bad + (not ok)
        if not frames and table is None and stream[start + side : start + side + 4] in (b"Xing", b"Info"):
            flags, spot, table = int.from_bytes(stream[start + side + 4 : start + side + 8], "big"), start + side + 8, {}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    table[name], spot = int.from_bytes(stream[spot : spot + 4], "big"), spot + 4
            table["seek"] = stream[spot : spot + 100] if flags & 4 else b""
        else:
            frames.append(at)
            bodies.append(stream[start + side : start + side + UNIT])
            samples += count
            rates[hertz] = rates.get(hertz, 0) + count
            kbits[rate] = kbits.get(rate, 0) + 1
        at, chained = end, bool(header(stream[end : end + 4])) or end == n
    for hertz, count in rates.items():
        length += Fraction(count, hertz)
    return {"payload": b"".join(bodies), "tags": tags, "table": table, "frames": frames, "samples": samples, "length": length, "skipped": skipped + n - at if at < n else skipped, "crc_good": good, "crc_bad": bad, "kbits": kbits}


def feature(found: dict) -> str:
    """One line of text with what the reader found, exact and in a fixed order."""
    length, frames, table = found["length"], found["frames"], found["table"] or {}
    points = [frames[len(frames) * k // 10] for k in range(10)] if frames else []
    rates = ",".join(f"{k}x{v}" for k, v in sorted(found["kbits"].items()))
    return f"frames={len(frames)};table={table.get('frames', -1)};samples={found['samples']};seconds={length.numerator}/{length.denominator};kbits={rates};crc={found['crc_good']}/{found['crc_bad']};skipped={found['skipped']};seek={','.join(map(str, points))}"


def store(docs: DataFrame) -> DataFrame:
    """doc_id and the stream (media, binary) of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encode(t or b"") for t in texts], pa.binary())], names=["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, media binary")


def describe(media: DataFrame) -> DataFrame:
    """Reads streams back: digests, tags, the duration (seconds, and exactly as a fraction), the byte offset
    of every frame and the feature line."""
    kind = media.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, seconds double, samples long, duration string, frame_offsets array<long>"
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.string(), pa.list_(pa.int64())]

    def row(stream: bytes) -> tuple:
        found = read(stream)
        payload = found["payload"]
        return (int(found["tags"].get("n_bytes", -1)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stream), hashlib.sha256(stream).hexdigest(), feature(found), float(found["length"]), found["samples"], f"{found['length'].numerator}/{found['length'].denominator}", found["frames"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                rows = list(zip(*[row(s or b"") for s in part.column(1).to_pylist()], strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(rows, types, strict=True)]], names=[f.split()[0] for f in schema.split(", ")])

    return media.select("doc_id", "media").mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The digest columns of every text, with the exact duration and the offset of every frame."""
    return describe(store(docs)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "seconds", "samples", "duration", "frame_offsets")
