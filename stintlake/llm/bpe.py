"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The leaves of the tree are the pairs of a word's neighbouring symbols, as rank * size + position; its
root is therefore the leftmost pair of the lowest rank. Merging it changes at most three leaves, each
in logarithmic time, until the root says that no pair can be merged: a word of n bytes takes
O(n log n), whatever its pairs.

The vocabulary is a tokenizers JSON file; its path is a parameter. The file (some 1.5 MB, independent
of the documents) is read on the driver and sent to the tasks. The added token is cut out of the text
first, as the library does. Words repeat, so each task keeps the ids of the words it has met, up to
CACHE_WORDS, then starts afresh.

Null texts count as empty and give no tokens. Repeated rows give the same result each; ties of rank are
broken by the leftmost position. A very long text is encoded word by word, so it takes a few times its
bytes; a very long word takes a tree of its own. An empty table gives an empty result. Only doc_id (any
type) and text are read, so extra columns have no influence.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: How the vocabulary's pre-tokenizer cuts text (a fixed value of the byte-level format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS, CACHE_BYTES = 250_000, 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, source: str):
        found = json.loads(source)
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        vocab = found["model"]["vocab"]
        self.first = [vocab[c] for c in letters]
        self.rank: dict[int, int] = {}
        self.result: list[int] = []
        for k, pair in enumerate(found["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << 32 | vocab[b], k)
            self.result.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in found["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.piece = [b""] * size
        for token, i in vocab.items():
            self.piece[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.added.items():
            self.piece[i] = token.encode()
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.cache: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.first[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        rank, none = self.rank, 1 << 62
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        shift = size.bit_length() - 1
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[size + i] = r << shift | i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

        def put(i: int, value: int) -> None:
            i += size
            if tree[i] == value:
                return
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                least = a if a < b else b
                if tree[i] == least:
                    return
                tree[i] = least
                i >>= 1

        while tree[1] != none:
            at = tree[1] & (size - 1)
            ids[at] = self.result[tree[1] >> shift]
            gone = after[at]
            after[at] = following = after[gone]
            ids[gone] = -1
            if gone < n - 1:
                put(gone, none)
            if following < n:
                before[following] = at
                r = rank.get(ids[at] << 32 | ids[following])
                put(at, none if r is None else r << shift | at)
            else:
                put(at, none)
            left = before[at]
            if left >= 0:
                r = rank.get(ids[left] << 32 | ids[at])
                put(left, none if r is None else r << shift | left)
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> bytes:
        out = np.array(self.merge(word.encode()), "<u4").tobytes()
        if len(word) <= CACHE_BYTES:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        get, make = self.cache.get, self._word
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(self.added[part].to_bytes(4, "little"))
            else:
                out += [get(w) or make(w) for w in self.words.findall(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        piece = self.piece
        return b"".join([piece[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_known: dict[str, Bpe] = {}


def _bpe(source: str) -> Bpe:
    key = hashlib.md5(source.encode()).hexdigest()
    if key not in _known:
        _known[key] = Bpe(source)
    return _known[key]


def encode_and_decode(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, with ids=True the ids as well."""
    with open(path or default_path(), encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(source.value)
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                codes = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                columns = [pa.array([len(c) // 4 for c in codes], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in codes], pa.string()), pa.array([hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in codes], pa.string())]
                if ids:
                    columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in codes], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
